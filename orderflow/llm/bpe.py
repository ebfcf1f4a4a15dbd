"""Byte-level BPE encoding and decoding by a tree reduction over a monoid of encoded stretches of text.

An element is the encoding of one stretch as if it stood alone: where its pieces (matches of the splitting pattern)
start, and the tokens of every piece. A stretch of more than LEAF characters is the join of its two halves:

* Pieces. A piece of the left half that ends REACH characters before the half's end is final, since no match depends on
  more than that. From the first other one the pattern runs on; the first match that ends where a piece of the right
  half starts ends the repair, because matching depends only on what follows. Pieces that grew together from old ones
  keep their tokens and join them as below.
* Tokens. Inside a piece, lowest rank first, leftmost first. A row of tokens is the encoding of its bytes exactly if
  every two neighbours are the encoding of theirs: merges inside a token never look beyond it, so the first merge over
  some boundary would also happen with just its two neighbours. A window around the seam is merged anew and grows on
  each side, doubling, until its outermost token is the old one or fits the old one outside. Pieces that are new to the
  cache are encoded the same way, by halves down to SHORT bytes.

Decoding concatenates the bytes of tokens up a tree of halves.

A worker holds the rows of one step besides the batch that Spark sends it, and remembers pieces by the bytes they take.

Letter, number and white-space classes are those of the tiktoken library, which is asked for them, since Unicode
versions differ between libraries.

Defined cases: a null text is encoded like an empty one, as no ids; null ids, and null or unknown ids in a row of ids,
stand for no bytes; equal texts and repeated rows are encoded each for itself; texts may have any length; an empty table
gives no rows; the result column replaces one of its name, other columns stay.
"""

from __future__ import annotations

import base64
import heapq
import re
import sys
from array import array
from collections.abc import Callable, Iterator
from functools import cache, reduce
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

#: Characters of a stretch that is split at once; tokens whose bytes are joined at once.
LEAF = 4096
#: No match of the pattern depends on more than so many characters after its end (the longest contraction, and the
#: character after a run).
REACH = 3
#: Bytes of the pieces, and of the pairs of tokens, that a Python worker remembers at most; the longest such piece.
PIECES, PAIRS, LONGEST = 96 << 20, 32 << 20, 48
#: Bytes that an entry takes in a dictionary's table and by the rounding of its key and value.
ENTRY = 64
#: Bytes of text, or ids, that a worker turns at once; a longer row is turned alone.
STEP = 1 << 20
#: Bytes of a piece, or of a window, that are merged by looking for the lowest rank along a row.
SHORT = 24


class Recent(dict):
    """Remembers what was used lately: once half full, what was not used since the time before is forgotten.

    ``most``: entries, or the sum of what ``size`` gives for their keys and values.
    """

    def __init__(self, most: int, size: Callable[[object, object], int] = lambda key, value: 1):
        super().__init__()
        self.half, self.size, self.held, self.older = most // 2, size, 0, {}

    def keep(self, key, value):
        size = self.size(key, value)
        if self.held + size > self.half:
            self.older = dict(self)
            self.clear()
            self.held = 0
        self.held += size
        self[key] = value
        return value

    def __missing__(self, key):
        found = self.older.get(key)
        return None if found is None else self.keep(key, found)


def bytes_taken(key: object, value: object) -> int:
    return ENTRY + sys.getsizeof(key) + sys.getsizeof(value)


def packed(tokens: list[int]) -> bytes:
    return array("i", tokens).tobytes()


def unpacked(tokens: bytes) -> list[int]:
    return array("i", tokens).tolist()


@cache
def character_class(escape: str, last: int = 0x10FFFF) -> str:
    """The inside of a Python character class for what the tiktoken library takes as ``escape``, such as ``\\p{L}``."""
    import tiktoken

    every = "".join(map(chr, chain(range(0xD800), range(0xE000, last + 1))))
    bytewise = tiktoken.Encoding("classes", pat_str=escape, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
    points = [ord(c) for c in bytes(bytewise.encode_ordinary(every)).decode()]
    starts = [p for p, before in zip(points, [-2, *points]) if p != before + 1]
    ends = [p for p, after in zip(points, [*points[1:], -2]) if p != after - 1]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts, ends))


def as_python(pattern: str, last: int = 0x10FFFF) -> str:
    """The splitting pattern for Python's ``re``, its classes spelled out, for texts of characters up to ``last``."""
    inside, out = False, []
    for part in re.findall(r"\\[pP]\{\w+\}|\\.|.", pattern, re.DOTALL):
        if re.match(r"\\p\{|\\s", part):
            spelled = character_class(part, last)
            part = spelled if inside else f"[{spelled}]"
        elif part == r"\S" and not inside:
            part = f"[^{character_class(chr(92) + 's', last)}]"
        elif part in ("[", "]"):
            inside = part == "["
        out.append(part)
    return "".join(out)


class Codec:
    """``vocabulary``: lines of base64 bytes and rank; ``patterns``: from ``as_python``, every character in some match.

    The first pattern is for texts whose characters have 16 bits, where a class is one table look-up, the second for others.
    """

    def __init__(self, vocabulary: bytes, patterns: tuple[str, str], unmade: frozenset[bytes] | None = None):
        self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        self.bytes = {rank: token for token, rank in self.rank.items()}
        self.patterns = [re.compile(p) for p in patterns]
        self.beyond = re.compile("[\U00010000-\U0010ffff]")
        self.pieces, self.seams = Recent(PIECES, bytes_taken), Recent(PAIRS, bytes_taken)
        #: Tokens that merges alone do not make; the library gives a piece equal to one its rank all the same.
        self.unmade = self.find_unmade() if unmade is None else unmade

    def find_unmade(self) -> frozenset[bytes]:
        return frozenset(token for token in self.rank if len(self.merged(token)) > 1)

    def merged(self, data: bytes) -> list[int]:
        """The tokens of a window: the pair of lowest rank is merged, of equal ones the leftmost, until none is left."""
        return self._merged_in_heap(data) if len(data) > SHORT else self._merged_in_row(data)

    def _merged_in_row(self, data: bytes) -> list[int]:
        rank, none = self.rank.get, len(self.rank)
        parts = [data[i : i + 1] for i in range(len(data))]
        pairs = [rank(data[i : i + 2], none) for i in range(len(data) - 1)]
        while pairs and (lowest := min(pairs)) < none:
            i = pairs.index(lowest)
            parts[i] += parts.pop(i + 1)
            del pairs[i]
            if i < len(pairs):
                pairs[i] = rank(parts[i] + parts[i + 1], none)
            if i:
                pairs[i - 1] = rank(parts[i - 1] + parts[i], none)
        return [self.rank[p] for p in parts]

    def _merged_in_heap(self, data: bytes) -> list[int]:
        """The same in n log n steps."""
        rank, n = self.rank, len(data)
        end, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank.get(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or end[i] >= n or end[end[i]] != stop:
                continue  # one of the two has grown meanwhile
            alive[end[i]] = False
            end[i] = stop
            if stop < n:
                before[stop] = i
                if (r := rank.get(data[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            left = before[i]
            if left >= 0 and (r := rank.get(data[left:stop])) is not None:
                heapq.heappush(heap, (r, left, stop))
        out, i = [], 0
        while i < n:
            out.append(rank[data[i : end[i]]])
            i = end[i]
        return out

    def _pair(self, left: int, right: int) -> list[int]:
        """The tokens that two neighbouring tokens become; empty where they fit, that is, stay."""
        found = self.seams[left, right]
        if found is None:
            found = self.merged(self.bytes[left] + self.bytes[right])
            self.seams.keep((left, right), found := [] if found == [left, right] else found)
        return found

    def joined(self, left: list[int], right: list[int]) -> list[int]:
        """The tokens of two neighbouring stretches, neither empty, of one piece."""
        window, a, b = self._pair(left[-1], right[0]), 1, 1
        if not window:
            return left + right
        while True:
            more_left = a < len(left) and window[0] != left[-a] and self._pair(left[-a - 1], window[0])
            more_right = b < len(right) and window[-1] != right[b - 1] and self._pair(window[-1], right[b])
            if not more_left and not more_right:
                return left[:-a] + window + right[b:]
            a, b = min(len(left), a << bool(more_left)), min(len(right), b << bool(more_right))
            window = self.merged(b"".join(map(self.bytes.__getitem__, chain(left[-a:], right[:b]))))

    def _halves(self, data: bytes) -> list[int]:
        if len(data) <= SHORT:
            return self._merged_in_row(data)
        half = len(data) // 2
        return self.joined(self._halves(data[:half]), self._halves(data[half:]))

    def piece(self, text: str) -> bytes:
        """The tokens that merges make of one piece, packed."""
        found = self.pieces[text]
        if found is None:
            found = packed(self._halves(text.encode()))
            if len(text) <= LONGEST:
                self.pieces.keep(text, found)
        return found

    def _stretch(self, pattern: re.Pattern, text: str, low: int, high: int) -> tuple[list[int], list[bytes]]:
        """(starts, packed tokens) of the pieces of text[low:high]."""
        if high - low <= LEAF:
            found = pattern.findall(text, low, high)
            ends = list(accumulate(map(len, found), initial=low))
            if ends.pop() != high:
                raise ValueError("the pattern leaves characters out")
            known = self.pieces
            return ends, [known[p] or self.piece(p) for p in found]
        middle = (low + high) // 2
        starts, tokens = self._stretch(pattern, text, low, middle)
        right = self._stretch(pattern, text, middle, high)
        keep, end = len(starts), middle
        while keep and end > middle - REACH:
            keep -= 1
            end = starts[keep]
        old_starts, old_tokens = starts[keep:], tokens[keep:]  # the old pieces from where the repair begins
        del starts[keep:], tokens[keep:]
        at, i, j = end, 0, 0
        while at < high:
            stop = pattern.match(text, at, high).end()
            parts, first = [], None
            while i < len(old_starts) and old_starts[i] < stop:
                first = old_starts[i] if first is None else first
                parts.append(old_tokens[i])
                i += 1
            while j < len(right[0]) and right[0][j] < stop:
                first = right[0][j] if first is None else first
                parts.append(right[1][j])
                j += 1
            after = old_starts[i] if i < len(old_starts) else right[0][j] if j < len(right[0]) else high
            starts.append(at)
            if first == at and after == stop:
                tokens.append(packed(reduce(self.joined, map(unpacked, parts))) if len(parts) > 1 else parts[0])
            else:
                tokens.append(self.piece(text[at:stop]))
            at = stop
            if i == len(old_starts) and after == stop:
                break
        starts += right[0][j:]
        tokens += right[1][j:]
        return starts, tokens

    def encode(self, text: str) -> list[int]:
        return unpacked(self.encode_packed(text))

    def encode_packed(self, text: str) -> bytes:
        if not text:
            return b""
        pattern = self.patterns[bool(self.beyond.search(text))]
        starts, tokens = self._stretch(pattern, text, 0, len(text))
        if self.unmade:
            words = (text[a:b].encode() for a, b in zip(starts, [*starts[1:], len(text)]))
            tokens = [packed([self.rank[w]]) if w in self.unmade else t for w, t in zip(words, tokens)]
        return b"".join(tokens)


def joined_bytes(tokens: pa.Array, starts: np.ndarray) -> pa.Array:
    """The bytes of rows of tokens, ``starts`` with the end last: by stretches of LEAF, then by pairs until one is left."""
    width, nothing = LEAF, pa.scalar(b"", tokens.type)
    while True:
        counts = np.diff(starts)
        groups = -(-counts // width)
        at = np.repeat(starts[:-1] - width * (np.cumsum(groups) - groups), groups) + width * np.arange(groups.sum())
        lists = pa.LargeListArray.from_arrays(np.append(at, starts[-1]), tokens)
        tokens = pc.binary_join(lists, nothing)
        starts, width = np.concatenate([[0], np.cumsum(groups)]), 2
        if (groups <= 1).all():
            lists = pa.LargeListArray.from_arrays(starts, tokens)
            return pc.binary_join(lists, nothing)  # a row without tokens is empty


class Tokenizer:
    """A vocabulary read once on the driver (a file of a few megabytes) and sent to the tasks."""

    def __init__(self, vocabulary: bytes, pattern: str):
        self.patterns = as_python(pattern, 0xFFFF), as_python(pattern)
        self.vocabulary = vocabulary
        self.unmade = Codec(vocabulary, self.patterns).unmade

    def codec(self) -> Codec:
        return Codec(self.vocabulary, self.patterns, self.unmade)


def load(path: str, pattern: str) -> Tokenizer:
    """A vocabulary file in tiktoken's form and its splitting pattern."""
    with open(path, "rb") as file:
        return Tokenizer(file.read(), pattern)


def _with_column(df: DataFrame, source: str, target: str, kind: str, run) -> DataFrame:
    # not to be evaluated again for each use of the column
    return df.withColumn(target, F.arrow_udf(run, kind).asNondeterministic()(F.col(f"`{source}`")))


def _steps(rows: pa.Array, lengths: pa.Array) -> Iterator[pa.Array]:
    """The rows in runs that are STEP and one row long at most."""
    before = np.cumsum(np.append(0, np.asarray(pc.fill_null(lengths, 0), np.int64)))[:-1]
    starts = np.flatnonzero(np.diff(before // STEP, prepend=-1))
    for start, end in zip(starts, [*starts[1:], len(rows)]):
        yield rows[start:end]


def _encoded(codec: Codec, texts: pa.Array) -> pa.Array:
    rows = [codec.encode_packed(text.as_py() or "") for text in texts]
    ends = np.cumsum([0, *map(len, rows)]) // array("i").itemsize
    ids = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(rows))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)


def _token_bytes(of: dict[int, bytes]) -> pa.Array:
    """The bytes of every id, in order of ids."""
    return pa.array([of.get(i) for i in range(max(of) + 1)], pa.large_binary())


def _decoded(tokens: pa.Array, lists: pa.Array) -> pa.Array:
    """``tokens``: from ``_token_bytes``."""
    if not len(lists):
        return pa.array([], pa.binary())
    starts = np.asarray(lists.offsets).astype(np.int64)
    ids = lists.values[starts[0] : starts[-1]]
    starts -= starts[0]
    known = pc.and_(pc.greater_equal(ids, 0), pc.less(ids, len(tokens)))
    found = pc.fill_null(tokens.take(pc.if_else(known, ids, None)), b"")
    lengths = np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
    if (lengths != np.diff(starts)).any():  # a null row may stand over ids
        return _decoded(tokens, pa.array(lists.to_pylist(), lists.type))
    return joined_bytes(found, starts).cast(pa.binary())


def _codec_of(df: DataFrame, tokenizer: Tokenizer) -> Callable[[], Codec]:
    """Gives tasks the codec."""
    sent = df.sparkSession.sparkContext.broadcast({"arguments": (tokenizer.vocabulary, tokenizer.patterns, tokenizer.unmade)})
    # a worker that is used again finds the codec of its last task, with what that remembers, beside the broadcast value
    return lambda: sent.value.get("codec") or sent.value.setdefault("codec", Codec(*sent.value["arguments"]))


def encode(df: DataFrame, tokenizer: Tokenizer, text: str = "text", ids: str = "ids") -> DataFrame:
    """All rows with the token ids of the whole text, without special tokens."""
    codec_of = _codec_of(df, tokenizer)

    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = codec_of()
        for part in parts:
            for rows in _steps(part, pc.binary_length(part)):
                yield _encoded(codec, rows)

    return _with_column(df, text, ids, "array<int>", run)


def decode(df: DataFrame, tokenizer: Tokenizer, ids: str = "ids", data: str = "decoded") -> DataFrame:
    """All rows with the bytes of their ids; bytes, as a cut row of ids need not be UTF-8."""
    sent = df.sparkSession.sparkContext.broadcast(tokenizer.vocabulary)

    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = _token_bytes({int(rank): base64.b64decode(token) for token, rank in map(bytes.split, sent.value.splitlines())})
        for part in parts:
            for rows in _steps(part, pc.list_value_length(part)):
                yield _decoded(tokens, rows)

    return _with_column(df, ids, data, "binary", run)


def encode_and_decode(df: DataFrame, tokenizer: Tokenizer, text: str = "text", ids: str = "ids", data: str = "decoded") -> DataFrame:
    """``encode``, then ``decode`` of its ids, in one Python worker per task, where two would each hold their batch."""
    codec_of = _codec_of(df, tokenizer)

    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = codec_of()
        tokens = _token_bytes(codec.bytes)
        for part in parts:
            for rows in _steps(part, pc.binary_length(part)):
                found = _encoded(codec, rows)
                yield pa.StructArray.from_arrays([found, _decoded(tokens, found)], ["ids", "data"])

    both = _with_column(df, text, "_both", "struct<ids: array<int>, data: binary>", run)
    return both.withColumns({ids: F.col("_both.ids"), data: F.col("_both.data")}).drop("_both")

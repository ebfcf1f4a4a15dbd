"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` cuts the training texts into blocks and stores, per block, every term's positions: a row holds the
sorted term hashes, the number of positions of each term, and all positions term by term. ``phrase_hits`` takes the
test windows in query blocks of bounded size. In every index block a window starts from its rarest term there: that
term's positions, less the term's offset in the window, are candidate starts, and they are intersected with the
offset-adjusted positions of the other terms, rarest first. ``near_hits`` finds spans that hold all terms of a window
in any order and may have any length. Documents stand apart by a gap in the positions, so no phrase crosses their border;
spans that do are dropped.

A window is ``length`` consecutive item words; an item of fewer words, but not none, is one window.

Defined cases: null and empty texts have no words and no hits; items without words give no window; repeated documents
are judged one by one; items sharing an id count as one item; a null item id counts as the id ``''``; a document is
indexed whole in one block, however long; empty tables give no rows, or no hits.
"""

from __future__ import annotations

from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from orderflow.llm.words import ALPHANUMERIC, blocks
from orderflow.session import scratch_path

LENGTH = 10
GAP = 64  # positions between documents
BLOCK_BYTES = 4 << 20
#: Item words per query block, 8 bytes each: the largest broadcast.
QUERY_WORDS = 2_000_000
CANDIDATES = 1 << 21  # candidate starts looked at together


def _pack(numbers: np.ndarray) -> bytes:
    """Differences of 32-bit numbers, low bytes first, so that the file's compression finds the zeros."""
    return np.diff(numbers.astype(np.uint32), prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint32).ravel(), dtype=np.uint32).astype(np.int64)


def build_index(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The stored index: (block, ids, n_words, terms, counts, positions)."""
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"block string, ids array<{kind}>, n_words array<bigint>, terms binary, counts binary, positions binary"

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for i, batch in enumerate(blocks(batches, "_text", BLOCK_BYTES)):
            words, n = ALPHANUMERIC.hashes(batch.column("_text"))
            first = np.cumsum(n) - n + GAP * np.arange(1, len(n) + 1)
            positions = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(len(words))
            order = np.argsort(words, kind="stable")
            terms, counts = np.unique(words, return_counts=True)
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([f"{part}-{i}"]),
                "ids": pa.array([batch.column("_id").to_pylist()], pa.list_(batch.column("_id").type)),
                "n_words": pa.array([n.tolist()], pa.list_(pa.int64())),
                "terms": pa.array([terms.tobytes()], pa.binary()),
                "counts": pa.array([counts.astype(np.uint32).tobytes()], pa.binary()),
                "positions": pa.array([_pack(positions[order])], pa.binary()),
            })

    path = scratch_path(spark, "postings")
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).mapInArrow(build, schema)
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


class Windows:
    """The windows of one query block: terms, each window's term numbers (-1 beyond its end) and its item."""

    def __init__(self, ids: list[str], texts: pa.Array, length: int):
        words, n = ALPHANUMERIC.hashes(texts)
        self.ids, begin = ids, np.cumsum(n) - n
        self.terms, number = np.unique(words, return_inverse=True)
        many = np.where(n > 0, np.maximum(n - length + 1, 1), 0)
        self.item = np.repeat(np.arange(len(n)), many)
        start = np.repeat(begin - (np.cumsum(many) - many), many) + np.arange(many.sum())
        self.size = np.minimum(n, length)[self.item]
        at = start[:, None] + np.arange(length)
        self.words = np.where(np.arange(length) < self.size[:, None], np.append(number, -1)[np.minimum(at, len(words))], -1)


def query_blocks(items: DataFrame, text: str, item_id: str, length: int) -> Iterator[Windows]:
    """The items in blocks of at most QUERY_WORDS words (or one longer item)."""
    size = F.coalesce(F.length(text), F.lit(0))
    rows = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")), F.col(text)).where(size > 0)
    ids, texts, words = [], [], 0
    for name, value in rows.toLocalIterator():
        ids.append(name)
        texts.append(value)
        words += len(value) // 2 + 1
        if words >= QUERY_WORDS:
            yield Windows(ids, pa.array(texts, pa.large_string()), length)
            ids, texts, words = [], [], 0
    if ids:
        yield Windows(ids, pa.array(texts, pa.large_string()), length)


class _Postings:
    """The positions, in one index block, of the terms of a query block."""

    def __init__(self, row: dict, terms: np.ndarray):
        known, count = np.frombuffer(row["terms"], np.uint64), np.frombuffer(row["counts"], np.uint32).astype(np.int64)
        n = np.asarray(row["n_words"], np.int64)
        self.first = np.cumsum(n) - n + GAP * np.arange(1, len(n) + 1)
        self.end = int(self.first[-1] + n[-1]) if len(n) else 0
        positions = _unpack(row["positions"])
        at = np.minimum(np.searchsorted(known, terms), max(len(known) - 1, 0))
        found = known[at] == terms if len(known) else np.zeros(len(terms), bool)
        self.count = np.where(found, count[at] if len(known) else 0, 0)
        before = (np.cumsum(count) - count)[at] if len(known) else self.count
        self.start = np.cumsum(self.count) - self.count
        take = np.repeat(before - self.start, self.count) + np.arange(self.count.sum())
        self.keys = (np.repeat(np.arange(len(terms)), self.count) << 33) | positions[take]

    def has(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        key = (term << 33) | position
        at = np.searchsorted(self.keys, key)
        return self.keys[np.minimum(at, len(self.keys) - 1)] == key

    def candidates(self, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(windows, their words' order from the rarest, (window, position of its rarest word) rows)."""
        counts = np.where(words >= 0, self.count[words], np.iinfo(np.int64).max)
        alive = np.flatnonzero((counts > 0).all(axis=1))
        order = np.argsort(counts[alive], axis=1, kind="stable")
        rarest = words[alive, order[:, 0]] if len(alive) else np.zeros(0, np.int64)
        many = self.count[rarest]
        group = (np.cumsum(many) - many) // CANDIDATES
        for g in np.unique(group):
            part = np.flatnonzero(group == g)
            m = many[part]
            row = np.repeat(np.arange(len(part)), m)
            take = np.repeat(self.start[rarest[part]] - (np.cumsum(m) - m), m) + np.arange(m.sum())
            yield alive[part], order[part], np.stack([row, self.keys[take] & ((1 << 33) - 1)])

    def phrases(self, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
        """(window, start) of all exact occurrences."""
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for ids, order, (row, position) in self.candidates(windows.words):
            start = position - order[row, 0]
            for j in range(1, order.shape[1]):
                offset = order[row, j]
                term = windows.words[ids[row], offset]
                keep = (term < 0) | self.has(np.maximum(term, 0), start + offset)
                row, start = row[keep], start[keep]
            out.append((ids[row], start))
        return tuple(np.concatenate(x) for x in zip(*out))

    def near(self, windows: Windows, span: int) -> tuple[np.ndarray, ...]:
        """(window, first, last) of the shortest span of at most ``span`` words from each start that holds all terms."""
        out = [(np.zeros(0, np.int64),) * 3]
        for ids, _, (row, position) in self.candidates(windows.words):
            for back in range(span):  # the span starts at most so far before the rarest word
                start = position - back
                window, last, fits = ids[row], start.copy(), np.zeros(len(row), bool)
                ok = start >= 0
                for j in range(windows.words.shape[1]):
                    term = windows.words[window, j]
                    at = np.searchsorted(self.keys, (np.maximum(term, 0) << 33) | np.maximum(start, 0))
                    key = self.keys[np.minimum(at, len(self.keys) - 1)]
                    here = key & ((1 << 33) - 1)
                    ok &= (term < 0) | ((key >> 33 == term) & (here >= start) & (here < start + span))
                    last = np.where(term >= 0, np.maximum(last, here), last)
                    fits |= (term >= 0) & (here == start)
                inside = np.searchsorted(self.first, start, "right") == np.searchsorted(self.first, last, "right")
                keep = ok & fits & inside & (last < start + span)
                out.append((window[keep], start[keep], last[keep]))
        found = np.unique(np.stack([np.concatenate(x) for x in zip(*out)]), axis=1)
        return tuple(found)


def _search(index: DataFrame, windows: Windows, mode: str, span: int) -> DataFrame:
    kind = index.schema["ids"].dataType.elementType.simpleString()
    item = "array<string>" if mode == "phrase" else "array<struct<item:string,first:bigint,last:bigint>>"
    schema = f"block string, doc int, id {kind}, n_words bigint, runs array<struct<s:bigint,e:bigint>>, items {item}"
    sent = index.sparkSession.sparkContext.broadcast(vars(windows))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = SimpleNamespace(**sent.value)
        for batch in batches:
            for row in batch.to_pylist():
                p = _Postings(row, q.terms)
                runs, items = [[] for _ in row["ids"]], [[] for _ in row["ids"]]
                if len(p.keys) and mode == "phrase":
                    window, start = p.phrases(q)
                    edge = np.zeros(p.end + GAP + 1, np.int64)
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + q.size[window], -1)
                    hit = np.diff((np.cumsum(edge) > 0).astype(np.int8), prepend=0)
                    for s, e in zip(np.flatnonzero(hit == 1).tolist(), np.flatnonzero(hit == -1).tolist()):
                        d = int(np.searchsorted(p.first, s, "right")) - 1
                        runs[d].append({"s": s, "e": e})
                    doc = np.searchsorted(p.first, start, "right") - 1
                    for d, i in np.unique(np.stack([doc, q.item[window]]), axis=1).T.tolist():
                        items[d].append(q.ids[i])
                elif len(p.keys):
                    for w, s, e in zip(*(x.tolist() for x in p.near(q, span))):
                        d = int(np.searchsorted(p.first, s, "right")) - 1
                        items[d].append({"item": q.ids[q.item[w]], "first": s - int(p.first[d]), "last": e - int(p.first[d])})
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([row["block"]] * len(runs)),
                    "doc": pa.array(range(len(runs)), pa.int32()),
                    "id": pa.array(row["ids"], batch.schema.field("ids").type.value_type),
                    "n_words": pa.array(row["n_words"], pa.int64()),
                    "runs": pa.array(runs, pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))),
                    "items": pa.array(items, pa.list_(
                        pa.string() if mode == "phrase" else pa.struct([("item", pa.string()), ("first", pa.int64()), ("last", pa.int64())])
                    )),
                })

    return index.mapInArrow(search, schema)


def phrase_hits(
    index: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", length: int = LENGTH
) -> DataFrame:
    """(id, n_words, n_hit, items) of every document: words in exact occurrences, sorted ids of the items with any."""
    found = [_search(index, w, "phrase", 0) for w in query_blocks(items, text, item_id, length)]
    if not found:
        found = [_search(index, Windows([], pa.array([], pa.large_string()), length), "phrase", 0)]
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    rows = rows.groupBy("block", "doc").agg(
        F.any_value("id").alias("id"), F.any_value("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("runs"))).alias("runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    # runs of different query blocks may overlap
    covered = F.aggregate(
        "runs",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda a, r: F.struct(
            (a["n"] + F.greatest(F.lit(0), r["e"] - F.greatest(r["s"], a["end"]))).alias("n"),
            F.greatest(r["e"], a["end"]).alias("end"),
        ),
        lambda a: a["n"],
    )
    return rows.select("id", "n_words", covered.alias("n_hit"), "items")


def near_hits(
    index: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", length: int = LENGTH, span: int = 20
) -> DataFrame:
    """(id, item, first, last): word ranges of at most ``span`` words that hold all words of a window in any order."""
    out = index.sparkSession.createDataFrame([], f"id {index.schema['ids'].dataType.elementType.simpleString()}, item string, first bigint, last bigint")
    for windows in query_blocks(items, text, item_id, length):
        rows = _search(index, windows, "near", span).select("id", F.explode("items").alias("_hit"))
        out = out.unionByName(rows.select("id", "_hit.item", "_hit.first", "_hit.last"))
    return out.distinct()

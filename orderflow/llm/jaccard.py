"""Exact Jaccard self-join of shingle sets by a universe-partitioned pigeonhole with one-deletion neighbourhoods.

Two sets that link differ in at most ``difference`` elements. Per size band the universe of shingles is hashed into
segments, more than that number, so linked sets agree on whole segments. Each segment's elements make one signature.
Some segments of a band also get their one-deletion neighbourhood, the signatures with one element left out: if no
neighbourhood meets, each of these segments holds two differences. From the other segments a set indexes as many
signatures as there may be differences left, and one more, the least frequent first by a table of frequencies common to
all sets; by the prefix principle two linked sets then index a common one. How many segments get a neighbourhood is
allocated per band at the least estimated cost: signature rows against the frequent signatures they spare.

Documents with equal sets form one class, and classes are joined. Classes sharing a signature form a bucket. All
classes of a bucket are compared with its hub, the one with the most frequent signatures. What the hub does not bring
into one component is compared with the rest of the bucket, unless sizes or the two distances from the hub exclude it.
So a group of near copies costs a star, not all its pairs. A comparison first counts differing segments, by one byte
each: there are no more of them than differing elements, and as a distance they obey the triangle inequality. Pairs
that this does not exclude are compared on their exact sets.

The frequency table has a fixed size and steers cost only: any table gives the same links. Sets are hashed shingles
of 64 bits, classes 128-bit sums over them.

Defined cases: null texts, and texts without words, have the empty set and link with nothing; with fewer words than a
shingle the whole sequence is one shingle; a component is named by its smallest document id, a null id never naming one
unless all are null; repeated rows are members each; an empty table gives no rows; further columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orderflow.llm.components import components
from orderflow.llm.words import SPACED, WordClass, _mixed, blocks
from orderflow.session import materialize, scratch_path

WORDS, NUM, DEN = 3, 9, 10
BLOCK_BYTES, BLOCK_ROWS = 4 << 20, 2048
MAX_ROLES = 1 << 12  # of one block, the bits that the sort key of the index has for them
BAND_RATIO, SLACK = 1.5, 2
TABLE_BITS = 22  # of the frequency table: 4 bytes times two to this
LOCAL_COUNT = 4  # occurrences in one task from which a place of the table is reported
MAX_NEIGHBOURHOODS = 4
FILTER_BITS = 27  # of the filter of wanted classes
CHUNK, COMPARED = 512, 1 << 22  # classes of a bucket in one block, bytes of codes compared at once

LIMITS = [1, 2, 3, 5]
while LIMITS[-1] < 1 << 40:
    LIMITS.append(int(LIMITS[-1] * BAND_RATIO) + 1)
LIMITS = np.array(LIMITS, np.int64)


def difference(n: np.ndarray, partner: np.ndarray, num: int, den: int) -> np.ndarray:
    """The most elements in which linked sets of these sizes differ."""
    return (n + partner) * (den - num) // (den + num)


class Plan:
    """Segments per band, and how many of them get a one-deletion neighbourhood."""

    def __init__(self, num: int, den: int, neighbourhoods: dict[int, int] | None = None):
        if not 0 < num <= den:
            raise ValueError(f"the similarity {num}/{den} must be above 0 and at most 1")
        self.num, self.den = num, den
        largest = LIMITS[1:] - 1
        # a set takes part in every band up to that of its largest partner
        self.bands = int((self.last_band(largest) - np.arange(len(largest))).max()) + 1
        self.allowed = difference(largest, np.minimum(largest * den // num, largest), num, den)
        self.near = np.zeros(len(largest), np.int64)
        for band, k in (neighbourhoods or {}).items():
            self.near[band] = k
        self.segments = SLACK * (self.allowed + 1)

    def last_band(self, n: np.ndarray) -> np.ndarray:
        """The band of the largest partner of sets of these sizes."""
        return np.minimum(np.searchsorted(LIMITS, n * self.den // self.num, "right") - 1, len(LIMITS) - 2)

    def allocate(self, stats: list) -> Plan:
        """The plan of least cost; stats: (band, sets, elements, signatures, frequent ones, their squared counts)."""
        chosen = {}
        for band, sets, elements, signatures, frequent, squares in stats:
            need, m = int(self.allowed[band]) + 1, int(self.segments[band])
            size, hot = elements / sets, frequent / max(1, signatures) * m  # expected per set
            price = squares / max(1, frequent)  # the bucket a frequent signature leads to

            def cost(k: int) -> float:
                rest = max(0, need - 2 * k)
                return k * (size / m + 1) + rest + price * max(0.0, hot - (m - k - rest))

            chosen[band] = min(range(min(need // 2, MAX_NEIGHBOURHOODS) + 1), key=cost)
        return Plan(self.num, self.den, chosen)


def shingle_sets(texts: pa.Array, words: int, kind: WordClass = SPACED) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes of every text in order, their number per text); at most BLOCK_ROWS texts."""
    tokens, n = kind.hashes(texts)
    begin = np.cumsum(n) - n
    many = np.where(n > 0, np.maximum(n - words + 1, 1), 0)
    doc = np.repeat(np.arange(len(n)), many)
    at = begin[doc] + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    size = np.minimum(n, words)[doc]
    value = _mixed(size.astype(np.uint64))
    for i in range(words):
        value = np.where(i < size, _mixed(value + tokens[np.minimum(at + i, max(len(tokens) - 1, 0))] * np.uint64(2 * i + 3)), value) if len(at) else value
    # the text's number and the leading bits in one number sort fast
    order = np.argsort((doc.astype(np.uint64) << np.uint64(53)) | (value >> np.uint64(11)))
    value, doc = value[order], doc[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return value[new], np.bincount(doc[new], minlength=len(n))


def _sums(values: np.ndarray, groups: np.ndarray, many: int) -> np.ndarray:
    """Sums modulo 2 ** 64 per group, exact while a group has fewer than two million values."""
    low = np.bincount(groups, (values & np.uint64(0xFFFFFFFF)).astype(np.float64), many).astype(np.uint64)
    high = np.bincount(groups, (values >> np.uint64(32)).astype(np.float64), many)
    return low + (high.astype(np.uint64) << np.uint64(32))


def class_keys(values: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit keys of every set."""
    doc = np.repeat(np.arange(len(n)), n)
    a = _sums(_mixed(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)), doc, len(n))
    b = _sums(_mixed(values + np.uint64(0x5851F42D4C957F2D)), doc, len(n))
    return _mixed(a + n.astype(np.uint64)).view(np.int64), _mixed(b + n.astype(np.uint64)).view(np.int64)


def roles(plan: Plan, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(set, band, differences allowed): a set takes part in its own band and in all up to that of its largest partner."""
    sets = np.flatnonzero(n > 0)
    band = np.searchsorted(LIMITS, n[sets], "right") - 1
    many = plan.last_band(n[sets]) - band + 1
    row = np.repeat(sets, many)
    where = np.repeat(band, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    largest = np.minimum(n[row] * plan.den // plan.num, LIMITS[where + 1] - 1)
    return row, where, difference(n[row], largest, plan.num, plan.den)


def signatures(plan: Plan, values: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """(role, signature, segment) of all segments, the roles, and (role, signature) of the neighbourhoods."""
    row, band, allowed = roles(plan, n)
    begin, size, m = (np.cumsum(n) - n)[row], n[row], plan.segments[band]
    role = np.repeat(np.arange(len(row)), size)
    element = values[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())]
    segment = ((element >> np.uint64(32)) * m[role].astype(np.uint64)) >> np.uint64(32)
    first = np.cumsum(m) - m
    at = first[role] + segment.astype(np.int64)
    of_role = np.repeat(np.arange(len(row)), m)
    number = np.arange(m.sum()) - first[of_role]
    salt = _mixed((band[of_role].astype(np.uint64) << np.uint64(40)) + number.astype(np.uint64) + np.uint64(1))
    mixed = _mixed(element ^ np.uint64(0xC2B2AE3D27D4EB4F))
    total = _sums(mixed, at, int(m.sum())) + salt
    close = segment.astype(np.int64) < plan.near[band][role]
    less = _mixed(total[at[close]] - mixed[close])
    whole = number < plan.near[band][of_role]
    near = np.concatenate([of_role[whole], role[close]]), np.concatenate([_mixed(total[whole]), less])
    return (of_role, _mixed(total), number), (row, band, allowed), near


def _place(signature: np.ndarray) -> np.ndarray:
    return (signature >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def _read_sets(batches: Iterator[pa.RecordBatch], words: int, rows: int = BLOCK_ROWS) -> Iterator[tuple]:
    for batch in blocks(batches, "_text", BLOCK_BYTES, rows):
        values, n = shingle_sets(batch.column("_text"), words)
        yield batch, values, n, *class_keys(values, n)


def _distinct(a: np.ndarray, b: np.ndarray, n: np.ndarray, seen: set) -> np.ndarray:
    """Numbers of the sets of a task that are not empty and were not seen before."""
    out = []
    for i, key in enumerate(zip(a.tolist(), b.tolist())):
        if n[i] and key not in seen:
            seen.add(key)
            out.append(i)
    return np.array(out, np.int64)


def _only(values: np.ndarray, n: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    wanted = np.zeros(len(n), bool)
    wanted[keep] = True
    return values[np.repeat(wanted, n)], n[wanted]


class Counter:
    """What one task has seen: the frequency table and, per band, sets, elements, signatures and frequent signatures."""

    def __init__(self, plan: Plan):
        self.plan, self.seen, self.signatures = plan, set(), [np.zeros(0, np.int64)]
        self.sets, self.elements = np.zeros(len(LIMITS)), np.zeros(len(LIMITS))

    def add(self, values: np.ndarray, n: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        some, size = _only(values, n, _distinct(a, b, n, self.seen))
        (role, signature, _), (row, band, _), _ = signatures(self.plan, some, size)
        self.signatures.append((band[role] << TABLE_BITS) | _place(signature))
        self.sets += np.bincount(band, minlength=len(LIMITS))
        self.elements += np.bincount(band, size[row], len(LIMITS))

    def rows(self) -> dict[str, np.ndarray]:
        """Places seen often as (place, count), and bands as (-1 - band, sets, elements, signatures, frequent, squares)."""
        found = np.concatenate(self.signatures)
        band, place = found >> TABLE_BITS, found & ((1 << TABLE_BITS) - 1)
        table = np.bincount(place, minlength=1 << TABLE_BITS)
        times = table[place]
        often = times >= LOCAL_COUNT
        stats = [self.sets, self.elements, np.bincount(band, minlength=len(LIMITS))]
        stats += [np.bincount(band[often], w, len(LIMITS)) for w in (None, times[often])]
        places, used = np.flatnonzero(table >= LOCAL_COUNT), np.flatnonzero(self.sets)
        out = {"_place": np.concatenate([places, -1 - used]), "_c": np.concatenate([table[places], self.sets[used]]).astype(float)}
        return out | {k: np.concatenate([np.zeros(len(places)), v[used]]).astype(float) for k, v in zip(("_e", "_x", "_y", "_z"), stats[1:])}


def frequencies(counted: DataFrame, plan: Plan) -> tuple[np.ndarray, Plan]:
    """The frequency table of all tasks, and the plan with neighbourhoods allocated."""
    bands = counted.where("_place < 0").groupBy("_place").agg(*(F.sum(k).alias(k) for k in ("_c", "_e", "_x", "_y", "_z")))
    plan = plan.allocate([(-1 - r[0], *r[1:]) for r in bands.collect()])  # a row per band
    places = counted.where("_place >= 0").groupBy("_place").agg(F.sum("_c").cast("float").alias("_c"))
    table = np.zeros(1 << TABLE_BITS, np.float32)
    # eight bytes a place, read batch by batch: a full table is 32 MB on its way through the driver
    for batch in places.select(F.col("_place").cast("int"), "_c").toArrow().to_batches():
        table[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return table, plan


def index(texts: DataFrame, plan: Plan, table: np.ndarray, words: int) -> DataFrame:
    """The stored index, once per task that meets a class: (sig, node, band, n, heat) of the signatures that each class
    indexes, and (node, band, code) with a byte for each segment."""
    spark = texts.sparkSession
    sent = spark.sparkContext.broadcast(table)
    schema = "sig bigint, node bigint, band int, n bigint, heat float, code binary"

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency, seen = sent.value, set()
        for _, values, n, a, b in _read_sets(batches, words, min(BLOCK_ROWS, max(1, MAX_ROLES // plan.bands))):
            keep = _distinct(a, b, n, seen)
            some, size = _only(values, n, keep)
            (role, signature, number), (row, band, allowed), near = signatures(plan, some, size)
            codes, ends = signature.astype(np.uint8).tobytes(), np.cumsum(plan.segments[band]).tolist()
            codes = [codes[s:e] for s, e in zip([0, *ends], ends)]
            node = a[keep][row]
            yield pa.RecordBatch.from_arrays([
                pa.nulls(len(row), pa.int64()), pa.array(node), pa.array(band, pa.int32()), pa.nulls(len(row), pa.int64()),
                pa.nulls(len(row), pa.float32()), pa.array(codes, pa.binary()),
            ], names)
            left = number >= plan.near[band][role]
            role, signature, number = role[left], signature[left], number[left]
            often = frequency[_place(signature)]
            # role, frequency, signature and segment in one number: an order of segments common to all sets of a band
            rank = np.minimum(2 * np.log2(1 + often), 31).astype(np.uint64)
            key = (role.astype(np.uint64) << np.uint64(52)) | (rank << np.uint64(47)) | (signature >> np.uint64(36) << np.uint64(19))
            order = np.argsort(key | (number.astype(np.uint64) & np.uint64((1 << 19) - 1)))
            role, signature, often = role[order], signature[order], often[order]
            many = np.bincount(role, minlength=len(row))
            rank = np.arange(len(role)) - (np.cumsum(many) - many)[role]
            take = rank < (allowed + 1 - 2 * plan.near[band])[role]
            heat = np.bincount(role[take], np.minimum(often[take], 1e6), len(row))
            role, signature = np.concatenate([role[take], near[0]]), np.concatenate([signature[take], near[1]])
            yield pa.RecordBatch.from_arrays([
                pa.array(signature.view(np.int64)), pa.array(node[role]), pa.array(band[role], pa.int32()),
                pa.array(size[row[role]].astype(np.int64)), pa.array(heat[role].astype(np.float32)), pa.nulls(len(role), pa.binary()),
            ], names)

    names = ["sig", "node", "band", "n", "heat", "code"]
    path = scratch_path(spark, "signatures")
    texts.select("_text").mapInArrow(emit, schema).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def count_differing(pairs: DataFrame, codes: DataFrame) -> DataFrame:
    """The pairs (a, b, band, ...) with ``differ``, the number of segments whose codes differ."""
    codes = codes.where("code is not null").select("node", "band", "code").dropDuplicates(["node", "band"])
    left, right = (codes.select(F.col("node").alias(k), "band", F.col("code").alias(f"_{k}")) for k in "ab")
    rows = pairs.join(left, ["a", "band"]).join(right, ["b", "band"]).select(*pairs.columns, "_a", "_b")
    schema = rows.drop("_a", "_b").schema.add("differ", "long")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = zip(batch.column("_a").to_pylist(), batch.column("_b").to_pylist())
            differ = [int(np.count_nonzero(np.frombuffer(x, np.uint8) != np.frombuffer(y, np.uint8))) for x, y in codes]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(differ, pa.int64())], [*batch.schema.names[:-2], "differ"])

    return rows.mapInArrow(count, schema)


def wanted_sets(texts: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """(node, elements) of the classes in ``nodes``, stored; found again by a filter of fixed size."""
    size = 1 << FILTER_BITS
    bit = F.expr("shiftleft(1L, cast(node & 63 as int))")
    cell = F.shiftrightunsigned("node", 64 - FILTER_BITS + 6)
    cells = nodes.groupBy(cell.alias("cell")).agg(F.bit_or(bit).alias("bits")).toArrow()
    bits = np.zeros(size >> 6, np.uint64)
    bits[cells.column("cell").to_numpy()] = cells.column("bits").to_numpy().view(np.uint64)
    sent = texts.sparkSession.sparkContext.broadcast(bits)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, seen = sent.value, set()
        for _, values, n, a, b in _read_sets(batches, words):
            key = a.view(np.uint64)
            hit = wanted[key >> np.uint64(64 - FILTER_BITS + 6)] >> (key & np.uint64(63)) & np.uint64(1)
            begin = np.cumsum(n) - n
            keep = [i for i in _distinct(a, b, n, seen).tolist() if hit[i]]
            yield pa.RecordBatch.from_pydict({
                "node": a[keep],
                "elements": pa.array([values[begin[i] : begin[i] + n[i]].tobytes() for i in keep], pa.binary()),
            })

    found = texts.select("_text").mapInArrow(emit, "node bigint, elements binary")
    found = found.join(nodes.select("node").distinct(), "node", "left_semi")
    return materialize(found.groupBy("node").agg(F.any_value("elements").alias("elements")), "sets")


def compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, common, total) for pairs (a, b) of classes, on the exact sets."""
    left = sets.select(F.col("node").alias("a"), F.col("elements").alias("_a"))
    right = sets.select(F.col("node").alias("b"), F.col("elements").alias("_b"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common, total = [], []
            for x, y in zip(batch.column("_a").to_pylist(), batch.column("_b").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.sort(np.frombuffer(y, np.uint64))
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                common.append(int(np.count_nonzero(y[at] == x)))
                total.append(len(x) + len(y) - common[-1])
            yield pa.RecordBatch.from_pydict({
                "a": batch.column("a"), "b": batch.column("b"), "common": pa.array(common, pa.int64()), "total": pa.array(total, pa.int64())
            })

    rows = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "_a", "_b")
    return rows.mapInArrow(verify, "a bigint, b bigint, common bigint, total bigint")


def linked(texts: DataFrame, counted: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """(node, root): the classes that link with another one, and their components."""
    table, plan = frequencies(counted, Plan(num, den))
    stored = index(texts, plan, table, words)
    # both readers of the dealt rows take all columns, so they are dealt once
    rows = stored.where("sig is not null").drop("code").repartition("sig")
    hub = F.max(F.struct("heat", "node", "n", "band")).alias("hub")
    buckets = rows.groupBy("sig").agg(hub, F.min("node").alias("_a"), F.max("node").alias("_b")).where("_a <> _b")
    members = rows.join(buckets.select("sig", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n")), "sig")
    members = materialize(members.distinct(), "buckets")
    fits = lambda x, y: f"{x} * {den} >= {y} * {num} and {y} * {den} >= {x} * {num}"
    allowed = lambda x, y: F.expr(f"({x} + {y}) * {den - num} div {den + num}")
    stars = members.where("node <> hub").where(fits("n", "hub_n"))
    stars = stars.select(F.col("node").alias("a"), F.col("hub").alias("b"), "band", allowed("n", "hub_n").alias("allowed"))
    seen = materialize(count_differing(stars.distinct(), stored), "stars")
    links = exact_links(seen.where("differ <= allowed"), texts, words, num, den)
    roots = components(links)
    late = exact_links(across(members, seen, roots, stored, plan), texts, words, num, den)
    if late.isEmpty():
        return roots
    return components(links.unionByName(late))


def across(members: DataFrame, seen: DataFrame, roots: DataFrame, stored: DataFrame, plan: Plan) -> DataFrame:
    """(a, b): classes of one bucket that are in different components after the stars, differ in few enough segments and
    were not compared yet. A bucket's codes are compared block by block, CHUNK classes at a time, and only pairs that
    pass come out."""
    far = seen.select(F.col("a").alias("node"), F.col("b").alias("hub"), "band", F.col("differ").alias("far"))
    named = members.where("node <> hub").drop("heat").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_buckets = named.groupBy("sig").agg(F.count("*").alias("g"), F.min("root").alias("_x"), F.max("root").alias("_y"))
    named = named.join(open_buckets.where("_x <> _y").select("sig", "g"), "sig").join(far, ["node", "hub", "band"], "left")
    codes = stored.where("code is not null").select("node", "band", "code").dropDuplicates(["node", "band"])
    named = materialize(named.join(codes, ["node", "band"]), "open-buckets")
    chunks = F.ceil(F.col("g") / CHUNK)
    one = F.struct("node", "n", "root", F.coalesce("far", F.lit(-1)).alias("far"), "code")
    blocks = named.groupBy("sig", F.pmod(F.xxhash64("node"), chunks).alias("chunk"), chunks.alias("chunks"))
    blocks = blocks.agg(F.collect_list(one).alias("left"))
    num, den = plan.num, plan.den

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [np.zeros(0, np.int64)] * 2
            found = [out]
            for row in batch.to_pylist():
                x, y = (
                    {k: np.array([r[k] for r in row[side]], np.int64) for k in ("node", "n", "root", "far")}
                    | {"code": np.array([np.frombuffer(r["code"], np.uint8) for r in row[side]])}
                    for side in ("left", "right" if "right" in row else "left")
                )
                step = max(1, COMPARED // y["code"].size)
                for i in range(0, len(x["node"]), step):
                    part = {k: v[i : i + step, None] for k, v in x.items()}
                    allowed = (part["n"] + y["n"]) * (den - num) // (den + num)
                    ok = (part["root"] != y["root"]) & (part["n"] * den >= y["n"] * num) & (y["n"] * den >= part["n"] * num)
                    ok &= (part["far"] < 0) | (y["far"] < 0) | (np.abs(part["far"] - y["far"]) <= allowed)
                    u, v = np.nonzero(ok)
                    few = (x["code"][i + u] != y["code"][v]).sum(axis=1) <= allowed[u, v]
                    pair = x["node"][i + u[few]], y["node"][v[few]]
                    found.append([np.minimum(*pair), np.maximum(*pair)])
            pairs = np.unique(np.concatenate(found, axis=1), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    inside = blocks.select("left").mapInArrow(compare, "a bigint, b bigint")
    split = materialize(blocks.where("chunks > 1"), "split-buckets")
    if split.isEmpty():
        return inside.distinct()
    other = split.select("sig", F.col("chunk").alias("_chunk"), F.col("left").alias("right"))
    between = split.join(other, "sig").where("chunk < _chunk").select("left", "right")
    return inside.unionByName(between.mapInArrow(compare, "a bigint, b bigint")).distinct()


def exact_links(pairs: DataFrame, texts: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """(a, b) of the pairs that link by their exact sets, stored."""
    pairs = materialize(pairs.select("a", "b").distinct(), "pairs")
    if pairs.isEmpty():
        return pairs
    sets = wanted_sets(texts, pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))), words)
    return materialize(compare(pairs, sets).where(f"common * {den} >= total * {num}").select("a", "b"), "links")


def classes(docs: DataFrame, text: str = "text", words: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """All columns but the text, with n_shingles and the class's component in _root (null for empty sets)."""
    spark, own = docs.sparkSession, (text, "n_shingles", "_root")
    kinds = [f for f in docs.schema.fields if f.name not in own]
    found, counts = "n_shingles bigint, _node bigint, _other bigint", "_place bigint, _c double, _e double, _x double, _y double, _z double"
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds), found, counts])
    plan, texts = Plan(num, den), docs.select(F.col(text).alias("_text"))
    numbers = [(pa.int64(), k) for k in ("n_shingles", "_node", "_other", "_place")] + [(pa.float64(), f"_{k}") for k in "cexyz"]

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, others = Counter(plan), None
        for batch, values, n, a, b in _read_sets(batches, words):
            others = batch.schema.names[:-1], [c.type for c in batch.columns[:-1]]
            new = {"n_shingles": n.astype(np.int64), "_node": a, "_other": b}
            columns = [pa.array(new[k], t) if k in new else pa.nulls(len(n), t) for t, k in numbers]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*others[0], *(k for _, k in numbers)])
            counter.add(values, n, a, b)
        if others:
            rows = counter.rows()
            many = len(rows["_place"])
            columns = [pa.nulls(many, t) for t in others[1]] + [pa.array(rows[k], t) if k in rows else pa.nulls(many, t) for t, k in numbers]
            yield pa.RecordBatch.from_arrays(columns, [*others[0], *(k for _, k in numbers)])

    rows = docs.select(*(F.col(f"`{f.name}`") for f in kinds), F.col(text).alias("_text")).mapInArrow(describe, schema)
    path = scratch_path(spark, "shingled")
    rows.write.parquet(path)
    stored = spark.read.schema(rows.schema).parquet(path)
    roots = linked(texts, stored.where("_place is not null"), words, num, den)
    root = F.coalesce(F.col("_linked"), F.col("_node"))
    rows = stored.where("_place is null").join(roots.select(F.col("node").alias("_node"), F.col("root").alias("_linked")), "_node", "left")
    rows = rows.withColumn("_root", F.when(F.col("n_shingles") > 0, root))
    return rows.select(*(f"`{f.name}`" for f in kinds), "n_shingles", "_root")


def join_components(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = WORDS, num: int = NUM, den: int = DEN
) -> DataFrame:
    """All columns but the text, with n_shingles, component_id and the component's class in _root (null for empty sets)."""
    rows = materialize(classes(docs.drop("component_id"), text, words, num, den), "classes")
    names = rows.where("_root is not null").groupBy("_root").agg(F.min(doc_id).alias("component_id"))
    found = rows.join(names, "_root", "left")
    return found.withColumn("component_id", F.when(F.col("_root").isNull(), F.col(doc_id)).otherwise(F.col("component_id")))

"""Shards of near-equal bytes by histogram sort.

Rows sort by a 62-bit key: 38 bits of the text's hash, so that copies stand together, 12 bits of the row's hash, so that a
large group of copies can be cut, then 12 bits of a lasting row number, so that a large group of equal rows can be cut too.
Rounds of one distributed count each narrow the key ranges: the first
counts exact bytes and rows of 16,384 ranges, every further one divides by 256 those ranges that hold a shard boundary
and more than the tolerance, or more than one task should sort. The driver sees counts of ranges only. When all
boundaries meet the tolerance, the rows move once, to the ranges, where they are numbered.

Defined cases: null text has no bytes and counts one byte for its separator; equal texts stay in one shard unless a
boundary falls into a group larger than the tolerance, as do rows equal in all columns, which are interchangeable; an
empty table gives no rows; input columns named ``size``, ``shard`` or ``slot`` are replaced.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from orderflow.llm.common import hashable
from orderflow.session import materialize

KEY_BITS, FIRST_BITS, STEP_BITS, ROW_BITS, NUMBER_BITS = 62, 14, 8, 12, 12
#: The largest range that one task numbers; rows beyond are divided, so the list of ranges grows as bytes / RANGE_BYTES.
RANGE_BYTES = 256 << 20


def sort_key(df: DataFrame, text: str) -> Column:
    """``df``: with ``_number``."""
    low = ROW_BITS + NUMBER_BITS
    of_text = F.shiftrightunsigned(F.xxhash64(F.col(text)), 64 - KEY_BITS + low)
    of_row = F.shiftrightunsigned(F.xxhash64(*hashable(df.drop("_number")), F.lit(7)), 64 - ROW_BITS)
    of_number = F.shiftrightunsigned(F.xxhash64("_number"), 64 - NUMBER_BITS)
    return F.shiftleft(of_text, low).bitwiseOR(F.shiftleft(of_row, NUMBER_BITS)).bitwiseOR(of_number)


def numbered(df: DataFrame) -> DataFrame:
    """Rows with a number that stays the same however often they are read: their place in their file, else a stored number."""
    try:
        return df.withColumn("_number", F.xxhash64("_metadata.file_path", "_metadata.row_index"))
    except AnalysisException:  # not straight from files
        return materialize(df.withColumn("_number", F.monotonically_increasing_id()), "shard-rows")


def ranges(keyed: DataFrame, shards: int, tolerance: float, law: str) -> list[tuple[int, int, int, int]]:
    """(shift, prefix, shard, first slot) of key ranges that each lie in one shard; ``keyed``: key, size."""
    spark = keyed.sparkSession
    shift, found, heavy = KEY_BITS - FIRST_BITS, {}, None  # found: first key -> (shift, bytes, rows)
    while True:
        rows = keyed
        if heavy is not None:
            above = F.broadcast(spark.createDataFrame([(p,) for p in heavy], "_above long"))
            rows = keyed.join(above, F.shiftright("_key", shift + step) == F.col("_above"), "left_semi")
        counts = rows.groupBy(F.shiftright("_key", shift).alias("_prefix")).agg(
            F.sum("size").alias("bytes"), F.count("*").alias("rows"), (F.min("_key") < F.max("_key")).alias("many")
        )
        for prefix, size, n, many in counts.collect():
            found[prefix << shift] = (shift, size, n, many)
        order = sorted(found)
        weight = [found[k][1 if law == "bytes" else 2] for k in order]
        ends = list(accumulate(weight))
        total, bytes_in_all = (ends[-1] if ends else 0), sum(v[1] for v in found.values())
        targets = [total * i / shards for i in range(1, shards)]
        most = min(RANGE_BYTES, max(1, bytes_in_all // 1024))
        holds = {bisect_right(ends, t) for t in targets}
        wanted = [
            k
            for i, k in enumerate(order)
            if found[k][0] == shift and found[k][3] and (found[k][1] > most or i in holds and weight[i] > tolerance * total / shards)
        ]
        if not wanted or shift == 0:
            break
        heavy = [k >> shift for k in wanted]
        for k in wanted:
            del found[k]
        step = min(STEP_BITS, shift)
        shift -= step
    # each boundary at the nearer end of the range that holds it
    cuts = []
    for t in targets if ends else []:
        i = min(bisect_right(ends, t), len(ends) - 1)
        cuts.append(ends[i] if ends[i] - t <= t - (ends[i] - weight[i]) else ends[i] - weight[i])
    out, shard_rows = [], [0] * shards
    for i, k in enumerate(order):
        shard = bisect_right(cuts, ends[i] - weight[i])
        out.append((found[k][0], k >> found[k][0], shard, shard_rows[shard]))
        shard_rows[shard] += found[k][2]
    return out


def shard_rows(
    df: DataFrame, shards: int = 16, text: str = "text", tolerance: float = 0.001, law: str = "bytes"
) -> DataFrame:
    """All rows with size, shard (0 to shards - 1) and slot (gapless from 0 in each shard, in key order)."""
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")
    df = df.drop("shard", "slot", *(c for c in ["size"] if c != text))
    df = numbered(df)
    keyed = df.withColumns({"size": size, "_key": sort_key(df, text), "_row": F.xxhash64(*hashable(df))})
    counted = materialize(keyed.select("_key", "size"), "shard-keys")
    found = ranges(counted, shards, tolerance, law)
    spark = df.sparkSession
    places = keyed.withColumn("_place", F.lit(None).cast("struct<first:long,shard:int,slot:long>"))
    for shift in sorted({x[0] for x in found}):
        level = [(p, (p << s, shard, slot)) for s, p, shard, slot in found if s == shift]
        # about 40 bytes for each of at most 256 * (bytes / RANGE_BYTES + 1040) + 16,384 ranges
        table = F.broadcast(spark.createDataFrame(level, "_prefix long, _at struct<first:long,shard:int,slot:long>"))
        places = places.join(table, F.shiftright("_key", shift) == F.col("_prefix"), "left")
        places = places.withColumn("_place", F.coalesce("_place", "_at")).drop("_prefix", "_at")
    order = W.partitionBy(F.col("_place.first")).orderBy("_key", "_row")
    slot = (F.col("_place.slot") + F.row_number().over(order) - 1).cast("long")
    return places.withColumns({"shard": F.col("_place.shard"), "slot": slot}).drop("_key", "_row", "_place", "_number")

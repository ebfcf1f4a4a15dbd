"""Sources mixed to target weights along a low-discrepancy schedule.

The mix has equal slots of T words. Slot k takes the van der Corput point of k, mapped through the sources' cumulative
targets; with a power of two of slots these points are the grid cells j = 0, 1, .. visited in bit-reversed order, so a
source owns the cells between its cumulative targets and every stretch of the mix keeps the proportions. A source's
slots are ranked, and its r-th slot takes the r-th block of T words of the source, whose documents stand in hash order,
twice over: words beyond the source's size come from a second pass.

T is a 2 ** SLOT_BITS th of the mix, and SLOT_WORDS at most: larger inputs get more slots. A source has as many cells as
its whole words of target need, and its last block is cut, so it takes these words exactly, at every size.

Targets: the mix is ``share`` times all words, dealt by weight; a source gets at most ``passes`` times its size and the
excess is dealt again by weight until no source is above. Running sums over a source's documents are summed per 4096
hash ranges first, so a source with a third of all rows is no single group.

Defined cases: a null source is a source of its own, after all others; null and empty texts have no words and are
taken 0 times; rows equal in id and text are interchangeable; with no words at all every target is 0; an empty table
gives no rows; input columns named like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from orderflow.llm.common import in_slices, null_last_key, running_totals
from orderflow.session import materialize

WEIGHTS, SHARE, PASSES, SLOT_BITS, SEED = (3, 1, 2), 1.5, 2, 16, "mix"
SLOT_WORDS = 1024
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, passes: int = PASSES) -> DataFrame:
    """For (_source, source_size): target, words to take, slots, and the slots before the source's."""
    sliced = in_slices(sizes, [F.col("_source")], "mix-sources")
    ranked = running_totals(sliced, [F.col("_source")], {"_rank": F.lit(1)})
    turn = F.array(*map(F.lit, weights))
    weighed = F.element_at(turn, (F.col("_rank") % len(weights) + 1).cast("int")).cast("long")
    sources = materialize(ranked.select("_slice", "_source", "source_size", weighed.alias("_weight")), "mix-weights")
    cap = passes * F.col("source_size")
    budget = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    level, at_cap = 0.0, -1
    while True:  # each round caps further sources, so it ends after at most one round per source
        over = F.col("_weight") * F.lit(level) > cap
        capped, taken, free = sources.agg(
            F.count_if(over), F.sum(F.when(over, cap)), F.sum(F.when(~over, F.col("_weight")))
        ).first()
        if capped == at_cap or not free:
            break
        level, at_cap = (budget - (taken or 0)) / free, capped
    target = F.when(F.col("_weight") * F.lit(level) > cap, cap.cast("double")).otherwise(F.col("_weight") * F.lit(level))
    words = F.floor("target").cast("long")
    placed = running_totals(sources.withColumn("target", target), [F.col("_source")], {"_before": words})
    block = min(max(1, -(-int(budget) // (1 << SLOT_BITS))), SLOT_WORDS)
    owned = sources.withColumn("target", target)
    owned = owned.withColumns({"_slots": F.ceil(words / F.lit(block)).cast("long"), "_take": words})
    bits = max(SLOT_BITS, ((owned.agg(F.sum("_slots")).first()[0] or 0) - 1).bit_length())
    return running_totals(owned, [F.col("_source")], {"_first": F.col("_slots")}).select(
        "_source", "source_size", "target", F.lit(block).cast("long").alias("_block_words"), F.lit(bits).alias("_bits"),
        "_first", "_slots", "_take",
    )


def slot_of_block() -> Column:
    """The slot of a source's block: the ``_block``-th smallest of the bit-reversed numbers of the source's cells.

    Cells are halved by their bits, lowest first, as these are the highest of the slot; those with bit 0 come first.
    """

    def halve(state: Column, bit: Column) -> Column:
        ends = [F.col("_first") + x - 1 - state["low"] for x in (F.col("_slots"), F.lit(0))]
        zeros = F.call_function("shiftright", ends[0], bit + 1) - F.call_function("shiftright", ends[1], bit + 1)
        one = state["rank"] >= zeros
        power = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
        return F.struct(
            (state["low"] + F.when(one, power).otherwise(F.lit(0))).alias("low"),
            (state["rank"] - F.when(one, zeros).otherwise(F.lit(0))).alias("rank"),
            (state["slot"] * 2 + one.cast("long")).alias("slot"),
        )

    zero = F.lit(0).cast("long")
    start = F.struct(zero.alias("low"), F.col("_block").cast("long").alias("rank"), zero.alias("slot"))
    return F.aggregate(F.sequence(F.lit(0), F.col("_bits") - 1), start, halve, lambda state: state["slot"])


def place(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """All rows with size, source_size, target, and their place in the source: _source, _bucket, _row, _start."""
    docs = docs.drop(*({"size", "source_size", "target", "taken", "passes"} - {text, source, doc_id}))
    mark = F.concat_ws(
        ":", F.lit(SEED), F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.md5(F.coalesce(F.col(text), F.lit("")))
    )
    rows = docs.withColumns({
        "size": F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long"),
        "_source": null_last_key(F.col(source)),
        "_hash": F.md5(mark),
    }).withColumn("_bucket", F.substring("_hash", 1, 3))
    buckets = materialize(rows.groupBy("_source", "_bucket").agg(F.sum("size").alias("_words")), "mix-buckets")
    targets = materialize(source_targets(buckets.groupBy("_source").agg(F.sum("_words").alias("source_size"))), "mix-targets")
    earlier = W.partitionBy("_source").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)  # 4096 rows at most
    base = buckets.withColumn("_base", F.coalesce(F.sum("_words").over(earlier), F.lit(0))).drop("_words")
    base = base.join(targets, "_source")
    inside = W.partitionBy("_source", "_bucket").orderBy("_hash", F.col(doc_id))
    return rows.join(base, ["_source", "_bucket"]).withColumns({
        "_row": F.row_number().over(inside),
        "_start": F.col("_base") + F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, 0)) - F.col("size"),
    })


def turns(placed: DataFrame, passes: int = PASSES) -> DataFrame:
    """The rows of each pass that have words in the mix, the source's words from _at to _end; _doc is carried on."""
    carried = [c for c in ("_doc",) if c in placed.columns]
    each = placed.where("size > 0 and _take > 0").select(
        *carried, "_source", "_bucket", "_row", "_start", "size", "_take", "_block_words", "source_size",
        "_bits", "_first", "_slots",
        F.explode(F.sequence(F.lit(0), F.lit(passes - 1))).alias("_pass"),
    )
    at = F.col("_start") + F.col("_pass") * F.col("source_size")
    return each.withColumns({"_at": at, "_end": F.least(at + F.col("size"), F.col("_take"))}).where("_at < _end")


def pieces(placed: DataFrame, passes: int = PASSES) -> DataFrame:
    """The mix itself: for every slot its words, as (slot, _pass, from_word, to_word) of a document's row."""
    block = F.sequence(F.expr("_at div _block_words"), F.expr("(_end - 1) div _block_words"))
    cut = turns(placed, passes).withColumn("_block", F.explode(block))
    begin = F.greatest(F.col("_at"), F.col("_block") * F.col("_block_words")) - F.col("_at")
    end = F.least(F.col("_end"), (F.col("_block") + 1) * F.col("_block_words")) - F.col("_at")
    return cut.select(
        slot_of_block().alias("slot"), "_source", "_bucket", "_row", "_pass", begin.alias("from_word"), end.alias("to_word")
    )


def repeat_mixed(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """The documents of the mix along its slots, with the columns of ``docs``.

    Each stands, whole, once per pass in which any of its words is taken, in the slot of its first word. Partitions, and
    rows within them, are in the order of the mix.
    """
    whole = docs.select(*dict.fromkeys((text, source, doc_id)), F.struct(*(f"`{c}`" for c in docs.columns)).alias("_doc"))
    placed = turns(place(whole, text, source, doc_id)).withColumn("_block", F.expr("_at div _block_words"))
    slotted = placed.select("_doc", slot_of_block().alias("_slot"), "_at")
    return slotted.repartitionByRange("_slot", "_at").sortWithinPartitions("_slot", "_at").select("_doc.*")


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """All rows with size, source_size, target, taken (words in the mix) and passes (times the row is in it, even in part)."""
    placed = place(docs, text, source, doc_id)
    uses = pieces(placed).groupBy("_source", "_bucket", "_row").agg(
        F.sum(F.col("to_word") - F.col("from_word")).alias("taken"), (F.max("_pass") - F.min("_pass") + 1).alias("passes")
    )
    used = placed.join(uses, ["_source", "_bucket", "_row"], "left")
    inner = [c for c in used.columns if c.startswith("_") and c not in docs.columns]
    return used.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ("taken", "passes")}).drop(*inner)

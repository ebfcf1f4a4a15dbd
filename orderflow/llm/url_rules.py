"""URL filters by a sort-merge range join.

A host's labels in reverse order, each followed by a separator, form its key, so that a rule's host covers one
interval of keys and intervals nest. Distinct hosts and the two ends of every rule interval are sorted together into
ranges; each end carries the stack of host rules that are open after it, and a window hands every host the stack of
the last end before it. A range starts with the stack that is open there. Pages then meet their host's stack and the
longest rule whose path starts theirs decides.

Defined cases: a null URL, or one without ``://``, has empty host and path and fits no rule; without a fitting rule the
verdict is ``allow`` and the rule null; control characters are characters like others; of two fitting rules of equal length the one with the longer host wins, then
a block before an allow; repeated rules count once; empty tables give no rows or no rules; input columns named host,
path, rule or verdict are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from orderflow.llm.common import ascii_lower, in_slices

END, AFTER, ESCAPE = "\x01", "\x02", "\x03"
OTHERWISE = "allow"


def split_url(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.locate("://", url) > 0, F.expr("substring(_url, locate('://', _url) + 3)"))
    host = ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0))
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def host_key(host: Column) -> Column:
    """Separators and escapes inside a label are escaped, so that a label ends nowhere else."""
    for found, escaped in (ESCAPE, f"{ESCAPE}c"), (END, f"{ESCAPE}a"), (AFTER, f"{ESCAPE}b"):
        host = F.replace(host, F.lit(found), F.lit(escaped))
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), END), F.lit(END))


def ancestors(key: Column) -> Column:
    """The keys of the host and of all domains above it."""
    labels = F.split(F.substring(key, F.lit(1), F.length(key) - 1), END)
    depths = F.sequence(F.lit(1), F.size(labels))
    return F.transform(depths, lambda n: F.concat(F.array_join(F.slice(labels, 1, n), END), F.lit(END)))


def rule_stacks(rules: DataFrame) -> DataFrame:
    """For every rule host (_key): the rules open inside its interval, best first, and those open after it."""
    one = F.struct(
        (-F.length(F.concat("host", "path"))).alias("order"), (-F.length("host")).alias("near"),
        F.when(F.col("verdict") == "block", 0).otherwise(1).alias("rank"),
        F.col("path"), F.concat("host", "path").alias("rule"), F.col("verdict"),
    )
    rules = rules.where("host is not null and path is not null and verdict is not null").select(
        ascii_lower(F.col("host")).alias("host"), "path", "verdict"
    )
    own = rules.select(host_key(F.col("host")).alias("_key"), one.alias("_rule")).groupBy("_key")
    own = own.agg(F.collect_set("_rule").alias("_own"))  # the paths ruled for one host
    above = own.select("_key", F.explode(ancestors(F.col("_key"))).alias("_up"))
    chain = above.join(own.select(F.col("_key").alias("_up"), "_own"), "_up")
    inside = F.array_sort(F.flatten(F.collect_list("_own")))
    outer = F.array_sort(F.flatten(F.collect_list(F.when(F.col("_up") != F.col("_key"), F.col("_own")))))
    return chain.groupBy("_key").agg(inside.alias("_stack"), outer.alias("_outer"))


def host_stacks(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, _stack): the rules whose host covers it; only hosts with any. ``hosts``: distinct host."""
    nodes = rule_stacks(rules)
    points = hosts.select(host_key(F.col("host")).alias("_key"), F.lit(2).alias("_kind"), "host", F.lit(None).alias("_stack"))
    last = F.concat(F.expr("substring(_key, 1, length(_key) - 1)"), F.lit(AFTER))
    none = F.lit(None).cast("string").alias("host")
    opens = nodes.select("_key", F.lit(1).alias("_kind"), none, "_stack")
    closes = nodes.select(last.alias("_key"), F.lit(0).alias("_kind"), none, F.col("_outer").alias("_stack"))
    rows = in_slices(opens.unionByName(closes).unionByName(points), [F.col("_key")], "url-sweep")
    # the stack open where a slice starts: that of the longest rule host above its first key
    starts = rows.groupBy("_slice").agg(F.min("_key").alias("_first"))
    up = starts.select("_slice", F.explode(ancestors(F.concat(F.col("_first"), F.lit(END)))).alias("_key"))
    open_at = up.join(nodes, "_key").groupBy("_slice").agg(F.max_by("_stack", F.length("_key")).alias("_seed"))
    order = W.partitionBy("_slice").orderBy("_key", "_kind").rowsBetween(W.unboundedPreceding, 0)
    swept = rows.withColumn("_seen", F.last("_stack", ignorenulls=True).over(order)).where("_kind = 2")
    swept = swept.join(F.broadcast(open_at), "_slice", "left")  # one row per slice
    return swept.select("host", F.coalesce("_seen", "_seed").alias("_stack")).where(F.size("_stack") > 0)


def judge(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """All rows with host, path, rule and verdict."""
    pages = pages.drop(*({"host", "path", "rule", "verdict"} - {url})).withColumn("_url", F.col(url))
    host, path = split_url(F.col("_url"))
    pages = pages.withColumns({"host": host, "path": path}).drop("_url")
    stacks = host_stacks(pages.select("host").distinct(), rules)
    joined = pages.join(stacks, "host", "left")
    fits = F.filter("_stack", lambda r: F.startswith(F.col("path"), r["path"]))
    best = F.try_element_at(fits, F.lit(1))
    return joined.withColumns({"rule": best["rule"], "verdict": F.coalesce(best["verdict"], F.lit(OTHERWISE))}).drop("_stack")

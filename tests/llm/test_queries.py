"""The registered queries on the smallest tables: against their SQL, or against a plain version."""

import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from orderflow.llm import queries
from tests import oracle
from tests.llm import helpers

FOLDER = "/root/testdata/sf0.001"
TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", queries.ORACLE)
def test_against_sql(spark, duck, name):
    assert oracle.difference(duck, entry.queries()[name](spark, FOLDER), entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_mix_against_sql_at_larger_sizes(spark, folder):
    """One rule at every size: slots of one word and of many."""
    con, path = duckdb.connect(), f"/root/testdata/{folder}"
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet'")
    assert oracle.difference(con, entry.queries()["op6_van_der_corput_mix"](spark, path), queries.OP6_SQL) is None


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_shards(spark):
    rows = queries.QUERIES["op5_histogram_sort_shards"](spark, FOLDER).toPandas()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").toPandas().set_index("doc_id")
    assert sorted(rows.doc_id) == sorted(docs.index)
    for r in rows.itertuples():
        data = docs.text[r.doc_id].encode()
        assert r.size == len(data) + 1 and r.text_crc32 == zlib.crc32(data)
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in rows.groupby("shard"))
    sizes = rows.groupby("shard")["size"].sum()
    assert len(sizes) == 16 and sizes.max() - sizes.min() <= 2 * rows["size"].max()


def test_toxicity(spark):
    folder = "/root/testdata/sf0.1"
    rows = queries.QUERIES["op3_nnpu_toxicity"](spark, folder).toPandas().set_index("doc_id")
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas().set_index("doc_id")
    assert all(rows.held_out[i] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in rows.index)
    assert rows.score.between(0, 1).all() and ((rows.score >= 0.5) == (rows.predicted == 1)).all()
    both = rows.join(labels, how="inner")
    held = both[both.held_out]
    right = (held.predicted == 1) & (held.toxic == 1)
    assert right.sum() / (held.toxic == 1).sum() > 0.8 and right.sum() / (held.predicted == 1).sum() > 0.9


def test_neighbours(spark):
    rows = queries.QUERIES["op9_prefix_forest"](spark, FOLDER).toPandas()
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet").toPandas()
    ids, x = table.vec_id.to_numpy(), np.stack(table.embedding).astype(float)
    found = 0
    for q, g in rows.groupby("query_id"):
        far = np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1))
        far[ids == q] = np.inf
        best = ids[np.lexsort((ids, far))[:10]]
        found += len(set(best) & set(g.vec_id))
        by_id = dict(zip(ids, far))
        assert sorted(g["rank"]) == list(range(1, 14))
        assert all(by_id[v] == s for v, s in zip(g.vec_id, g.score))
    assert found >= 0.9 * len(rows)


def test_licences(spark):
    rows = queries.QUERIES["op10_paragraph_licences"](spark, "/root/testdata/sf0.01").toPandas().set_index("doc_id")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").toPandas().set_index("doc_id")
    notices = {
        "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
        "MIT": "Released under the MIT License.",
        "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
        "CC-BY-NC": "Licensed under CC BY-NC 4.0.",
    }
    for key, text in docs.text.items():
        want = {f for f, n in notices.items() if n in text}
        assert set(filter(None, rows.families[key].split(","))) == want
        assert rows.n_paragraphs[key] == sum(bool(p.strip(" ")) for p in text.replace("\r\n", "\n").split("\n"))


def test_pipeline(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    steps = dict(P.STAGES)
    bench = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]

    scored = queries.QUERIES["op3_nnpu_toxicity"](spark, FOLDER).toPandas()
    kept = steps["toxicity"](spark, docs, FOLDER)
    assert kept.columns == columns
    clean = set(scored.doc_id[scored.predicted == 0])
    assert {r.doc_id for r in kept.collect()} == clean

    near = steps["ngram_jaccard_join"](spark, docs, FOLDER)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = {k for k, n, c in helpers.components(rows, 5, 4, 5) if n == 0 or k == c}
    assert near.columns == columns and sorted(r.doc_id for r in near.collect()) == sorted(want)
    assert len(want) < len(rows)

    out = steps["benchmark_decontamination"](spark, docs, FOLDER)
    want = {k for k, t in rows if not helpers.hits(t, bench)[1]}
    assert out.columns == columns and {r.doc_id for r in out.collect()} == want

    mixed = steps["source_mix"](spark, docs, FOLDER)
    taken = queries.QUERIES["op6_van_der_corput_mix"](spark, FOLDER).toPandas().set_index("doc_id")
    count = mixed.groupBy("doc_id").count().toPandas().set_index("doc_id")["count"]
    assert mixed.columns == columns
    for key, r in taken.iterrows():
        assert (r.taken > 0) == (count.get(key, 0) > 0) and count.get(key, 0) >= -(-r.taken // max(r["size"], 1))

    last = P.run(spark, FOLDER).toPandas()
    assert set(columns) < set(last.columns) and len(last) > 0
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in last.groupby("shard"))
    assert set(last.doc_id) <= clean


def test_near_copies_with_other_splits(spark, tmp_path):
    """The near-copy stage names rows alike although the files are split differently at its end."""
    import corpus_pipeline as P

    path = str(tmp_path / "docs")
    spark.read.parquet(f"{FOLDER}/documents.parquet").repartition(7).write.parquet(path)
    docs = spark.read.parquet(path)
    want = {k for k, n, c in helpers.components([(r.doc_id, r.text) for r in docs.collect()], 5, 4, 5) if n == 0 or k == c}
    near = P.one_of_near_copies(spark, docs, FOLDER)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        assert sorted(r.doc_id for r in near.collect()) == sorted(want)
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_pipeline_mixes_along_the_schedule(spark, tmp_path):
    """The files of the mix stage, by name, hold its documents in the order of the slots."""
    import corpus_pipeline as P
    from orderflow.llm import mixing

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    path = str(tmp_path / "mixed")
    P.mix_sources(spark, docs, FOLDER).write.parquet(path)
    placed = mixing.place(docs)
    first = mixing.pieces(placed).where("from_word = 0").join(placed, ["_source", "_bucket", "_row"])
    want = [r.doc_id for r in first.orderBy("slot", F.col("_start") + F.col("_pass") * F.col("source_size")).collect()]
    files = sorted((tmp_path / "mixed").glob("part-*.parquet"))
    assert [x for f in files for x in spark.read.parquet(str(f)).toPandas().doc_id] == want


def test_passing_scratch(spark):
    from orderflow.session import materialize, passing_scratch

    before = materialize(spark.range(3), "before")
    with passing_scratch(spark):
        inside = materialize(spark.range(4), "inside")
        path = inside.inputFiles()[0].rsplit("/", 1)[0]
        assert inside.count() == 4
    assert spark.read.parquet(path).count() == 0 and before.count() == 3

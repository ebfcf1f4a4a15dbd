"""Tree BPE, embedding whitening and the Merkle manifest against plain versions, on small and awkward inputs."""

import base64
import hashlib
import math
import random
import sys
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from orderflow.llm import bpe, merkle, queries, whitening

FOLDER = "/root/testdata/sf0.001"
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


# byte-level BPE


@pytest.fixture(scope="module")
def tokenizer():
    return bpe.load(public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path(VOCABULARY), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def bytes_of_ids(library):
    return pa.array([library.decode_single_token_bytes(i) for i in range(library.n_vocab)], pa.large_binary())


def test_awkward_texts_like_the_library(tokenizer, library, monkeypatch):
    """Seams everywhere: stretches of two characters, texts of few kinds of characters and of letters new to Unicode."""
    monkeypatch.setattr(bpe, "LEAF", 2)
    codec, draw, texts, rows = tokenizer.codec(), random.Random(11), [], []
    kinds = ["a", "b", "the ", "ing", " ", "  ", "\n", "\t", "\x1c", " ", "'", "'s", "'re", "'ll", "1", "22", "é", "漢", "😀", "-", "़", "࢏", "\U000323b0"]
    for _ in range(1500):
        some = draw.sample(kinds, draw.randint(1, 6))
        text = "".join(draw.choice(some) for _ in range(draw.choice([1, 5, 30, 200])))
        ids = codec.encode(text)
        assert ids == library.encode_ordinary(text), repr(text)
        texts.append(text), rows.append(ids)
    decoded = bpe._decoded(bytes_of_ids(library), pa.array(rows, pa.list_(pa.int32())))
    assert decoded.to_pylist() == [t.encode() for t in texts]


@pytest.mark.parametrize("text", ["a" * 20001, "ab" * 9999, " " * 10001 + "x", "漢字" * 5000, "'re" * 3000, "1234567890" * 1500, "\n" * 9999, "-=" * 5000])
def test_long_pieces_like_the_library(tokenizer, library, text):
    assert tokenizer.codec().encode(text) == library.encode_ordinary(text)


def test_joins_hold_for_any_ranks():
    """Ranks in any order, and tokens that merges never make: as the library encodes with them."""
    draw = random.Random(3)
    for _ in range(40):
        longer = {"".join(draw.choice("ab ") for _ in range(draw.randint(2, 6))).encode() for _ in range(25)}
        tokens = [bytes([i]) for i in range(256)]
        rest = sorted(longer)
        draw.shuffle(rest)
        ranks = {t: i for i, t in enumerate([*tokens, *rest])}
        lines = b"\n".join(base64.b64encode(t) + b" %d" % r for t, r in ranks.items())
        own = bpe.Tokenizer(lines, public_tokenizers.PATTERN).codec()
        library = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        for _ in range(40):
            text = "".join(draw.choice("aab ") for _ in range(draw.randint(0, 60)))
            assert own.encode(text) == library.encode_ordinary(text)


def test_encode_and_decode_columns(spark, tokenizer, library):
    texts = [None, "", "plain words", "plain words", "😀" * 300, "x" * 70000, "<|endoftext|>"]
    rows = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(texts)], "id int, text string, ids string")
    encoded = bpe.encode(rows, tokenizer)
    assert encoded.columns == ["id", "text", "ids"]
    found = {r.id: r for r in bpe.decode(encoded, tokenizer).collect()}
    for i, t in enumerate(texts):
        assert found[i].ids == library.encode_ordinary(t or "") and bytes(found[i].decoded) == (t or "").encode()
    assert bpe.decode(bpe.encode(rows.limit(0), tokenizer), tokenizer).count() == 0
    odd = spark.createDataFrame([(None,), ([64, None, 10**9],)], "ids array<int>")
    assert sorted(bytes(r.decoded) for r in bpe.decode(odd, tokenizer).collect()) == [b"", library.decode_bytes([64])]


def test_bpe_query(spark, library):
    rows = {r.doc_id: r for r in queries.QUERIES["op11_tree_bpe"](spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        ids = library.encode_ordinary(d.text or "")
        r = rows[d.doc_id]
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()


def test_encode_and_decode_at_once(spark, tokenizer, library):
    """Null, empty and equal texts, steps of several rows, rows longer than a step; other columns stay."""
    texts = [None, "", "plain words", "plain words", "😀漢" * 300, "one of many words " * 40000, None, "two\n" * 150000, "three " * 100000, ""]
    rows = spark.createDataFrame([(i, t, "kept", "lost") for i, t in enumerate(texts)], "id int, text string, other string, ids string").coalesce(1)
    both = bpe.encode_and_decode(rows, tokenizer, data="bytes")
    assert sorted(both.columns) == ["bytes", "id", "ids", "other", "text"]
    found = {r.id: r for r in both.collect()}
    assert len(found) == len(texts) and all(r.other == "kept" for r in found.values())
    for i, t in enumerate(texts):
        assert found[i].text == t and found[i].ids == library.encode_ordinary(t or "") and bytes(found[i].bytes) == (t or "").encode()
    assert bpe.encode_and_decode(rows.limit(0), tokenizer).count() == 0


def test_bpe_query_has_one_python_worker_per_task(spark):
    plan = queries.QUERIES["op11_tree_bpe"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_steps_are_bounded(library, monkeypatch):
    """A step is at most STEP and one row long, and decodes like the whole."""
    monkeypatch.setattr(bpe, "STEP", 100)
    draw = random.Random(5)
    lists = [draw.choice([None, [], [64] * draw.randint(1, 70), [70, None, 10**9], [65] * 500]) for _ in range(300)]
    rows = pa.array(lists, pa.list_(pa.int32()))
    steps = list(bpe._steps(rows, rows.value_lengths()))
    assert [x for step in steps for x in step.to_pylist()] == lists and len(steps) > 50
    assert all(sum(len(x or ()) for x in step.to_pylist()[:-1]) <= 100 for step in steps)
    tokens = bytes_of_ids(library)
    assert [x for step in steps for x in bpe._decoded(tokens, step).to_pylist()] == bpe._decoded(tokens, rows).to_pylist()
    assert not list(bpe._steps(rows[:0], rows[:0].value_lengths()))


def test_remembered_bytes_are_bounded(tokenizer, library, monkeypatch):
    """Pieces of many wide characters count by what they take."""
    monkeypatch.setattr(bpe, "PIECES", 1 << 16)
    codec, draw = tokenizer.codec(), random.Random(7)
    for _ in range(40):
        text = " ".join("".join(chr(draw.randrange(0x20000, 0x2A000)) for _ in range(draw.randint(1, 40))) for _ in range(20))
        assert codec.encode(text) == library.encode_ordinary(text)
        kept = [*codec.pieces.items(), *codec.pieces.older.items()]
        assert sum(sys.getsizeof(k) + sys.getsizeof(v) for k, v in kept) <= 1 << 16
    assert len(codec.pieces) > 5


# whitening


def plain_whitening(vectors):
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(d)]
    deviation = [sum((n * r[j] - sums[j]) ** 2 for j in range(d)) for r in x]
    centred = np.array([[(n * r[j] - sums[j]) / n for j in range(d)] for r in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return n, deviation, centred, values[::-1], vectors[:, ::-1]


def test_whitening_like_a_dense_solver(spark):
    draw = np.random.default_rng(2)
    good = (draw.normal(size=(400, 9)) @ np.diag([9, 5, 5, 3, 2, 1, 0.5, 0.2, 0]) + 3).tolist()
    good += good[:3]
    bad = [None, [], [None] + [1.0] * 8, [math.nan] + [1.0] * 8, [math.inf] + [1.0] * 8, [1e30] + [1.0] * 8, [1.0, 2.0]]
    rows = [(i, v, "kept") for i, v in enumerate(good)] + [(1000 + i, v, "kept") for i, v in enumerate(bad)]
    frame = spark.createDataFrame(rows, "vec_id int, embedding array<float>, whitened string")
    found, model, error = whitening.whiten(frame)
    found = {r.vec_id: r for r in found.collect()}
    n, deviation, centred, values, _ = plain_whitening(good)
    assert sorted(found) == list(range(n)) and model.n == n and error < 1e-9
    assert model.components.shape == (9, 8)  # the constant dimension has no variance
    assert np.allclose(model.eigenvalues, values[:8], rtol=1e-9) and np.isclose(model.trace, values.sum(), rtol=1e-12)
    covariance = centred.T @ centred / n
    for k in range(8):
        v = model.components[:, k]
        assert np.isclose(v @ v, 1) and np.allclose(covariance @ v, model.eigenvalues[k] * v, atol=1e-8 * values[0])
    for i in range(n):
        assert found[i].deviation == deviation[i]
        assert np.allclose(found[i].whitened, centred[i] @ model.components / np.sqrt(model.eigenvalues), atol=1e-8)


def test_whitening_of_little(spark):
    kind = "vec_id int, embedding array<float>"
    for rows, n in (([], 0), ([(1, None)], 0), ([(1, [0.5, 2.0])], 1), ([(1, [0.5, 2.0]), (2, [0.5, 2.0])], 2)):
        found, model, error = whitening.whiten(spark.createDataFrame(rows, kind))
        assert model.n == n and error == 0
        assert [(r.deviation, r.whitened) for r in found.collect()] == [(0, [])] * n
    # of a tie in lengths the longer vectors count
    tie = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], kind)
    assert [r.vec_id for r in whitening.whiten(tie)[0].collect()] == [2]


def test_whitening_of_huge_entries(spark):
    """Entries near the end of a long: sums and deviations stay whole numbers, and null where they are none."""
    rows = [(1, [2.0**55]), (2, [-(2.0**55)]), (3, [1.0])]
    found, model, _ = whitening.whiten(spark.createDataFrame(rows, "vec_id int, embedding array<double>"))
    assert model.sums == [3_000_064]
    # 3 * 1_000_064 less the sum is 128
    assert {r.vec_id: r.deviation for r in found.collect()} == {1: None, 2: None, 3: 128**2}


def test_factors_of_random_matrices():
    draw = np.random.default_rng(4)
    for d, rank in ((1, 1), (2, 2), (5, 5), (16, 7), (33, 33)):
        half = draw.normal(size=(d, rank)) * 10.0 ** draw.integers(-1, 2, rank)
        scatter = half @ half.T
        low, order = whitening.cholesky(scatter)
        assert low.shape == (d, rank) and np.allclose(low @ low.T, scatter[np.ix_(order, order)], atol=1e-9 * scatter.max())
        assert np.allclose(low, np.tril(low))
        values, vectors = whitening.components(scatter)
        assert np.allclose(vectors.T @ vectors, np.eye(rank), atol=1e-10)
        assert np.allclose(values, np.linalg.eigvalsh(scatter)[::-1][:rank], rtol=1e-6, atol=1e-10 * values[0])


def test_whitening_query(spark):
    rows = queries.QUERIES["op12_cholesky_whitening"](spark, FOLDER).toPandas()
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet").toPandas()
    n, deviation, centred, values, _ = plain_whitening(table.embedding.tolist())
    assert len(rows) == 32 * n and (rows.n == n).all() and (rows.identity_error < 1e-6).all()
    wide = rows.pivot(index="vec_id", columns="component", values="whitened")
    assert list(wide.columns) == list(range(1, 33))
    own = wide.loc[table.vec_id].to_numpy()
    assert np.allclose(own.T @ own / n, np.eye(32), atol=1e-6)
    assert dict(zip(rows.vec_id, rows.deviation)) == dict(zip(table.vec_id.tolist(), deviation))
    shares = rows.drop_duplicates("component").sort_values("component").explained
    assert np.allclose(shares, values[:32] / values.sum(), rtol=1e-6)


# Merkle manifest


def plain_manifest(rows, fields, tree, order):
    """[(row, leaf, subroot, root, siblings)] by keeping every level."""
    sha = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()
    spell = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
        return out

    def siblings(tall, i):
        return [level[(i >> k) ^ 1] for k, level in enumerate(tall[:-1]) if (i >> k) ^ 1 < len(level)]

    names = sorted({r[tree] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    leaves = {}
    for name in names:
        own = [(r, sha(*(spell(r[f]) for f in fields))) for r in rows if r[tree] == name]
        leaves[name] = sorted(own, key=lambda x: (x[0][order] is not None, x[0][order] or 0, x[1]))
    trees = {name: levels([d for _, d in own]) for name, own in leaves.items()}
    crown = levels([trees[name][-1][0] for name in names]) if names else []
    out = []
    for at, name in enumerate(names):
        for i, (row, leaf) in enumerate(leaves[name]):
            out.append((row, leaf, trees[name][-1][0], crown[-1][0], siblings(trees[name], i) + siblings(crown, at)))
    return out


FIELDS = ["id", "kind", "n", "text"]


@pytest.mark.parametrize("step", [2, 6])
def test_manifest_like_all_levels_kept(spark, step):
    draw = random.Random(step)
    rows = [{"id": i, "kind": "hot", "n": i, "text": f"text {i}"} for i in range(150)]
    rows += [{"id": draw.choice([None, 1, 2, i]), "kind": draw.choice([None, "", "a", "é", "z" * 50]), "n": draw.choice([None, 5]), "text": draw.choice([None, "", "x" * 9000, "1:-"])} for i in range(60)]
    rows += rows[-5:] + [{"id": 7, "kind": "one", "n": 1, "text": "-"}]
    frame = spark.createDataFrame([tuple(r.values()) + ("clash",) for r in rows], "id int, kind string, n int, text string, leaf string")
    found = merkle.manifest(frame.repartition(3), FIELDS, tree="kind", order="id", extra={"text": F.col("text")}, step=step)
    found = found.withColumn("folded", merkle.fold(F.col("leaf"), F.col("path"))).collect()
    want = plain_manifest(rows, FIELDS, "kind", "id")
    key = lambda x: str(x)
    got = [(r.id, r.text, r.leaf, r.subroot, r.root, [s.digest for s in r.path if s.digest]) for r in found]
    assert sorted(got, key=key) == sorted([(r["id"], r["text"], leaf, sub, root, way) for r, leaf, sub, root, way in want], key=key)
    assert all(r.folded == r.root for r in found)


def test_manifest_of_little(spark):
    kind = "id int, kind string, n int, text string"
    assert merkle.manifest(spark.createDataFrame([], kind), FIELDS, "kind", "id").count() == 0
    one = merkle.manifest(spark.createDataFrame([(None, None, None, None)], kind), FIELDS, "kind", "id").first()
    assert one.leaf == one.subroot == one.root == hashlib.sha256(b"----").hexdigest() and one.path == []


def test_stored_levels_are_few(spark):
    leaves = spark.range(1000).select(F.lit("t").alias("_tree"), F.col("id").alias("_index"), F.lit(1000).cast("long").alias("_count"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    forest = merkle.grow(leaves, 4)
    assert [x.count() for x in forest.levels] == [1000, 63, 4, 1]


def test_manifest_query_finds_tampering(spark):
    rows = queries.QUERIES["op13_merkle_manifest"](spark, FOLDER).collect()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    want = {r["doc_id"]: x for r, *x in plain_manifest([d.asDict() for d in docs], ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id")}
    assert len(rows) == len(docs)
    for r in rows:
        leaf, subroot, root, way = want[r.doc_id]
        assert (r.leaf, r.subroot, r.root) == (leaf, subroot, root)
        assert r.proof_sha256 == hashlib.sha256("".join(way).encode()).hexdigest()
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 7 != 0) == (r.folded_root == root)


def test_remembered_pieces_are_bounded():
    """What is used stays, what is not goes; never more than asked for."""
    known = bpe.Recent(10)
    for i in range(200):
        known.keep(i, [i])
        assert known[0] == [0] and len(known) + len(known.older) <= 10
    assert known[1] is None and known[199] == [199]

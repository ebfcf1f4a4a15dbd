"""Each operator on small fixtures: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import gzip
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orderflow.llm import ann, chat, decontaminate, jaccard, licenses, mixing, sharding, toxicity, url_rules, warc, words
from orderflow.llm import components as C
from tests.llm import helpers

DOCS = "doc_id long, text string, source string"


def odd_texts(seed, n=60):
    r = random.Random(seed)
    vocabulary = ["the", "of", "Ünï", "x1", "A", "b-c", "日本", "zz", "q"]
    texts = [" ".join(r.choice(vocabulary) for _ in range(r.randint(1, 40))) for _ in range(n)]
    return [*texts, None, "", " \n\t", "!!!", texts[0], texts[0], "the of " * 3000]


# words


@pytest.mark.parametrize("chunk", [64, 1 << 17])
def test_words(monkeypatch, chunk):
    monkeypatch.setattr(words, "CHUNK", chunk)
    r = random.Random(3)
    texts = ["".join(r.choice("aB Z9é-\n\tß日.\x00") for _ in range(r.randint(0, 60))) for _ in range(200)] + [None, "", "a" * 300]
    for separators, pattern in ((range(0x30), helpers.ALNUM), (None, helpers.SPACED)):
        kind = words.SPACED if separators is None else words.ALPHANUMERIC
        kind = words.WordClass(bytes(np.flatnonzero(~kind.inside).tolist()))
        hashes, n = kind.hashes(pa.array(texts))
        want = [helpers.words(t, pattern) for t in texts]
        assert n.tolist() == [len(w) for w in want]
        known = {}
        for w, h in zip((x for w in want for x in w), hashes.tolist()):
            assert known.setdefault(w, h) == h
        assert len(set(known.values())) == len(known)
        grams = {x for h, d in kind.features(pa.array(texts), 4) for x in zip(d.tolist(), h.tolist())}
        bytes_of = {(i, x.encode()) for i, w in enumerate(want) for x in w}
        assert len(grams) == len(bytes_of) + len({(i, x[k : k + 4], 0) for i, x in bytes_of for k in range(len(x) - 3)})


# 1 decontamination


@pytest.mark.parametrize("query_words", [5, 1000])
def test_phrases(spark, monkeypatch, query_words):
    monkeypatch.setattr(decontaminate, "QUERY_WORDS", query_words)
    monkeypatch.setattr(decontaminate, "CANDIDATES", 50)
    r = random.Random(1)
    texts = odd_texts(1)
    items = [(i, " ".join(helpers.words(r.choice(texts[:60]))[:k])) for i, k in enumerate([1, 3, 10, 14, 30, 12])]
    items += [(7, None), (8, "..."), (2, "zz zz q the"), (None, "q q"), (9, "nowhere to be found")]
    docs = spark.createDataFrame([(i, t, "n_hit") for i, t in enumerate(texts)], "doc_id long, text string, items string")
    index = decontaminate.build_index(docs)
    rows = decontaminate.phrase_hits(index, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((x.id, x.n_words, x.n_hit, x["items"]) for x in rows) == sorted((i, *helpers.hits(t, items)) for i, t in enumerate(texts))
    none = decontaminate.phrase_hits(index, spark.createDataFrame([], "item_id long, text string")).collect()
    assert len(none) == len(texts) and not any(x.n_hit for x in none)
    assert decontaminate.phrase_hits(decontaminate.build_index(docs.limit(0)), docs.select(F.col("doc_id").alias("item_id"), "text")).count() == 0


@pytest.mark.parametrize("span", [1, 5, 100])
def test_near(spark, span):
    texts, item = odd_texts(2), "x1 the zz"
    texts += ["x1 " + "a " * 70 + "the zz", "x1 " + "a " * 98 + "the zz", "zz", "x1", "the"]  # longer than the gap between documents
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = decontaminate.near_hits(decontaminate.build_index(docs), spark.createDataFrame([(1, item)], "item_id long, text string"), span=span)
    need, want = set(item.split()), set()
    for i, t in enumerate(texts):
        w = helpers.words(t)
        for s in range(len(w)):
            for e in range(s, min(s + span, len(w))):
                if need <= set(w[s : e + 1]):
                    if w[s] in need:
                        want.add((i, "1", s, e))
                    break
    assert {tuple(x) for x in rows.collect()} == want


# 2 chat


def test_template_language():
    run = lambda source, **v: chat.compile_template(source)(v)[0]
    assert run("a{{ 'b' + 'c' }}{{ x ~ 1 }}", x=2) == "abc21"
    assert run("{% for m in xs %}{{ loop.index }}{{ m.k }}{% if not loop.last %},{% endif %}{% endfor %}", xs=[{"k": "p"}, {"k": None}]) == "1p,2"
    assert run("{% if a == 1 and b in ['x', 'y'] %}1{% elif a > 1 %}2{% else %}3{% endif %}", a=2, b="x") == "2"
    assert run("{% set y = x|trim|upper %}{{ y }}{{ y|length }}", x=" ab ") == "AB2"
    assert chat.fold(chat.parse("a{{ 'b' + 'c' }}{% if 1 == 1 %}d{% else %}{{ x }}{% endif %}")) == ("block", ("text", "abcd"))
    text, spans = chat.compile_template("x{% generation %}{{ v }}{% endgeneration %}y{% generation %}z{% endgeneration %}")({"v": "日本"})
    assert (text, spans) == ("x日本yz", [(1, 3), (4, 5)])
    assert run("{{ x.__class__ }}{{ x['__len__'] }}{{ missing.y }}", x="s") == ""
    for bad in ("{% for x in y %}", "{{ f(x) }}", "{{ x|open }}", "{% import os %}", "{{ 1 + }}", "{{ x.1 }}", "{% endif %}", "{{ __import__('os') }}"):
        with pytest.raises(chat.TemplateError):
            chat.compile_template(bad)


def test_conversations(spark):
    tricky = ["\\", "<turn>", "</turn>\n", "\\</turn>", "a\nb", "", None, "\\\\<turn>user\n", "日本</turn>", "\n"]
    rows = [(c, t, role, text) for c in range(3) for t, (role, text) in enumerate(zip(["user", "assistant", None, "a\nb", "<turn>"] * 2, tricky))]
    rows += [(5, 1, "assistant", "b"), (5, 1, "assistant", "a"), (5, None, "user", "z"), (None, 0, "user", "n"), (5, 1, "assistant", "a")]
    rows += [(9, i, "assistant", "x" * 50_000) for i in range(4)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    got = {r.conv_id: r for r in chat.format_conversations(table).collect()}
    assert set(got) == {c for c, *_ in rows}
    for key, r in got.items():
        said = sorted(((t is None, t or 0, role or "", text or "") for c, t, role, text in rows if c == key))
        turns, loss = chat.read_back(r.formatted, [(s.begin, s.end) for s in r.spans])
        assert turns == [(role, text) for *_, role, text in said]
        assert loss == "".join(text for *_, role, text in said if role == "assistant")
    assert chat.format_conversations(table.limit(0)).count() == 0


# 3 toxicity


def test_toxicity_cases(spark):
    r = random.Random(5)
    plain = ["alpha", "beta", "gamma", "delta", "omega"]
    rows = []
    for i in range(400):
        toxic = i % 4 == 0
        text = [r.choice(plain) for _ in range(20)] + ["vilexword"] * (2 if toxic else 0)
        rows.append((i, " ".join(text), int(toxic)))
    docs = spark.createDataFrame([(i, t, "s") for i, t, _ in rows], DOCS).withColumn("score", F.lit("mine"))
    labels = spark.createDataFrame([(i, x if i % 2 == 0 else 0) for i, _, x in rows if i % 3] + [(None, 1), (999, 1)], "doc_id long, toxic int")
    odd = spark.createDataFrame([(None, None, None), (1000, "", "s"), (1000, "vilexword " * 5000, None), (1001, "beta", "s")], DOCS)
    odd = odd.withColumn("score", F.lit("mine"))
    model = toxicity.train(docs.unionByName(odd), labels)
    got = {(x.doc_id, x.text): x.predicted for x in toxicity.score(docs.unionByName(odd), model).collect()}
    assert all(got[i, t] == x for i, t, x in rows)
    assert got[None, None] == got[1000, ""] == got[1001, "beta"] == 0 and got[1000, "vilexword " * 5000] == 1
    none = toxicity.train(docs, labels.where("toxic = 7"))
    assert {x.score for x in toxicity.score(docs, none).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), toxicity.train(docs.limit(0), labels)).count() == 0


def test_risk_is_not_negative():
    """Toxic rows among the unlabelled ones do not teach the features away."""
    weights, bias = toxicity.fit([[0]] * 50, [[0]] * 30 + [[1]] * 270, 2, 0.1)
    assert weights[0] + bias > 0 > weights[1] + bias


# 4 WARC


def test_archives(spark, tmp_path):
    long = "日" * 70_000
    rows = [(3, "http://b.example.org/x?q=1", "p" * 100), (1, "http://b.example.org/x?q=1", "p" * 100), (2, None, "p" * 99), (4, "http://a.example.org", "p" * 99)]
    rows += [(5, "no scheme\r\n here", None), (6, "HTTP://B.Example.org/x?q=1", ""), (7, "http://c.example.org/", long), (8, "http://c.example.org/", long), (8, "http://c.example.org/", long)]
    rows += [(None, "http://d.example.org/", long), (9, "http://e.example.org/a\r\n\r\nb", "x\r\n\r\ny" * 30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("archive", F.lit("mine"))
    archives = warc.write_archives(pages)
    index = warc.build_index(archives, lines=2)
    got = sorted(map(tuple, warc.read_all(archives, index).drop("archive", "offset", "length").collect()), key=str)
    want = []
    for page, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        again = len(data) >= 100 and page != min(same)
        want.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", min(same) if again else None))
    assert got == sorted(want, key=str)

    ask = spark.createDataFrame([("http://b.example.org/x?q=1",), ("https://c.example.org/",), ("http://zzz.org/",), (None,)], "url string")
    found = warc.lookup(archives, index, ask).collect()
    fields = [warc.parse(gzip.decompress(bytes(r.record)))[0] for r in found]
    assert sorted(f["Page-ID"] for f in fields) == ["1", "2", "3", "6", "7", "8", "8"]
    assert all(len(r.record) == r.length for r in found)

    warc.export_files(archives, str(tmp_path / "out"))
    data = b"".join(gzip.decompress(p.read_bytes()) for p in sorted((tmp_path / "out").glob("part-*")) if p.stat().st_size)
    assert len(re.findall(rb"WARC/1\.1\r\n", data)) == len(rows) and long.encode() in data

    none = warc.write_archives(pages.limit(0))
    assert warc.read_all(none, warc.build_index(none)).count() == 0 == warc.lookup(none, warc.build_index(none), ask).count()


def test_archives_by_range(spark, monkeypatch):
    """Records are cut out of the archives' bytes, where the lines say, and the query finds them by their URLs."""
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 3000)
    rows = [(i, f"http://h{i % 7}.example.org/{'long/' * 60}{i // 3}" if i % 5 else None, f"{i % 40} text " * 30) for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    archives = warc.write_archives(pages)
    stored = {r.archive: bytes(r.data) for r in archives.select("archive", "data").collect()}
    assert len(stored) > 3 and all(gzip.decompress(x).count(b"WARC/1.1\r\n") > 1 for x in stored.values())
    index = warc.build_index(archives, lines=4)
    found = warc.lookup(archives, index, pages).collect()
    assert all(stored[r.archive][r.offset : r.offset + r.length] == bytes(r.record) for r in found)
    assert sorted(int(warc.parse(gzip.decompress(bytes(r.record)))[0]["Page-ID"]) for r in found) == list(range(400))
    some = warc.lookup(archives, index, pages.where("page_id in (1, 2, 399)")).collect()
    assert {r.url_key for r in some} == {warc.url_key(u) for i, u, _ in rows if i in (1, 2, 399)}
    # a line that names other bytes is followed there: nothing else joins records to rows
    one = found[0]
    moved = spark.createDataFrame([("k", one.archive, one.offset + 1, 5)], warc.RANGE)
    assert bytes(warc.read_ranges(archives, moved).first().record) == bytes(one.record)[1:6]


def test_query_reads_through_the_index(spark, monkeypatch):
    from orderflow.llm import queries

    asked = []
    lookup = warc.lookup
    monkeypatch.setattr(warc, "lookup", lambda *a, **k: asked.append(1) or lookup(*a, **k))
    queries.QUERIES["op4_warc_index"](spark, "/root/testdata/sf0.001")
    assert asked


# 5 sharding


@pytest.mark.parametrize("law", ["bytes", "rows"])
def test_shard_cases(spark, law):
    rows = [(i, "copy " * 20, "s") for i in range(500)] + [(i, f"{i} é" * (i % 50), None) for i in range(500, 1500)]
    rows += [(None, None, None), (1, "", ""), (1, "", ""), (2, "y" * 5000, "s")]
    table = spark.createDataFrame(rows, DOCS).withColumns({"size": F.lit("x"), "SHARD2": F.lit(1), "slot": F.lit(1)})
    got = sharding.shard_rows(table, 7, law=law).toPandas()
    assert len(got) == len(rows) and sorted(got["size"]) == sorted(len((t or "").encode()) + 1 for _, t, _ in rows)
    assert set(got.shard) == set(range(7)) and all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))
    weight = got.groupby("shard")["size"].sum() if law == "bytes" else got.groupby("shard").size()
    largest = got["size"].max() if law == "bytes" else 1
    assert weight.max() - weight.min() <= 2 * largest + 0.01 * weight.mean()
    assert sharding.shard_rows(table.limit(0), 7).count() == 0


@pytest.mark.parametrize("stored", [True, False])
def test_shards_of_one_repeated_row(spark, tmp_path, stored):
    """A third of all rows is one row: it is cut at the shards' boundaries and numbered in several tasks."""
    rows = [(i, f"text {i} " * 6, "s") for i in range(2000)] + [(7, "again " * 10, "s")] * 1000
    table = spark.createDataFrame(rows, DOCS)
    if stored:
        table.repartition(3).write.parquet(str(tmp_path / "t"))
        table = spark.read.parquet(str(tmp_path / "t"))
    got = sharding.shard_rows(table, 16).toPandas()
    assert len(got) == 3000 and all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))
    sizes = got.groupby("shard")["size"].sum()
    assert len(sizes) == 16 and sizes.max() - sizes.min() <= 4 * got["size"].max()


# 6 mixing


def test_mix_cases(spark):
    rows = [(i, "w " * (i % 30), "a") for i in range(600)] + [(i, "w\u00a0w x\x0by " * 3, ["b", "B", None, ""][i % 4]) for i in range(600, 700)]
    rows += [(None, None, None), (1, "one", "é"), (1, "one", "é"), (2, "w " * 9000, "b")]
    table = spark.createDataFrame(rows, DOCS).withColumns({"taken": F.lit("x"), "size": F.lit("y"), "extra": F.lit(1)})
    got = mixing.mix(table).toPandas()
    assert len(got) == len(rows) and got.extra.eq(1).all()
    size = lambda t: len(helpers.SPACED.findall(t or ""))
    assert all(r.size == size(r.text) for r in got.itertuples())
    names = sorted({s for _, _, s in rows if s is not None}, key=lambda s: [ord(c) for c in s]) + [None]
    sizes = [sum(size(t) for _, t, s in rows if s == name) for name in names]
    weight, aim, capped = [(3, 1, 2)[i % 3] for i in range(len(names))], None, set()
    while True:
        rest = 1.5 * sum(sizes) - sum(2 * sizes[i] for i in capped)
        level = rest / sum(w for i, w in enumerate(weight) if i not in capped)
        aim = [2 * s if i in capped else w * level for i, (s, w) in enumerate(zip(sizes, weight))]
        over = {i for i in range(len(names)) if aim[i] > 2 * sizes[i]}
        if not over:
            break
        capped |= over
    block = -(-int(1.5 * sum(sizes)) // 65536)
    for name, s, target in zip(names, sizes, aim):
        g = got[got.source.isna()] if name is None else got[got.source == name]
        assert (g.source_size == s).all() and np.allclose(g.target, target)
        assert g.taken.sum() == int(target) and (g.taken <= 2 * g["size"]).all()
    again = mixing.mix(table.repartition(7)).toPandas()
    key = ["doc_id", "source", "size", "taken"]
    assert got[key].sort_values(key).to_numpy().tolist().__str__() == again[key].sort_values(key).to_numpy().tolist().__str__()
    placed = mixing.place(table)
    slots = mixing.pieces(placed)
    assert slots.groupBy("slot").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("n")).where(F.col("n") > block).count() == 0
    assert mixing.mix(table.limit(0)).count() == 0
    assert {r.taken for r in mixing.mix(table.where("size(split(text, ' ')) < 0 or text is null")).collect()} == {0}
    assert mixing.repeat_mixed(table).columns == table.columns


@pytest.mark.parametrize("slot_bits,slot_words", [(4, 1024), (4, 64), (11, 1024)])
def test_mix_rare_sources(spark, monkeypatch, slot_bits, slot_words):
    """Slots much larger than a source: it is still taken near its target, and slots are visited in bit-reversed order."""
    monkeypatch.setattr(mixing, "SLOT_BITS", slot_bits)
    monkeypatch.setattr(mixing, "SLOT_WORDS", slot_words, raising=False)
    rows = [(i, "w " * 100, "abc"[i % 3]) for i in range(150)] + [(150 + i, "w " * (i + 1), f"r{i}") for i in range(12)]
    table = spark.createDataFrame(rows, DOCS)
    got = mixing.mix(table).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    for r in got:
        assert r.taken > 0 and r.taken == int(r.target)
    assert mixing.repeat_mixed(table).select("source").distinct().count() == 15
    placed = mixing.place(table)
    cells = {r["_source"]: r for r in placed.select("_source", "_first", "_slots", "_bits", "_take", "_block_words").distinct().collect()}
    slots = mixing.pieces(placed).select("_source", "slot").distinct().groupBy("_source").agg(F.array_sort(F.collect_list("slot"))).collect()
    seen = set()
    for source, found in slots:
        c = cells[source]
        turned = sorted(int(f"{j:0{c['_bits']}b}"[::-1], 2) for j in range(c["_first"], c["_first"] + c["_slots"]))
        assert found == turned[: -(-c["_take"] // c["_block_words"])] and not seen & set(found)
        seen |= set(found)


@pytest.mark.parametrize("slot_words", [7, 1024])
def test_mixed_documents_follow_the_schedule(spark, monkeypatch, slot_words):
    monkeypatch.setattr(mixing, "SLOT_BITS", 4)
    monkeypatch.setattr(mixing, "SLOT_WORDS", slot_words)
    rows = [(i, "w " * (i % 23), "abcde"[i % 5]) for i in range(1500)] + [(None, "null w", None), (3, "w " * 700, "b")]
    table = spark.createDataFrame(rows, DOCS).repartition(5)
    placed = mixing.place(table)
    first = mixing.pieces(placed).where("from_word = 0").join(placed, ["_source", "_bucket", "_row"])
    want = [r.size for r in first.orderBy("slot", F.col("_start") + F.col("_pass") * F.col("source_size")).collect()]
    mixed = mixing.repeat_mixed(table).collect()
    assert [len(r.text.split()) for r in mixed] == want
    if slot_words == 7:  # every stretch of the mix has the proportions of the whole
        shares = lambda part: {s: sum(len(r.text.split()) for r in part if r.source == s) / sum(len(r.text.split()) for r in part) for s in "abcde"}
        whole = shares(mixed)
        for k in range(4):
            part = shares(mixed[k * len(mixed) // 4 : (k + 1) * len(mixed) // 4])
            assert all(abs(part[s] - whole[s]) < 0.1 for s in "abcde")


# 7 Jaccard


def edited(r, base, k, vocabulary):
    out = list(base)
    for _ in range(k):
        out[r.randrange(len(out))] = r.choice(vocabulary)
    return out


@pytest.mark.parametrize("size,num,den,table_bits", [(3, 9, 10, 22), (5, 4, 5, 22), (3, 4, 5, 8), (1, 1, 2, 22)])
def test_jaccard(spark, monkeypatch, size, num, den, table_bits):
    monkeypatch.setattr(jaccard, "TABLE_BITS", table_bits)  # with 8 every signature counts as frequent
    if table_bits == 8:
        monkeypatch.setattr(jaccard, "CHUNK", 3)
    r = random.Random(size * den + table_bits)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for n in (3, 5, 9, 12, 25, 60, 150, 400):
        base = [r.choice(vocabulary) for _ in range(n)]
        for _ in range(14):
            texts.append(" ".join(edited(r, base, r.randint(0, max(1, n // 12)), vocabulary)))
            texts.append(" ".join(base[r.randint(0, n // 15) :] + [r.choice(vocabulary) for _ in range(r.randint(0, n // 15))]))
    texts += [None, "", "  ", "one", "ONE", "one two", "w1 \u00a0 w2", texts[0], texts[3], texts[3]]
    docs = [(1000 - i, t) for i, t in enumerate(texts)] + [(None, texts[5]), (1000, texts[0]), (None, "alone here now")]
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"node": F.lit(1), "component_id": F.lit("x")})
    rows = jaccard.join_components(table.repartition(5), words=size, num=num, den=den).collect()
    key = lambda x: str(x)
    assert sorted(((x.doc_id, x.n_shingles, x.component_id) for x in rows), key=key) == sorted(helpers.components(docs, size, num, den), key=key)


@pytest.mark.parametrize("num, den", [(1, 2), (2, 5), (1, 4), (3, 10)])
def test_jaccard_low_similarity(spark, num, den):
    """Sets whose partners are several size bands away link as well."""
    r = random.Random(den)
    texts = []
    for group, n in enumerate([2, 4, 7, 14, 30, 61, 120] * 3):
        base = [f"g{group}w{i}" for i in range(n)]
        texts += [" ".join(r.sample(base, max(1, n * part // den))) for part in (num, num, den) for _ in range(2)]
        texts.append(" ".join(base))
        texts.append(" ".join(base[: max(1, n // 2)] + [f"x{group}y{i}" for i in range(n // 3)]))
    docs = list(enumerate(texts))
    rows = jaccard.join_components(spark.createDataFrame(docs, "doc_id long, text string"), words=1, num=num, den=den).collect()
    assert sorted((x.doc_id, x.n_shingles, x.component_id) for x in rows) == sorted(helpers.components(docs, 1, num, den))


def test_jaccard_bands():
    assert jaccard.Plan(9, 10).bands == jaccard.Plan(4, 5).bands == 2
    assert jaccard.Plan(1, 1).bands == 1
    with pytest.raises(ValueError):
        jaccard.Plan(0, 1)


def test_jaccard_neighbourhoods(spark, monkeypatch):
    """The same links whatever number of segments gets a one-deletion neighbourhood."""
    r = random.Random(9)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for n in (8, 30, 90):
        base = [r.choice(vocabulary) for _ in range(n)]
        texts += [" ".join(edited(r, base, r.randint(0, max(1, n // 25)), vocabulary)) for _ in range(20)]
    docs = list(enumerate(texts))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    for k in (1, 3):
        most = lambda plan, stats, k=k: jaccard.Plan(plan.num, plan.den, {s[0]: min((plan.allowed[s[0]] + 1) // 2, k) for s in stats})
        monkeypatch.setattr(jaccard.Plan, "allocate", most)
        rows = jaccard.join_components(table).collect()
        assert sorted((x.doc_id, x.n_shingles, x.component_id) for x in rows) == sorted(helpers.components(docs))


def test_jaccard_empty(spark):
    assert jaccard.join_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rows = jaccard.join_components(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).collect()
    assert sorted((x.doc_id, x.n_shingles, x.component_id) for x in rows) == [(1, 0, 1), (2, 0, 2)]


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 103), (101, 103), (101, 102), (7, 7)]
    got = {x.node: x.root for x in C.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 104)}}


# 8 URL rules


def test_url_rules(spark):
    r = random.Random(8)
    labels = ["a", "b", "c"]
    host = lambda: ".".join(r.choice(labels) for _ in range(r.randint(1, 4)))
    path = lambda: "/" + "/".join(r.choice("xy") for _ in range(r.randint(0, 3)))
    rules = [(host(), path(), r.choice(["allow", "block"])) for _ in range(25)]
    rules += [("c", "/", "block"), ("c\x01x", "/", "allow"), rules[0], ("A.b", "/", "block"), (None, "/", "block"), ("c", None, "allow")]
    urls = [f"http://{host()}{path()}{r.choice(['', '?q', '#f', '/'])}" for _ in range(400)]
    urls += [f"http://{x}/x" for x in ("c\x01x", "c\x02", "x\x01c", "b.c\x01x", "\x01.c", "c\x03a", "c\x03", "\x03.b.c", "c\x00")]
    urls += [None, "", "a.b/x", "://", "x://A.B.C/x?://z", "http://a", "http://..a/x", "http://a.b?x/y", urls[0]]
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    got = {x.page_id: x for x in url_rules.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        name = re.match(r"[^/?#]*", rest)[0].translate(helpers.FOLD)
        where = re.match(r"[^/?#]*([^?#]*)", rest)[1]
        fits = [
            (-len(h + p), -len(h), v != "block", p, h.translate(helpers.FOLD) + p, v)
            for h, p, v in rules
            if h and p and (name == h.translate(helpers.FOLD) or name.endswith("." + h.translate(helpers.FOLD))) and where.startswith(p)
        ]
        best = min(fits, default=(0, 0, 0, 0, None, "allow"))
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (name, where, best[4], best[5]), u
    none = url_rules.judge(pages, spark.createDataFrame([], "host string, path string, verdict string"))
    assert {x.verdict for x in none.collect()} == {"allow"}
    assert url_rules.judge(pages.limit(0), spark.createDataFrame(rules, "host string, path string, verdict string")).count() == 0


# 9 neighbours


def test_neighbour_cases(spark):
    r = np.random.default_rng(4)
    rows = [(i, r.standard_normal(8).tolist()) for i in range(300)] + [(i, [1.0] * 8) for i in range(300, 900)]
    rows += [(900, None), (901, [0.0] * 8), (902, [float("nan")] * 8), (903, [float("inf")] + [1.0] * 7), (904, [None] + [1.0] * 7), (905, [])]
    rows += [(906, [1.0, 2.0]), (907, [1.0, 3.0]), (None, [1.0] * 8), (3, rows[3][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("mine"))
    ask = table.where("vec_id is null or vec_id % 100 in (0, 1, 2, 3, 4, 5, 6)")
    got = {}
    for x in ann.search(ann.build_index(table), ask, k=10).collect():
        got.setdefault(x.query_id, {})[x.rank] = (x.vec_id, x.score)
    good = {i: np.array(v, np.float32).astype(float) for i, v in rows if i is not None and i not in range(900, 906)}
    assert set(got) == {i for i in good if i % 100 < 7}
    for q, ranked in got.items():
        near = sorted((float(np.sqrt(((v - good[q]) ** 2).sum())), i) for i, v in good.items() if i != q and len(v) == len(good[q]))[:10]
        assert [ranked[k + 1] for k in range(len(ranked))] == [(i, s) for s, i in near]
    assert ann.search(ann.build_index(table.limit(0)), ask).count() == 0
    assert ann.search(ann.build_index(table), ask.limit(0)).count() == 0


def test_recall_on_blocks(spark, monkeypatch):
    """With many blocks and a share below one the forest itself must find the neighbours."""
    monkeypatch.setattr(ann, "ROWS", 64)
    r = np.random.default_rng(6)
    x = r.standard_normal((3000, 32))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = ann.search(ann.build_index(table), table.where("vec_id % 50 = 0")).toPandas()
    hit = 0
    for q, g in found.groupby("query_id"):
        far = ((x - x[q]) ** 2).sum(axis=1)
        far[q] = np.inf
        hit += len(set(np.argsort(far)[:10]) & set(g.vec_id))
    assert hit >= 0.9 * len(found) == 0.9 * 600


def test_neighbours_with_repeated_ids(spark, monkeypatch):
    """Rows repeated under one id in one block take no places from other ids, near or far in the forest."""
    monkeypatch.setattr(ann, "ROWS", 16)
    r = np.random.default_rng(7)
    x = r.standard_normal((50, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] * 3 + [(100, (x[0] + 1e-3).tolist())] * 400
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    ask = spark.createDataFrame([(i, x[i].tolist()) for i in range(10)], "vec_id long, embedding array<double>")
    found = ann.search(ann.build_index(table), ask, k=10).toPandas()
    assert sorted(found.groupby("query_id")["rank"].count()) == [10] * 10
    nearest = found[(found.query_id == 0) & (found["rank"] == 1)]
    assert nearest.vec_id.tolist() == [100]
    monkeypatch.setattr(ann, "ROWS", 1024)
    found = ann.search(ann.build_index(table), ask, k=10).toPandas()
    all_ids, all_x = np.r_[np.arange(50), 100], np.vstack([x, x[0] + 1e-3])
    for q, g in found.groupby("query_id"):
        far = np.sqrt(((all_x - x[q]) ** 2).sum(axis=1))
        far[q] = np.inf
        assert g.sort_values("rank").vec_id.tolist() == all_ids[np.lexsort((all_ids, far))[:10]].tolist()


# 10 licences


def test_licence_cases(spark):
    r = random.Random(10)
    plain = [" ".join(r.choice(["river", "stone", "the", "under", "work", "is", "free", "night"]) for _ in range(15)) for _ in range(300)]
    rows = [(i, f"{p}\n\n{plain[-i]}", "s") for i, p in enumerate(plain)]
    mit, apache = "Released under the MIT License.", "licensed under the APACHE license, version 2.0"
    rows += [(1001, f"{plain[0]}\r\n{mit}\n{apache}", "s"), (1002, mit, None), (1002, mit, None), (1003, plain[1] + "\n" + plain[5] + ". " + mit + " " + plain[2], "s")]
    rows += [(1004, None, None), (1005, "", "s"), (1006, " \n\n", "s"), (None, apache, "s"), (1007, (plain[3] + "\n") * 3000 + mit, "s")]
    table = spark.createDataFrame(rows, DOCS).withColumns({"families": F.lit("mine"), "text2": F.lit(1)})
    got = [(x.doc_id, x.n_paragraphs, x.families, x.n_confirmed) for x in licenses.scan(table).collect()]
    want = [(i, 2, [], 0) for i in range(300)]
    want += [(1001, 3, ["Apache-2.0", "MIT"], 2), (1002, 1, ["MIT"], 1), (1002, 1, ["MIT"], 1), (1003, 2, ["MIT"], 1)]
    want += [(1004, 0, [], 0), (1005, 0, [], 0), (1006, 0, [], 0), (None, 1, ["Apache-2.0"], 1), (1007, 3001, ["MIT"], 1)]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert licenses.scan(table.limit(0)).count() == 0


def test_licence_thresholds_count_every_paragraph(spark):
    """All scores count, not those of a sample; notices, sentences and blocks do not."""
    known = licenses.notices(spark)
    rows = [(i, 0, "MIT", f"the mit of {i}", 0.5 + i / 1000, True) for i in range(400)]
    rows += [(400 + i, 0, "MIT", "Released under the MIT License.", 0.999, True) for i in range(50)]
    rows += [(500, 0, "MIT", "a sentence", 0.9, False), (501, 0, "BSD", "plain bsd", 0.51, True)]
    found = spark.createDataFrame(rows, "_row long, _at int, family string, paragraph string, probability double, _whole boolean")
    kept = {r._row for r in licenses.over_thresholds(found, 10_000 + 50, known).collect()}
    assert kept == {*range(390, 400), *range(400, 450), 500, 501}  # 10 of 10,000 exceed the threshold
    assert licenses.over_thresholds(found, 1_000_000, known).count() == len(rows)


def test_wrapped_licences(spark):
    """Notices set in several lines, with and without comment marks, count once and only where they stand."""
    r = random.Random(11)
    plain = [" ".join(r.choice(["river", "stone", "the", "under", "work", "is", "free", "night"]) for _ in range(15)) for _ in range(200)]
    mit = ["Permission is hereby granted, free of charge, to any person obtaining a copy", "of this software and associated documentation files (the \"Software\"), to deal", "in the Software without restriction, including without limitation the rights"]
    bsd = ["Redistribution and use in source and binary forms, with or without", "modification, are permitted provided that the following conditions are met:"]
    gpl = ["This program is free software: you can redistribute it and/or modify", "it under the terms of the GNU General Public License as published by", "the Free Software Foundation, either version 3 of the License, or", "(at your option) any later version."]
    c = lambda lines: "/*\r\n" + "".join(f" * {x}\r\n" for x in lines) + " */\r\nint main;"
    sharp = lambda lines: "#\n" + "".join(f"# {x}\n" for x in lines) + "#\n"
    rows = [(i, f"{p}\n{plain[-i]}", "s") for i, p in enumerate(plain)]
    rows += [(1000, c(mit), "s"), (1001, sharp(bsd), "s"), (1002, "\n".join(gpl), "s"), (1003, plain[0] + ".\n" + "\n".join(mit) + ".\n" + plain[1], "s")]
    rows += [(1004, sharp(mit) + plain[2] + "\n" + sharp(gpl), "s"), (1005, plain[3] + "\nReleased under the MIT License.\n" + plain[4], "s")]
    rows += [(1006, "*" * 200000 + "x" + " " * 200000 + "y\n" + plain[5], "s")]
    got = {x.doc_id: (x.families, x.n_confirmed) for x in licenses.scan(spark.createDataFrame(rows, DOCS)).collect()}
    want = {i: ([], 0) for i in range(200)} | {1000: (["MIT"], 1), 1001: (["BSD"], 1), 1002: (["GPL-3.0"], 1), 1003: (["MIT"], 1)}
    want |= {1004: (["GPL-3.0", "MIT"], 2), 1005: (["MIT"], 1), 1006: ([], 0)}
    assert got == want


def test_frequency_table_on_the_driver(spark):
    """Many places of the table cost the driver the table and no object each; counts of tasks add up, bands allocate."""
    import tracemalloc

    many, rest = 200_000, [F.lit(1.0).alias(k) for k in ("_e", "_x", "_y", "_z")]
    places = spark.range(2 * many).select((F.col("id") % many * 20).alias("_place"), (F.col("id") % 7 + 0.0).alias("_c"), *rest)
    band = spark.range(2).select(F.lit(-1 - 6).cast("long").alias("_place"), F.lit(50.0).alias("_c"), F.lit(400.0).alias("_e"), *rest[1:])
    tracemalloc.start()
    try:
        table, plan = jaccard.frequencies(places.unionByName(band), jaccard.Plan(9, 10))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 2 * table.nbytes
    want = np.zeros(len(table))
    np.add.at(want, np.arange(2 * many) % many * 20, np.arange(2 * many) % 7)
    assert (table == want).all()
    assert plan.near.tolist() == jaccard.Plan(9, 10).allocate([(6, 100.0, 800.0, 2.0, 2.0, 2.0)]).near.tolist()

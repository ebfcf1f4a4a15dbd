"""The registered queries of this subpackage and, where SQL can state them, the SQL they are compared with."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from orderflow.llm import ann, bpe, chat, decontaminate, jaccard, licenses, merkle, mixing, sharding, toxicity, url_rules, warc, whitening


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_positional_index(spark: SparkSession, folder: str) -> DataFrame:
    index = decontaminate.build_index(table(spark, folder, "documents").select("doc_id", "text"))
    found = decontaminate.phrase_hits(index, table(spark, folder, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


OP1_SQL = r"""
WITH fold AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS phrase
  FROM items, unnest(range(1, greatest(len(w) - 10, 0) + 2)) t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM windows),
grams AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM fold, sizes, unnest(range(1, len(w) - size + 2)) t(i) WHERE len(w) >= size),
hits AS (SELECT doc_id, i, g.size, item_id FROM grams g JOIN windows v ON g.phrase = v.phrase AND g.size = v.size),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + size)) t(p) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS list
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT f.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM fold f LEFT JOIN words x ON f.doc_id = x.doc_id LEFT JOIN found y ON f.doc_id = y.doc_id
"""


def op2_chat_template(spark: SparkSession, folder: str) -> DataFrame:
    tricky = "\\### Assistant: </turn> ok"
    own = [(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)]
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    formatted = chat.format_conversations(rows.unionByName(spark.createDataFrame(own, rows.schema)))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {k: [] for k in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")}
            for text, spans in zip(batch.column("formatted").to_pylist(), batch.column("spans").to_pylist()):
                turns, loss = chat.read_back(text, [(s["begin"], s["end"]) for s in spans])
                whole = "".join(f"{role}\n{said}\n" for role, said in turns)
                digest = [hashlib.sha256(x.encode()).hexdigest() for x in (whole, loss)]
                for k, v in zip(out, (len(turns), digest[0], len(loss), digest[1], len(text))):
                    out[k].append(v)
            yield pa.RecordBatch.from_pydict({"conv_id": batch.column("conv_id"), **out})

    return formatted.mapInArrow(
        digests, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    )


OP2_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized AS (
  SELECT *, replace(replace(replace(text, '\', '\\'), '<turn>', '\<turn>'), '</turn>', '\</turn>') AS escaped,
    replace(replace(replace(replace(role, '\', '\\'), '<turn>', '\<turn>'), '</turn>', '\</turn>'), chr(10), '\' || chr(10)) AS header
  FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS LAST, role, text), '')) AS loss_sha256,
  sum(length(header) + length(escaped) + 15)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


def op3_nnpu_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, folder, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op4_warc_index(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    archives = warc.write_archives(pages)
    found = warc.read_records(warc.lookup(archives, warc.build_index(archives), pages))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP4_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY d, n) AS first FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""


def op5_histogram_sort_shards(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    docs = docs.withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit(""))))
    return sharding.shard_rows(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op6_van_der_corput_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


OP6_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(concat_ws(':', 'mix', coalesce(doc_id::VARCHAR, 'null'), md5(coalesce(text, '')))) AS h
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r
  FROM sized GROUP BY source),
weighed AS (SELECT *, [3, 1, 2][r % 3 + 1] AS w, 2 * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS budget FROM sources),
ordered AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / w, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
         sum(w) OVER (ORDER BY cap::DOUBLE / w, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
  FROM weighed),
level AS (
  SELECT arg_min((budget - used)::DOUBLE / free, used) AS v FROM ordered WHERE NOT (w * ((budget - used)::DOUBLE / free) > cap)),
aimed AS (
  SELECT source, r, source_size, cap, budget, CASE WHEN w * v > cap THEN cap::DOUBLE ELSE w * v END AS target
  FROM ordered, (SELECT coalesce(v, 0) AS v FROM level)),
takes AS (SELECT *, floor(target)::BIGINT AS take FROM aimed),
placed AS (
  SELECT doc_id, source, size, sum(size) OVER (PARTITION BY source ORDER BY h, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS a
  FROM sized)
SELECT doc_id, size, source_size, target,
       (least(greatest(take - a, 0), size) + least(greatest(take - source_size - a, 0), size))::BIGINT AS taken
FROM placed p JOIN takes t ON p.source IS NOT DISTINCT FROM t.source
"""

def op7_partition_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    found = jaccard.join_components(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id")


OP7_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
  FROM split, unnest(range(1, greatest(len(w) - 2, 1) + 1)) t(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * c >= 90 * (x.n + y.n - c)),
reach(node, other) AS (SELECT doc_id, doc_id FROM sizes UNION SELECT node, b FROM reach JOIN links ON other = a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(least(d.doc_id, m), d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes s ON d.doc_id = s.doc_id
LEFT JOIN (SELECT node, min(other) AS m FROM reach GROUP BY node) r ON d.doc_id = r.node
"""


URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def op8_url_sweep(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    judged = url_rules.judge(table(spark, folder, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


OP8_SQL = r"""
WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
parts AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM cut),
rules(rhost, rpath, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fits AS (
  SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS verdict
  FROM parts, rules WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id)
SELECT p.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts p LEFT JOIN fits f ON p.page_id = f.page_id
"""

def op9_prefix_forest(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return ann.search(ann.build_index(rows), rows.where(F.col("vec_id") % 100 == 0))


def op10_paragraph_licences(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_paragraphs", F.array_join("families", ",").alias("families"), "n_confirmed", "n_unconfirmed")


def op11_tree_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    tokenizer = bpe.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    found = bpe.encode_and_decode(table(spark, folder, "documents").select("doc_id", "text"), tokenizer)
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_cholesky_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows, model, error = whitening.whiten(table(spark, folder, "embeddings").select("vec_id", "embedding"))
    shares = F.lit((model.eigenvalues / (model.trace or 1.0)).tolist()).cast("array<double>")
    turned = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("_at", "whitened"))
    return turned.select(
        "vec_id", (F.col("_at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("_at")).alias("explained"), F.lit(error).alias("identity_error"),
    )


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    tampers = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    n_chars = F.when(tampers, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    tampered = merkle.digest(*(n_chars if f == "n_chars" else f for f in fields))
    # only where it differs, since every row's leaf is carried anyway
    claimed = {"claimed": F.when(tampers, tampered)}
    proofs = merkle.manifest(table(spark, folder, "documents"), fields, tree="lang", order="doc_id", extra=claimed)
    folded = merkle.fold(F.coalesce("claimed", "leaf"), F.col("path"))
    found = proofs.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("path.digest", ""), 256).alias("proof_sha256"), folded.alias("folded_root")
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


OP13_SQL = r"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    n_chars, coalesce(strlen(text) || ':' || text, '-') AS tail,
    xor(4294967295, list_reduce([4294967295] || flatten(list_transform(split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS crc
  FROM documents),
digests AS (
  SELECT doc_id, lang, i, n, crc, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
    sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail) AS other
  FROM leaves),
nodes(lang, level, i, n, d) AS (
  SELECT lang, 0, i, n, leaf FROM digests
  UNION ALL
  SELECT lang, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY i)) FROM nodes WHERE n > 1
  GROUP BY lang, level, n, i // 2),
tops AS (SELECT lang, level AS height, d, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
crown(level, i, n, d) AS (
  SELECT 0, i, n, d FROM tops
  UNION ALL
  SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY i)) FROM crown WHERE n > 1 GROUP BY level, n, i // 2),
ways AS (
  SELECT x.lang, x.i, s.level, (x.i >> s.level) % 2 = 1 AS on_left, sib.d
  FROM digests x JOIN (SELECT DISTINCT lang, level FROM nodes WHERE n > 1) s ON x.lang IS NOT DISTINCT FROM s.lang
  LEFT JOIN nodes sib ON sib.lang IS NOT DISTINCT FROM x.lang AND sib.level = s.level AND sib.i = xor(x.i >> s.level, 1)
  UNION ALL
  SELECT x.lang, x.i, t.height + s.level, (t.i >> s.level) % 2 = 1, sib.d
  FROM digests x JOIN tops t ON x.lang IS NOT DISTINCT FROM t.lang JOIN (SELECT DISTINCT level FROM crown WHERE n > 1) s ON true
  LEFT JOIN crown sib ON sib.level = s.level AND sib.i = xor(t.i >> s.level, 1)),
folds(lang, i, level, d) AS (
  SELECT lang, i, 0, CASE WHEN crc % 7 = 0 THEN other ELSE leaf END FROM digests
  UNION ALL
  SELECT f.lang, f.i, f.level + 1, sha256(CASE WHEN on_left THEN coalesce(w.d, '') || f.d ELSE f.d || coalesce(w.d, '') END)
  FROM folds f JOIN ways w ON f.lang IS NOT DISTINCT FROM w.lang AND f.i = w.i AND f.level = w.level),
last AS (SELECT lang, i, arg_max(d, level) AS d FROM folds GROUP BY lang, i),
proofs AS (SELECT lang, i, sha256(coalesce(string_agg(d, '' ORDER BY level), '')) AS proof FROM ways GROUP BY lang, i)
SELECT doc_id, leaf, t.d AS subroot, r.d AS root, coalesce(proof, sha256('')) AS proof_sha256, l.d AS folded_root, l.d = r.d AS verified
FROM digests x JOIN tops t ON x.lang IS NOT DISTINCT FROM t.lang JOIN last l ON x.lang IS NOT DISTINCT FROM l.lang AND x.i = l.i
LEFT JOIN proofs p ON x.lang IS NOT DISTINCT FROM p.lang AND x.i = p.i JOIN crown r ON r.n = 1
"""


QUERIES = {
    "op1_positional_index": op1_positional_index,
    "op2_chat_template": op2_chat_template,
    "op3_nnpu_toxicity": op3_nnpu_toxicity,
    "op4_warc_index": op4_warc_index,
    "op5_histogram_sort_shards": op5_histogram_sort_shards,
    "op6_van_der_corput_mix": op6_van_der_corput_mix,
    "op7_partition_jaccard": op7_partition_jaccard,
    "op8_url_sweep": op8_url_sweep,
    "op9_prefix_forest": op9_prefix_forest,
    "op10_paragraph_licences": op10_paragraph_licences,
    "op11_tree_bpe": op11_tree_bpe,
    "op12_cholesky_whitening": op12_cholesky_whitening,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE = {
    "op1_positional_index": OP1_SQL,
    "op2_chat_template": OP2_SQL,
    "op4_warc_index": OP4_SQL,
    "op6_van_der_corput_mix": OP6_SQL,
    "op7_partition_jaccard": OP7_SQL,
    "op8_url_sweep": OP8_SQL,
    "op13_merkle_manifest": OP13_SQL,
}

"""Toxicity by non-negative positive-unlabelled learning.

The classifier sees confirmed toxic texts and unlabelled ones, never confirmed clean ones. With class prior p its risk
is p * L(toxic, 1) + max(0, L(unlabelled, 0) - p * L(toxic, 0)): the unlabelled texts hold toxic ones too, and taking
their share out may not push the rest below zero. When it does, the step climbs that term again. The model is a
logistic one on the presence of words and of runs of four bytes inside words, chosen on the training texts.

Training texts are a bounded sample, the documents of smallest id hash: at most MAX_TOXIC toxic and MAX_UNLABELLED
unlabelled ones. Scoring reads every text whole, once, and moves no row.

Defined cases: labels without document and documents without id take no part in training; of documents sharing an
id the smallest text trains; null and empty texts score by the bias alone; without any toxic training text, or with
an empty table, every score is 0; input columns named ``score`` or ``predicted`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from orderflow.llm.words import ALPHANUMERIC, blocks
from orderflow.session import materialize

GRAM = 4
MAX_TOXIC, MAX_UNLABELLED, MAX_FEATURES = 8000, 16000, 1024
MIN_TEXTS, MIN_Z = 3, 4.0  # toxic texts that a feature must be in, and its least standardised log-odds
STEPS, RATE, DECAY = 400, 0.1, 1e-5
BLOCK_BYTES = 4 << 20


@dataclass
class Model:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """One fold, by the checksum of the id's text; a null id is in no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(False))


def training_texts(docs: DataFrame, labels: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(_id, toxic, _text): the sample, stored."""
    known = ~held_out(F.col(doc_id)) & F.col(doc_id).isNotNull()
    order = F.md5(F.col("_id").cast("string"))
    toxic = labels.where(known & (F.col("toxic") == 1)).select(F.col(doc_id).alias("_id")).distinct()
    some = docs.where(known).select(F.col(doc_id).alias("_id")).distinct()
    toxic = toxic.join(some, "_id", "left_semi").orderBy(order, "_id").limit(MAX_TOXIC).withColumn("toxic", F.lit(1))
    some = some.orderBy(order, "_id").limit(MAX_UNLABELLED).withColumn("toxic", F.lit(0))
    chosen = materialize(toxic.unionByName(some), "pu-sample")
    ids = F.broadcast(chosen.select("_id").distinct())  # MAX_TOXIC + MAX_UNLABELLED ids at most
    texts = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text")).join(ids, "_id")
    return materialize(chosen.join(texts.groupBy("_id").agg(F.min("_text").alias("_text")), "_id"), "pu-texts")


def _present(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, feature) of a batch, as two arrays sorted by text."""
    docs, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for feature, doc in ALPHANUMERIC.features(batch.column("_text"), GRAM):
        order = np.lexsort((feature, doc))
        feature, doc = feature[order], doc[order]
        new = np.ones(len(doc), bool)
        new[1:] = (np.diff(doc) != 0) | (feature[1:] != feature[:-1])
        docs.append(doc[new])
        found.append(feature[new])
    docs, found = np.concatenate(docs), np.concatenate(found)
    order = np.lexsort((found, docs))
    docs, found = docs[order], found[order]
    new = np.ones(len(docs), bool)
    new[1:] = (np.diff(docs) != 0) | (found[1:] != found[:-1])
    return docs[new], found[new]


def choose_features(sample: DataFrame) -> np.ndarray:
    """Features with the largest standardised log-odds between toxic and unlabelled texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "_text", BLOCK_BYTES):
            docs, found = _present(batch)
            toxic = batch.column("toxic").to_numpy()[docs] == 1
            feature, number = np.unique(found, return_inverse=True)
            hits = np.bincount(number[toxic], minlength=len(feature))
            yield pa.RecordBatch.from_pydict({
                "f": feature.view(np.int64), "p": hits, "u": np.bincount(number, minlength=len(feature)) - hits
            })

    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    p, u = F.col("p") + 0.5, F.col("u") + 0.5
    odds = F.log(p / (n.get(1, 0) + 1 - p)) - F.log(u / (n.get(0, 0) + 1 - u))
    counted = sample.select("toxic", "_text").mapInArrow(count, "f bigint, p bigint, u bigint")
    counted = counted.groupBy("f").agg(F.sum("p").alias("p"), F.sum("u").alias("u")).where(F.col("p") >= MIN_TEXTS)
    best = counted.withColumn("z", odds / F.sqrt(1 / p + 1 / u)).where(F.col("z") > MIN_Z).orderBy(F.desc("z"), "f").limit(MAX_FEATURES)
    return np.sort(np.array([r["f"] for r in best.select("f").collect()], np.int64).view(np.uint64))


def _find(features: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Feature numbers, -1 for unknown ones."""
    if not len(features):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(features, values), len(features) - 1)
    return np.where(features[at] == values, at, -1)


def fit(toxic: list[list[int]], unlabelled: list[list[int]], n_features: int, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias by full-batch Adam on the non-negative risk; rows list the features that are present."""
    rows = toxic + unlabelled
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.array([x for r in rows for x in r], np.int64)
    n, m = max(1, len(toxic)), max(1, len(unlabelled))
    is_toxic = np.arange(len(rows)) < len(toxic)
    theta, mean, square = np.zeros(n_features + 1), np.zeros(n_features + 1), np.zeros(n_features + 1)
    theta[-1] = np.log(prior / (1 - prior))
    for step in range(1, STEPS + 1):
        g = np.bincount(row, theta[column], len(rows)) + theta[-1]
        s = 1 / (1 + np.exp(-np.clip(g, -30, 30)))
        as_clean = np.logaddexp(0, g)
        rest = as_clean[~is_toxic].mean() - prior * as_clean[is_toxic].mean()
        positive = np.where(is_toxic, prior / n * (s - 1), 0)
        negative = np.where(is_toxic, -prior / n * s, s / m)
        slope = positive + negative if rest >= 0 else -negative
        grad = np.append(np.bincount(column, slope[row], n_features), slope.sum())
        grad[:-1] += DECAY * theta[:-1]
        mean, square = 0.9 * mean + 0.1 * grad, 0.999 * square + 0.001 * grad**2
        theta -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> Model:
    """The model; the class prior is the toxic share of all labels outside the held-out fold."""
    known = labels.where(~held_out(F.col(doc_id)) & F.col("toxic").isNotNull())
    prior = known.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]
    sample = training_texts(docs, labels, text, doc_id)
    features = choose_features(sample) if prior else np.zeros(0, np.uint64)
    if not len(features):
        return Model(features, np.zeros(0), -np.inf)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "_text", BLOCK_BYTES):
            lists = [[] for _ in range(batch.num_rows)]
            docs, found = _present(batch)
            number = _find(features, found)
            for d, f in zip(docs[number >= 0].tolist(), number[number >= 0].tolist()):
                lists[d].append(f)
            yield pa.RecordBatch.from_pydict({"_id": batch.column("_id").cast(pa.string()), "toxic": batch.column("toxic"), "f": pa.array(lists, pa.list_(pa.int32()))})

    table = sample.mapInArrow(rows, "_id string, toxic int, f array<int>").orderBy("toxic", "_id").collect()
    sides = [[r["f"] for r in table if r["toxic"] == side] for side in (1, 0)]
    weights, bias = fit(*sides, len(features), min(max(prior, 1e-3), 0.999))
    return Model(features, weights, bias)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All rows with score (0 to 1) and predicted (score >= 0.5)."""
    features, weights, bias = model.features, model.weights, model.bias
    maybe = np.zeros(1 << 20, bool)
    maybe[features >> np.uint64(44)] = True

    def scores(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            out = np.full(len(part), bias)
            for batch in blocks(iter([pa.RecordBatch.from_arrays([part], ["_text"])]), "_text", BLOCK_BYTES):
                first = batch.column(0).offset - part.offset
                seen = [np.zeros(0, np.int64)]
                for feature, doc in ALPHANUMERIC.features(batch.column(0), GRAM):
                    some = np.flatnonzero(maybe[feature >> np.uint64(44)])
                    number = _find(features, feature[some])
                    seen.append(np.unique((doc[some] * len(features) + number)[number >= 0]))
                seen = np.unique(np.concatenate(seen))
                if len(seen):
                    doc, number = np.divmod(seen, len(features))
                    out[first : first + batch.num_rows] += np.bincount(doc, weights[number], batch.num_rows)
            yield pa.array(1 / (1 + np.exp(-np.clip(out, -700, 700))) * (out > -np.inf))

    scorer = F.arrow_udf(scores, "double")
    docs = docs.drop(*({"score", "predicted"} - {text}))
    return docs.withColumn("score", scorer(F.col(text))).withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))

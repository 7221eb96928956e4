"""Toxicity of texts by a counterfactually regularised linear classifier.

Features are lower-case words and word beginnings of PREFIXES letters; a feature that occurs k times
counts log(1 + k), and log(1 + words) is a feature of its own. Of the features of the training rows,
those stay that occur in at least LEAST_ROWS of them and whose rates in the two classes differ by
LEAST_Z standard errors. Logistic regression fits their weights. For each training text that mentions
a group (identity terms), a counterfactual has each such term replaced by the next one of its list; the
squared change of the logit is penalised, so that the mention itself does not decide.

Training rows are bounded by MAX_TRAINING (those with the least hash of their id), which bounds what
the driver holds; all documents are scored, in one narrow pass with the weights broadcast, at most
MAX_FEATURES of them.

A null or blank text is scored by the bias. Rows with a null label or an id without a document teach
nothing; repeated labels of an id count once, as toxic if any is. Without labelled rows the score is
1/3 for every text. Repeated documents get the same score. Empty tables give an empty result.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipyard.llm.words import gather, slices, split_words, sums
from quipyard.session import store

MAX_TRAINING = 20_000
MAX_FEATURES = 20_000
LEAST_ROWS = 5
LEAST_Z = 4.0
PREFIXES = (4, 5, 6, 7)
#: Weight of the squared weights and of the squared logit changes.
RIDGE, FAIRNESS = 2e-4, 1.0
STEPS = 400
#: Lists of terms that name groups; a term's counterfactual is the next of its list.
IDENTITY_TERMS = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "straight", "lesbian", "bisexual"),
    ("black", "white", "asian", "latino"),
    ("immigrants", "citizens"),
    ("frauen", "männer"),
    ("muslime", "christen", "juden"),
    ("femmes", "hommes"),
    ("musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres"),
    ("musulmanes", "cristianos", "judíos"),
)


def is_held_out(doc_id: Column) -> Column:
    """Rows that never teach: crc32 of the id as text is divisible by 5; a null id is held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def features_of(word: str) -> list[str]:
    """Features of one lower-case word."""
    bare = word.strip(string.punctuation)
    if not bare:
        return []
    return ["=" + bare, *["^" + bare[:n] for n in PREFIXES if len(bare) >= n]]


@dataclass
class Model:
    """Weights by feature, of log(1 + words), and the bias."""

    bias: float = float(np.log(0.5))
    length: float = 0.0
    weights: dict[str, float] = field(default_factory=dict)

    def scores(self, texts: pa.Array) -> np.ndarray:
        places = {name: i for i, name in enumerate(self.weights)}
        sizes, rows, features, counts = feature_counts(texts, places)
        weights = np.fromiter(self.weights.values(), float, len(self.weights))
        logits = self.bias + self.length * np.log1p(sizes)
        logits += np.bincount(rows, weights[features] * np.log1p(counts), len(sizes))
        return 1 / (1 + np.exp(-np.clip(logits, -500, 500)))


def feature_counts(texts: pa.Array, places: dict[str, int]):
    """Words of each text, and (row, feature, count) of the features that have a place."""
    sizes, codes, distinct = split_words(pc.utf8_lower(pc.fill_null(texts, "")))
    known = [[places[f] for f in features_of(w) if f in places] for w in distinct.to_pylist()]
    widths = np.fromiter(map(len, known), np.int64, len(known))
    flat = np.array([f for fs in known for f in fs], np.int64)
    # one number per text and feature
    owners = np.repeat(np.arange(len(sizes)), sums(widths[codes], sizes))
    pairs, counts = np.unique(owners * max(1, len(places)) + gather(codes, widths, flat), return_counts=True)
    return sizes, pairs // max(1, len(places)), pairs % max(1, len(places)), counts


def counterfactual(text: str, terms: dict[str, str]) -> str:
    """Lower-case text with each identity term replaced; the same text if there is none."""
    words = []
    for word in text.lower().split():
        bare = word.strip(string.punctuation)
        words.append(word.replace(bare, terms[bare]) if bare in terms else word)
    return " ".join(words)


def _swaps(lists) -> dict[str, str]:
    return {a: b for terms in lists for a, b in zip(terms, (*terms[1:], terms[0]))}


def training_rows(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAINING) -> DataFrame:
    """text and label of at most `most` labelled documents that are not held out.

    Of several rows with one id the one with the least hash of its text counts.
    """
    known = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").filter(~is_held_out(F.col("doc_id")))
    once = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    some = once.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    # at most `most` ids and labels, and a row for each
    rows = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")
    least = F.min(F.struct(F.xxhash64("text"), "text", F.col("toxic").cast("int").alias("toxic"))).alias("row")
    return rows.groupBy("doc_id").agg(least).select("row.text", "row.toxic")


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        rows: tuple[Counter, Counter] = Counter(), Counter()
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            found = {f for w in set((text or "").lower().split()) for f in features_of(w)}
            rows[int(toxic == 1)].update(found)
        names = list(rows[0].keys() | rows[1].keys())
        columns = [pa.array(names, pa.string())] + [pa.array([rows[y][n] for n in names], pa.int64()) for y in (0, 1)]
        yield pa.RecordBatch.from_arrays(columns, ["feature", "clean", "toxic"])


def select_features(rows: DataFrame, clean: int, toxic: int, always: list[str]) -> list[str]:
    """Features whose share of rows differs between the classes, the clearest first."""
    counted = rows.mapInArrow(_count_features, "feature STRING, clean BIGINT, toxic BIGINT")
    summed = counted.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    p, q = F.col("toxic") / max(toxic, 1), F.col("clean") / max(clean, 1)
    share = (F.col("toxic") + F.col("clean")) / max(toxic + clean, 1)
    error = F.sqrt(share * (1 - share) * (1 / max(toxic, 1) + 1 / max(clean, 1)) + 1e-12)
    clear = summed.filter(F.col("toxic") + F.col("clean") >= LEAST_ROWS).withColumn("z", F.abs(p - q) / error)
    found = clear.filter((F.col("z") >= LEAST_Z) | F.col("feature").isin(always))
    return [r.feature for r in found.orderBy(F.desc("z"), "feature").limit(MAX_FEATURES).collect()]


def fit_weights(sizes, rows, features, values, labels, pairs, n_features: int, fairness: float):
    """Logistic regression by Adam on sparse rows; `pairs` are (row, counterfactual row)."""
    n = len(labels)
    weight = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (labels == 0).sum())) * 0.5 + 0.5 / n
    theta, m, v = np.zeros(n_features + 2), np.zeros(n_features + 2), np.zeros(n_features + 2)
    theta[-1] = np.log((labels.sum() + 0.5) / ((labels == 0).sum() + 1))
    lengths = np.log1p(sizes) - 5
    total = len(sizes)
    for step in range(1, STEPS + 1):
        logits = np.bincount(rows, theta[features] * values, total) + theta[-2] * lengths + theta[-1]
        pull = np.zeros(total)
        pull[:n] = weight * (1 / (1 + np.exp(-np.clip(logits[:n], -50, 50))) - labels)
        if len(pairs):
            change = 2 * fairness / len(pairs) * (logits[pairs[:, 0]] - logits[pairs[:, 1]])
            np.add.at(pull, pairs[:, 0], change)
            np.add.at(pull, pairs[:, 1], -change)
        gradient = np.concatenate((np.bincount(features, pull[rows] * values, n_features), [pull @ lengths, pull.sum()]))
        gradient[:n_features] += RIDGE * theta[:n_features]
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        theta -= 0.1 * (1 - step / (STEPS + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    theta[-1] -= 5 * theta[-2]
    return theta


def train(
    docs: DataFrame,
    labels: DataFrame,
    identity_terms=IDENTITY_TERMS,
    fairness: float = FAIRNESS,
    most: int = MAX_TRAINING,
) -> Model:
    """Fit on a bounded number of labelled rows."""
    swaps = _swaps(identity_terms)
    rows = store(training_rows(docs, labels, most), "training")
    counts = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if not counts:
        return Model()
    names = select_features(rows, counts.get(0, 0), counts.get(1, 0), ["=" + t for t in swaps])
    places = rows.sparkSession.sparkContext.broadcast({name: i for i, name in enumerate(names)})

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            swapped = [counterfactual(t, swaps) if any(w in t.lower() for w in swaps) else None for t in texts]
            changed = [i for i, (t, s) in enumerate(zip(texts, swapped)) if s is not None and s != " ".join(t.lower().split())]
            every = pa.array(texts + [swapped[i] for i in changed], pa.large_string())
            sizes, owners, features, n = feature_counts(every, places.value)
            of = [-1] * len(texts) + changed
            at = np.searchsorted(owners, np.arange(len(sizes) + 1))
            toxic = batch.column("toxic").to_pylist()
            columns = [
                pa.array([toxic[i if o < 0 else o] for i, o in zip(range(len(sizes)), of)], pa.int32()),
                pa.array(sizes, pa.int64()),
                pa.array([None if o < 0 else len(sizes) - i for i, o in enumerate(of)], pa.int32()),
                pa.array([features[a:b].tolist() for a, b in zip(at, at[1:])], pa.list_(pa.int32())),
                pa.array([n[a:b].tolist() for a, b in zip(at, at[1:])], pa.list_(pa.int32())),
                pa.array([o if o >= 0 else i for i, o in enumerate(of)], pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["toxic", "size", "swapped", "features", "counts", "origin"])

    # at most twice `most` sparse rows
    schema = "toxic INT, size BIGINT, swapped INT, features ARRAY<INT>, counts ARRAY<INT>, origin INT"
    batch_no = F.spark_partition_id().alias("part")
    table = rows.mapInArrow(vectors, schema).select("*", batch_no).toArrow().to_pylist()
    return _fit(table, names, fairness)


def _fit(table: list[dict], names: list[str], fairness: float) -> Model:
    texts = [r for r in table if r["swapped"] is None]
    order = {id(r): i for i, r in enumerate(texts)}
    run, every, pairs = {}, list(texts), []
    for r in table:  # a batch's counterfactuals stand behind its texts
        if r["swapped"] is None:
            run[(r["part"], r["origin"])] = order[id(r)]
        else:
            pairs.append((run[(r["part"], r["origin"])], len(every)))
            every.append(r)
    sizes = np.array([r["size"] for r in every], float)
    widths = [len(r["features"]) for r in every]
    rows = np.repeat(np.arange(len(every)), widths)
    features = np.array([f for r in every for f in r["features"]], np.int64)
    values = np.log1p(np.array([c for r in every for c in r["counts"]], float))
    labels = np.array([r["toxic"] for r in texts], float)
    pairs = np.array(pairs, np.int64).reshape(-1, 2)
    theta = fit_weights(sizes, rows, features, values, labels, pairs, len(names), fairness)
    return Model(float(theta[-1]), float(theta[-2]), dict(zip(names, theta[: len(names)].tolist())))


def score_documents(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            scores = shared.value.scores(batch.column("text"))
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    source = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), is_held_out(F.col(doc_id)).alias("held_out"), F.col(text).alias("text")
    )
    return source.mapInArrow(run, "doc_id BIGINT, held_out BOOLEAN, score DOUBLE, predicted INT")


def drop_toxic(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` without texts that score 0.5 or more; all columns as they were, and no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            yield batch.filter(pa.array(shared.value.scores(batch.column(text)) < 0.5))

    return docs.mapInArrow(run, docs.schema)

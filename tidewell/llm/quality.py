"""Quality classifier: regularised quadratic discriminant analysis.

Statistics of every whole text are transformed (logarithms, logits of shares, both
drawn towards usual values by a fixed amount of text, so that those of short texts are
no extremes) and written once. Class means and covariances come from sums that Spark adds up over all
labelled rows; each covariance is shrunk towards the pooled one and that towards a
multiple of the identity. A score is the logistic of the prior's log-odds and the
difference of the two Mahalanobis log-densities, computed with the Cholesky factors
kept in the model.

Defined results: a null text counts as empty, as does one of white space alone; empty
texts are scored by the same statistics (of no characters); a class without labelled rows leaves every score at the other
class's value (1 or 0; 0.5 without any label). Rows stand alone: repeats and order do
not matter. Repeated labels of an id count by majority. Further columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from tidewell.llm import common

QUERY = "op6_quality"

#: Shares of the pooled covariance and of the identity in a class covariance.
TO_POOLED, TO_IDENTITY = 0.1, 0.02
#: Characters and words of usual text by which every text's statistics are drawn in.
USUAL_CHARS, USUAL_WORDS = 100.0, 20.0
#: Labels up to this number are broadcast (16 bytes each).
BROADCAST_LABELS = 500_000
#: A document is kept at this score and above.
THRESHOLD = 0.7

NAMES = (
    "log_chars", "log_words", "word_length", "longest_word", "upper", "punctuation", "symbols", "digits",
    "spaces", "marks", "entropy", "distinct_words", "top_word", "repeated_lines", "sentence_ends", "bare_words",
)

_PUNCTUATION, _SYMBOLS, _MARKS = b".,;:'\"()-", b"#$%&*|<>{}~^@=+_\\/[]`", b"!?"


def logit(k: float, n: float, usual: float, amount: float) -> float:
    """Log-odds of k in n, after an amount of text with the usual share."""
    return math.log((k + amount * usual) / (n - k + amount * (1 - usual)))


def statistics(text: str | None) -> list[float]:
    """Transformed statistics of one text, in the order of NAMES."""
    text = text or ""
    if not text.strip():
        text = ""
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    words = text.split()
    n, m, size = len(text), len(words), int(raw.sum())
    counts = Counter(words)
    lines = Counter(x for x in text.split("\n") if x.strip())
    lower, upper = int(raw[97:123].sum()), int(raw[65:91].sum())
    repeated = sum(len(x) * (k - 1) for x, k in lines.items())
    p = raw[raw > 0] / max(1, size)
    # Entropy with the usual correction for the bytes not yet seen.
    bits = float(-(p * np.log2(p)).sum()) * size + (len(p) - 1) / (2 * math.log(2)) if size else 0.0
    share = lambda chars, usual: logit(int(raw[list(chars)].sum()), size, usual, USUAL_CHARS)
    of_words = lambda k, usual: logit(k, m, usual, USUAL_WORDS)
    return [
        math.log1p(n),
        math.log1p(m),
        math.log((n + 6 * USUAL_WORDS) / (m + USUAL_WORDS)),
        math.log(10 + max(map(len, counts), default=0)),
        logit(upper, lower + upper, 0.04, USUAL_CHARS),
        share(_PUNCTUATION, 0.03),
        share(_SYMBOLS, 0.005),
        share(range(48, 58), 0.01),
        share(b" \t\n\r", 0.17),
        share(_MARKS, 0.003),
        (bits + 4.3 * USUAL_CHARS) / (size + USUAL_CHARS),
        math.log((len(counts) + USUAL_WORDS) / (m + USUAL_WORDS)),
        of_words(max(counts.values(), default=0), 0.06),
        logit(repeated, n, 0.02, USUAL_CHARS),
        of_words(sum(k for w, k in counts.items() if w[-1] in ".!?"), 0.07),
        of_words(sum(k for w, k in counts.items() if w.isalpha()), 0.85),
    ]


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, x): statistics of every whole text."""
    common.bound_batches(docs.sparkSession)
    source = docs.select("doc_id", F.col("text").alias("__text"))

    def run(batches):
        for batch in batches:
            x = [statistics(t) for t in batch.column("__text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "x"])

    return source.mapInArrow(run, source.select("doc_id").schema.add("x", ArrayType(DoubleType())))


class Discriminant:
    """Two Gaussian classes, their Cholesky factors and log priors."""

    def __init__(self, counts, sums, squares):
        """Per class: number of rows, sum of x, sum of x times x transposed."""
        n = np.array(counts, float)
        self.constant = None
        if n.min() < 2:
            self.constant = 0.5 if n.max() < 2 else float(n.argmax())
            return
        means = [s / k for s, k in zip(sums, n, strict=True)]
        within = [q / k - np.outer(m, m) for q, k, m in zip(squares, n, means, strict=True)]
        pooled = (n[0] * within[0] + n[1] * within[1]) / n.sum()
        self.scale = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
        unit = np.outer(self.scale, self.scale)
        d = len(self.scale)
        self.means, self.inverse, self.log_det = [], [], []
        for m, w, k in zip(means, within, n, strict=True):
            w = w / unit
            # A class of few rows leans more on the pooled covariance.
            a = min(1.0, TO_POOLED + d / (d + k))
            w = (1 - a) * w + a * pooled / unit
            w = (1 - TO_IDENTITY) * w + TO_IDENTITY * max(np.trace(w) / d, 1e-6) * np.eye(d)
            factor = np.linalg.cholesky(w)
            self.means.append(m / self.scale)
            self.inverse.append(np.linalg.inv(factor))
            self.log_det.append(2 * float(np.log(np.diag(factor)).sum()))
        self.prior = float(np.log(n[1] / n[0]))

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for rows of statistics."""
        if self.constant is not None:
            return np.full(len(x), self.constant)
        z = x / self.scale
        log = [-0.5 * (((z - m) @ f.T) ** 2).sum(axis=1) - 0.5 * d for m, f, d in zip(self.means, self.inverse, self.log_det, strict=True)]
        return 1 / (1 + np.exp(-np.clip(self.prior + log[1] - log[0], -500, 500)))


def fit(held: DataFrame, labels: DataFrame) -> Discriminant:
    """Fit on features (doc_id, x) of all ids in labels (label_id, y); only sums reach the driver."""
    d = len(NAMES)
    rows = held.join(labels, held["doc_id"] == labels["label_id"]).select("y", *[F.col("x")[i].alias(f"x{i}") for i in range(d)])
    first = [F.sum(f"x{i}").alias(f"s{i}") for i in range(d)]
    second = [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"q{i}_{j}") for i in range(d) for j in range(i + 1)]
    counts, sums, squares = [0, 0], [np.zeros(d)] * 2, [np.zeros((d, d))] * 2
    for r in rows.groupBy("y").agg(F.count("*").alias("n"), *first, *second).collect():
        q = np.zeros((d, d))
        for i in range(d):
            for j in range(i + 1):
                q[i, j] = q[j, i] = r[f"q{i}_{j}"]
        counts[r["y"]], sums[r["y"]], squares[r["y"]] = r["n"], np.array([r[f"s{i}"] for i in range(d)]), q
    return Discriminant(counts, sums, squares)


def fit_texts(docs: DataFrame, labels: DataFrame) -> Discriminant:
    """fit() on the texts of docs (doc_id, text) that have a label; statistics are computed for those alone if the labels can be broadcast."""
    if labels.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS:
        ids = F.broadcast(labels.select("label_id"))
        return fit(features(docs.join(ids, docs["doc_id"] == ids["label_id"], "left_semi")), labels)
    return fit(common.table(features(docs), "quality"), labels)


def score(held: DataFrame, model: Discriminant) -> DataFrame:
    """held with a column score."""
    shipped = held.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), float).reshape(batch.num_rows, len(NAMES))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shipped.value.score(x), pa.float64())], names=[*batch.schema.names, "score"])

    return held.mapInArrow(run, StructType([*held.schema.fields, StructField("score", DoubleType())]))


def score_texts(docs: DataFrame, model: Discriminant) -> DataFrame:
    """docs with a column score (in place of one it has), from every whole text."""
    docs = docs.drop("score")
    common.bound_batches(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            x = np.array([statistics(t) for t in batch.column("text").to_pylist()], float).reshape(batch.num_rows, len(NAMES))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shipped.value.score(x), pa.float64())], names=[*batch.schema.names, "score"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("score", DoubleType())]))


def train_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels that may be learned from: the fold other than the held-out one."""
    labels = common.label_of(common.read(spark, sf_dir, "labels"), "quality")
    return labels.where(common.fold(F.col("label_id"), 4) != 2)


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, x, score) of every document, by a model fitted on the labelled ones."""
    held = common.table(features(docs), "quality")
    return score(held, fit(held, labels))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = classify(spark, common.read(spark, sf_dir, "documents"), train_labels(spark, sf_dir))
    return out.select(
        "doc_id",
        F.coalesce(common.fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )

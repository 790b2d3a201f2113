"""Quality classifier learned from trusted positives and unlabelled text.

The model is a logistic score over counted features of a text. It minimises the
non-negative unbiased risk of positive-unlabelled learning: with the class prior
``p``, trusted positives P and unlabelled text U,

    p * R_P(+1)  +  max(0, R_U(-1) - p * R_P(-1)).

Known negatives are never used as such; they only count for the prior. Every pass
over the features is a Spark job that brings back one gradient and one Hessian.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curaspan.llm.common import key_remainder, map_texts, with_plain_names, written
from curaspan.session import broadcast_if_small

LEARN_MODULUS = 5
MIN_SCORE = 0.3
MAX_PASSES = 15
# Weight of the squared coefficients; with few trusted texts more is needed.
RIDGE = 2e-3
RIDGE_PER_TRUSTED = 2.0
# Step length along the risk that went negative, as in the non-negative correction.
CORRECTION = 0.5
# Labels up to this count go to every executor; more are joined through a shuffle.
BROADCAST_LABELS = 500_000

_GROUPS = [
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&",
    b"|<>", b"!?", b".,;:", b"\"'`", b"()[]{}", b"@/\\_+=~^-", b"\n", b" \t\r\x0b\x0c",
]
_MEMBERS = np.zeros((256, len(_GROUPS) + 1))
for _g, _chars in enumerate(_GROUPS):
    _MEMBERS[list(_chars), _g] = 1
_MEMBERS[0x80:, len(_GROUPS)] = 1
N_FEATURES = 2 * (len(_GROUPS) + 1) + 8


class QualityModel(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last one is the bias
    prior: float

    def scores(self, features: np.ndarray) -> np.ndarray:
        margin = _standard(features, self.mean, self.scale) @ self.weights
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def _standard(features: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    # Far outliers would rule the fit; six deviations tell as much.
    scaled = np.clip((features - mean) / scale, -6, 6)
    return np.hstack([scaled, np.ones((len(scaled), 1))])


def text_features(texts: list[bytes]) -> np.ndarray:
    """One row of ``N_FEATURES`` numbers per text; an empty text has zeros."""
    out = np.zeros((len(texts), N_FEATURES))
    k = len(_GROUPS) + 1
    for row, raw in zip(out, texts):
        if not raw:
            continue
        share = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _MEMBERS / len(raw)
        row[:k] = share
        row[k : 2 * k] = np.sqrt(share)
        words = raw.split()
        if not words:
            continue
        counts = Counter(words)
        pairs = Counter(zip(words, words[1:]))
        lines = [line for line in raw.split(b"\n") if line.strip()]
        n = len(words)
        same = sum(c for (a, b), c in pairs.items() if a == b)
        row[2 * k :] = (
            np.log1p(n),
            np.log1p(len(raw) / n),
            len(counts) / n,
            max(counts.values()) / n,
            same / n,
            1 - len(pairs) / max(1, n - 1),
            1 - len(set(lines)) / len(lines),
            np.log1p(n / len(lines)),
        )
    return out


def document_features(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id_col`` and the features of every row as ``features`` (array of doubles)."""
    return map_texts(
        docs, [id_col], text_col, "features array<double>", lambda t: [list(text_features(t))]
    )


def _totals(df: DataFrame, size: int, add) -> np.ndarray:
    """Sum of the vectors that ``add`` makes of batches; ``size`` rows come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                flat = batch.column(0).flatten().to_numpy(zero_copy_only=False)
                features = flat.reshape(batch.num_rows, N_FEATURES)
                mark = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
                total += add(features, mark)
        yield pa.RecordBatch.from_arrays([pa.array([total])], names=["v"])

    sums = (
        df.select("features", "__positive")
        .mapInArrow(run, "v array<double>")
        .select(F.posexplode("v").alias("i", "x"))
        .groupBy("i")
        .agg(F.sum("x").alias("x"))
    )
    out = np.zeros(size)
    for row in sums.collect():
        out[row["i"]] = row["x"]
    return out


def fit_quality(learning: DataFrame, prior: float) -> QualityModel:
    """Fit on rows of ``features`` and ``__positive``; all rows are the unlabelled text.

    Without positives the model is constant: every text has the score ``prior``.
    """
    d = N_FEATURES

    def moments(x: np.ndarray, mark: np.ndarray) -> np.ndarray:
        return np.concatenate([[len(x), mark.sum()], x.sum(0), (x * x).sum(0)])

    m = _totals(learning, 2 + 2 * d, moments)
    n, n_trusted = m[0], m[1]
    mean = m[2 : 2 + d] / max(n, 1)
    scale = np.sqrt(np.maximum(m[2 + d :] / max(n, 1) - mean**2, 0))
    scale[scale < 1e-9] = 1
    weights = np.zeros(d + 1)
    weights[-1] = np.log(prior / (1 - prior))
    if not n_trusted:
        return QualityModel(mean, scale, weights, prior)

    def risk(w: np.ndarray):
        """Risk terms, their gradients and the Hessian at ``w``."""

        def add(x: np.ndarray, mark: np.ndarray) -> np.ndarray:
            x = _standard(x, mean, scale)
            g = x @ w
            p = 1 / (1 + np.exp(-np.clip(g, -500, 500)))
            soft = np.logaddexp(0, g)
            xp = x[mark]
            return np.concatenate(
                [
                    [soft.sum(), soft[mark].sum(), g[mark].sum()],
                    p @ x,
                    p[mark] @ xp,
                    xp.sum(0),
                    ((x * (p * (1 - p))[:, None]).T @ x).ravel(),
                ]
            )

        k = d + 1
        t = _totals(learning, 3 + 3 * k + k * k, add)
        soft_u, soft_p, g_p = t[0] / n, t[1] / n_trusted, t[2] / n_trusted
        grad_u, grad_p, sum_p = (
            t[3 : 3 + k] / n, t[3 + k : 3 + 2 * k] / n_trusted, t[3 + 2 * k : 3 + 3 * k] / n_trusted,
        )
        negative = soft_u - prior * soft_p  # R_U(-1) - p * R_P(-1)
        positive = prior * (soft_p - g_p)  # p * R_P(+1)
        ridge = (RIDGE + RIDGE_PER_TRUSTED / n_trusted) * np.r_[np.ones(d), 0]
        total = positive + max(0.0, negative) + 0.5 * ridge @ (w * w)
        gradient = grad_u - prior * sum_p + ridge * w
        hessian = t[3 + 3 * k :].reshape(k, k) / n + np.diag(ridge + 1e-9)
        return total, negative, gradient, hessian, grad_u - prior * grad_p

    now = risk(weights)
    length = 1.0
    for _ in range(MAX_PASSES):
        total, negative, gradient, hessian, of_negative = now
        if negative < 0:
            # The unlabelled risk is overfitted: go back up along it.
            weights = weights + CORRECTION * of_negative
            now = risk(weights)
            continue
        step = np.linalg.solve(hessian, gradient)
        tried = weights - length * step
        then = risk(tried)
        if then[0] > total + 1e-9:
            length /= 2
            continue
        weights, now, length = tried, then, min(1.0, 2 * length)
        if total - then[0] < 1e-6:
            break
    return QualityModel(mean, scale, weights, prior)


def learn_quality(
    features: DataFrame, labels: DataFrame, id_col: str, learn: Column
) -> QualityModel:
    """Model from the rows of ``features`` (of ``document_features``) where ``learn`` holds.

    ``labels`` has ``id_col`` and ``quality``. An id is trusted if all its labels are 1;
    the prior is the trusted share of judged ids in the learning rows (one added to
    either side). Ids that are NULL, labels that are NULL and ids without a document
    count for nothing.
    """
    judged = (
        labels.where(F.col(id_col).isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col(id_col).alias("__id"))
        .agg((F.min("quality") == 1).alias("__label"))
    )
    rows = features.where(learn).select(F.col(id_col).alias("__id"), "features")
    marked = rows.join(broadcast_if_small(judged, BROADCAST_LABELS), "__id", "left").select(
        "features", "__label", F.coalesce("__label", F.lit(False)).alias("__positive")
    )
    marked = written(marked, "quality-learning")
    known = marked.agg(F.count("__label").alias("n"), F.count_if("__positive").alias("good")).first()
    prior = (known["good"] + 1) / (known["n"] + 2)
    return fit_quality(marked, float(np.clip(prior, 0.05, 0.98)))


def score_features(features: DataFrame, model: QualityModel, columns: list[str]) -> DataFrame:
    """``columns`` of ``features`` and the ``score`` of each row."""
    source = features.select(*columns, "features")
    schema = source.drop("features").schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(len(columns)).flatten().to_numpy(zero_copy_only=False)
            score = model.scores(flat.reshape(batch.num_rows, N_FEATURES))
            arrays = [batch.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(score)], names=schema.names)

    return source.mapInArrow(run, schema)


def score_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Quality of every document, learned from four of five folds of the ids.

    Result: ``id_col``, held_out, score, predicted. NULL and empty texts are scored
    like any text (their features are zero). A NULL id is held out. Repeated rows are
    scored row by row. An empty table gives an empty result. Only ``id_col`` (for the
    folds) and the text are read; other columns never matter, whatever their names.
    """
    features = written(document_features(docs, id_col, text_col), "quality-features")
    held_out = key_remainder(F.col(id_col), LEARN_MODULUS) == 0
    model = learn_quality(features, labels, id_col, ~held_out)
    return score_features(features, model, [id_col]).select(
        F.col(id_col),
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= MIN_SCORE).cast("int").alias("predicted"),
    )


def keep_good(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``MIN_SCORE``, with all their columns."""
    judged = labels.select(F.col(id_col).alias("__label_id"), "quality")

    def keep(df: DataFrame, id_name: str, text_name: str) -> DataFrame:
        return _keep(df, judged.withColumnRenamed("__label_id", id_name), id_name, text_name)

    return with_plain_names(docs, id_col, text_col, keep)


def _keep(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    features = written(document_features(docs, id_col, text_col), "quality-features")
    held_out = key_remainder(F.col(id_col), LEARN_MODULUS) == 0
    model = learn_quality(features, labels, id_col, ~held_out)
    scored = map_texts(
        docs.withColumn("__source", F.col(text_col)),
        docs.columns,
        "__source",
        "__score double",
        lambda texts: [model.scores(text_features(texts))],
    )
    return scored.where(F.col("__score") >= MIN_SCORE).drop("__score")

"""Language identification: multinomial naive Bayes over hashed character n-grams.

Spark counts the hashed n-grams of every language; the log-probability matrix goes to
the executors and whole batches of texts are scored there as sparse rows.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curaspan.llm.common import key_remainder, map_texts, raw_texts, text_slices

# Learning rows are those whose crc32 of the id modulo MODULUS is not HELD_OUT.
MODULUS, HELD_OUT = 4, 2
ORDERS = (1, 2, 3)
HASH_BITS = 16
# The matrix has one column per language. Beyond this many entries (8 bytes each) fewer
# buckets are used, so what is broadcast stays within 32 MB whatever the column holds.
MATRIX_ENTRIES = 1 << 22
MIN_HASH_BITS = 10
SMOOTHING = 0.5
UNKNOWN = "und"
# Code points are worked on in parts of this size, with the overlap that n-grams need.
PART_POINTS = 400_000

_MULTIPLIERS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))


@functools.cache
def _letters() -> np.ndarray:
    """Per code point its lower case if it is a letter, else a space."""
    table = np.full(sys.maxunicode + 1, 32, np.uint32)
    for i in range(sys.maxunicode + 1):
        if chr(i).isalpha():
            low = chr(i).lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def letter_points(raw: bytes) -> np.ndarray:
    """Lower-cased letters, each run of anything else as one space, a space at both ends.

    A text without letters gives an empty array.
    """
    points = np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    points = np.concatenate([[np.uint32(32)], _letters()[points], [np.uint32(32)]])
    space = points == 32
    points = points[~(space & np.r_[False, space[:-1]])]
    return points if len(points) > 1 else points[:0]


def ngram_buckets(points: np.ndarray, bits: int = HASH_BITS) -> np.ndarray:
    """Bucket of every n-gram of the text; each order is hashed on its own."""
    found = []
    for order in ORDERS:
        if len(points) < order:
            continue
        n = len(points) - order + 1
        code = np.full(n, order, np.uint32)
        for k in range(order):
            code = (code ^ points[k : k + n]) * _MULTIPLIERS[k]
            code ^= code >> np.uint32(15)
        found.append((code * _MULTIPLIERS[0]) >> np.uint32(32 - bits))
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


def ngram_counts(docs: DataFrame, text_col: str, lang_col: str, bits: int = HASH_BITS) -> DataFrame:
    """(lang, bucket, c, d): n-grams per language and bucket; bucket -1 counts its rows in d.

    Each task adds up its own rows first, so a language with most rows is no hot key.
    """
    size = 1 << bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for part in text_slices(batches, 1):
            for lang, raw in zip(part.column(0).to_pylist(), raw_texts(part.column(1))):
                points = letter_points(raw)
                if not len(points):
                    continue
                rows[lang] = rows.get(lang, 0) + 1
                total = totals.setdefault(lang, np.zeros(size, np.int64))
                for k in range(0, len(points), PART_POINTS):
                    # n-grams that start in this part, at most two points beyond it
                    piece = points[k : k + PART_POINTS + max(ORDERS) - 1]
                    total += np.bincount(ngram_buckets(piece, bits), minlength=size)
                    if k + PART_POINTS < len(points):
                        total -= _overlap(points[k + PART_POINTS :][: max(ORDERS) - 1], bits, size)
        for lang, total in totals.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * (len(used) + 1), pa.string()),
                    pa.array(np.r_[-1, used], pa.int64()),
                    pa.array(np.r_[0, total[used]], pa.int64()),
                    pa.array(np.r_[rows[lang], np.zeros(len(used), np.int64)], pa.int64()),
                ],
                names=["lang", "bucket", "c", "d"],
            )

    source = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("t"))
    found = source.mapInArrow(run, "lang string, bucket long, c long, d long")
    return found.groupBy("lang", "bucket").agg(F.sum("c").alias("c"), F.sum("d").alias("d"))


def _overlap(points: np.ndarray, bits: int, size: int) -> np.ndarray:
    """n-grams wholly inside the points that two neighbouring parts have in common."""
    return np.bincount(ngram_buckets(points, bits), minlength=size)


def train(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang"
) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, log priors, log probabilities per bucket and language) of ``docs``.

    Rows without a language or without a letter teach nothing. Counts cover all rows; at
    most ``MATRIX_ENTRIES`` sums and one row per language come to the driver.
    """
    known = docs.where(F.col(lang_col).isNotNull())
    langs = known.select(lang_col).distinct().count()
    bits = HASH_BITS
    while langs << bits > MATRIX_ENTRIES and bits > MIN_HASH_BITS:
        bits -= 1
    if langs << bits > MATRIX_ENTRIES:
        raise ValueError(f"{langs} different values of {lang_col!r}: not a column of languages")
    found = ngram_counts(known, text_col, lang_col, bits).toPandas()
    names = sorted(found["lang"].unique().tolist())
    if not names:
        return [], np.zeros(0), np.zeros((1 << bits, 0))
    place = {name: i for i, name in enumerate(names)}
    column = found["lang"].map(place).to_numpy(np.int64)
    bucket = found["bucket"].to_numpy(np.int64)
    counts = np.zeros((1 << bits, len(names)))
    real = bucket >= 0
    counts[bucket[real], column[real]] = found["c"].to_numpy(np.float64)[real]
    rows = np.zeros(len(names))
    rows[column[~real]] = found["d"].to_numpy(np.float64)[~real]
    logs = np.log(counts + SMOOTHING) - np.log(counts.sum(0) + SMOOTHING * len(counts))
    return names, np.log(rows) - np.log(rows.sum()), logs


def log_posteriors(texts: list[bytes], priors: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """Log posterior of every text (rows) and language (columns); NaN without a letter.

    A letter is seen once per order, so the sum over n-grams is divided by their number.
    """
    bits = len(logs).bit_length() - 1
    out = np.full((len(texts), len(priors)), np.nan)
    for i, raw in enumerate(texts):
        points = letter_points(raw)
        if not len(points):
            continue
        total = np.zeros(len(priors))
        for k in range(0, len(points), PART_POINTS):
            piece = points[k : k + PART_POINTS + max(ORDERS) - 1]
            total += _sparse_sum(ngram_buckets(piece, bits), logs)
            if k + PART_POINTS < len(points):
                rest = points[k + PART_POINTS :][: max(ORDERS) - 1]
                total -= _sparse_sum(ngram_buckets(rest, bits), logs)
        out[i] = priors + total / len(ORDERS)
    if len(priors):
        top = out.max(1, keepdims=True)
        out -= top + np.log(np.exp(out - top).sum(1, keepdims=True))
    return out


def _sparse_sum(buckets: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """Counts of the buckets as a sparse row, times the matrix."""
    counts = np.bincount(buckets, minlength=len(logs))
    used = np.flatnonzero(counts)
    return counts[used] @ logs[used]


def predict_languages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """``id_col``, held_out, lang_pred and score (its posterior) of every row of ``docs``.

    Learns from the rows whose crc32 of the id as text modulo ``MODULUS`` is not
    ``HELD_OUT`` and whose language is known; a NULL id has remainder 0. NULL text, empty
    text and text without a letter give ``und`` with score 0, and so does everything if
    nothing could be learned; an empty table gives an empty result. Whole texts of any
    length count, in parts of bounded size. Repeated rows are predicted row by row and
    each counts in learning. Equal posteriors: the smaller language value. Other columns
    are ignored, whatever their names.
    """
    held_out = key_remainder(F.col(id_col), MODULUS) == HELD_OUT
    names, priors, logs = train(docs.where(~held_out), text_col, lang_col)
    model = docs.sparkSession.sparkContext.broadcast((names, priors, logs))

    def score(texts: list[bytes]) -> list[list]:
        names, priors, logs = model.value
        if not names:
            return [[UNKNOWN] * len(texts), [0.0] * len(texts)]
        found = log_posteriors(texts, priors, logs)
        lost = np.isnan(found[:, 0])
        best = np.where(lost, 0, np.argmax(np.where(lost[:, None], 0, found), 1))
        value = np.exp(found[np.arange(len(texts)), best])
        return [
            [UNKNOWN if gone else names[b] for gone, b in zip(lost, best)],
            np.where(lost, 0.0, np.minimum(value, 1.0)).tolist(),
        ]

    own = docs.select(F.col(id_col), held_out.alias("held_out"), F.col(text_col).alias("__source"))
    names = [id_col, "held_out"]
    return map_texts(own, names, "__source", "lang_pred string, score double", score)

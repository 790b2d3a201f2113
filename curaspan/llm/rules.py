"""Quality rules: countable rules per text and a hashed n-gram likelihood ratio.

The ratio compares two multinomials over hashed byte trigrams: one of trusted
target texts, one of the raw corpus. Its mean per trigram decides, with one fixed
threshold for every document; nothing is drawn at random.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curaspan.llm.common import map_texts, raw_texts, text_slices
from curaspan.session import broadcast_if_small

HASH_BITS = 16
N_BUCKETS = 1 << HASH_BITS
# A document fails when its trigrams are on average this many nats less likely
# under the trusted multinomial than under the raw one.
MIN_LOG_RATIO = -0.5
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
# Trusted ids up to this count (8 bytes each) go to every executor; more are joined
# through a shuffle.
BROADCAST_IDS = 500_000

_SPACE = b" \t\n\x0b\x0c\r"
_CONTINUATION = bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"


def trigram_buckets(raw: bytes) -> np.ndarray:
    """Bucket of every byte trigram; shorter texts have none."""
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    code = b[:-2] | (b[1:-1] << 8) | (b[2:] << 16) if b.size > 2 else b[:0]
    return (code * np.uint32(2654435761)) >> np.uint32(32 - HASH_BITS)


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more, the first one included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    again = np.fromiter((counts[w] > 1 for w in windows), bool, len(windows))
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(windows)] |= again
    return int(covered.sum())


def duplicate_lines(raw: bytes) -> int:
    """Lines with a word that are equal to an earlier line."""
    lines = [line for line in raw.split(b"\n") if line.strip(_SPACE)]
    return len(lines) - len(set(lines))


def rule_counts(raw: bytes) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of one text."""
    words = raw.split()
    word_chars = len(raw.translate(None, _SPACE + _CONTINUATION))
    n_symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    return len(words), word_chars, n_symbols, duplicate_lines(raw), repeated_words(words)


def corpus_counts(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per bucket the trigrams of the raw corpus and of trusted documents (bucket, raw, target)."""
    mark = trusted.select(F.col(id_col).alias("__id")).where("__id is not null").distinct()
    marked = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(
        broadcast_if_small(mark.withColumn("__trusted", F.lit(True)), BROADCAST_IDS), "__id", "left"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, N_BUCKETS), np.int64)
        for part in text_slices(batches, 0):
            trusted = [bool(v) for v in part.column(1).to_pylist()]
            for raw, good in zip(raw_texts(part.column(0)), trusted):
                found = np.bincount(trigram_buckets(raw), minlength=N_BUCKETS)
                totals[0] += found
                if good:
                    totals[1] += found
        used = np.flatnonzero(totals[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(totals[0, used]), pa.array(totals[1, used])],
            names=["bucket", "raw", "target"],
        )

    found = marked.select("__text", "__trusted").mapInArrow(
        run, "bucket long, raw long, target long"
    )
    return found.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame) -> np.ndarray:
    """log(target share / raw share) per bucket, with one added to every count.

    At most ``N_BUCKETS`` rows come to the driver. Without any trusted text all are zero.
    """
    weights = np.zeros((2, N_BUCKETS))
    for row in counts.collect():
        weights[:, row["bucket"]] = row["raw"], row["target"]
    raw, target = weights
    if not target.sum():
        return np.zeros(N_BUCKETS)
    return np.log((target + 1) / (target.sum() + N_BUCKETS)) - np.log(
        (raw + 1) / (raw.sum() + N_BUCKETS)
    )


def apply_rules(
    docs: DataFrame,
    trusted: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_log_ratio: float = MIN_LOG_RATIO,
) -> DataFrame:
    """Counts, ratio and verdict of every document.

    ``trusted`` names the documents of the target corpus by ``id_col``. Result:
    ``id_col``, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, log_ratio, kept. A NULL or empty text has no words and fails the
    base rules; its ratio is 0. A NULL id is never trusted. Repeated rows are
    judged row by row; other columns are ignored, whatever their names. Without
    trusted text the ratio is 0 everywhere and only the base rules decide.
    """
    weights = log_ratios(corpus_counts(docs, trusted, id_col, text_col))

    def score(texts: list[bytes]) -> list[list]:
        rows = []
        for raw in texts:
            n_words, chars, symbols, dup_lines, repeats = rule_counts(raw)
            found = trigram_buckets(raw)
            ratio = float(weights[found].mean()) if found.size else 0.0
            failed = n_words < MIN_WORDS or 100 * repeats > MAX_REPEATED_PERCENT * n_words
            kept = not failed and ratio >= min_log_ratio
            rows.append((n_words, chars, symbols, dup_lines, repeats, failed, ratio, kept))
        return list(zip(*rows))

    return map_texts(
        docs.select(F.col(id_col), F.col(text_col).alias("__source")),
        [id_col],
        "__source",
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
        " base_failed boolean, log_ratio double, kept boolean",
        score,
    )

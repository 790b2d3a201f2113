"""Anonymize until no personal data is left: whole overlaps, then detection again on the result."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curaspan.functions.patterns import DEFAULT_PATTERNS, PiiPattern
from curaspan.operators.anonymize import anonymize
from curaspan.operators.detect import detect_pii
from curaspan.session import scratch_path

# Texts still not clean after this many passes fail the job.
MAX_PASSES = 8


def anonymize_fully(
    text_col: str = "text",
    patterns: Sequence[PiiPattern] = DEFAULT_PATTERNS,
    entities: Callable[[Column], Column] | Column | None = None,
    max_passes: int = MAX_PASSES,
) -> Callable[[DataFrame], DataFrame]:
    """Detect and anonymize so that no pattern matches the result.

    Adds the columns of ``detect_pii`` and ``anonymize``, where overlapping spans are
    one span, so no part of a losing one stays. Replacing a span can uncover another, such as
    digits that were glued to an address. So the result is looked at again, and rows with
    hits are replaced again until there are none. Added as well: ``residual_spans``, the
    spans replaced after the first pass, and ``anonymization_passes``. The log
    has the spans of the first pass, at their places in the original text.

    Every pass is written to the scratch folder and only its rows with hits go on. Entities
    count in the first pass alone. A NULL text is empty; ids are not used. Raises ``RuntimeError``
    if texts are not clean after ``max_passes``. Runs jobs when applied; not for streams.
    """

    def apply(df: DataFrame) -> DataFrame:
        first = (
            df.transform(detect_pii(text_col, patterns, entities, overlaps="union"))
            .transform(anonymize(text_col))
            .withColumns({"residual_spans": F.lit(0), "anonymization_passes": F.lit(1)})
        )
        looked_at = first.select(F.struct(*first.columns).alias("__row"))
        clean = []
        for _ in range(max_passes):
            checked = _written(
                looked_at.withColumn("__masked", F.col("__row.anonymized_text")).transform(
                    detect_pii("__masked", patterns, overlaps="union")
                )
            )
            clean.append(checked.where(~F.col("has_pii")).select("__row.*"))
            dirty = checked.where("has_pii")
            if dirty.isEmpty():
                return reduce(DataFrame.unionByName, clean)
            row = F.col("__row")
            again = dirty.transform(anonymize("__masked"))
            looked_at = again.select(
                row.withField("anonymized_text", F.col("anonymized_text"))
                .withField("residual_spans", row["residual_spans"] + F.col("pii_count"))
                .withField("anonymization_passes", row["anonymization_passes"] + 1)
                .alias("__row")
            )
        raise RuntimeError(f"personal data is left in texts after {max_passes} passes")

    return apply


def _written(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "residual")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

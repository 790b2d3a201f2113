"""Aggregates over a curated table: the tables behind an exploratory report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curaspan.functions.times import print_for_tag
from curaspan.operators.quantiles import quantiles
from curaspan.schemas import SCORE_COLUMNS

# Threshold of a good record, threshold of a weak record, share of
# records shown when none is weak, number of score bins, standard deviations
# above the mean that make a span count anomalous.
THRESHOLD = 0.8
LOW_QUALITY = 0.5
WEAKEST_SHARE = 0.01
SCORE_BINS = 30
ANOMALY_DEVIATIONS = 2

LOW_QUALITY_COLUMNS = ["record_id", "source_format", "quality_score", *SCORE_COLUMNS, "pii_count"]


def _printable(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(name)
    if isinstance(kind, T.TimestampType):
        return print_for_tag(F.col(name))
    return F.col(name).cast("string")


def column_profile(df: DataFrame) -> DataFrame:
    """Per column: type, NULL count, NULL percentage, a shortened sample value.

    One pass over the table; the sample is the smallest printed value.
    """
    per_column = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"nulls_{i}") for i, c in enumerate(df.columns)],
        *[
            F.min(F.substring(_printable(df, c), 1, 60)).alias(f"sample_{i}")
            for i, c in enumerate(df.columns)
        ],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
                F.col(f"nulls_{i}").alias("null_count"),
                (F.col(f"nulls_{i}") / F.greatest(F.col("__rows"), F.lit(1)) * 100.0).alias("null_pct"),
                F.col(f"sample_{i}").alias("sample"),
            )
            for i, c in enumerate(df.columns)
        ]
    )
    return per_column.select(F.inline(rows))


def records_per_format(df: DataFrame) -> DataFrame:
    return (
        df.where(F.col("source_format").isNotNull())
        .groupBy("source_format")
        .agg(F.count(F.lit(1)).alias("records"))
        .orderBy(F.desc("records"), "source_format")
    )


def pii_rate(df: DataFrame) -> DataFrame:
    """Per format: records, records with personal data, their percentage."""
    return (
        df.where(F.col("source_format").isNotNull())
        .groupBy("source_format")
        .agg(F.count("has_pii").alias("total"), F.count_if("has_pii").alias("with_pii"))
        .withColumn("pct_with_pii", F.col("with_pii") / F.col("total") * 100.0)
        .orderBy(F.desc("pct_with_pii"), "source_format")
    )


def type_frequency(df: DataFrame) -> DataFrame:
    """Records per type; a record counts once for each type it has."""
    return (
        df.select(F.explode("pii_types_found").alias("pii_type"))
        .where(F.col("pii_type") != "")
        .groupBy("pii_type")
        .agg(F.count(F.lit(1)).alias("records"))
        .orderBy(F.desc("records"), "pii_type")
    )


def pii_count_histogram(df: DataFrame) -> DataFrame:
    """Records per span count, every count from 0 to the largest, zeros included."""
    counts = df.groupBy("pii_count").agg(F.count(F.lit(1)).alias("records"))
    bins = counts.agg(F.max("pii_count").alias("top")).select(
        F.explode(F.sequence(F.lit(0), F.col("top"))).alias("pii_count")
    )
    return bins.join(counts, "pii_count", "left").select(
        "pii_count", F.coalesce("records", F.lit(0)).alias("records")
    )


def describe(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles, maximum; one row.

    Values are counted per distinct value first, so the exact quartiles work on
    value counts and not on all records.
    """
    value = F.col(column).cast("double")
    counts = (
        df.where(value.isNotNull())
        .groupBy(value.alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    quartiles = F.percentile("value", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n"))
    spread = df.agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))
    return (
        counts.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("count"),
            F.min("value").alias("min"),
            quartiles.alias("q"),
            F.max("value").alias("max"),
        )
        .select(
            "count",
            spread.select("mean").scalar().alias("mean"),
            spread.select("std").scalar().alias("std"),
            "min",
            F.get("q", F.lit(0)).alias("q25"),
            F.get("q", F.lit(1)).alias("q50"),
            F.get("q", F.lit(2)).alias("q75"),
            "max",
        )
    )


def describe_continuous(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """``describe`` for a column of many different values; NaN counts as NULL.

    Counts per value would be as many as the rows. The quartiles are exact as well, or
    with ``approximate`` those of one pass over a sketch.
    """
    value = F.col(column).cast("double")
    value = F.when(~F.isnan(value), value)
    quartiles = quantiles(df, column, (0.25, 0.5, 0.75), approximate)
    return df.agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        *[F.lit(q).cast("double").alias(name) for q, name in zip(quartiles, ("q25", "q50", "q75"))],
        F.max(value).alias("max"),
    )


def quality_histogram(df: DataFrame, bins: int = SCORE_BINS) -> DataFrame:
    """Records per equal-width score bin between the smallest and the largest score.

    The last bin includes its upper end. Scores take few distinct values, so the
    records are counted per score before bins are worked out.
    """
    counts = df.groupBy("quality_score").agg(F.count(F.lit(1)).alias("n"))
    ends = df.agg(F.min("quality_score").alias("low"), F.max("quality_score").alias("high"))
    # Equal scores everywhere: the range is widened by a half on either side.
    low = F.when(F.col("low") == F.col("high"), F.col("low") - 0.5).otherwise(F.col("low"))
    high = F.when(F.col("low") == F.col("high"), F.col("high") + 0.5).otherwise(F.col("high"))
    edges = ends.select(low.alias("low"), high.alias("high"))
    width = (F.col("high") - F.col("low")) / float(bins)
    binned = (
        counts.select(
            "n",
            "quality_score",
            edges.select("low").scalar().alias("low"),
            edges.select("high").scalar().alias("high"),
        )
        .withColumn(
            "bin",
            # The last bin whose lower edge the score reaches.
            F.size(
                F.filter(
                    F.sequence(F.lit(0), F.lit(bins - 1)),
                    lambda i: F.col("low") + i * width <= F.col("quality_score"),
                )
            )
            - 1,
        )
        .groupBy("bin")
        .agg(F.sum("n").alias("records"))
    )
    all_bins = edges.select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "low", width.alias("width")
    )
    return all_bins.join(binned, "bin", "left").select(
        "bin",
        (F.col("low") + F.col("bin") * F.col("width")).alias("bin_from"),
        (F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("bin_to"),
        F.coalesce("records", F.lit(0)).alias("records"),
    )


def above_threshold(df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    passed = F.count_if(F.col("quality_score") >= threshold)
    return df.agg(
        passed.alias("passed"),
        F.count(F.lit(1)).alias("records"),
        (passed / F.greatest(F.count(F.lit(1)), F.lit(1)) * 100.0).alias("pct_above"),
    )


def box_statistics(df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per format: quartiles, whiskers, share above the threshold, ordered by median.

    Records are counted per format and score; all the rest works on those few
    rows. A whisker ends at the outermost score within 1.5 box heights.
    """
    score = F.col("quality_score")
    counts = (
        df.where(F.col("source_format").isNotNull() & score.isNotNull())
        .groupBy("source_format", "quality_score")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    boxes = counts.groupBy("source_format").agg(
        F.percentile(score, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n")).alias("q"),
        (F.sum(F.when(score >= threshold, F.col("n")).otherwise(0)) / F.sum("n") * 100.0).alias("pct_above"),
    )
    q1, q3 = F.get("q", F.lit(0)), F.get("q", F.lit(2))
    reach = 1.5 * (q3 - q1)
    inside = F.when((score >= q1 - reach) & (score <= q3 + reach), score)
    return (
        counts.join(boxes, "source_format")
        .groupBy("source_format", "q", "pct_above")
        .agg(F.min(inside).alias("whisker_low"), F.max(inside).alias("whisker_high"))
        .select(
            "source_format",
            q1.alias("q25"),
            F.get("q", F.lit(1)).alias("median"),
            q3.alias("q75"),
            "whisker_low",
            "whisker_high",
            "pct_above",
        )
        .orderBy("median", "source_format")
    )


def dimension_means(df: DataFrame) -> DataFrame:
    return (
        df.where(F.col("source_format").isNotNull())
        .groupBy("source_format")
        .agg(*[F.avg(c).alias(c) for c in SCORE_COLUMNS])
    )


def low_quality(df: DataFrame, threshold: float = LOW_QUALITY) -> DataFrame:
    """Records below the threshold, weakest first."""
    return (
        df.where(F.col("quality_score") < threshold)
        .select(*LOW_QUALITY_COLUMNS)
        .orderBy("quality_score", "record_id")
    )


def weakest(df: DataFrame, share: float = WEAKEST_SHARE) -> DataFrame:
    """Records up to the given quantile of the score, weakest first."""
    counts = df.groupBy("quality_score").agg(F.count(F.lit(1)).alias("n"))
    cutoff = counts.select(
        F.percentile("quality_score", F.lit(share), F.col("n")).alias("cutoff")
    ).scalar()
    return (
        df.where(F.col("quality_score") <= cutoff)
        .select(*LOW_QUALITY_COLUMNS)
        .orderBy("quality_score", "record_id")
    )


def weak_segment(df: DataFrame) -> DataFrame:
    """The low-quality records or, if there are none, the weakest share.

    Both cases are one cutoff on the score, so the segment is a plain filter.
    """
    counts = df.groupBy("quality_score").agg(F.count(F.lit(1)).alias("n"))
    highest = counts.agg(
        F.coalesce(
            F.max(F.when(F.col("quality_score") < LOW_QUALITY, F.col("quality_score"))),
            F.percentile("quality_score", F.lit(WEAKEST_SHARE), F.col("n")),
        ).alias("highest")
    ).scalar()
    return df.where(F.col("quality_score") <= highest).select(*LOW_QUALITY_COLUMNS)


def worst_dimension(df: DataFrame) -> DataFrame:
    """The dimension with the lowest mean in the weak segment; the first one on a tie."""
    means = weak_segment(df).agg(*[F.avg(c).alias(c) for c in SCORE_COLUMNS])
    ranked = F.array(
        *[
            F.struct(F.col(c).alias("mean"), F.lit(i).alias("place"), F.lit(c).alias("dimension"))
            for i, c in enumerate(SCORE_COLUMNS)
        ]
    )
    worst = F.array_min(F.filter(ranked, lambda r: r["mean"].isNotNull()))
    return means.select(worst["dimension"].alias("dimension"), worst["mean"].alias("mean"))


def flag_anomalies(df: DataFrame) -> DataFrame:
    """Add ``is_pii_anomaly``: more spans than the mean plus two sample deviations."""
    cutoff = (
        df.agg(
            (F.avg("pii_count") + ANOMALY_DEVIATIONS * F.stddev_samp("pii_count")).alias("cutoff")
        )
    ).scalar()
    return df.withColumn(
        "is_pii_anomaly", F.coalesce(F.col("pii_count") > cutoff, F.lit(False))
    )


def anomaly_breakdown(df: DataFrame) -> DataFrame:
    """Per format: anomalous records, their largest and mean span count."""
    return (
        df.transform(flag_anomalies)
        .where(F.col("is_pii_anomaly") & F.col("source_format").isNotNull())
        .groupBy("source_format")
        .agg(
            F.count("pii_count").alias("anomaly_records"),
            F.max("pii_count").alias("max_pii_count"),
            F.avg("pii_count").alias("mean_pii_count"),
        )
    )


def count_by_score(df: DataFrame) -> DataFrame:
    """Span count against score: records per pair and anomaly flag."""
    return (
        df.transform(flag_anomalies)
        .groupBy("pii_count", "quality_score", "is_pii_anomaly")
        .agg(F.count(F.lit(1)).alias("records"))
    )

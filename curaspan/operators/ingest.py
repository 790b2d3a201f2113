"""Bring raw sources into the unified record table: repair, dedup, tag, check, profile."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curaspan.functions.text import is_blank, join_nonempty, stable_id
from curaspan.functions.times import parse_due_date, print_for_tag
from curaspan.schemas import TAGGED_SCHEMA, UNIFIED_COLUMNS

# The format names of the three kinds of source.
CHAT_FORMAT = "slack"
TABULAR_FORMAT = "csv"
BLOCK_FORMAT = "plaintext"

# Position of a row inside its file, attached by the readers. The pair orders
# the rows of one file; neither part does so alone.
SPLIT = "__split"
ROW = "__row"


def repair_ids(raw: DataFrame) -> DataFrame:
    """Give rows with a blank ``record_id`` a derived one and flag them."""
    data = [c for c in raw.columns if c not in ("source_file", SPLIT, ROW)]
    missing = is_blank(F.col("record_id"))
    derived = stable_id(
        F.col("source_file"), F.col(SPLIT), F.col(ROW), F.to_json(F.struct(*data))
    )
    return raw.withColumns(
        {
            "record_id": F.when(missing, derived).otherwise(F.col("record_id")),
            "record_id_was_missing": F.when(missing, F.lit(True)),
        }
    )


def keep_first(raw: DataFrame) -> DataFrame:
    """First row per file and ``record_id`` in file order.

    Spark keeps at most one row per id and task before the shuffle (a window
    group limit), so an id that holds a large share of the rows arrives at the
    final task as a handful of rows.
    """
    in_file_order = Window.partitionBy("source_file", "record_id").orderBy(SPLIT, ROW)
    return (
        raw.withColumn("__nth", F.row_number().over(in_file_order))
        .where(F.col("__nth") == 1)
        .drop("__nth")
    )


def tabular_to_unified(raw: DataFrame) -> DataFrame:
    """Tabular rows (all strings, blanks as ``""``) to unified records."""
    data = [
        c for c in raw.columns if c not in ("source_file", SPLIT, ROW, "record_id_was_missing")
    ]

    def field(name: str) -> Column:
        return F.col(name) if name in data else F.lit("")

    rows = raw.transform(repair_ids).transform(keep_first)
    return rows.select(
        "record_id",
        F.lit(TABULAR_FORMAT).alias("source_format"),
        "source_file",
        parse_due_date(field("due_date")).alias("timestamp"),
        join_nonempty(field("assignee_name"), field("notes")).alias("text"),
        # The flag is NULL unless the id was repaired, and NULL fields are left out.
        F.to_json(F.struct(*data, "record_id_was_missing")).alias("raw_metadata"),
    )


def tabular_counters(raw: DataFrame) -> DataFrame:
    """Per file: rows read, ids repaired, duplicate rows dropped.

    A repaired id is unique, so only rows that came with an id can be duplicates.
    """
    blank = is_blank(F.col("record_id"))
    return raw.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(blank).alias("ids_repaired"),
        (F.count_if(~blank) - F.count_distinct(F.when(~blank, F.col("record_id")))).alias(
            "duplicates_dropped"
        ),
    )


def unify(frames: list[DataFrame], spark: SparkSession) -> DataFrame:
    """Concatenate unified tables and add the lineage tag; no input gives an empty table."""
    if not frames:
        return spark.createDataFrame([], TAGGED_SCHEMA)
    parts = [f.select(*UNIFIED_COLUMNS) for f in frames]
    return reduce(DataFrame.unionByName, parts).transform(tag_lineage)


def tag_lineage(df: DataFrame) -> DataFrame:
    """Add ``format::file::timestamp``."""
    return df.withColumn(
        "source_lineage_tag",
        F.concat(
            F.col("source_format"),
            F.lit("::"),
            F.col("source_file"),
            F.lit("::"),
            print_for_tag(F.col("timestamp")),
        ),
    )


def validate(records: DataFrame) -> DataFrame:
    """Rule violations per file: ``source_format, source_file, rule, bad_rows`` (> 0 only).

    Rows are never dropped for a violation. One pass; the distinct count first
    collapses equal ids inside each task, so neither a large file nor a repeated
    id ends up in one task.
    """
    record_id, text = F.col("record_id"), F.col("text")
    chat = F.col("source_format") == CHAT_FORMAT
    tabular = F.col("source_format") == TABULAR_FORMAT
    blocks = F.col("source_format") == BLOCK_FORMAT
    checks = {
        "record_id is null or empty": F.count_if(chat & (record_id.isNull() | (record_id == ""))),
        "text is null": F.count_if(chat & text.isNull()),
        "timestamp is null": F.count_if(chat & F.col("timestamp").isNull()),
        "record_id is duplicated": F.count_if(tabular & record_id.isNotNull())
        - F.count_distinct(F.when(tabular, record_id)),
        "text is blank": F.count_if(blocks & is_blank(text)),
    }
    counted = records.groupBy("source_format", "source_file").agg(
        *[column.alias(rule) for rule, column in checks.items()]
    )
    return counted.unpivot(
        ["source_format", "source_file"], list(checks), "rule", "bad_rows"
    ).where("bad_rows > 0")


def count_by_format(records: DataFrame) -> DataFrame:
    return records.groupBy("source_format").agg(F.count(F.lit(1)).alias("records"))


def ingest_profile(records: DataFrame) -> DataFrame:
    """Per format: records, NULL timestamps, empty texts."""
    text = F.col("text")
    return records.groupBy("source_format").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("timestamp").isNull()).alias("null_timestamps"),
        F.count_if(text.isNull() | (text == "")).alias("empty_texts"),
    )


def preview(records: DataFrame, per_format: int = 2) -> DataFrame:
    """A few shortened records per format, lowest ids first.

    The window group limit keeps ``per_format`` rows per task before the
    shuffle, however large a format is.
    """
    order = Window.partitionBy("source_format").orderBy("source_file", "record_id")
    return (
        records.withColumn("nth", F.row_number().over(order))
        .where(F.col("nth") <= per_format)
        .select(
            "source_format",
            "nth",
            F.substring("record_id", 1, 8).alias("record_id"),
            F.substring(print_for_tag(F.col("timestamp")), 1, 19).alias("timestamp"),
            F.translate(F.substring("text", 1, 55), "\n", " ").alias("text"),
        )
    )

"""Write the curated table, the lineage log with its summary and runs, and the quality report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curaspan.schemas import NESTED_COLUMNS

# Columns that hold raw personal data; a release leaves them out.
RAW_COLUMNS = ("text", "raw_metadata", "pii_detections", "anonymization_log")

# How the two outputs that grow with the records are compressed. Texts and their masked copies,
# and the lines of a log, repeat most of what they say.
CURATED_CODEC = "zstd"
LOG_CODEC = "gzip"


def nested_to_json(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, for readers without nested types."""
    return df.withColumns({c: F.to_json(c) for c in NESTED_COLUMNS if c in df.columns})


def write_curated(
    df: DataFrame, path: str, nested_as_json: bool = False, mode: str = "overwrite"
) -> str:
    """Curated Parquet, one file per task."""
    out = df.transform(nested_to_json) if nested_as_json else df
    out.write.mode(mode).option("compression", CURATED_CODEC).parquet(path)
    return path


def release_view(df: DataFrame) -> DataFrame:
    """The curated table without the columns that still hold original values."""
    return df.drop(*RAW_COLUMNS)


def write_lineage(events: DataFrame, path: str, mode: str = "overwrite") -> str:
    """JSON Lines, one event per line, gzipped; ``mode="append"`` adds a run to an existing log."""
    events.select("json").write.mode(mode).option("compression", LOG_CODEC).text(path)
    return path


def write_lineage_summary(summary: DataFrame, path: str, mode: str = "overwrite") -> str:
    """The one-row summary as JSON next to the log; a log of several runs has one row for each."""
    summary.coalesce(1).write.mode(mode).json(path)
    return path


def write_run_entry(entry: DataFrame, path: str, mode: str = "append") -> str:
    """Add the rows of a run to the table of runs, or start a new table with ``mode="overwrite"``."""
    entry.write.mode(mode).option("compression", CURATED_CODEC).parquet(path)
    return path


def write_report(report: DataFrame, path: str) -> str:
    """The one-row report as indented JSON."""
    (
        report.select(F.to_json(F.struct(*report.columns), {"pretty": "true"}).alias("value"))
        .coalesce(1)
        .write.mode("overwrite")
        .text(path)
    )
    return path

"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SCRATCH_ATTR = "_curaspan_local_scratch"


def build_session(app_name: str = "curaspan", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings every job here relies on (UTC clock, AQE)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
        # Plans here are built from many small expressions; do not record a call
        # site for each of them.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Pin what the jobs here rely on.

    The clock is UTC, as every timestamp rule is. The size of file splits no
    longer follows the number of live executors, so the position of a row in its
    file comes out the same in every scan of the session.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if not spark.conf.get("spark.sql.files.minPartitionNum", None):
        cores = spark.sparkContext.defaultParallelism
        spark.conf.set("spark.sql.files.minPartitionNum", str(cores))
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local-mode session
    without that setting (tests, a laptop) falls back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError(
            "Set spark.checkpoint.dir to a folder every executor can reach; "
            "a machine-local temporary folder is only used in local mode."
        )
    if not hasattr(spark, _SCRATCH_ATTR):
        setattr(spark, _SCRATCH_ATTR, tempfile.mkdtemp(prefix="curaspan-"))
    return getattr(spark, _SCRATCH_ATTR)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch folder; nothing there is ever overwritten."""
    return f"{scratch_root(spark)}/curaspan/{name}-{uuid.uuid4().hex}"


def broadcast_if_small(df: DataFrame, max_rows: int, max_bytes: int = 64 << 20) -> DataFrame:
    """Broadcast ``df`` only when it is proven to be small, by rows and by text length.

    The check looks no further than ``max_rows + 1`` rows. A larger side is left
    as it is, and Spark shuffles both sides with its skew handling.
    """
    lengths = [F.octet_length(F.col(c)) for c, kind in df.dtypes if kind in ("string", "binary")]
    size = sum((F.coalesce(n, F.lit(0)) for n in lengths), F.lit(0))
    found = df.limit(max_rows + 1).agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")
    )
    row = found.first()
    if row["rows"] <= max_rows and row["bytes"] <= max_bytes:
        return F.broadcast(df)
    return df

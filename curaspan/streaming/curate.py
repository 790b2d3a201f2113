"""Curate records as files arrive.

Detection, anonymization and scoring look at one row at a time, so the batch
functions accept a streaming table as they are: no state, no watermark. The entity
dictionary groups hits by text and needs a batch: call it inside ``foreachBatch``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from curaspan.plans.pipeline import curate


def start_curation(
    records: DataFrame, output_path: str, checkpoint_path: str, drain: bool = False
) -> StreamingQuery:
    """Append curated records to Parquet, each input file exactly once.

    ``records`` is a streaming unified table. ``drain=True`` processes what is
    there and stops; otherwise the query keeps running.
    """
    writer = (
        records.transform(curate)
        .writeStream.format("parquet")
        .option("path", output_path)
        .option("checkpointLocation", checkpoint_path)
        .outputMode("append")
    )
    if drain:
        writer = writer.trigger(availableNow=True)
    return writer.start()

"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curaspan.session import scratch_path

# Numpy work runs over slices of about this much text, so that its arrays stay small
# next to a worker's memory. A single longer text is a slice of its own.
SLICE_BYTES = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    This cuts the lineage: a lost executor costs no more than the running stage.
    The collection lets Spark's cleaner drop the shuffle files of finished plans.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def with_plain_names(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    transform: Callable[[DataFrame, str, str], DataFrame],
) -> DataFrame:
    """``transform(docs, id_col, text_col)`` with columns renamed by position meanwhile.

    Columns of any name, also of a name that ``transform`` uses inside, pass unchanged.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    out = transform(plain, f"c{names.index(id_col)}", f"c{names.index(text_col)}")
    return out.toDF(*names)


def key_remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; 0 for a NULL key."""
    return F.coalesce(F.crc32(key.cast("string")) % modulus, F.lit(0))


def text_slices(
    batches: Iterator[pa.RecordBatch], text: int, size: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice holds about ``size`` bytes of the text column."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0)
        lengths = lengths.to_numpy(zero_copy_only=False).astype(np.int64)
        part = np.cumsum(lengths) // size
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for start, end in zip(edges, edges[1:]):
            yield batch.slice(start, end - start)


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text; NULL is empty."""
    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]


def map_texts(
    df: DataFrame,
    columns: Sequence[str],
    text_col: str,
    added: str,
    score: Callable[[list[bytes]], Sequence[Sequence]],
) -> DataFrame:
    """``columns`` of ``df`` plus the ``added`` (DDL) columns that ``score`` makes of the texts.

    A column of ``df`` with the name of an added one is replaced by it. The text
    itself is only returned where ``columns`` names it.
    """
    new = df.sparkSession.createDataFrame([], added).schema
    kept = [c for c in columns if c not in new.names]
    source = df.select(*kept, F.col(text_col).alias("__text"))
    schema = source.drop("__text").schema
    for field in new:
        schema = schema.add(field)
    kinds = [_arrow_type(f.dataType.simpleString()) for f in new]
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, len(kept)):
            made = score(raw_texts(part.column(len(kept))))
            arrays = [part.column(i) for i in range(len(kept))]
            arrays += [pa.array(v, type=k) for v, k in zip(made, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return source.mapInArrow(run, schema)


def _arrow_type(kind: str) -> pa.DataType:
    return {
        "bigint": pa.int64(),
        "int": pa.int32(),
        "double": pa.float64(),
        "boolean": pa.bool_(),
        "string": pa.string(),
        "binary": pa.binary(),
        "array<int>": pa.list_(pa.int32()),
        "array<bigint>": pa.list_(pa.int64()),
        "array<double>": pa.list_(pa.float64()),
    }[kind]

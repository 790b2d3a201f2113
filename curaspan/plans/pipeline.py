"""The end-to-end run: ingest, detect, anonymize, score, export, audit log, report."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from curaspan.operators.anonymize import anonymize
from curaspan.operators.detect import detect_pii
from curaspan.operators.entities import with_entities
from curaspan.operators.ingest import (
    BLOCK_FORMAT,
    CHAT_FORMAT,
    TABULAR_FORMAT,
    count_by_format,
    unify,
    validate,
)
from curaspan.operators.lineage import lineage_events, new_run_id, now_iso, summary_of_records
from curaspan.operators.quality import quality_report, run_totals, score_quality
from curaspan.operators.run_history import run_entry
from curaspan.plans.manifest import Manifest, combined, files_fingerprint, table_fingerprint
from curaspan.session import prepare, scratch_path
from curaspan.sources.readers import (
    LoadedSource,
    as_path,
    read_blocks,
    read_chat,
    read_curated,
    read_tabular,
)
from curaspan.sources.writers import (
    write_curated,
    write_lineage,
    write_lineage_summary,
    write_report,
    write_run_entry,
)

Reader = Callable[[SparkSession, str | list[str]], LoadedSource]

READERS: dict[str, Reader] = {
    CHAT_FORMAT: read_chat,
    TABULAR_FORMAT: read_tabular,
    BLOCK_FORMAT: read_blocks,
}

# The defaults of a run.
DEFAULT_CONFIG = {
    "quality_threshold": 0.8,
    "lineage_dir": "data/lineage",
    "quality_report_path": "data/quality_reports/quality_report.json",
    "parquet_path": "data/processed/curated_dataset.parquet",
    "rejects_path": "data/processed/rejects.parquet",
    # CSV with line breaks inside quotes and chat arrays, cut out of input splits.
    "multiline": True,
}
LINEAGE_FILE = "lineage_log"


REJECTS = "source string, source_file string, raw string"
_TABLES = ("records", "rejects", "counters")


@dataclass(frozen=True)
class Ingested:
    """The unified table, and what went wrong on the way.

    ``rejects`` has the unreadable rows with their ``source``, ``failures`` what could not
    be read at all.
    """

    records: DataFrame
    failures: list[str] = field(default_factory=list)
    rejects: DataFrame | None = None
    counters: DataFrame | None = None
    # Of the sources and how they were read; None if that cannot be told.
    fingerprint: str | None = None
    # Sources taken from the tables of an earlier run.
    resumed: list[str] = field(default_factory=list)

    @property
    def violations(self) -> DataFrame:
        return validate(self.records)


def _union(frames: list[DataFrame]) -> DataFrame | None:
    return reduce(DataFrame.unionByName, frames) if frames else None


def _stage(spark: SparkSession, loaded: LoadedSource) -> dict[str, Any]:
    """Write the tables of a source in jobs of their own; returns where they are.

    What cannot be read fails here, where it can be told which source it was.
    """
    tables: dict[str, Any] = {"failures": loaded.failures}
    for name in _TABLES:
        df = getattr(loaded, name)
        if df is not None:
            path = scratch_path(spark, f"ingest-{name}")
            df.write.option("compression", "zstd").parquet(path)
            tables[name] = {"path": path, "schema": df.schema.json()}
    return tables


def _read_staged(spark: SparkSession, tables: Mapping[str, Any]) -> LoadedSource:
    """A source from its staged tables. Raises an AnalysisException where they are gone."""
    found = {}
    for name in _TABLES:
        if name in tables:
            schema = StructType.fromJson(json.loads(tables[name]["schema"]))
            found[name] = spark.read.schema(schema).parquet(tables[name]["path"])
    return LoadedSource(**found, failures=list(tables["failures"]))


def _unreadable_file(error: Exception) -> str | None:
    """The file that Spark could not read, if the error names one."""
    found = re.search(r"while reading file (\S+)\.\s", str(error))
    return found.group(1) if found else None


def _plain(uri: str) -> str:
    return re.sub(r"\Afile:/+", "/", uri)


def _read_by_file(
    spark: SparkSession, path: str, reader: Reader, staged: bool
) -> tuple[LoadedSource, list[str], dict[str, Any] | None]:
    """The source without the files that cannot be read, what was left out, and its staged tables.

    Nothing is listed as long as all goes well. Each file that breaks costs one more
    attempt over the others; what has been read of it is not kept.
    """
    left_out: list[str] = []
    at: str | list[str] = path
    while True:
        try:
            source = reader(spark, at)
            tables = _stage(spark, source) if staged else None
            return (_read_staged(spark, tables) if tables else source), left_out, tables
        except (PySparkException, Py4JJavaError) as error:
            broken = _unreadable_file(error)
            files = spark.read.text(at).inputFiles() if broken else []
            rest = [f for f in files if broken and _plain(f) != _plain(broken)]
            if not rest or len(rest) == len(files):
                raise
            left_out.append(f"file left out: {_plain(broken)}")
            at = [as_path(f) for f in rest]


def _read_or_resume(
    spark: SparkSession, path: str, reader: Reader, staged: bool, manifest: Manifest | None, fingerprint: str | None
) -> tuple[LoadedSource, list[str], bool]:
    """The source, what was left out of it, and whether it comes from the tables of an earlier run."""
    if manifest is None:
        source, left_out, _ = _read_by_file(spark, path, reader, staged)
        return source, left_out, False
    known = manifest.finished("ingest", path, fingerprint)
    if known is not None:
        try:
            return _read_staged(spark, known["tables"]), known["left_out"], True
        except AnalysisException:
            pass  # The scratch folder has been emptied since.
    manifest.start("ingest", path, fingerprint)
    source, left_out, tables = _read_by_file(spark, path, reader, staged=True)
    manifest.finish("ingest", path, fingerprint, tables=tables, left_out=left_out)
    return source, left_out, False


def ingest_all(
    spark: SparkSession,
    sources: Mapping[str, str | Reader],
    staged: bool = False,
    manifest: Manifest | None = None,
    multiline: bool = True,
) -> Ingested:
    """Read every source; what cannot be read is noted and skipped.

    ``sources`` maps a path to a format name or to a reader function. With ``staged``
    every source is read once, right away, into the scratch folder. A file that breaks
    while it is read is left out and named; the other files of its source stay, and so
    do the other sources. With a ``manifest`` (always staged), sources that an earlier run
    read whole and whose files are the same since are taken from its tables; those of a
    reader function are always read again, since what it does cannot be told.
    """
    loaded, rejects, failures, prints, resumed = [], [], [], [], []
    for path, kind in sources.items():
        reader = _reader(kind, multiline)
        fingerprint = None
        if manifest is not None and isinstance(kind, str):
            fingerprint = combined(path, kind, multiline, files_fingerprint(spark, path))
        prints.append(fingerprint)
        try:
            source, left_out, old = _read_or_resume(spark, path, reader, staged, manifest, fingerprint)
        except (PySparkException, Py4JJavaError, ValueError) as error:
            failures.append(f"{path}: load error: {str(error).splitlines()[0]}")
            continue
        loaded.append(source)
        resumed += [path] if old else []
        failures += [f"{path}: {failure}" for failure in [*left_out, *source.failures]]
        if source.rejects is not None:
            rejects.append(source.rejects.select(F.lit(path).alias("source"), "source_file", "raw"))
    return Ingested(
        records=unify([s.records for s in loaded], spark),
        failures=failures,
        rejects=_union(rejects),
        counters=_union([s.counters for s in loaded if s.counters is not None]),
        fingerprint=combined(*prints),
        resumed=resumed,
    )


def ingest_report(ingested: Ingested) -> dict[str, Any]:
    """What an ingest took in and what it left out; every part has a few rows at most.

    Records per format, rows dropped as duplicates, ids repaired, unreadable rows per
    source, rule violations per format and rule, and the sources that failed whole or
    in part.
    """
    formats = {r["source_format"]: r["records"] for r in count_by_format(ingested.records).collect()}
    by_rule = ingested.violations.groupBy("source_format", "rule").agg(
        F.count(F.lit(1)).alias("files"), F.sum("bad_rows").alias("bad_rows")
    )
    violations = [r.asDict() for r in by_rule.orderBy("source_format", "rule").collect()]
    repairs = {"duplicates_dropped": 0, "ids_repaired": 0}
    if ingested.counters is not None:
        sums = ingested.counters.agg(*[F.sum(name).alias(name) for name in repairs]).first()
        repairs = {name: sums[name] or 0 for name in repairs}
    rejected: dict[str, int] = {}
    if ingested.rejects is not None:
        rows = ingested.rejects.groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()
        rejected = {r["source"]: r["n"] for r in sorted(rows)}
    broken = [f"{source}: {n} unreadable rows or files" for source, n in rejected.items()]
    return {
        "records_per_format": formats,
        **repairs,
        "rejected_per_source": rejected,
        "rule_violations": violations,
        "load_failures": [*ingested.failures, *broken],
    }


def curate(records: DataFrame, entity_dictionary: DataFrame | None = None) -> DataFrame:
    """Detection, anonymization and scoring of a unified table.

    Row by row and without a shuffle, unless an entity dictionary is given.
    """
    if entity_dictionary is None:
        detected = records.transform(detect_pii())
    else:
        detected = (
            records.transform(with_entities(entity_dictionary, output="__entities"))
            .transform(detect_pii(entities=F.col("__entities")))
            .drop("__entities")
        )
    return detected.transform(anonymize()).transform(score_quality)


def _reader(kind: str | Reader, multiline: bool) -> Reader:
    """The reader of a format, or the given one. Two formats have a choice of ``multiline``."""
    if not isinstance(kind, str):
        return kind
    reader = READERS[kind]
    if kind in (CHAT_FORMAT, TABULAR_FORMAT) and not multiline:
        return lambda spark, path: reader(spark, path, multiline=False)
    return reader


def _exists(spark: SparkSession, parquet_path: str) -> bool:
    try:
        read_curated(spark, parquet_path)
    except AnalysisException:
        return False
    return True


def _logged(spark: SparkSession, log_path: str, run_id: str) -> bool:
    """Whether the log has events of a run. Spark commits a log whole or not at all."""
    mark = json.dumps(run_id, ensure_ascii=False)
    try:
        return not spark.read.text(log_path).where(F.contains("value", F.lit(f'"run_id":{mark}'))).isEmpty()
    except AnalysisException:
        return False


def run_pipeline(spark: SparkSession, config: Mapping[str, Any]) -> dict[str, Any]:
    """Run all stages and return the run summary.

    ``config["sources"]`` is required; see ``DEFAULT_CONFIG`` for the rest. The
    optional ``entity_dictionary`` is a table of ``phrase, label``.

    Every source is read into the scratch folder first, on its own. The curated table
    is written next, and log, report and totals are computed from the written table:
    detection runs once, and all outputs agree. Rows that could not be read are
    written beside the curated table.

    With ``manifest_dir`` a run notes what it has finished. The next start with the same
    folder takes sources that have not changed, and the curated table made of them, as they
    are (``resumed`` in the summary names them). A run that broke is gone on with under its
    own run id, and its events are never logged twice.
    """
    started = time.perf_counter()
    prepare(spark)
    settings = {**DEFAULT_CONFIG, **config}
    threshold = float(settings["quality_threshold"])
    dictionary = settings.get("entity_dictionary")
    nested_as_json = bool(settings.get("nested_as_json", False))
    lineage_mode = settings.get("lineage_mode", "overwrite")
    parquet_path = settings["parquet_path"]
    log_path = f"{settings['lineage_dir'].rstrip('/')}/{LINEAGE_FILE}.jsonl"
    manifest = Manifest(spark, settings["manifest_dir"]) if settings.get("manifest_dir") else None

    times = {"ingestion_timestamp": now_iso()}
    ingested = ingest_all(
        spark, settings["sources"], staged=True, manifest=manifest, multiline=bool(settings["multiline"])
    )
    resumed = list(ingested.resumed)
    curated_print = run_print = None
    if manifest is not None:
        words = "" if dictionary is None else table_fingerprint(dictionary)
        curated_print = combined(ingested.fingerprint, words, nested_as_json)
        run_print = combined(curated_print, parquet_path, threshold, lineage_mode)
    broken = manifest.broken("run", log_path, run_print) if manifest is not None else None
    run_id = settings.get("run_id") or (broken or {}).get("run_id") or new_run_id()
    if manifest is not None:
        manifest.start("run", log_path, run_print, run_id=run_id)

    rejects = ingested.rejects
    if rejects is None:
        rejects = spark.createDataFrame([], REJECTS)
    rejects.write.mode("overwrite").parquet(settings["rejects_path"])
    report = ingest_report(ingested)
    known = manifest.finished("curate", parquet_path, curated_print) if manifest is not None else None
    if known is None or not _exists(spark, parquet_path):
        times["detection_timestamp"] = now_iso()
        if manifest is not None:
            manifest.start("curate", parquet_path, curated_print)
        write_curated(curate(ingested.records, dictionary), parquet_path, nested_as_json)
        times["anonymization_timestamp"] = now_iso()
        if manifest is not None:
            manifest.finish("curate", parquet_path, curated_print, times=times)
    else:
        times = known["times"]
        resumed.append(parquet_path)
    saved = read_curated(spark, parquet_path)

    summary_path = f"{settings['lineage_dir'].rstrip('/')}/{LINEAGE_FILE}_summary.json"
    runs_path = f"{settings['lineage_dir'].rstrip('/')}/{LINEAGE_FILE}_runs.parquet"
    again = broken is not None and broken["run_id"] == run_id and lineage_mode == "append"
    if not (again and _logged(spark, log_path, run_id)):
        write_lineage(lineage_events(saved, run_id, threshold, **times), log_path, lineage_mode)
    if not (again and _logged(spark, summary_path, run_id)):
        write_lineage_summary(summary_of_records(saved, run_id, log_path), summary_path, lineage_mode)
    write_run_entry(run_entry(saved, run_id, log_path), runs_path, lineage_mode)
    write_report(quality_report(saved), settings["quality_report_path"])

    totals = run_totals(saved, threshold).first()
    if manifest is not None:
        manifest.finish("run", log_path, run_print, run_id=run_id)
    return {
        "total_records_ingested": totals["records"],
        "pii_detected_in": totals["pii_records"],
        "spans_replaced": totals["replacements"],
        "records_passed_quality_threshold": totals["passed"],
        "mean_quality_score": totals["mean_quality_score"],
        "quality_report_path": settings["quality_report_path"],
        "lineage_log_path": log_path,
        "lineage_runs_path": runs_path,
        "parquet_path": parquet_path,
        "run_id": run_id,
        "rejects_path": settings["rejects_path"],
        "resumed": resumed,
        **report,
        "elapsed_seconds": round(time.perf_counter() - started, 2),
    }

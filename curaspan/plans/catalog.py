"""Every operator as a query over the star-schema tables.

Results are flat: nested values are exploded or joined, timestamps printed,
doubles rounded to six digits.
"""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curaspan.functions.patterns import PiiPattern
from curaspan.functions.times import print_iso
from curaspan.operators import ingest, lineage, profile, quality, run_history
from curaspan.operators.anonymize import anonymize
from curaspan.operators.detect import detect_candidates, detect_pii, explode_detections
from curaspan.operators.entities import with_entities
from curaspan.operators.residual import anonymize_fully
from curaspan.operators.token_table import token_table
from curaspan.plans import views
from curaspan.plans.manifest import FINISHED, STARTED, Manifest
from curaspan.plans.pipeline import ingest_all, ingest_report, run_pipeline
from curaspan.schemas import UNIFIED_COLUMNS
from curaspan.session import prepare, scratch_path
from curaspan.sources.readers import (
    read_blocks,
    read_chat,
    read_curated,
    read_tabular,
    read_tabular_raw,
)
from curaspan.sources.writers import (
    write_curated,
    write_lineage,
    write_lineage_summary,
    write_report,
    write_run_entry,
)
from curaspan.streaming.curate import start_curation

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values used by the lineage queries, so that results can be compared.
RUN_ID = "20230907_081545_5be07d49"
RUN_TIME = "2023-09-07T08:15:45+00:00"
STRICT_THRESHOLD = 0.9


def _six(col: str | Column) -> Column:
    return F.round(F.col(col) if isinstance(col, str) else col, 6)


def _long(col: str | Column) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("long")


def _rounded(df: DataFrame) -> DataFrame:
    """All doubles to six digits, all integers to long."""
    changes = {}
    for name, kind in df.dtypes:
        if kind == "double":
            changes[name] = _six(name)
        elif kind == "int":
            changes[name] = _long(name)
    return df.withColumns(changes) if changes else df


def _flat_spans(df: DataFrame) -> DataFrame:
    return df.select(
        "record_id",
        "pii_type",
        "matched_text",
        _long("start").alias("span_start"),
        _long("end").alias("span_end"),
        _six("confidence").alias("confidence"),
        "layer",
    )


def pii_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = views.records(spark, sf_dir).transform(detect_candidates())
    spans = found.select("record_id", F.inline_outer("pii_candidates"))
    return _flat_spans(spans.where(F.col("pii_type").isNotNull()))


def pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    detected = views.records(spark, sf_dir).transform(detect_pii())
    return _flat_spans(explode_detections(detected, "record_id"))


def pii_record_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(
        views.records(spark, sf_dir)
        .transform(detect_pii())
        .select(
            "record_id",
            F.concat_ws(",", "pii_types_found").alias("pii_types"),
            "has_pii",
            "pii_count",
            "max_pii_confidence",
        )
    )


def _anonymized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.records(spark, sf_dir).transform(detect_pii()).transform(anonymize())


def anonymized_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _anonymized(spark, sf_dir).select(
        "record_id",
        "anonymized_text",
        _long("anonymization_count").alias("anonymization_count"),
        F.concat_ws(",", "strategies_used").alias("strategies"),
    )


def _flat_log(df: DataFrame) -> DataFrame:
    return (
        df.select("record_id", F.inline_outer("anonymization_log"))
        .where(F.col("pii_type").isNotNull())
        .select(
            "record_id",
            "original_text",
            "replacement",
            "pii_type",
            "strategy",
            _long("position.start").alias("span_start"),
            _long("position.end").alias("span_end"),
        )
    )


def anonymization_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_log(_anonymized(spark, sf_dir))


# So few digits that tokens collide on tables of any size.
SHORT_TOKEN_DIGITS = 3


def unique_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with tokens of three digits, colliding ones lengthened."""
    detected = views.curated(spark, sf_dir)
    tokens = token_table(detected, hex_digits=SHORT_TOKEN_DIGITS)
    return _flat_log(detected.transform(anonymize(hex_digits=SHORT_TOKEN_DIGITS, tokens=tokens)))


def token_referential_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _flat_log(views.curated(spark, sf_dir))
        .groupBy("replacement", "strategy")
        .agg(
            F.count(F.lit(1)).alias("spans"),
            F.count_distinct("original_text").alias("originals"),
            F.count_distinct("record_id").alias("records"),
        )
    )


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _anonymized(spark, sf_dir).transform(quality.score_quality)
    return _rounded(scored.select("record_id", *profile.SCORE_COLUMNS, "quality_score"))


def quality_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(quality.quality_statistics(views.curated(spark, sf_dir)))


def quality_report_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "report")
    write_report(quality.quality_report(views.curated(spark, sf_dir)), path)
    report = spark.read.schema(
        "record_count long, threshold_used double, mean_quality_score double, "
        "median_quality_score double, std_quality_score double, pct_above_threshold double, "
        "pct_records_with_pii double, pct_pii_records_fully_anonymized double, "
        "weights struct<completeness:double,consistency:double,format_conformance:double,pii_removal:double>"
    ).json(path, multiLine=True)
    return report.select("*", "weights.*").drop("weights")


def _damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated records, some with broken tags or with fewer replacements than spans."""
    tag, missed = F.length("record_id") % 4, F.length("text") % 3
    fewer = F.greatest(F.col("anonymization_count") - 1, F.lit(0))
    return views.curated(spark, sf_dir).withColumns(
        {
            "source_lineage_tag": F.when(tag == 0, F.lit("no separator"))
            .when(tag == 1, F.lit("one::separator"))
            .otherwise(F.col("source_lineage_tag")),
            "anonymization_count": F.when(missed == 0, F.lit(0))
            .when(missed == 1, fewer)
            .otherwise(F.col("anonymization_count")),
        }
    ).transform(quality.score_quality)


def damaged_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    dimensions = ["format_conformance_score", "pii_removal_confidence_score", "quality_score"]
    return _rounded(
        _damaged(spark, sf_dir).groupBy(*dimensions).agg(F.count(F.lit(1)).alias("records"))
    )


def damaged_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(
        quality.quality_statistics(_damaged(spark, sf_dir)).select(
            "record_count", "pct_records_with_pii", "pct_pii_records_fully_anonymized"
        )
    )


LICENSE_PATTERN = PiiPattern("LICENSE", "LICENSE", 0.9, r"(?:MIT|Apache|Public) License")


def custom_pattern_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detection with a pattern of the caller's own in the registry."""
    documents = views.records(spark, sf_dir).where(F.col("source_format") == ingest.BLOCK_FORMAT)
    detected = documents.transform(detect_pii(patterns=[LICENSE_PATTERN]))
    return _flat_spans(explode_detections(detected, "record_id"))


def threshold_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(quality.run_totals(views.curated(spark, sf_dir), STRICT_THRESHOLD))


_EVENT_FIELDS = """event string, run_id string, record_id string, source_format string,
source_file string, ingestion_timestamp string, source_timestamp string, text_length long,
pii_types_found array<string>, pii_count long, detection_timestamp string, strategy string,
pii_type string, original_length long, replacement string, anonymization_timestamp string,
quality_score double, completeness_score double, pii_removal_confidence_score double,
passed_threshold boolean"""


def _events(spark: SparkSession, sf_dir: str, ordered: bool = False) -> DataFrame:
    return lineage.lineage_events(
        views.curated(spark, sf_dir),
        RUN_ID,
        STRICT_THRESHOLD,
        ingestion_timestamp=RUN_TIME,
        detection_timestamp=RUN_TIME,
        anonymization_timestamp=RUN_TIME,
        ordered=ordered,
    )


def _flat_events(events: DataFrame) -> DataFrame:
    return _rounded(
        events.withColumn("pii_types_found", F.concat_ws(",", "pii_types_found"))
    )


def lineage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _events(spark, sf_dir, ordered=True).select(
        "stage", "pos", F.from_json("json", _EVENT_FIELDS).alias("e")
    )
    return _flat_events(parsed.select("stage", "pos", "e.*"))


def lineage_log_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_lineage(_events(spark, sf_dir), scratch_path(spark, "lineage"))
    return _flat_events(spark.read.schema(_EVENT_FIELDS).json(path))


def lineage_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.count_events(_events(spark, sf_dir))


def lineage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_summary(lineage.lineage_summary(_events(spark, sf_dir), RUN_ID, "lineage_log.jsonl"))


def lineage_summary_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "lineage_summary")
    summary = lineage.summary_of_records(views.curated(spark, sf_dir), RUN_ID, "lineage_log.jsonl")
    write_lineage_summary(summary, path)
    return _flat_summary(spark.read.schema(summary.schema).json(path))


def _overlapping_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of three runs over parts of the curated table that share records."""
    saved = views.curated(spark, sf_dir)
    path = scratch_path(spark, "lineage_runs")
    parts = ("source_format <> 'plaintext'", "source_format <> 'slack'", "has_pii")
    for day, part in enumerate(parts, 1):
        entry = run_history.run_entry(saved.where(part), f"2023090{day}{RUN_ID[8:]}", "lineage_log.jsonl")
        write_run_entry(entry, path)
    return spark.read.parquet(path)


def lineage_runs_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct records over the runs of a log, from their sketches."""
    total = run_history.runs_summary(_overlapping_runs(spark, sf_dir))
    return total.select("log_file", "runs", "total_events", "records", "records_exact")


def lineage_records_added(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each run of a log adds to the runs before it, from the ids of their records."""
    return run_history.records_added(_overlapping_runs(spark, sf_dir))


def lineage_run_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run ids and times as a run without given ones stamps them, read from its log."""
    events = lineage.lineage_events(views.curated(spark, sf_dir), lineage.new_run_id())
    log = spark.read.schema(_EVENT_FIELDS).json(write_lineage(events, scratch_path(spark, "lineage_stamps")))
    stamp = F.coalesce("ingestion_timestamp", "detection_timestamp", "anonymization_timestamp")
    return log.groupBy("event").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_distinct("run_id").alias("run_ids"),
        F.bool_and(F.col("run_id").rlike("^[0-9]{8}_[0-9]{6}_[0-9a-f]{8}$")).alias("well_formed"),
        F.count_distinct(F.try_to_timestamp(stamp)).alias("stamps"),
    )


def report_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report refuses records that were never scored, and takes them once they are."""
    unscored = views.curated(spark, sf_dir).drop("quality_score")
    try:
        quality.quality_report(unscored)
        refused = ""
    except ValueError as error:
        refused = str(error).split("'")[1]
    report = quality.quality_report(unscored.transform(quality.score_quality))
    return report.select(
        F.lit(refused).alias("refused_without"),
        F.col("record_count").alias("records"),
        _six("mean_quality_score").alias("mean_quality_score"),
    )


def _flat_summary(summary: DataFrame) -> DataFrame:
    return summary.select("run_id", "total_events", "events_by_type.*", "records_processed", "log_file")


def _flat_records(df: DataFrame) -> DataFrame:
    """Records without their derived ids, equal ones counted."""
    return (
        df.withColumn("timestamp", print_iso(F.col("timestamp")))
        .groupBy(df.columns)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def csv_dedup_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = read_tabular(spark, views.ticket_files(spark, sf_dir)).records
    repaired = F.get_json_object("raw_metadata", "$.record_id_was_missing") == "true"
    return _flat_records(
        loaded.select(
            F.when(repaired, F.lit("repaired")).otherwise(F.col("record_id")).alias("record_id"),
            "source_format",
            "timestamp",
            "text",
        )
    )


def csv_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = read_tabular(spark, views.ticket_files(spark, sf_dir)).records
    fields = ", ".join(f"{c} string" for c in views.TICKET_COLUMNS)
    meta = F.from_json("raw_metadata", f"{fields}, record_id_was_missing boolean")
    packed = loaded.select("record_id", meta.alias("m"))
    return (
        packed.select("m.*", (F.col("record_id") == F.col("m.record_id")).alias("id_agrees"))
        .withColumn(
            "record_id",
            F.when(F.col("record_id_was_missing"), F.lit("repaired")).otherwise(F.col("record_id")),
        )
        .groupBy(*views.TICKET_COLUMNS, "record_id_was_missing", "id_agrees")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def csv_records_across_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickets with line breaks in quotes, read in splits that cut through records."""
    with views.small_splits(spark, "32k"):
        raw = read_tabular_raw(spark, views.ticket_files(spark, sf_dir))
    return raw.groupBy(*views.TICKET_COLUMNS).agg(F.count(F.lit(1)).alias("n"))


def csv_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    counters = read_tabular(spark, views.ticket_files(spark, sf_dir)).counters
    return counters.agg(
        *[F.sum(c).alias(c) for c in ("rows_read", "ids_repaired", "duplicates_dropped")]
    )


def due_date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = read_tabular_raw(spark, views.ticket_files(spark, sf_dir))
    return (
        raw.groupBy("due_date")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("parsed", print_iso(ingest.parse_due_date(F.col("due_date"))))
    )


def due_date_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ship dates in the rarer layouts."""
    line, shipped = F.col("l_linenumber"), F.col("l_shipdate")
    text = (
        F.when(line == 1, F.date_format(shipped, "MM/dd/yy"))
        .when(line == 2, F.concat(F.date_format(shipped, "MM/dd/yyyy"), F.lit(" 3:30 PM")))
        .when(line == 3, F.date_format(shipped, "MMMM d yyyy"))
        .when(line == 4, F.date_format(shipped, "yyyyMMdd"))
        .when(line == 5, F.date_format(shipped, "yyyy.MM.dd"))
        .when(line == 6, F.date_format(shipped, "d-MMMM-yyyy"))
        .otherwise(F.upper(F.date_format(shipped, "MMM d yyyy")))
    )
    dates = views.table(spark, sf_dir, "lineitem").groupBy(text.alias("due_date")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return dates.withColumn("parsed", print_iso(ingest.parse_due_date(F.col("due_date"))))


def _mixed_loaded(spark: SparkSession, sf_dir: str):
    return read_tabular(spark, views.mixed_ticket_files(spark, sf_dir), multiline=True)


def csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with other columns and another order, each read by its own header."""
    loaded = _mixed_loaded(spark, sf_dir).records
    meta = F.from_json(
        "raw_metadata", "record_id_was_missing boolean, warehouse string, status string"
    )
    rows = loaded.withColumn("m", meta)
    shown = F.when(F.col("m.record_id_was_missing"), F.lit("repaired")).otherwise(F.col("record_id"))
    return _flat_records(
        rows.select(shown.alias("record_id"), "timestamp", "text", "m.warehouse", "m.status")
    )


def ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with more fields than their header are rejected whole, nothing is cut off."""
    rejects = _mixed_loaded(spark, sf_dir).rejects
    return rejects.groupBy("raw").agg(F.count(F.lit(1)).alias("n"))


def ingest_run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run tells about its ingest, as names and numbers."""
    folders = views.mixed_ticket_files(spark, sf_dir)
    sources = {path: ingest.TABULAR_FORMAT for path in folders}
    sources[views.block_files(spark, sf_dir)] = ingest.BLOCK_FORMAT
    sources[views.chat_array_files(spark, sf_dir)] = ingest.CHAT_FORMAT
    sources[f"{folders[0]}/nothing-here"] = ingest.TABULAR_FORMAT
    report = ingest_report(ingest_all(spark, sources, staged=True))
    rows = [(f"records {name}", n) for name, n in report["records_per_format"].items()]
    rows += [(name, report[name]) for name in ("duplicates_dropped", "ids_repaired")]
    rows.append(("rejected", sum(report["rejected_per_source"].values())))
    rows += [(f"{v['source_format']}: {v['rule']}", v["bad_rows"]) for v in report["rule_violations"]]
    # One source does not exist, one has rejects.
    rows.append(("load_failures", len(report["load_failures"])))
    return spark.createDataFrame(rows, "name string, n long")


def _chat_rows(loaded: DataFrame) -> DataFrame:
    meta = F.from_json("raw_metadata", "channel string, username string, user_id string")
    return _flat_records(
        loaded.select("source_format", "timestamp", "text", meta.alias("m")).select(
            "source_format", "timestamp", "text", "m.*"
        )
    )


def chat_array_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON array per file."""
    return _chat_rows(read_chat(spark, views.chat_array_files(spark, sf_dir)).records)


def chat_elements_across_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays read in splits that cut through messages."""
    with views.small_splits(spark, "8k"):
        loaded = read_chat(spark, views.chat_array_files(spark, sf_dir)).records
    return _chat_rows(loaded)


def chat_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = read_chat(spark, views.chat_files(spark, sf_dir), multiline=False).records
    return _chat_rows(loaded)


def text_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = read_blocks(spark, views.block_files(spark, sf_dir)).records
    return loaded.groupBy("source_format", "text", "raw_metadata").agg(F.count(F.lit(1)).alias("n"))


def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = read_blocks(spark, views.line_files(spark, sf_dir)).records
    return loaded.groupBy("source_format", "text").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("record_id").alias("ids")
    )


def text_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Block files, line files and files with carriage returns side by side."""
    paths = [f(spark, sf_dir) for f in (views.block_files, views.line_files, views.windows_files)]
    loaded = read_blocks(spark, paths).records
    # Ids are counted under a hash, so that a text itself is shuffled once and copies of it
    # meet before that. One key: the join then finds both sides in place.
    keyed = loaded.withColumn(
        "key", F.unhex(F.sha2(F.concat_ws("\n", "source_format", "text"), 256))
    )
    counts = keyed.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("record_id").alias("ids")
    )
    texts = keyed.groupBy("key").agg(
        *[F.any_value(name).alias(name) for name in ("source_format", "text")]
    )
    return texts.join(counts, "key").select("source_format", "text", "n", "ids")


def stable_line_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of line files that stay the same when other files are read with them."""
    lines = views.line_files(spark, sf_dir)
    alone = read_blocks(spark, lines).records.select("record_id")
    among = read_blocks(spark, [views.block_files(spark, sf_dir), lines]).records
    return alone.join(among, "record_id").agg(F.count_distinct("record_id").alias("same_ids"))


def unify_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.count_by_format(views.records(spark, sf_dir))


def lineage_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.records(spark, sf_dir).select("record_id", "source_lineage_tag")


def validation_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checked on the records plus the tickets before their dedup."""
    raw = views.tickets(spark, sf_dir).select(
        "record_id",
        F.lit(ingest.TABULAR_FORMAT).alias("source_format"),
        F.lit("tickets").alias("source_file"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        F.col("notes").alias("text"),
        F.lit("{}").alias("raw_metadata"),
    )
    return ingest.validate(
        views.records(spark, sf_dir).select(*UNIFIED_COLUMNS).unionByName(raw)
    )


def ingest_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.ingest_profile(views.records(spark, sf_dir))


def ingest_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(ingest.preview(views.records(spark, sf_dir)))


def curated_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "curated_json")
    write_curated(views.curated(spark, sf_dir), path, nested_as_json=True)
    return _flat_spans(explode_detections(read_curated(spark, path), "record_id"))


def dictionary_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    notes = views.shipping_notes(spark, sf_dir)
    found = notes.transform(with_entities(views.entity_dictionary(spark, sf_dir)))
    return (
        found.select("record_id", F.inline_outer("entities"))
        .where(F.col("label").isNotNull())
        .select(
            "record_id",
            "label",
            "matched_text",
            _long("start").alias("span_start"),
            _long("end").alias("span_end"),
        )
    )


def two_layer_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    notes = views.shipping_notes(spark, sf_dir)
    found = notes.transform(with_entities(views.entity_dictionary(spark, sf_dir)))
    detected = found.transform(detect_pii(entities=F.col("entities")))
    return _flat_spans(explode_detections(detected, "record_id"))


def streaming_curation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents arriving as a stream of files, curated into Parquet."""
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    arriving = (
        spark.readStream.schema(schema)
        # A pattern names a single file as well as a folder of files.
        .parquet(f"{sf_dir}/documents.[p]arquet")
        .select(
            F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("record_id"),
            F.lit(ingest.BLOCK_FORMAT).alias("source_format"),
            F.concat(F.lit("documents/"), F.col("source")).alias("source_file"),
            F.lit(None).cast("timestamp").alias("timestamp"),
            "text",
            F.lit("{}").alias("raw_metadata"),
        )
        .transform(ingest.tag_lineage)
    )
    out = scratch_path(spark, "stream")
    start_curation(arriving, out, scratch_path(spark, "stream_checkpoint"), drain=True).awaitTermination()
    return _rounded(
        read_curated(spark, out).select("record_id", "anonymized_text", "pii_count", "quality_score")
    )


def pipeline_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on raw chat, CSV and text files; curated table, log, summary, report and rejects per format."""
    out = scratch_path(spark, "pipeline")

    def chat_lines(session: SparkSession, path: str):
        return read_chat(session, path, multiline=False)

    summary = run_pipeline(
        spark,
        {
            "sources": {
                views.chat_files(spark, sf_dir): chat_lines,
                views.ticket_files(spark, sf_dir): ingest.TABULAR_FORMAT,
                views.block_files(spark, sf_dir): ingest.BLOCK_FORMAT,
            },
            "lineage_dir": f"{out}/lineage",
            "quality_report_path": f"{out}/quality_report.json",
            "parquet_path": f"{out}/curated.parquet",
            "rejects_path": f"{out}/rejects.parquet",
        },
    )
    saved = read_curated(spark, summary["parquet_path"])
    log = spark.read.schema(_EVENT_FIELDS).json(summary["lineage_log_path"])
    logged = log.where(F.col("event") == "ingested").groupBy("source_format").agg(
        F.count(F.lit(1)).alias("logged"), F.sum("text_length").alias("text_length")
    )
    told = spark.read.json(f"{out}/lineage/lineage_log_summary.json").select("records_processed")
    per_format = _rounded(
        saved.groupBy("source_format").agg(
            F.count(F.lit(1)).alias("records"),
            F.count_if("has_pii").alias("pii_records"),
            F.sum("anonymization_count").alias("spans"),
            F.avg("quality_score").alias("mean_quality_score"),
            F.count_if(F.col("quality_score") >= profile.THRESHOLD).alias("passed"),
        )
    )
    report = spark.read.json(summary["quality_report_path"], multiLine=True)
    rejects = spark.read.parquet(summary["rejects_path"]).agg(F.count(F.lit(1)).alias("n"))
    return per_format.join(logged, "source_format").withColumns(
        {
            "records_processed": told.scalar(),
            "reported_records": report.select("record_count").scalar(),
            "reported_mean": report.select(_six("mean_quality_score")).scalar(),
            "rejected_rows": rejects.scalar(),
        }
    )


def pipeline_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that breaks at its report, gone on with by a second start: what each stage did, and the log."""
    out = scratch_path(spark, "resume")
    settings = {
        "sources": {
            views.ticket_files(spark, sf_dir): ingest.TABULAR_FORMAT,
            views.block_files(spark, sf_dir): ingest.BLOCK_FORMAT,
        },
        "lineage_dir": f"{out}/lineage",
        "lineage_mode": "append",
        "quality_report_path": f"{out}/report.json",
        "parquet_path": f"{out}/curated.parquet",
        "rejects_path": f"{out}/rejects.parquet",
        "manifest_dir": f"{out}/manifest",
    }
    try:
        run_pipeline(spark, {**settings, "quality_report_path": "nostore://report.json"})
    except (PySparkException, Py4JJavaError):
        pass
    summary = run_pipeline(spark, settings)
    log = spark.read.schema(_EVENT_FIELDS).json(summary["lineage_log_path"])
    logged = log.agg(F.count(F.lit(1)).alias("events"))
    runs = log.agg(F.count_distinct("run_id").alias("run_ids"))
    steps = Manifest(spark, settings["manifest_dir"]).entries().groupBy("stage").agg(
        F.count_if(F.col("state") == STARTED).alias("started"),
        F.count_if(F.col("state") == FINISHED).alias("finished"),
    )
    return steps.withColumns({"events": logged.scalar(), "run_ids": runs.scalar()})


def price_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices, nearly all of them different, with exact quartiles."""
    return _rounded(profile.describe_continuous(views.table(spark, sf_dir, "lineitem"), "l_extendedprice"))


def residual_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per format what was masked with whole overlaps, and what is found in the result."""
    masked = views.records(spark, sf_dir).transform(anonymize_fully())
    lengths = F.transform("pii_detections", lambda s: s["end"] - s["start"])
    left = masked.transform(detect_candidates("anonymized_text"))
    return left.groupBy("source_format").agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(_long("pii_count")).alias("spans"),
        F.sum(_long(F.aggregate(lengths, F.lit(0), lambda a, b: a + b))).alias("masked_characters"),
        F.sum(_long(F.size("pii_candidates"))).alias("residual_left"),
    )


def _on_curated(operator: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _rounded(operator(views.curated(spark, sf_dir)))

    return query


QUERIES: dict[str, Query] = {
    "pii_candidates": pii_candidates,
    "pii_spans": pii_spans,
    "pii_record_summary": pii_record_summary,
    "anonymized_text": anonymized_text,
    "anonymization_log": anonymization_log,
    "token_referential_counts": token_referential_counts,
    "unique_tokens": unique_tokens,
    "residual_report": residual_report,
    "quality_scores": quality_scores,
    "quality_statistics": quality_statistics,
    "quality_report_file": quality_report_file,
    "damaged_scores": damaged_scores,
    "damaged_statistics": damaged_statistics,
    "custom_pattern_spans": custom_pattern_spans,
    "threshold_summary": threshold_summary,
    "lineage_events": lineage_events,
    "lineage_log_file": lineage_log_file,
    "lineage_event_counts": lineage_event_counts,
    "lineage_summary": lineage_summary,
    "lineage_summary_file": lineage_summary_file,
    "lineage_runs_total": lineage_runs_total,
    "lineage_records_added": lineage_records_added,
    "lineage_run_stamps": lineage_run_stamps,
    "report_guard": report_guard,
    "csv_dedup_repair": csv_dedup_repair,
    "csv_metadata": csv_metadata,
    "csv_records_across_splits": csv_records_across_splits,
    "csv_counters": csv_counters,
    "due_date_parse": due_date_parse,
    "due_date_layouts": due_date_layouts,
    "csv_mixed_headers": csv_mixed_headers,
    "ingest_rejects": ingest_rejects,
    "ingest_run_report": ingest_run_report,
    "chat_json_roundtrip": chat_json_roundtrip,
    "chat_array_roundtrip": chat_array_roundtrip,
    "chat_elements_across_splits": chat_elements_across_splits,
    "text_blocks": text_blocks,
    "text_lines": text_lines,
    "text_mixed": text_mixed,
    "stable_line_ids": stable_line_ids,
    "unify_counts": unify_counts,
    "lineage_tags": lineage_tags,
    "validation_rules": validation_rules,
    "ingest_profile": ingest_profile,
    "ingest_preview": ingest_preview,
    "curated_json_roundtrip": curated_json_roundtrip,
    "dictionary_spans": dictionary_spans,
    "two_layer_spans": two_layer_spans,
    "streaming_curation": streaming_curation,
    "pipeline_run": pipeline_run,
    "pipeline_resume": pipeline_resume,
    "column_profile": _on_curated(profile.column_profile),
    "records_per_format": _on_curated(profile.records_per_format),
    "pii_rate": _on_curated(profile.pii_rate),
    "type_frequency": _on_curated(profile.type_frequency),
    "pii_histogram": _on_curated(profile.pii_count_histogram),
    "pii_describe": _on_curated(lambda df: profile.describe(df, "pii_count")),
    "quality_histogram": _on_curated(profile.quality_histogram),
    "quality_describe": _on_curated(lambda df: profile.describe(df, "quality_score")),
    "price_describe": price_describe,
    "above_threshold": _on_curated(profile.above_threshold),
    "box_statistics": _on_curated(profile.box_statistics),
    "dimension_means": _on_curated(profile.dimension_means),
    "low_quality": _on_curated(profile.low_quality),
    "weakest_1pct": _on_curated(profile.weakest),
    "worst_dimension": _on_curated(profile.worst_dimension),
    "pii_anomalies": _on_curated(
        lambda df: df.transform(profile.flag_anomalies).select(
            "record_id", "pii_count", "is_pii_anomaly"
        )
    ),
    "anomaly_breakdown": _on_curated(profile.anomaly_breakdown),
    "scatter_data": _on_curated(profile.count_by_score),
}


def prepared(query: Query) -> Query:
    """The query on a session with the settings all results rely on."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(prepare(spark), sf_dir)

    return run

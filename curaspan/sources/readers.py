"""Read raw sources into the unified record table, and curated tables back."""

from __future__ import annotations

import csv
import re
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curaspan.functions.text import INNER_LINE_ENDS, stable_id, strip
from curaspan.functions.times import parse_iso
from curaspan.operators.ingest import (
    BLOCK_FORMAT,
    CHAT_FORMAT,
    ROW,
    SPLIT,
    tabular_counters,
    tabular_to_unified,
)
from curaspan.schemas import NESTED_COLUMNS
from curaspan.session import broadcast_if_small
from curaspan.sources.split_records import array_elements, quoted_records, table_splits, written

_CORRUPT = "_corrupt_record"

# The fields of a chat message.
CHAT_FIELDS = ("user_id", "username", "timestamp", "channel", "text")
CHAT_METADATA = ("channel", "username", "user_id")


@dataclass(frozen=True)
class LoadedSource:
    """Lazy tables of one source.

    ``records`` is the unified table, ``rejects`` the unreadable rows
    (``source_file, raw``), ``counters`` the repair counts of a tabular source,
    ``failures`` what could not be opened at all.
    """

    records: DataFrame
    rejects: DataFrame | None = None
    counters: DataFrame | None = None
    failures: list[str] = field(default_factory=list)


def _file_path() -> Column:
    """Plain path for local files, full URI for everything else."""
    uri = F.col("_metadata.file_path")
    # The usual form goes without a regex for every row.
    usual = F.startswith(uri, F.lit("file:///")) & ~F.startswith(uri, F.lit("file:////"))
    return F.when(usual, F.substr(uri, F.lit(8))).otherwise(F.regexp_replace(uri, r"\Afile:/+", "/"))


# Input splits up to this count (some 150 bytes each) go to every executor.
BROADCAST_SPLITS = 500_000
# Files up to this count as well, for the look at their line structure.
BROADCAST_FILES = 200_000


def _at_scan(raw: DataFrame, *columns: Column | str) -> DataFrame:
    """``columns`` with file, split and row number, taken at the scan, before any shuffle."""
    return raw.select(
        *columns,
        _file_path().alias("source_file"),
        F.col("_metadata.file_block_start").alias(SPLIT),
        F.monotonically_increasing_id().alias(ROW),
    )


def _from_split_start(scanned: DataFrame, raw: DataFrame) -> DataFrame:
    """Count the rows of every split from zero.

    The number a scan gives to a row starts with that of its task, which depends on all
    other files and on the cores. Less the first number of its split it depends on the
    file alone. There is one small row per split; a scan has no more splits than files
    and tasks together, both known without a job.
    """
    firsts = scanned.groupBy("source_file", SPLIT).agg(F.min(ROW).alias("__first"))
    if len(raw.inputFiles()) + raw.rdd.getNumPartitions() <= BROADCAST_SPLITS:
        firsts = F.broadcast(firsts)
    return scanned.join(firsts, ["source_file", SPLIT]).withColumn(
        ROW, F.col(ROW) - F.col("__first")
    ).drop("__first")


def _with_position(raw: DataFrame) -> DataFrame:
    return _from_split_start(_at_scan(raw, "*"), raw)


def as_path(encoded: str) -> str:
    """The path to read a file by, from the form in which a scan names it."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(encoded))


def read_chat(spark: SparkSession, paths: str | list[str], multiline: bool = True) -> LoadedSource:
    """Chat export: a JSON array of messages per file, or JSON Lines.

    Both are split: elements of an array are cut out of the input splits it lies in.
    ``multiline=False`` reads JSON Lines without that work. A missing field is ``""``, an
    explicit null stays NULL. An array that does not parse rejects its file; the one row
    for it in ``rejects`` holds the first element that does not parse, or of an array that
    is never closed the first element.
    """
    schema = T.StructType(
        [T.StructField(name, T.VariantType()) for name in CHAT_FIELDS]
        + [T.StructField(_CORRUPT, T.StringType())]
    )
    if multiline:
        return _chat_source(*_chat_arrays(spark, paths))
    raw = (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .json(paths)
        .transform(_with_position)
    )

    # Spark refuses plans that read nothing but the corrupt-record column, so the
    # tests refer to a data column as well; that part is always true.
    any_text = F.coalesce(F.length(F.col("text").cast("string")) >= 0, F.lit(True))
    good = raw.where(F.col(_CORRUPT).isNull() & any_text).select(
        "source_file", SPLIT, ROW, *[_chat_field(F.col(name)).alias(name) for name in CHAT_FIELDS]
    )
    rejects = raw.where(F.col(_CORRUPT).isNotNull() & any_text).select(
        "source_file", F.col(_CORRUPT).alias("raw")
    )
    return _chat_source(good, rejects)


def _chat_field(value: Column) -> Column:
    return F.when(value.isNull(), F.lit("")).when(~F.is_variant_null(value), value.cast("string"))


def _chat_source(fields: DataFrame, rejects: DataFrame) -> LoadedSource:
    records = fields.select(
        stable_id(
            F.col("source_file"), F.col(SPLIT), F.col(ROW), F.to_json(F.struct(*CHAT_FIELDS))
        ).alias("record_id"),
        F.lit(CHAT_FORMAT).alias("source_format"),
        "source_file",
        parse_iso(F.col("timestamp")).alias("timestamp"),
        "text",
        F.to_json(F.struct(*CHAT_METADATA), {"ignoreNullFields": "false"}).alias("raw_metadata"),
    )
    return LoadedSource(records, rejects)


def _chat_arrays(spark: SparkSession, paths: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Fields of the messages in arrays, and one row for each file that does not parse.

    An element may hold any JSON value; only an object is a message.
    """
    message = F.try_parse_json("value")
    elements = array_elements(spark, paths, _file_path()).withColumn("message", message)
    parsed = elements.select(
        "source_file",
        SPLIT,
        ROW,
        *[
            _chat_field(F.try_variant_get("message", f"$.{name}", "variant")).alias(name)
            for name in CHAT_FIELDS
        ],
        F.when(F.schema_of_variant("message").startswith("OBJECT") & F.col("closed"), F.lit(None))
        .otherwise(F.col("value"))
        .alias("raw"),
        F.col("message").isNotNull().alias("parses"),
    )
    parsed = written(parsed, "chat-elements")
    order = F.struct("parses", SPLIT, ROW)
    broken = parsed.where("raw is not null").groupBy("source_file").agg(F.min_by("raw", order).alias("raw"))
    broken = written(broken, "chat-rejects")
    listed = broadcast_if_small(broken.select("source_file"), BROADCAST_FILES)
    return parsed.drop("raw", "parses").join(listed, "source_file", "left_anti"), broken


def _tabular_reader(spark: SparkSession, multiline: bool):
    return (
        spark.read.option("header", True)
        .option("multiLine", multiline)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .option("columnPruning", False)
    )


def _files_by_header(spark: SparkSession, paths: str | list[str]) -> list[str | list[str]]:
    """The paths as they are if all files start with the same line, else lists of files.

    One pass over the first splits; only the different first lines and the names of the
    files come to the driver, which has listed them before.
    """
    lines = _at_scan(spark.read.text(paths), "value").where(F.col(SPLIT) == 0)
    headers = lines.groupBy("source_file").agg(F.min_by("value", ROW).alias("header"))
    groups = headers.groupBy("header").agg(F.sort_array(F.collect_list("source_file")).alias("files"))
    found = sorted(groups.collect(), key=lambda g: g["files"][0])
    if len(found) <= 1:
        return [paths]
    return [[as_path(f) for f in g["files"]] for g in found]


def _field_count(line: Column) -> Column:
    """Fields of a CSV line: one more than its commas outside quotes."""
    unquoted = F.regexp_replace(line, r'"(?:[^"]|"")*+"', "")
    return F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","), F.lit(""))) + 1


def _tabular_group(spark: SparkSession, paths: str | list[str], multiline: bool) -> DataFrame:
    """Rows of files with the same header."""
    names = _tabular_reader(spark, multiline).csv(paths).columns
    if "record_id" not in names:
        raise ValueError(f"{paths}: no 'record_id' column in the header {names}")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _CORRUPT]])
    return _checked(_tabular_reader(spark, multiline).schema(schema).csv(paths).transform(_with_position), names)


def _checked(raw: DataFrame, names: list[str]) -> DataFrame:
    """Rows with blanks for missing fields; only those with too many keep their raw text."""
    # Rows with too many and with too few fields are flagged alike. The latter are
    # complete once padded with blanks.
    # Spark refuses plans that read nothing but the corrupt-record column, so the test
    # refers to a data column as well; that part is always true.
    any_field = F.coalesce(F.length(names[0]) >= 0, F.lit(True))
    too_long = any_field & (_field_count(F.col(_CORRUPT)) > len(names))
    return raw.withColumn(_CORRUPT, F.when(too_long, F.col(_CORRUPT))).select(
        *[F.coalesce(F.col(n), F.lit("")).alias(n) for n in names],
        _CORRUPT,
        "source_file",
        SPLIT,
        ROW,
    )


def _tabular_groups(
    spark: SparkSession, paths: str | list[str], multiline: bool, parsed_once: bool = False
) -> tuple[list[DataFrame], list[str]]:
    """One table per header, and the files whose header has no id.

    ``parsed_once`` writes the rows of multiline files, for a caller that reads them more than once.
    """
    if multiline:
        return _quoted_groups(spark, paths, parsed_once)
    tables, failures = [], []
    for files in _files_by_header(spark, paths):
        try:
            tables.append(_tabular_group(spark, files, multiline))
        except ValueError as error:
            failures.append(f"load error: {error}")
    if not tables:
        raise ValueError("; ".join(failures))
    return tables, failures


def _header_names(line: str) -> list[str]:
    """Column names of a header line; nameless and repeated columns are numbered."""
    names = next(csv.reader([line.removeprefix("\ufeff")]), [])
    lower = [name.lower() for name in names]
    return [
        f"_c{i}" if not name else f"{name}{i}" if lower.count(name.lower()) > 1 else name
        for i, name in enumerate(names)
    ]


def _quoted_groups(
    spark: SparkSession, paths: str | list[str], parsed_once: bool
) -> tuple[list[DataFrame], list[str]]:
    """``_tabular_groups`` for files with line breaks inside quotes.

    Records are cut once for all files. Only the different header lines come to the driver, no
    names of files.
    """
    records = quoted_records(spark, paths, _file_path())
    with table_splits(spark):
        tables, failures = _groups_of(records, parsed_once)
    if not tables:
        raise ValueError("; ".join(failures) or f"{paths}: no records")
    return tables, failures


def _groups_of(records: DataFrame, parsed_once: bool) -> tuple[list[DataFrame], list[str]]:
    """Parsed rows of the records of CSV files, a table for each header with an id."""
    place = F.struct(SPLIT, ROW)
    # Numbers alone are aggregated by hash; the text of a header is looked up by its place.
    firsts = records.groupBy("source_file", SPLIT).agg(F.min(ROW).alias(ROW))
    firsts = firsts.groupBy("source_file").agg(F.min(place).alias("head"))
    firsts = written(firsts, "csv-heads")
    # Headers stand in the first splits; the text of later ones is not read for them.
    last = firsts.agg(F.max(f"head.{SPLIT}")).first()[0]
    early = records.where(F.col(SPLIT) <= F.lit(-1 if last is None else last))
    heads = early.join(broadcast_if_small(firsts, BROADCAST_FILES), "source_file").where(
        place == F.col("head")
    )
    heads = heads.select("source_file", "head", F.col("value").alias("header"))
    heads = written(heads, "csv-headers")
    rows = records.join(broadcast_if_small(heads, BROADCAST_FILES), "source_file").where(
        place > F.col("head")
    )
    tables, failures = [], []
    for header in sorted(r["header"] for r in heads.select("header").distinct().collect()):
        names = _header_names(header)
        if "record_id" not in names:
            example = heads.where(F.col("header") == header).agg(F.min("source_file")).first()[0]
            failures.append(f"load error: {example}: no 'record_id' column in the header {names}")
            continue
        kinds = ", ".join(f"`{n.replace('`', '``')}` string" for n in [*names, _CORRUPT])
        options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
        fields = F.from_csv("value", kinds, options).alias("fields")
        own = rows.where(F.col("header") == header).select("source_file", SPLIT, ROW, fields)
        parsed = _checked(own.select("fields.*", "source_file", SPLIT, ROW), names)
        tables.append(written(parsed, "csv-rows") if parsed_once else parsed)
    return tables, failures


def read_tabular_raw(
    spark: SparkSession, paths: str | list[str], multiline: bool = True
) -> DataFrame:
    """CSV with a header, every field a string, blanks as ``""``; unreadable rows keep a note.

    Every file is read by its own header; a column that a file does not have is NULL.
    """
    tables, _ = _tabular_groups(spark, paths, multiline)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def read_tabular(
    spark: SparkSession, paths: str | list[str], multiline: bool = True
) -> LoadedSource:
    """Tabular CSV source with id repair and keep-first dedup per file.

    Every file is read by its own header. A row with more fields than its header is
    rejected whole. ``multiline`` allows line breaks inside quotes: records are put
    together from the lines of all input splits, with one shuffle by split. Switch it off
    for inputs without such line breaks to do without.
    """
    tables, failures = _tabular_groups(spark, paths, multiline, parsed_once=True)
    loaded = []
    for raw in tables:
        good = raw.where(F.col(_CORRUPT).isNull()).drop(_CORRUPT)
        rejects = raw.where(F.col(_CORRUPT).isNotNull()).select(
            "source_file", F.col(_CORRUPT).alias("raw")
        )
        loaded.append((good.transform(tabular_to_unified), rejects, tabular_counters(good)))
    records, rejects, counters = (reduce(DataFrame.unionByName, x) for x in zip(*loaded))
    return LoadedSource(records, rejects, counters, failures)


def read_blocks(spark: SparkSession, paths: str | list[str]) -> LoadedSource:
    """Text files cut at empty lines; a file that yields one block is cut into lines.

    One look at the line structure says how to read each file. Block files and line files
    are cut by the reader itself, and none of their text is shuffled, whatever other
    files lie beside them. Only block files with other line ends than ``\\n`` take the
    general way by lines.
    """
    found = _files_of(block_file_kinds(spark, paths, "\n"))
    if found["odd"]:
        odd = _files_of(block_file_kinds(spark, found["odd"], None))
        found = {**found, "lines": [*found["lines"], *odd["lines"]], "odd": odd["blocks"]}
    pieces = []
    if found["blocks"]:
        pieces.append(_separated_blocks(spark, found["blocks"]))
    if found["lines"]:
        pieces.append(_lines_of(_text_lines(spark, found["lines"]).where("content")))
    if found["odd"]:
        pieces.append(_blocks_by_line(spark, found["odd"]))
    if not pieces:
        pieces.append(_separated_blocks(spark, paths).where(F.lit(False)))
    records = (
        reduce(DataFrame.unionByName, pieces)
        .withColumn("text", strip(F.col("text")))
        .where(F.col("text") != "")
        .select(
            stable_id(
                F.col("source_file"), F.col(SPLIT), F.col(ROW), F.col("piece"), F.col("text")
            ).alias("record_id"),
            F.lit(BLOCK_FORMAT).alias("source_format"),
            "source_file",
            "timestamp",
            "text",
            F.lit("{}").alias("raw_metadata"),
        )
    )
    return LoadedSource(records)


def _files_of(kinds: DataFrame) -> dict[str, list[str]]:
    """Paths by kind; as long as the list of files that the driver has made before."""
    rows = kinds.groupBy("kind").agg(F.sort_array(F.collect_list("source_file")).alias("files"))
    found = {row["kind"]: [as_path(f) for f in row["files"]] for row in rows.collect()}
    return {kind: found.get(kind, []) for kind in ("blocks", "lines", "odd")}


def _scan_lines(
    spark: SparkSession, paths: str | list[str], separator: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """The raw text table, and its lines with their position.

    ``empty`` lines have no character, ``content`` lines a visible one.
    """
    reader = spark.read if separator is None else spark.read.option("lineSep", separator)
    raw = reader.text(paths)
    return raw, _at_scan(
        raw,
        "value",
        (F.col("value") == "").alias("empty"),
        (strip(F.col("value")) != "").alias("content"),
        F.col("_metadata.file_modification_time").alias("timestamp"),
    )


def _text_lines(
    spark: SparkSession, paths: str | list[str], separator: str | None = None
) -> DataFrame:
    """Lines with their position from the start of their split."""
    raw, lines = _scan_lines(spark, paths, separator)
    return _from_split_start(lines, raw)


def block_file_kinds(
    spark: SparkSession, paths: str | list[str], separator: str | None = "\n"
) -> DataFrame:
    """Per file with content its ``kind``: blocks, lines, or odd if it has carriage returns.

    A file has two blocks if an empty line stands between its first and its last
    line with content. Only positions leave the scan, no text; every task reduces
    its lines before that. With ``separator=None`` all line ends count alike and no
    file is odd.
    """
    _, lines = _scan_lines(spark, paths, separator)
    position = F.struct(SPLIT, ROW)
    extent = (
        lines.groupBy("source_file", SPLIT)
        .agg(
            F.min(F.when(F.col("content"), position)).alias("first"),
            F.max(F.when(F.col("content"), position)).alias("last"),
            F.bool_or(F.contains("value", F.lit("\r"))).alias("odd"),
        )
        .groupBy("source_file")
        .agg(
            F.min("first").alias("first"),
            F.max("last").alias("last"),
            F.bool_or("odd").alias("odd"),
        )
        .where(F.col("first").isNotNull())
    )
    extent = broadcast_if_small(extent, BROADCAST_FILES)
    between = (
        lines.where("empty")
        .select("source_file", position.alias("position"))
        .join(extent, "source_file")
        .where((F.col("position") > F.col("first")) & (F.col("position") < F.col("last")))
        .select("source_file")
        .distinct()
        .withColumn("split", F.lit(True))
    )
    kind = F.when(F.col("odd"), F.lit("odd")).when(F.col("split"), F.lit("blocks"))
    return extent.join(between, "source_file", "left").select(
        "source_file", kind.otherwise(F.lit("lines")).alias("kind")
    )


def _lines_of(lines: DataFrame) -> DataFrame:
    """Lines, cut again at the rarer line ends the reader leaves in."""
    return lines.select(
        "source_file",
        "timestamp",
        SPLIT,
        ROW,
        F.posexplode(F.split("value", INNER_LINE_ENDS, -1)).alias("piece", "text"),
    )


def _separated_blocks(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Blocks as the reader cuts them at empty lines; each input split on its own."""
    return _text_lines(spark, paths, "\n\n").select(
        "source_file", "timestamp", SPLIT, ROW, F.lit(0).alias("piece"), F.col("value").alias("text")
    )


def _blocks_by_line(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Blocks of files with any line ends, put together from lines.

    An empty line opens a new block. The last empty line before a given line is
    found inside its input split and, for the lines before the first empty line
    of a split, carried over from earlier splits through one small row per
    split. Lines are grouped by split and by block, never by file.
    """
    lines = _text_lines(spark, paths)
    file_split = ["source_file", SPLIT]

    # One row per split: the last empty line of all earlier splits of the file.
    last_in_split = lines.groupBy(*file_split).agg(
        F.max(F.when(F.col("empty"), F.struct(SPLIT, ROW))).alias("last_empty")
    )
    earlier = (
        Window.partitionBy("source_file").orderBy(SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = last_in_split.select(
        *file_split, F.max("last_empty").over(earlier).alias("carried")
    )

    so_far = (
        Window.partitionBy(*file_split)
        .orderBy(ROW)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    here = F.max(F.when(F.col("empty"), F.struct(SPLIT, ROW))).over(so_far)
    start_of_file = F.struct(F.lit(-1).cast("long").alias(SPLIT), F.lit(-1).cast("long").alias(ROW))
    keyed = (
        lines.withColumn("here", here)
        .where(~F.col("empty"))
        .join(carried, file_split)
        .withColumn("block", F.coalesce("here", "carried", start_of_file))
    )
    return (
        keyed.groupBy("source_file", "timestamp", "block")
        .agg(F.array_sort(F.collect_list(F.struct(SPLIT, ROW, "value"))).alias("parts"))
        .select(
            "source_file",
            "timestamp",
            F.col(f"block.{SPLIT}").alias(SPLIT),
            F.col(f"block.{ROW}").alias(ROW),
            F.lit(0).alias("piece"),
            F.array_join(F.col("parts")["value"], "\n").alias("text"),
        )
    )


def read_curated(spark: SparkSession, path: str, decode_metadata: bool = False) -> DataFrame:
    """A curated table; nested columns stored as JSON text are decoded.

    The metadata of different sources have different fields; with ``decode_metadata``
    they come as VARIANT, text that is no JSON as NULL.
    """
    df = spark.read.parquet(path)
    if decode_metadata:
        df = df.withColumn("raw_metadata", F.try_parse_json("raw_metadata"))
    decoded = {
        name: F.from_json(F.col(name), kind)
        for name, kind in NESTED_COLUMNS.items()
        if name in df.columns and isinstance(df.schema[name].dataType, T.StringType)
    }
    return df.withColumns(decoded) if decoded else df

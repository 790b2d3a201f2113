"""Unified records over the star-schema tables, and raw files derived from them."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curaspan.functions.text import join_nonempty
from curaspan.operators.ingest import BLOCK_FORMAT, CHAT_FORMAT, TABULAR_FORMAT, unify
from curaspan.plans.pipeline import curate
from curaspan.session import broadcast_if_small, scratch_path
from curaspan.sources.readers import read_curated
from curaspan.sources.writers import write_curated

_written: dict[tuple[str, str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written_once(
    spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], object]
) -> str:
    """Path of a derived table or file, written on first use in this application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = scratch_path(spark, name)
        write(path)
        _written[key] = path
    return _written[key]


def _text(col: str) -> Column:
    return F.col(col).cast("string")


def order_note() -> Column:
    """A note with contact data made from the order's keys, by priority."""
    digits = F.lpad(_text("o_orderkey"), 10, "7")
    card = F.lpad(_text("o_orderkey"), 16, "4")

    def cut(col: Column, start: int, length: int) -> Column:
        return F.substring(col, start, length)

    phone = F.concat(
        F.lit("Call ("), cut(digits, 1, 3), F.lit(") "), cut(digits, 4, 3), F.lit("-"),
        cut(digits, 7, 4), F.lit(" today"),
    )
    ssn = F.concat(
        F.lit("SSN "), cut(digits, 1, 3), F.lit("-"), cut(digits, 4, 2), F.lit("-"),
        cut(digits, 6, 4), F.lit(", ask clerk."), _text("o_custkey"), F.lit("@example.com"),
    )
    payment = F.concat(
        F.lit("Card "), cut(card, 1, 4), F.lit("-"), cut(card, 5, 4), F.lit("-"), cut(card, 9, 4),
        F.lit("-"), cut(card, 13, 4), F.lit(", mail ops@10.20.30."),
        (F.col("o_custkey") % 256).cast("string"), F.lit(".example.com"),
    )
    host = F.concat(
        F.lit("Host 192.168."), (F.col("o_custkey") % 256).cast("string"), F.lit("."),
        (F.col("o_orderkey") % 256).cast("string"), F.lit(" ref "), digits,
    )
    priority = F.col("o_orderpriority")
    return (
        F.when(priority == "1-URGENT", phone)
        .when(priority == "2-HIGH", ssn)
        .when(priority == "3-MEDIUM", payment)
        .when(priority == "5-LOW", host)
        .otherwise(F.lit(""))
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unified, tagged records: documents, conversations, events and orders."""
    no_time = F.lit(None).cast("timestamp")
    documents = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc-"), _text("doc_id")).alias("record_id"),
        F.lit(BLOCK_FORMAT).alias("source_format"),
        F.concat(F.lit("documents/"), F.col("source")).alias("source_file"),
        no_time.alias("timestamp"),
        "text",
        F.to_json(F.struct("lang", "source")).alias("raw_metadata"),
    )
    conversations = table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", F.lit("conv"), _text("conv_id"), _text("turn")).alias("record_id"),
        F.lit(CHAT_FORMAT).alias("source_format"),
        F.lit("conversations").alias("source_file"),
        no_time.alias("timestamp"),
        "text",
        F.to_json(F.struct("role")).alias("raw_metadata"),
    )
    events = table(spark, sf_dir, "events").select(
        F.concat(F.lit("evt-"), _text("event_id")).alias("record_id"),
        F.lit("events").alias("source_format"),
        F.lit("events").alias("source_file"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.concat_ws(" ", "event_type", "props").alias("text"),
        F.lit("{}").alias("raw_metadata"),
    )
    orders = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("ord-"), _text("o_orderkey")).alias("record_id"),
        F.lit(TABULAR_FORMAT).alias("source_format"),
        F.concat(F.lit("orders/"), F.col("o_orderstatus")).alias("source_file"),
        F.when(
            F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderdate").cast("timestamp")
        ).alias("timestamp"),
        join_nonempty(
            F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(
                F.concat(F.lit("Clerk "), _text("o_custkey"))
            ),
            order_note(),
        ).alias("text"),
        F.to_json(F.struct("o_orderpriority")).alias("raw_metadata"),
    )
    return unify([documents, conversations, events, orders], spark)


def curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curated form of ``records``, written once and read back."""
    path = written_once(
        spark, sf_dir, "curated", lambda p: write_curated(curate(records(spark, sf_dir)), p)
    )
    return read_curated(spark, path)


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as tabular tickets: repeated ids, blank ids, five date layouts, quoted notes."""
    return _as_tickets(table(spark, sf_dir, "lineitem"))


def _as_tickets(lines: DataFrame) -> DataFrame:
    line = F.col("l_linenumber")
    shipped = F.col("l_shipdate")
    due = (
        F.when(line == 1, F.date_format(shipped, "yyyy-MM-dd"))
        .when(line == 2, F.date_format(shipped, "MM/dd/yyyy"))
        .when(line == 3, F.date_format(shipped, "dd-MMM-yyyy"))
        .when(line == 4, F.date_format(shipped, "yyyy/MM/dd"))
        .when(line == 5, F.date_format(shipped, "MMMM dd, yyyy"))
        .when(line == 6, F.lit("no date"))
        .otherwise(F.lit(""))
    )
    email = F.concat(F.lit("supplier."), _text("l_suppkey"), F.lit("@example.com"))
    quoted = F.concat(
        F.lit('Line "'), line.cast("string"), F.lit('", qty '),
        F.col("l_quantity").cast("int").cast("string"), F.lit("\ncall 415-555-"),
        F.lpad(_text("l_suppkey"), 4, "0"),
    )
    notes = (
        F.when(F.col("l_returnflag") == "A", quoted)
        .when(F.col("l_returnflag") == "R", F.concat(F.lit("Mail "), email, F.lit(", please")))
        .otherwise(F.lit(""))
    )
    return lines.select(
        F.when(F.col("l_discount") == 0, F.lit("")).otherwise(_text("l_orderkey")).alias("record_id"),
        F.when(F.col("l_tax") == 0, F.lit(""))
        .otherwise(F.concat(F.lit("Supplier "), _text("l_suppkey")))
        .alias("assignee_name"),
        email.alias("assignee_email"),
        F.concat(F.lit("Part "), _text("l_partkey")).alias("project_name"),
        F.col("l_linestatus").alias("status"),
        due.alias("due_date"),
        notes.alias("notes"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_returnflag",
        "l_tax",
        "l_discount",
        "l_shipdate",
    )


TICKET_COLUMNS = [
    "record_id", "assignee_name", "assignee_email", "project_name", "status", "due_date", "notes",
]

# The order of tickets in a file; ties are equal in every written column.
TICKET_ORDER = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag",
    "l_linestatus", "l_shipdate", "l_tax", "l_discount",
]


def _lines_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items, those of an order together and sorted.

    Their narrow columns go through the shuffle, before the texts of tickets are built.
    """
    lines = table(spark, sf_dir, "lineitem").select(*TICKET_ORDER)
    return lines.repartition("l_orderkey").sortWithinPartitions(*TICKET_ORDER)


def ticket_files(spark: SparkSession, sf_dir: str) -> str:
    """CSV files of tickets; all tickets of an order share a file, in line order."""

    def write(path: str) -> None:
        (
            _as_tickets(_lines_in_order(spark, sf_dir))
            .select(*TICKET_COLUMNS)
            .write.option("header", True)
            .option("escape", '"')
            .option("emptyValue", "")
            .csv(path)
        )

    return written_once(spark, sf_dir, "tickets", write)


def mixed_ticket_files(spark: SparkSession, sf_dir: str) -> list[str]:
    """Tickets in four folders with headers of their own, by order.

    The usual columns, the same in reverse order, one more column, and few columns without
    quoting, where some rows come out one field too long.
    """

    def write(path: str) -> None:
        lines = _lines_in_order(spark, sf_dir)
        surplus = F.when(F.col("l_returnflag") == "A", F.lit("a,surplus")).otherwise(F.lit("n"))
        # A column that holds whole lines, under a header that is a whole line.
        header = "record_id,assignee_name,notes"
        line = F.concat_ws(",", "record_id", "assignee_name", surplus)
        layouts = {
            "usual": (TICKET_COLUMNS, ","),
            "reversed": (TICKET_COLUMNS[::-1], ","),
            "wider": ([*TICKET_COLUMNS, "warehouse"], ","),
            "unquoted": ([header], "\x01"),
        }
        for part, (name, (columns, separator)) in enumerate(layouts.items()):
            own = lines.where(F.col("l_orderkey") % 4 == part)
            (
                _as_tickets(own)
                .withColumn("warehouse", F.concat(F.lit("W"), _text("l_suppkey")))
                .withColumn(header, line)
                .select(*[F.col(f"`{c}`") for c in columns])
                .write.option("header", True)
                .option("sep", separator)
                .option("escape", '"')
                .option("emptyValue", "")
                .csv(f"{path}/{name}")
            )

    path = written_once(spark, sf_dir, "mixed_tickets", write)
    return [f"{path}/{name}" for name in ("usual", "reversed", "wider", "unquoted")]


def _chat_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    minute = F.lpad((F.col("turn") % 60).cast("string"), 2, "0")
    return table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("U"), F.lpad(_text("conv_id"), 6, "0")).alias("user_id"),
        F.col("role").alias("username"),
        F.concat(F.lit("2024-01-15T09:"), minute, F.lit(":00Z")).alias("timestamp"),
        F.when(F.col("turn") > 0, F.concat(F.lit("room-"), _text("conv_id"))).alias("channel"),
        "text",
        F.floor(F.col("conv_id") / 100).alias("bucket"),
    )


# Messages of an array, about.
ARRAY_MESSAGES = 5000


def chat_array_files(spark: SparkSession, sf_dir: str) -> str:
    """The same messages as one JSON array per file, by hundred conversations.

    Where these have many messages, a hash deals them out, so that no array grows with a
    conversation.
    """

    def write(path: str) -> None:
        message = F.struct("user_id", "username", "timestamp", "channel", "text")
        messages = _chat_messages(spark, sf_dir)
        parts = F.ceil(F.count(F.lit(1)) / ARRAY_MESSAGES).alias("parts")
        sizes = broadcast_if_small(messages.groupBy("bucket").agg(parts), 500_000)
        (
            messages.join(sizes, "bucket")
            .groupBy("bucket", F.pmod(F.xxhash64(message), "parts").alias("part"))
            .agg(F.to_json(F.collect_list(message)).alias("value"))
            .write.partitionBy("bucket", "part")
            .text(path)
        )

    return written_once(spark, sf_dir, "chat_arrays", write)


def chat_files(spark: SparkSession, sf_dir: str) -> str:
    """Conversations as JSON Lines messages; opening turns lack the channel field."""

    def write(path: str) -> None:
        _chat_messages(spark, sf_dir).drop("bucket").write.json(path)

    return written_once(spark, sf_dir, "chat", write)


def block_files(spark: SparkSession, sf_dir: str) -> str:
    """Document texts separated by an empty line."""

    def write(path: str) -> None:
        table(spark, sf_dir, "documents").select("text").write.option("lineSep", "\n\n").text(path)

    return written_once(spark, sf_dir, "blocks", write)


def line_files(spark: SparkSession, sf_dir: str) -> str:
    """One customer per line, no empty lines."""

    def write(path: str) -> None:
        table(spark, sf_dir, "customer").select(
            F.concat_ws(", ", "c_name", "c_mktsegment").alias("value")
        ).write.text(path)

    return written_once(spark, sf_dir, "lines", write)


def windows_files(spark: SparkSession, sf_dir: str) -> str:
    """Document texts as blocks with carriage returns in all line ends."""

    def write(path: str) -> None:
        text = F.replace(F.col("text"), F.lit("\n"), F.lit("\r\n"))
        table(spark, sf_dir, "documents").select(text.alias("value")).write.option(
            "lineSep", "\r\n\r\n"
        ).text(path)

    return written_once(spark, sf_dir, "windows", write)


# Tasks for each core that share the splits of ``small_splits``.
SPLIT_TASKS = 16


@contextmanager
def small_splits(spark: SparkSession, size: str) -> Iterator[None]:
    """Files are read in splits of at most ``size`` meanwhile.

    A task reads many such splits, one after another: the number of tasks, each of which
    reports to the driver, does not grow with the files.
    """
    tasks = str(SPLIT_TASKS * spark.sparkContext.defaultParallelism)
    names = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.maxPartitionNum": tasks}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def shipping_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order texts that name the customer, segment, nation and region, plus the order note."""
    place = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    buyers = table(spark, sf_dir, "customer").join(
        place, F.col("c_nationkey") == F.col("n_nationkey")
    )
    # A file of one row group is one task; its narrow columns are dealt out before the
    # costly notes are built from them.
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    orders = orders.repartition(spark.sparkContext.defaultParallelism, "o_orderkey")
    # Streams the orders, also where their pruned columns look like the smaller side.
    buyers = broadcast_if_small(buyers, 200_000)
    return orders.join(buyers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.concat(F.lit("ord-"), _text("o_orderkey")).alias("record_id"),
        F.concat(
            F.lit("Order for "), F.col("c_name"), F.lit(" ("), F.col("c_mktsegment"), F.lit(") in "),
            F.col("n_name"), F.lit(", "), F.col("r_name"), F.lit(". "), order_note(),
        ).alias("text"),
    )


def entity_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as persons, segments as organisations, places alone and with their region."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))

    def entries(df: DataFrame, phrase: Column, label: str) -> DataFrame:
        return df.select(phrase.alias("phrase"), F.lit(label).alias("label"))

    return (
        entries(customer, F.col("c_name"), "PERSON")
        .unionByName(entries(customer, F.col("c_mktsegment"), "ORG").distinct())
        .unionByName(entries(nation, F.col("n_name"), "GPE"))
        .unionByName(entries(region, F.col("r_name"), "GPE"))
        .unionByName(entries(places, F.concat_ws(", ", "n_name", "r_name"), "GPE"))
    )

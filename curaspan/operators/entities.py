"""Entity spans from a dictionary of phrases, found with a join."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curaspan.functions.patterns import WORD
from curaspan.functions.spans import as_candidates, let, prefix_fold, resolve_overlaps
from curaspan.session import broadcast_if_small, scratch_path

_WORDS = rf"[{WORD}]+"

# A dictionary of up to this many phrases is sent to every executor, if it also has
# no more bytes than ``broadcast_if_small`` allows.
BROADCAST_PHRASES = 200_000

# Bits of the bitmap that texts are tested with: 16 to 32 for each phrase, 4 MB at most. A
# larger dictionary fills it up; then more runs leave their texts, and the join drops them.
BITS_PER_PHRASE = 16
MIN_BITS = 1 << 12
MAX_BITS = 1 << 25

ENTITIES = "array<struct<label:string,start:int,end:int,matched_text:string>>"


def _phrases(dictionary: DataFrame) -> DataFrame:
    """Dictionary entries as ``core``, from their first to their last word, with what is around it.

    ``anchor`` is the rarest word of the phrase in the dictionary (then the longest, then
    the first), ``k`` its place and ``n`` the number of words. Written once.
    """
    phrase = F.col("phrase")
    edges = rf"(?s)\A([^{WORD}]*+)(.*[{WORD}])([^{WORD}]*+)\z"
    entries = (
        dictionary.select(phrase.cast("string"), F.col("label").cast("string"))
        .where(phrase.isNotNull() & F.col("label").isNotNull())
        .distinct()
        .select(
            "phrase",
            "label",
            F.regexp_extract_all(phrase, F.lit(_WORDS), F.lit(0)).alias("words"),
            *[F.regexp_extract(phrase, edges, i).alias(part) for i, part in enumerate(("head", "core", "tail"), 1)],
        )
        .where(F.size("words") > 0)
    )
    placed = entries.select("*", F.posexplode("words").alias("k", "anchor"))
    uses = placed.groupBy("anchor").agg(F.count(F.lit(1)).alias("uses"))
    rarest = F.struct("uses", -F.length("anchor"), "k", "anchor")
    filed = (
        placed.join(uses, "anchor")
        .groupBy("phrase", "label", "head", "core", "tail", F.size("words").alias("n"))
        .agg(F.min(rarest).alias("rarest"))
        .select("phrase", "label", "head", "core", "tail", "n", "rarest.k", "rarest.anchor")
    )
    path = scratch_path(dictionary.sparkSession, "phrases")
    filed.write.parquet(path)
    return dictionary.sparkSession.read.schema(filed.schema).parquet(path)


def _slot(word: Column, bits: int) -> Column:
    """Number of the bit of ``word``; ``bits`` is a power of two."""
    return F.xxhash64(word).bitwiseAND(F.lit(bits - 1))


def _bitmap(words: DataFrame, bits: int) -> Column:
    """The bits of all ``word`` as an array of 64-bit numbers, for ``_is_set``."""
    slot = _slot(F.col("word"), bits)
    own = words.select(slot.alias("slot")).selectExpr(
        "slot div 64 AS at", "shiftleft(1L, cast(slot % 64 AS int)) AS mask"
    )
    none = words.sparkSession.range(bits // 64).selectExpr("id AS at", "0L AS mask")
    blocks = own.unionByName(none).groupBy("at").agg(F.bit_or("mask").alias("mask"))
    return blocks.agg(
        F.transform(F.sort_array(F.collect_list(F.struct("at", "mask"))), lambda b: b["mask"])
    ).scalar()


def _is_set(bitmap: Column, word: Column, bits: int) -> Column:
    slot = _slot(word, bits)
    block = F.get(bitmap, F.shiftright(slot, 6).cast("int"))
    return F.getbit(block, slot.bitwiseAND(F.lit(63)).cast("int")) == 1


# Parts that are looked at together: no row holds more of a text, with the runs that start
# in it, so that a long text with many runs takes room in proportion.
BLOCK_PARTS = 128


def _parts(text: Column) -> Column:
    """Gaps and words in turn, from the gap in front of the first word, which may be empty."""
    cut = F.regexp_extract_all(text, F.lit(rf"[{WORD}]+|[^{WORD}]+"), F.lit(0))
    return F.when(F.rlike(text, F.lit(rf"\A[{WORD}]")), F.concat(F.array(F.lit("")), cut)).otherwise(cut)


def _joined(parts: Column, first: Column, n: Column) -> Column:
    return F.array_join(F.slice(parts, first + 1, n), "")


def _blocks(parts: Column, width: int, overlap: int) -> Column:
    """Start and parts of every ``width`` parts, and of as many after them as runs may reach."""

    def cut(parts: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / width).cast("int"))
        lengths = F.transform(numbers, lambda b: F.length(_joined(parts, b * width, F.lit(width))))
        many = F.transform(
            prefix_fold(lengths, lambda a, b: a + b),
            lambda start, b: F.struct(
                start.alias("start"), F.slice(parts, b * width + 1, width + overlap).alias("parts")
            ),
        )
        one = F.array(F.struct(F.lit(0).alias("start"), parts.alias("parts")))
        return F.when(F.size(parts) <= width, one).otherwise(many)

    return let(parts, cut)


def _with(**columns: Column) -> list[Column | str]:
    """All columns and ``columns``, worked out once: no later filter is pushed below them."""
    made = F.struct(*[c.alias(name) for name, c in columns.items()])
    return ["*", F.inline_outer(F.array(made)).alias(*columns)]


def candidate_runs(df: DataFrame, phrases: DataFrame, text_col: str = "text") -> DataFrame | None:
    """Word runs that may be phrases: ``__key`` (a hash of the text), core, at, before, after.

    A bitmap holds the anchor and the core of every phrase. Runs are only built around a
    word whose bit is set, at the places where phrases have their anchors, and only those
    whose own bit is set leave the text. A set bit may be wrong, a missing one never is.
    Runs longer than the longest phrase, such as across a long gap, are not built. None
    if there are no phrases.
    """
    # A handful of numbers.
    shape = phrases.agg(
        F.count(F.lit(1)).alias("phrases"),
        F.max("n").alias("n"),
        *[F.max(F.length(part)).alias(part) for part in ("head", "core", "tail")],
    ).first()
    if not shape["phrases"]:
        return None
    bits = MIN_BITS
    while bits < BITS_PER_PHRASE * shape["phrases"] and bits < MAX_BITS:
        bits *= 2
    entries = phrases.select(F.explode(F.array("anchor", "core")).alias("word"))
    places = phrases.agg(F.collect_set(F.struct("n", "k"))).scalar()
    bitmap = _bitmap(entries, bits)
    parts, i, n, k = (F.col(name) for name in ("__parts", "__i", "__n", "__k"))
    first = F.col("__first")

    def anchors(bound: Column) -> Column:
        parts = bound["parts"]
        words = F.when(F.size(parts) > 1, F.sequence(F.lit(1), F.size(parts) - 1, F.lit(2)))
        return F.filter(words, lambda p: _is_set(bound["bits"], F.get(parts, p), bits))

    def earlier(p: Column) -> Column:
        return (p["n"] == n) & (p["k"] < k) & F.array_contains("__anchors", first + 2 * p["k"])

    # A run of n words has 2 * n - 1 parts, and a gap on each side.
    overlap = 2 * shape["n"] + 2
    width = max(BLOCK_PARTS, 2 * overlap)
    # The bitmap is named once in the list, so that no row ever holds it. The outer forms:
    # Spark would push a "size > 0" copy of the whole list below a plain explode.
    return (
        df.select(_text_key(text_col), _parts(F.col(text_col)).alias("__whole"))
        .select("__key", F.inline_outer(_blocks(F.col("__whole"), width, overlap)).alias("__start", "__parts"))
        .withColumn("__bits", bitmap)
        .withColumn("__anchors", let(F.struct(F.col("__bits").alias("bits"), parts.alias("parts")), anchors))
        .drop("__bits")
        .withColumn("__places", places)
        .select("*", F.explode_outer("__anchors").alias("__i"))
        .select("*", F.inline_outer("__places").alias("__n", "__k"))
        .select(*_with(__first=i - 2 * k))
        .where((first > 0) & (first < width) & (first + 2 * n - 2 < F.size(parts)))
        .select(*_with(core=_joined(parts, first, 2 * n - 1)))
        .where((F.length("core") <= shape["core"]) & _is_set(bitmap, F.col("core"), bits))
        # Two anchors may propose the same run: the one that stands first in it does.
        .select(*_with(__own=(n == 1) | ~F.exists("__places", earlier)))
        .where("__own")
        .select(
            "__key",
            "core",
            (F.col("__start") + F.length(_joined(parts, F.lit(0), first))).alias("at"),
            F.right(F.get(parts, first - 1), F.lit(shape["head"])).alias("before"),
            F.left(
                F.coalesce(F.get(parts, first + 2 * n - 1), F.lit("")), F.lit(shape["tail"])
            ).alias("after"),
        )
    )


def _entities_by_text(
    df: DataFrame, dictionary: DataFrame, text_col: str
) -> DataFrame | None:
    """Dictionary hits per different text: ``__key`` (a hash of the text) and ``__found``.

    With a dictionary of proven size the join is a broadcast; a larger one is shuffled,
    and so are the candidate runs, nearly all of which are hits. None if the dictionary
    is empty.
    """
    phrases = _phrases(dictionary)
    runs = candidate_runs(df, phrases, text_col)
    if runs is None:
        return None
    entries = broadcast_if_small(phrases.drop("anchor", "k", "n"), BROADCAST_PHRASES)
    hits = runs.join(entries, "core").where(
        F.endswith("before", F.col("head")) & F.startswith("after", F.col("tail"))
    )
    start = F.col("at") - F.length("head")
    return hits.groupBy("__key").agg(
        F.collect_set(
            F.struct(
                F.col("label").alias("label"),
                start.alias("start"),
                (start + F.length("phrase")).alias("end"),
                F.col("phrase").alias("matched_text"),
            )
        ).alias("__found")
    )


def _text_key(text_col: str) -> Column:
    """Half a SHA-256 as 16 bytes, which every run and hit of a text is shuffled with."""
    return F.substring(F.unhex(F.sha2(F.col(text_col), 256)), 1, 16).alias("__key")


def with_entities(
    dictionary: DataFrame, text_col: str = "text", output: str = "entities"
) -> Callable[[DataFrame], DataFrame]:
    """Add ``array<struct<label,start,end,matched_text>>`` of dictionary hits.

    ``dictionary`` has the columns ``phrase`` and ``label``. A phrase matches as
    it is written, from a word start to a word end; of overlapping hits the
    longest stays, then the earliest. Hits are looked up by text, so ids may repeat
    or be NULL. A text without hits has NULL. Streams are not supported: grouping the
    hits of a text needs the whole batch; use ``foreachBatch``.
    """

    def apply(df: DataFrame) -> DataFrame:
        if df.isStreaming:
            raise ValueError(
                "with_entities groups hits by text and cannot run on a stream; "
                "call it on the batches of foreachBatch"
            )
        found = _entities_by_text(df, dictionary, text_col)
        if found is None:
            return df.withColumn(output, F.array().cast(ENTITIES))

        # Order of preference: longer first, then earlier.
        candidates = F.transform(
            "__found",
            lambda e: F.get(
                as_candidates(
                    F.array(e), e["label"], (e["end"] - e["start"]).cast("double"), "ner", 0
                ),
                F.lit(0),
            ),
        )
        spans = F.transform(
            F.col("__longest"),
            lambda c: F.struct(
                c["pii_type"].alias("label"),
                c["start"].alias("start"),
                c["end"].alias("end"),
                c["matched_text"].alias("matched_text"),
            ),
        )
        return (
            df.withColumn("__key", _text_key(text_col))
            .join(found, "__key", "left")
            .withColumn("__candidates", candidates)
            .transform(resolve_overlaps, "__candidates", "__longest")
            .withColumn(output, spans)
            .select(*[c for c in df.columns if c != output], output)
        )

    return apply

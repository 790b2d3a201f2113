"""Spans inside a text: find them, settle overlaps, replace them.

Offsets count characters, start inclusive, end exclusive. All functions work on
one row, without Python and without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


_CANDIDATE_STRUCT = (
    "struct<rank:double,layer_rank:int,start:int,ordinal:int,end:int,"
    "pii_type:string,matched_text:string,confidence:double,layer:string>"
)
CANDIDATE_TYPE = f"array<{_CANDIDATE_STRUCT}>"

_LAYER_RANK = {"regex": 0, "ner": 1}


def empty_array(array_type: str) -> Column:
    return F.from_json(F.lit("[]"), array_type)


def find_spans(text: Column, regex: Column, matches: Column | None = None) -> Column:
    """Every left-to-right match of ``regex`` with its offsets.

    Spark has no function that returns offsets. Splitting a text by a regex and
    extracting the same regex give the gaps and the matches in turn.
    """
    matches = F.regexp_extract_all(text, regex, F.lit(0)) if matches is None else matches
    return spans_between(F.split(text, regex, -1), matches)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once, also if a lambda in ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _block_width(size: Column) -> Column:
    """Lists are worked on in blocks of about the square root of their size."""
    return F.greatest(F.lit(16), F.ceil(F.sqrt(size)).cast("int"))


# Lists up to this length take the plain forms, which are faster on few spans.
SHORT = 8


def prefix_fold(values: Column, fold: Callable[[Column, Column], Column]) -> Column:
    """Fold of all earlier values for each value, starting from 0.

    A short list is simply folded up to each value. Spark copies the state of ``aggregate`` at every step, so a list must not
    grow in there. The state here is one number: blocks are folded first, then
    the blocks before each block, then the values before each value in its block.
    """

    def folded(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), fold)

    def by_blocks(bound: Column) -> Column:
        values, width = bound["values"], bound["width"]
        blocks = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / width).cast("int"))
        totals = F.transform(blocks, lambda b: folded(F.slice(values, b * width + 1, width)))

        def place(before: Column) -> Column:
            return F.transform(
                values,
                lambda _, i: fold(
                    F.get(before, F.floor(i / width).cast("int")),
                    folded(F.slice(values, i - i % width + 1, i % width)),
                ),
            )

        before_blocks = let(
            totals, lambda t: F.transform(t, lambda _, b: folded(F.slice(t, F.lit(1), b)))
        )
        return let(before_blocks, place)

    def by_length(values: Column) -> Column:
        bound = F.struct(values.alias("values"), _block_width(F.size(values)).alias("width"))
        short = F.transform(values, lambda _, i: folded(F.slice(values, F.lit(1), i)))
        return F.when(F.size(values) <= SHORT, short).otherwise(let(bound, by_blocks))

    return let(values, by_length)


def spans_between(gaps: Column, matches: Column) -> Column:
    """Offsets of matches, given the pieces of text before, between and after them."""

    def place(bound: Column) -> Column:
        gaps, matches = bound["gaps"], bound["matches"]
        steps = F.zip_with(
            matches,
            F.slice(gaps, F.lit(1), F.size(matches)),
            lambda hit, gap: F.length(gap) + F.length(hit),
        )
        starts = F.zip_with(
            prefix_fold(steps, lambda a, b: a + b),
            F.slice(gaps, F.lit(1), F.size(matches)),
            lambda before, gap: before + F.length(gap),
        )
        return F.zip_with(
            starts,
            matches,
            lambda start, hit: F.struct(
                start.alias("start"),
                (start + F.length(hit)).alias("end"),
                hit.alias("matched_text"),
            ),
        )

    def place_one(start: Column) -> Column:
        hit = F.get(matches, F.lit(0))
        return F.array(
            F.struct(
                start.alias("start"),
                (start + F.length(hit)).alias("end"),
                hit.alias("matched_text"),
            )
        )

    # One match, the common case, stands right after the first gap.
    first_gap = F.length(F.get(gaps, F.lit(0)))
    return F.when(F.size(matches) == 1, let(first_gap, place_one)).otherwise(
        let(F.struct(gaps.alias("gaps"), matches.alias("matches")), place)
    )


def as_candidates(
    spans: Column, pii_type: Column, confidence: Column, layer: str, ordinal: int
) -> Column:
    """Spans with their order of preference in front.

    The leading fields sort candidates best first: higher confidence, pattern
    layer before entity layer, earlier start, earlier pattern.
    """
    return F.transform(
        spans,
        lambda s: F.struct(
            (-confidence).alias("rank"),
            F.lit(_LAYER_RANK[layer]).alias("layer_rank"),
            s["start"].alias("start"),
            F.lit(ordinal).alias("ordinal"),
            s["end"].alias("end"),
            pii_type.alias("pii_type"),
            s["matched_text"].alias("matched_text"),
            confidence.alias("confidence"),
            F.lit(layer).alias("layer"),
        ),
    )


def _by_start(candidates: Column) -> Column:
    return F.array_sort(
        candidates,
        lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(
            a["end"] - b["end"]
        ),
    )


def _keep_best(cluster: Column) -> Column:
    """Greedy choice inside one cluster: best first, skip what overlaps a kept span."""

    def step(kept: Column, candidate: Column) -> Column:
        clash = F.exists(
            kept,
            lambda k: (candidate["start"] < k["end"]) & (k["start"] < candidate["end"]),
        )
        return F.when(clash, kept).otherwise(F.concat(kept, F.array(candidate)))

    kept = F.aggregate(F.array_sort(cluster), empty_array(CANDIDATE_TYPE), step)
    return F.when(F.size(cluster) <= 1, cluster).otherwise(_by_start(kept))


def _as_one(cluster: Column) -> Column:
    """One span over all of a cluster, with the labels of its best candidate."""

    def widened(best: Column) -> Column:
        return F.array(
            best.withField("start", F.get(cluster, F.lit(0))["start"]).withField(
                "end", F.array_max(F.transform(cluster, lambda s: s["end"]))
            )
        )

    return F.when(F.size(cluster) <= 1, cluster).otherwise(let(F.array_min(cluster), widened))


def _settle_clusters(ordered: Column, settle: Callable[[Column], Column]) -> Column:
    """``settle`` for every cluster of overlapping candidates, in start order.

    A cluster begins with each candidate that starts at or after the end of all
    candidates before it.
    """

    def by_cluster(bound: Column) -> Column:
        spans, reach = bound["spans"], bound["reach"]
        positions = F.sequence(F.lit(0), F.size(spans) - 1)
        first = F.filter(
            positions, lambda i: F.get(spans, i)["start"] >= F.get(reach, i)
        )

        def cut(first: Column) -> Column:
            clusters = F.transform(
                first,
                lambda at, c: F.slice(
                    spans, at + 1, F.coalesce(F.get(first, c + 1), F.size(spans)) - at
                ),
            )
            return F.flatten(F.transform(clusters, settle))

        return let(first, cut)

    reach = prefix_fold(F.transform(ordered, lambda s: s["end"]), lambda a, b: F.greatest(a, b))
    return let(F.struct(ordered.alias("spans"), reach.alias("reach")), by_cluster)


def resolve_overlaps(df: DataFrame, candidates: str, output: str) -> DataFrame:
    """Add the non-overlapping candidates, best ones first served, ordered by start.

    Candidates in start order fall into clusters of overlapping spans. Spans of
    different clusters cannot clash, so the greedy choice runs per cluster: a
    text with thousands of spans stays cheap. Texts without any overlap, nearly
    all of them, need no choice at all, and few spans are one cluster.
    """
    ordered, column = "__ordered", F.col("__ordered")
    clashes = _clashes(column)
    found = F.col(candidates)
    return (
        df.withColumn(ordered, F.when(F.size(found) <= 1, found).otherwise(_by_start(found)))
        .withColumn(
            output,
            F.when(F.size(column) <= 1, column)
            .when(~clashes, column)
            .when(F.size(column) <= SHORT, _keep_best(column))
            .otherwise(_settle_clusters(column, _keep_best)),
        )
        .drop(ordered)
    )


def _clashes(ordered: Column) -> Column:
    """Whether any candidate in start order overlaps the one before it."""
    return F.exists(
        F.zip_with(
            ordered,
            F.slice(ordered, 2, F.size(ordered)),
            lambda a, b: F.coalesce(b["start"] < a["end"], F.lit(False)),
        ),
        lambda clash: clash,
    )


def union_overlaps(df: DataFrame, candidates: str, output: str) -> DataFrame:
    """Add the candidates with every cluster of overlapping ones as a single span.

    Unlike ``resolve_overlaps`` no part of a losing candidate stays uncovered. The span
    has the labels of the best candidate in it, and its ``matched_text`` too, which then
    is a part of the span only.
    """
    ordered, column = "__ordered", F.col("__ordered")
    found = F.col(candidates)
    return (
        df.withColumn(ordered, F.when(F.size(found) <= 1, found).otherwise(_by_start(found)))
        .withColumn(
            output,
            F.when(F.size(column) <= 1, column)
            .when(~_clashes(column), column)
            .otherwise(_settle_clusters(column, _as_one)),
        )
        .drop(ordered)
    )


def replace_spans(text: Column, spans: Column, replacement_of) -> Column:
    """Text with every span replaced; ``spans`` must be in start order, without overlap.

    Works by position, so other occurrences of the same value are not touched.
    Cutting a piece out of a text takes a scan up to it, so the text is first cut
    into sections of many spans each, and each section into pieces.
    """
    width = _block_width(F.size(spans))

    def cut(source: Column, part: Column, start: Column) -> Column:
        """``source``, the text from ``start`` to the end of ``part``, with its spans replaced."""

        def piece(span: Column, index: Column) -> Column:
            previous = F.when(index == 0, start).otherwise(F.get(part, index - 1)["end"])
            gap = F.substring(source, previous - start + 1, span["start"] - previous)
            return F.concat(gap, replacement_of(span))

        return F.array_join(F.transform(part, piece), "")

    def section(block: Column) -> Column:
        part = F.slice(spans, block * width + 1, width)
        start = F.when(block == 0, F.lit(0)).otherwise(F.get(spans, block * width - 1)["end"])

        def replaced(bound: Column) -> Column:
            part, start = bound["part"], bound["start"]
            length = F.get(part, F.size(part) - 1)["end"] - start
            return let(F.substring(text, start + 1, length), lambda t: cut(t, part, start))

        return let(F.struct(part.alias("part"), start.alias("start")), replaced)

    blocks = F.sequence(F.lit(0), F.floor((F.size(spans) - 1) / width).cast("int"))
    head = F.when(F.size(spans) <= 16, cut(text, spans, F.lit(0))).otherwise(
        F.array_join(F.transform(blocks, section), "")
    )
    last_end = F.get(spans, F.size(spans) - 1)["end"]
    tail = F.substring(text, last_end + 1, F.length(text))
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(head, tail))

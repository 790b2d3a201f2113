"""Find personal data in a text column."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curaspan.functions.patterns import DEFAULT_PATTERNS, PiiPattern
from curaspan.functions.spans import (
    CANDIDATE_TYPE,
    as_candidates,
    empty_array,
    find_spans,
    resolve_overlaps,
    union_overlaps,
)

# Entity labels that are reported, with their confidence.
ENTITY_CONFIDENCE = {"PERSON": 0.80, "ORG": 0.70, "GPE": 0.65}

_TEXT = "__text"
_HITS = "__hits_{}"
_GATE = "__gate_{}"


def _entity_candidates(entities: Column) -> Column:
    """Entity spans (label, start, end, matched_text) as candidates; other labels drop out."""
    known = F.filter(entities, lambda e: e["label"].isin(*ENTITY_CONFIDENCE))

    def confidence(label: Column) -> Column:
        result = F.lit(0.0)
        for name, value in ENTITY_CONFIDENCE.items():
            result = F.when(label == name, F.lit(value)).otherwise(result)
        return result

    return F.flatten(
        F.transform(
            known,
            lambda e: as_candidates(F.array(e), e["label"], confidence(e["label"]), "ner", 0),
        )
    )


def detect_candidates(
    text_col: str = "text",
    patterns: Sequence[PiiPattern] = DEFAULT_PATTERNS,
    entities: Callable[[Column], Column] | Column | None = None,
    output: str = "pii_candidates",
) -> Callable[[DataFrame], DataFrame]:
    """Add every match of every pattern (and entity), overlaps included.

    ``entities`` is the second detection layer: a column of
    ``array<struct<label,start,end,matched_text>>`` (see ``operators.entities``),
    or a function of the text that returns one, such as an iterator Pandas UDF
    around a model.
    """

    def apply(df: DataFrame) -> DataFrame:
        # Extract once per pattern in one projection; positions are then worked
        # out only where a pattern matched.
        staged = df.withColumn(_TEXT, F.coalesce(F.col(text_col).cast("string"), F.lit("")))
        gates = {
            gate: _GATE.format(index)
            for index, gate in enumerate(dict.fromkeys(p.gate for p in patterns if p.gate))
        }
        if gates:
            staged = staged.withColumns(
                {name: F.col(_TEXT).rlike(gate) for gate, name in gates.items()}
            )
        hits = {}
        for index, pattern in enumerate(patterns):
            found = F.regexp_extract_all(F.col(_TEXT), F.lit(pattern.regex), F.lit(0))
            if pattern.needs:
                found = F.when(F.contains(F.col(_TEXT), F.lit(pattern.needs)), found)
            if pattern.gate:
                found = F.when(F.col(gates[pattern.gate]), found)
            hits[_HITS.format(index)] = found
        staged = staged.withColumns(hits)

        layers = []
        for index, pattern in enumerate(patterns):
            found = F.col(_HITS.format(index))
            spans = find_spans(F.col(_TEXT), F.lit(pattern.regex), found)
            candidates = as_candidates(
                spans, F.lit(pattern.pii_type), F.lit(pattern.confidence), "regex", index
            )
            layers.append(F.when(F.size(found) > 0, candidates).otherwise(empty_array(CANDIDATE_TYPE)))
        if entities is not None:
            column = entities if isinstance(entities, Column) else entities(F.col(_TEXT))
            layers.append(
                F.coalesce(_entity_candidates(column).cast(CANDIDATE_TYPE), empty_array(CANDIDATE_TYPE))
            )
        return staged.withColumn(output, F.concat(*layers)).drop(
            _TEXT, *hits, *gates.values()
        )

    return apply


def detect_pii(
    text_col: str = "text",
    patterns: Sequence[PiiPattern] = DEFAULT_PATTERNS,
    entities: Callable[[Column], Column] | Column | None = None,
    overlaps: str = "best",
) -> Callable[[DataFrame], DataFrame]:
    """Add the five detection columns: spans, their types, flag, count, top confidence.

    Of overlapping matches the one with the higher confidence stays, a pattern
    before an entity at equal confidence. NULL text counts as empty. With
    ``overlaps="union"`` overlapping matches become one span over all of them, with the
    type of the best.
    """
    if overlaps not in ("best", "union"):
        raise ValueError("overlaps must be 'best' or 'union'.")
    settle = resolve_overlaps if overlaps == "best" else union_overlaps

    def covered(c: Column) -> Column:
        length = c["end"] - c["start"]
        text = F.substring(F.col(text_col).cast("string"), c["start"] + 1, length)
        return F.when(F.length(c["matched_text"]) == length, c["matched_text"]).otherwise(text)

    def apply(df: DataFrame) -> DataFrame:
        resolved = df.transform(
            detect_candidates(text_col, patterns, entities, output="__candidates")
        ).transform(settle, "__candidates", "__kept")
        detections = F.transform(
            F.col("__kept"),
            lambda c: F.struct(
                *[
                    (covered(c) if (name, overlaps) == ("matched_text", "union") else c[name]).alias(name)
                    for name in ("pii_type", "matched_text", "start", "end", "confidence", "layer")
                ]
            ),
        )
        return (
            resolved.withColumn("pii_detections", detections)
            .drop("__candidates", "__kept")
            .transform(summarize_detections)
        )

    return apply


def summarize_detections(df: DataFrame) -> DataFrame:
    """The four per-record columns derived from ``pii_detections``."""
    spans = F.col("pii_detections")
    return df.withColumns(
        {
            "pii_types_found": F.array_sort(F.array_distinct(spans["pii_type"])),
            "has_pii": F.size(spans) > 0,
            "pii_count": F.size(spans),
            "max_pii_confidence": F.coalesce(F.array_max(spans["confidence"]), F.lit(0.0)),
        }
    )


def explode_detections(df: DataFrame, *keys: str) -> DataFrame:
    """One row per span. Records without spans drop out."""
    # The outer form keeps Spark from pushing a copy of the whole detection
    # expression below the explode as a "size > 0" filter.
    return df.select(*keys, F.inline_outer("pii_detections")).where(F.col("pii_type").isNotNull())

"""Personal data: regexes propose spans, checksums confirm them, context moves the score.

All of it is Spark expressions on one row: no Python worker and no shuffle. Offsets
count code points, the end is exclusive.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curaspan.functions.spans import (
    empty_array,
    let,
    replace_spans,
    spans_between,
    union_overlaps,
)
from curaspan.llm.common import with_plain_names

SPAN_TYPE = "array<struct<kind:string,start:int,end:int,matched_text:string,score:double>>"
BASE_KINDS = ("email", "ip", "card", "phone")
# Characters in front of a span that count as its context.
CONTEXT_CHARS = 40
CONTEXT_BONUS = 0.4
MIN_SCORE = 0.5

_LOCAL = r"A-Za-z0-9._%+\-"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _digit_count(low: int, high: int) -> Callable[[Column], Column]:
    return lambda match: F.length(_digits(match)).between(low, high)


def luhn_valid(match: Column) -> Column:
    """13 to 19 digits whose Luhn sum is a multiple of ten."""

    def total(digits: Column) -> Column:
        places = F.sequence(F.lit(1), F.length(digits))

        def add(acc: Column, place: Column) -> Column:
            digit = F.substring(digits, -place, F.lit(1)).cast("int")
            twice = digit * 2
            folded = twice - F.when(twice > 9, 9).otherwise(0)
            return acc + F.when(place % 2 == 0, folded).otherwise(digit)

        return F.aggregate(places, F.lit(0), add)

    def valid(digits: Column) -> Column:
        return F.length(digits).between(13, 19) & (total(digits) % 10 == 0)

    return let(_digits(match), valid)


def mod97_valid(match: Column) -> Column:
    """The check of account numbers: country and check digits last, letters as 10 to 35."""

    def rest(code: Column) -> Column:
        moved = F.concat(F.substring(code, 5, 100), F.substring(code, 1, 4))

        def add(acc: Column, char: Column) -> Column:
            value = F.ascii(char)
            return F.when(value >= 65, acc * 100 + value - 55).otherwise(acc * 10 + value - 48) % 97

        return F.aggregate(F.split(moved, ""), F.lit(0), add)

    return let(F.regexp_replace(match, " ", ""), lambda code: rest(code) == 1)


def ip_valid(match: Column) -> Column:
    """Every part is at most 255, leading zeros aside."""

    def small(part: Column) -> Column:
        short = F.regexp_replace(part, "^0+", "")
        return (F.length(short) < 3) | ((F.length(short) == 3) & (short <= "255"))

    return F.forall(F.split(match, r"\."), small)


def _always(match: Column) -> Column:
    return F.lit(True)


@dataclass(frozen=True)
class Rule:
    """A kind of span: proposal, confirmation, score and the words that raise it.

    Texts without a match of ``gate``, a cheaper regex, skip the proposal. A base kind
    is reported at any score, the others from ``MIN_SCORE`` on.
    """

    kind: str
    regex: str
    gate: str
    valid: Callable[[Column], Column]
    score: float
    context: str


# The regexes of the base kinds take long runs possessively and only start where such
# a run starts: the same matches as the plain forms, without their quadratic cost.
RULES: tuple[Rule, ...] = (
    Rule(
        "email",
        rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)++",
        "@",
        _always,
        0.9,
        r"mail|contact|write",
    ),
    Rule(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        r"[0-9]\.[0-9]",
        ip_valid,
        0.6,
        r"\bip\b|host|server|address",
    ),
    Rule(
        "card",
        r"(?<![0-9])(?<![0-9][ \-])[0-9](?:[ \-]?[0-9]){12,18}+(?![ \-]?[0-9])",
        r"[0-9](?:[ \-]?[0-9]){12}",
        luhn_valid,
        0.8,
        r"card|visa|payment|credit",
    ),
    Rule(
        "phone",
        r"\+[0-9][ ().0-9\-]+[0-9]",
        r"\+[0-9]",
        _digit_count(9, 15),
        0.7,
        r"phone|tel\b|mobile|call|fax",
    ),
    Rule(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}"
        r"(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
        r"[A-Z]{2}[0-9]{2}[A-Z0-9 ]",
        mod97_valid,
        0.9,
        r"iban|account|konto|cuenta|compte",
    ),
    Rule(
        "ssn",
        r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])",
        r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        _always,
        0.3,
        r"\bssn\b|social security",
    ),
    Rule(
        "secret",
        r"(?<![A-Za-z0-9])[A-Za-z0-9]{12,64}(?![A-Za-z0-9])",
        r"(?i)password|token|secret|api.?key",
        lambda match: match.rlike("[0-9]") & match.rlike("[A-Za-z]"),
        0.3,
        r"(?:password|token|secret|api.?key)[ \"':=]{1,4}$",
    ),
    Rule(
        "secret",
        r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])",
        "AKIA",
        _always,
        0.9,
        r"key",
    ),
)


def _kind_spans(text: Column, rule: Rule) -> Column:
    """Confirmed spans of one rule with their scores."""
    regex = F.lit(rule.regex)

    def scored(bound: Column) -> Column:
        # The gap in front of a match holds its context.
        spans = F.zip_with(
            spans_between(bound["gaps"], bound["matches"]),
            F.slice(bound["gaps"], F.lit(1), F.size(bound["matches"])),
            lambda s, gap: F.struct(
                F.lit(rule.kind).alias("kind"),
                s["start"].alias("start"),
                s["end"].alias("end"),
                s["matched_text"].alias("matched_text"),
                F.when(
                    F.lower(F.right(gap, F.lit(CONTEXT_CHARS))).rlike(rule.context),
                    F.lit(min(1.0, rule.score + CONTEXT_BONUS)),
                )
                .otherwise(F.lit(rule.score))
                .alias("score"),
            ),
        )
        kept = F.filter(spans, lambda s: rule.valid(s["matched_text"]))
        if rule.kind in BASE_KINDS or rule.score >= MIN_SCORE:
            return kept
        return F.filter(kept, lambda s: s["score"] >= MIN_SCORE)

    found = F.struct(
        F.split(text, regex, -1).alias("gaps"),
        F.regexp_extract_all(text, regex, F.lit(0)).alias("matches"),
    )
    return F.when(text.rlike(rule.gate), let(found, scored)).otherwise(empty_array(SPAN_TYPE))


def with_pii(docs: DataFrame, text_col: str = "text", output: str = "pii") -> DataFrame:
    """Add the spans of personal data as ``output``, ordered by kind as in ``RULES``, then start.

    Base kinds (email, ip, card, phone) are leftmost non-overlapping matches per kind
    that pass their check. The other kinds are added to them and may overlap them. NULL
    and empty texts have no spans. Rows are independent: repeated rows and NULL ids
    make no difference. A column named as ``output`` is replaced.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    parts = []
    for kind in dict.fromkeys(rule.kind for rule in RULES):
        own = [_kind_spans(text, rule) for rule in RULES if rule.kind == kind]
        if len(own) == 1:
            parts.append(own[0])
        else:
            # Kinds with several rules: one span per place.
            by_start = F.concat(*own)
            parts.append(F.array_sort(F.array_distinct(by_start)))
    return docs.withColumn(output, F.concat(*parts))


def _printed(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def pii_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id_col``, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    NULL and empty texts have no spans and the hash of nothing; whole texts of any length
    are searched. Repeated rows and NULL ids give a row each, an empty table gives none.
    Other columns are ignored, whatever their names.
    """
    found = with_pii(docs.select(id_col, F.col(text_col).alias("__text")), "__text", "__pii")
    base = F.filter("__pii", lambda s: s["kind"].isin(*BASE_KINDS))

    def count_of(kind: str) -> Column:
        own = F.filter("__pii", lambda s: s["kind"] == kind)
        return F.size(own).cast("long").alias(f"n_{kind}")

    return found.select(
        id_col,
        *[count_of(kind) for kind in BASE_KINDS],
        F.sha2(_printed(base), 256).alias("base_sha256"),
        _printed(F.col("__pii")).alias("spans"),
    )


def mask_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Replace every span in the text by its kind in angle brackets.

    Overlapping spans are masked as one, named by the one with the highest score, then the
    earliest, so no character of any span stays. NULL texts stay NULL and empty ones empty;
    whole texts of any length are masked. Rows are independent, so repeated rows and NULL
    ids make no difference, and an empty table stays empty. All other columns pass
    unchanged, whatever their names.
    """
    return with_plain_names(docs, text_col, text_col, lambda df, _, text: _mask(df, text))


def _mask(docs: DataFrame, text_col: str) -> DataFrame:
    columns = docs.columns
    found = with_pii(docs, text_col, "__pii")
    candidates = F.transform(
        "__pii",
        lambda s: F.struct(
            (-s["score"]).alias("rank"),
            F.lit(0).alias("layer_rank"),
            s["start"].alias("start"),
            F.lit(0).alias("ordinal"),
            s["end"].alias("end"),
            s["kind"].alias("pii_type"),
            s["matched_text"].alias("matched_text"),
            s["score"].alias("confidence"),
            F.lit("regex").alias("layer"),
        ),
    )
    settled = found.withColumn("__candidates", candidates).transform(
        union_overlaps, "__candidates", "__settled"
    )
    masked = replace_spans(
        F.col(text_col),
        F.col("__settled"),
        lambda s: F.concat(F.lit("<"), F.upper(s["pii_type"]), F.lit(">")),
    )
    changed = F.when(F.size("__pii") > 0, masked).otherwise(F.col(text_col))
    return settled.withColumn(text_col, changed).select(*columns)

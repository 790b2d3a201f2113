"""Tokens that no two values share: a table that lengthens colliding digests only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curaspan.functions.tokens import PSEUDONYMIZE_TYPES, TOKEN_HEX_DIGITS, digest_of, token_of
from curaspan.session import broadcast_if_small

# Up to this many lengthened tokens, or texts that hold one, are sent to every executor.
BROADCAST_TOKENS = 200_000

TOKENS = "array<struct<pii_type:string,original_text:string,replacement:string>>"


def _shared(digest: Column, other: Column) -> Column:
    """How many leading digits two different digests share; 0 without a second one."""
    differs = F.transform(
        F.sequence(F.lit(1), F.lit(64)), lambda i: F.substr(digest, i, F.lit(1)) != F.substr(other, i, F.lit(1))
    )
    return F.when(other.isNotNull(), F.array_position(differs, True).cast("int") - 1).otherwise(0)


def token_table(
    df: DataFrame, known: DataFrame | None = None, hex_digits: int = TOKEN_HEX_DIGITS, salt: str = ""
) -> DataFrame:
    """``pii_type, original_text, replacement`` of every value in ``pii_detections`` that gets a token.

    A digest that shares its first ``hex_digits`` digits with another value of its type is
    cut one digit after the longest prefix it shares with any of them, so no two values of
    a type have one token; all others keep the usual token. Values of ``known``, an
    earlier table made with the same salt, keep their tokens, whatever is added.
    Without ``known`` a new value may lengthen the token of an old one.

    Equal values collapse before the shuffle, which then goes by digest and is even. NULL
    values have no token; the table holds originals and has to be kept as they are.
    """
    columns = ["pii_type", "original_text"]
    values = (
        df.select(F.inline_outer("pii_detections"))
        .where(F.col("pii_type").isin(*PSEUDONYMIZE_TYPES) & F.col("matched_text").isNotNull())
        .select("pii_type", F.col("matched_text").alias("original_text"))
    )
    none = F.lit(None).cast("string")
    rows = values.select(*columns, none.alias("old"))
    if known is not None:
        rows = rows.unionByName(known.select(*columns, F.col("replacement").alias("old")))
    digests = (
        rows.groupBy(*columns)
        .agg(F.max("old").alias("old"))
        .withColumn("digest", digest_of(F.col("original_text"), salt))
    )
    near = Window.partitionBy("pii_type", F.substring("digest", 1, hex_digits)).orderBy("digest")
    # Of sorted digests a neighbour shares the longest prefix.
    shared = F.greatest(
        _shared(F.col("digest"), F.col("before")), _shared(F.col("digest"), F.col("after"))
    )
    return (
        digests.withColumns({"before": F.lag("digest").over(near), "after": F.lead("digest").over(near)})
        .withColumn("digits", F.greatest(F.lit(hex_digits), shared + 1))
        .select(
            *columns,
            F.coalesce(
                "old", token_of(F.col("pii_type"), F.substr("digest", F.lit(1), F.col("digits")))
            ).alias("replacement"),
        )
    )


def with_tokens_of_text(
    df: DataFrame, tokens: DataFrame, text_col: str, hex_digits: int, salt: str, output: str
) -> DataFrame:
    """Add the tokens in ``tokens`` that differ from the usual ones and occur in a row's spans.

    These are few, so nearly all rows pass untouched: where they are proven to be few, text is
    not shuffled. Rows are looked up by a hash of their text and spans; ids may repeat.
    """
    usual = token_of(
        F.col("pii_type"), F.substring(digest_of(F.col("original_text"), salt), 1, hex_digits)
    )
    changed = tokens.where(F.col("replacement") != usual)
    key = F.sha2(F.concat_ws("\n", F.to_json("pii_detections"), F.col(text_col).cast("string")), 256)
    spans = df.select(key.alias("__key"), F.inline_outer("pii_detections")).select(
        "__key", "pii_type", F.col("matched_text").alias("original_text")
    )
    found = (
        spans.join(broadcast_if_small(changed, BROADCAST_TOKENS), ["pii_type", "original_text"])
        .groupBy("__key")
        .agg(F.collect_set(F.struct("pii_type", "original_text", "replacement")).cast(TOKENS).alias(output))
    )
    return (
        df.withColumn("__key", key)
        .join(broadcast_if_small(found, BROADCAST_TOKENS), "__key", "left")
        .drop("__key")
    )

"""Replacement tokens and the choice between hashing and redacting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Types replaced by a stable hash token, types blanked out, and
# the names of the two strategies. A type in neither list is blanked out.
PSEUDONYMIZE_TYPES = ("EMAIL", "PHONE_US", "SSN", "CREDIT_CARD", "PERSON")
REDACT_TYPES = ("IP_ADDRESS", "ORG", "GPE")
PSEUDONYMIZATION = "pseudonymization"
REDACTION = "redaction"
TOKEN_HEX_DIGITS = 8


def digest_of(matched_text: Column, salt: str = "") -> Column:
    """All digits of a value's SHA-256."""
    return F.sha2(F.concat(F.lit(salt), matched_text) if salt else matched_text, 256)


def token_of(pii_type: Column, digits: Column) -> Column:
    """``[TYPE_xxxxxxxx]``."""
    return F.concat(F.lit("["), pii_type, F.lit("_"), digits, F.lit("]"))


def pseudo_token(
    pii_type: Column, matched_text: Column, hex_digits: int = TOKEN_HEX_DIGITS, salt: str = ""
) -> Column:
    """``[TYPE_xxxxxxxx]`` from the SHA-256 of the matched text.

    The same value gets the same token everywhere. ``hex_digits`` widens the
    token where 32 bits collide (``token_table`` widens only those); ``salt`` makes guessing values harder.
    """
    return token_of(pii_type, F.substring(digest_of(matched_text, salt), 1, hex_digits))


def redact_token(pii_type: Column) -> Column:
    """``[REDACTED_TYPE]``."""
    return F.concat(F.lit("[REDACTED_"), pii_type, F.lit("]"))


def strategy_for(pii_type: Column) -> Column:
    return F.when(pii_type.isin(*PSEUDONYMIZE_TYPES), F.lit(PSEUDONYMIZATION)).otherwise(
        F.lit(REDACTION)
    )


def replacement_for(
    pii_type: Column, matched_text: Column, hex_digits: int = TOKEN_HEX_DIGITS, salt: str = ""
) -> Column:
    return F.when(
        pii_type.isin(*PSEUDONYMIZE_TYPES), pseudo_token(pii_type, matched_text, hex_digits, salt)
    ).otherwise(redact_token(pii_type))

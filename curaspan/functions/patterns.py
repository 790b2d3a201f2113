"""The registry of personal-data patterns."""

from __future__ import annotations

from dataclasses import dataclass

# Java's \d, \s, \b differ from the Unicode rules the results are defined by,
# so every class is spelled out:
#   digit   any decimal digit of any script
#   space   Unicode white space plus the four separators U+001C..U+001F
#   edges   a "word" character is a letter, a number or the underscore
#   letter  the ASCII letters and the four characters that case-fold to one
DIGIT = r"\p{Nd}"
SPACE = r"\t-\r\x1c-\x20\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LETTER = r"a-zA-Z\u0130\u0131\u017f\u212a"
WORD = r"\p{L}\p{N}_"
EDGE_BEFORE = rf"(?<![{WORD}])"
EDGE_AFTER = rf"(?![{WORD}])"


@dataclass(frozen=True)
class PiiPattern:
    """One rule: where its regex matches, a span of ``pii_type`` is reported.

    ``needs`` is an optional literal that every match must contain, ``gate`` an
    optional cheaper regex that every text with a match must satisfy. Texts that
    fail either skip the regex; a gate shared by several rules runs once.
    """

    name: str
    pii_type: str
    confidence: float
    regex: str
    needs: str | None = None
    gate: str | None = None


_LOCAL = rf"{LETTER}0-9._%+\-"
_PHONE_SEP = rf"[{SPACE}.\-]"
_OCTET = rf"(?:25[0-5]|2[0-4]{DIGIT}|[01]?{DIGIT}{DIGIT}?)"
# All numeric types need three digits in a row or a dot between digits.
_DIGITS = rf"{DIGIT}(?:{DIGIT}{{2}}|\.{DIGIT})"

# Types, order, confidences and the language of each pattern.
# EMAIL only starts where a run of local characters starts (or where the last
# match ended) and takes the run possessively: the same matches as the plain
# form, without its quadratic cost on long unbroken runs.
DEFAULT_PATTERNS: tuple[PiiPattern, ...] = (
    PiiPattern(
        name="EMAIL",
        pii_type="EMAIL",
        confidence=0.99,
        regex=rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[{LETTER}0-9.\-]+\.[{LETTER}]{{2,}}",
        needs="@",
    ),
    PiiPattern(
        name="PHONE_US",
        pii_type="PHONE_US",
        confidence=0.95,
        regex=(
            rf"(?:\+?1{_PHONE_SEP}?)?"
            rf"(?:\({DIGIT}{{3}}\){_PHONE_SEP}?|{DIGIT}{{3}}{_PHONE_SEP})"
            rf"{DIGIT}{{3}}{_PHONE_SEP}?{DIGIT}{{4}}"
            rf"|{EDGE_BEFORE}{DIGIT}{{10}}{EDGE_AFTER}"
        ),
        gate=_DIGITS,
    ),
    PiiPattern(
        name="SSN",
        pii_type="SSN",
        confidence=0.99,
        regex=rf"{EDGE_BEFORE}{DIGIT}{{3}}-{DIGIT}{{2}}-{DIGIT}{{4}}{EDGE_AFTER}",
        needs="-",
        gate=_DIGITS,
    ),
    PiiPattern(
        name="CREDIT_CARD",
        pii_type="CREDIT_CARD",
        confidence=0.95,
        regex=rf"{EDGE_BEFORE}(?:{DIGIT}{{4}}[-{SPACE}]?){{3}}{DIGIT}{{1,4}}{EDGE_AFTER}",
        gate=_DIGITS,
    ),
    PiiPattern(
        name="IP_ADDRESS",
        pii_type="IP_ADDRESS",
        confidence=0.85,
        regex=rf"{EDGE_BEFORE}(?:{_OCTET}\.){{3}}{_OCTET}{EDGE_AFTER}",
        needs=".",
        gate=_DIGITS,
    ),
)


def patterns_by_type(patterns: tuple[PiiPattern, ...] = DEFAULT_PATTERNS) -> dict[str, str]:
    """Type name to regex."""
    return {p.pii_type: p.regex for p in patterns}

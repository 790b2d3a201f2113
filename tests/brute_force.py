"""Plain Python models of detection, to check the Spark results against."""

from __future__ import annotations

import re

# Fixed values: (type, confidence, pattern) in order of preference on ties.
RULES = [
    ("EMAIL", 0.99, re.compile(r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}", re.IGNORECASE)),
    (
        "PHONE_US",
        0.95,
        re.compile(
            r"(?:\+?1[\s.\-]?)?(?:\(\d{3}\)[\s.\-]?|\d{3}[\s.\-])\d{3}[\s.\-]?\d{4}|\b\d{10}\b"
        ),
    ),
    ("SSN", 0.99, re.compile(r"\b\d{3}-\d{2}-\d{4}\b")),
    ("CREDIT_CARD", 0.95, re.compile(r"\b(?:\d{4}[-\s]?){3}\d{1,4}\b")),
    (
        "IP_ADDRESS",
        0.85,
        re.compile(r"\b(?:(?:25[0-5]|2[0-4]\d|[01]?\d\d?)\.){3}(?:25[0-5]|2[0-4]\d|[01]?\d\d?)\b"),
    ),
]


def candidates(text: str) -> list[tuple]:
    """(start, end, type, confidence) of every match."""
    return [
        (m.start(), m.end(), name, confidence)
        for name, confidence, rule in RULES
        for m in rule.finditer(text)
    ]


def best_subset(spans: list[tuple]) -> list[tuple]:
    """Take spans by falling confidence, earlier first; skip any that touches taken characters."""
    taken: set[int] = set()
    result = []
    for span in sorted(spans, key=lambda s: (-s[3], s[0])):
        covered = set(range(span[0], span[1]))
        if not covered & taken:
            taken |= covered
            result.append(span)
    return sorted(result)

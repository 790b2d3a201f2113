from __future__ import annotations

import re

import numpy as np
import pytest

from curaspan.llm.html_extract import (
    LABELLED,
    block_features,
    classify,
    default_tree,
    extract_text,
    main_texts,
    page_blocks,
)

WORDS = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"


def text_of(page: str) -> str:
    return main_texts([page.encode()], default_tree())[0]


def test_tree_fits_its_table():
    for page, labels in LABELLED:
        blocks = page_blocks(page)
        expected = [c == "1" for c in labels.replace(" ", "")]
        assert len(blocks) == len(expected), page
        assert classify(block_features(blocks), default_tree()).tolist() == expected, page


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        (f"<article><h1>A  b</h1><p>{WORDS}<br>x&amp;y</p></article>", f"A b {WORDS} x&y"),
        (f"<nav><a href=x>{WORDS}</a></nav><article><p>{WORDS}", WORDS),
        (f"<article><p>a<b>b</b>c\n\t d&nbsp;e {WORDS}.</p></article>", f"abc d e {WORDS}."),
        (f"<script>var t='</p>';</script><main><p>{WORDS}</p></main><style>p{{}}", WORDS),
        (f"<main><p>{WORDS}</p><!-- {WORDS} --></main><footer>{WORDS}</footer>", WORDS),
        (f"<main><p>{WORDS}</p><div class='comments'><p>{WORDS}</p></div></main>", WORDS),
        (f"<main><p title='a>b'>{WORDS}</p><form>{WORDS}</form></main>", WORDS),
        (f"<aside>{WORDS}</aside><article><p>{WORDS}<p>Short.</article>", f"{WORDS} Short."),
        ("<nav>a</nav>", ""),
        ("", ""),
    ],
)
def test_article_without_furniture(page, expected):
    assert text_of(page) == expected


# Names that hold a telling word without being furniture, and furniture of other names.
PROSE = (
    "The council met on Tuesday evening to talk about the new library building and its costs. "
    "Several members asked for a second opinion, and the mayor promised an answer by spring."
)
REMARK = "I was there and it was a long night for all of us, but the plan is a good one."


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        (f"<article class='post tag-notices'><p>{PROSE}</p><p>{PROSE}</p></article>", f"{PROSE} {PROSE}"),
        (f"<article class='has-share'><p>{PROSE}</p></article>", PROSE),
        (f"<div class='has-nav page'><article><p>{PROSE}</p></article></div>", PROSE),
        (f"<div class='sidebar-left layout'><main><p>{PROSE}</p></main></div>", PROSE),
        (f"<article><p>{PROSE}</p></article><ol class='commentlist'><li>{REMARK}</li></ol>", PROSE),
        (
            f"<article><p>{PROSE}</p></article><div id='discussion'><div><p>Eve Moss, 2 hours ago</p>"
            f"<p>{REMARK}</p></div><div><p>Tom Hill, 2024-03-01</p><p>{REMARK}</p></div></div>",
            PROSE,
        ),
        (f"<div class='content'><p>{PROSE}</p><div class='adsbox'>{REMARK}</div><p>{PROSE}</p></div>", f"{PROSE} {PROSE}"),
        (f"<div><p>{PROSE}</p><p>{PROSE}</p></div><div>Copyright 2024 Town Paper. All rights reserved.</div>", f"{PROSE} {PROSE}"),
        (f"<ol class='comment-list'><li><article class='comment'><p>{REMARK}</p></article></li></ol>", ""),
        (f"<article><p>Copyright law is old. {PROSE}</p></article>", f"Copyright law is old. {PROSE}"),
    ],
)
def test_names_do_not_decide_alone(page, expected):
    assert text_of(page) == expected


def test_given_pages_keep_the_article(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = {r["page_id"]: r for r in extract_text(pages).collect()}
    import html

    for row in pages.collect():
        article = re.search(r"<article>(.*)</article>", row["html"], re.S).group(1)
        plain = re.sub(r"<(?:br|/?p|/?h1)>", " ", article)
        plain = " ".join(html.unescape(re.sub(r"<[^>]*>", "", plain)).split())
        got = found[row["page_id"]]
        assert got["text"] == plain and got["n_chars"] == len(plain) and got["url"] == row["url"]


def test_null_empty_long_repeated_and_clashing(spark):
    long = "<div>" * 50_000 + f"{WORDS}. " * 2
    rows = [(1, "u", None, 1), (None, None, "", 2), (2, "u", long, 3), (2, "u", long, 3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    out = extract_text(df).collect()
    assert sorted(r["text"] for r in out) == ["", "", *[f"{WORDS}. {WORDS}."] * 2]
    assert extract_text(df.limit(0)).count() == 0


def test_unclosed_quotes_and_tags_are_read_in_linear_time():
    for page in ("<" * 200_000, "<a b='" * 50_000, "<!--" * 100_000, "<p " * 100_000, "&" * 200_000):
        assert isinstance(text_of(page), str)
    assert np.isfinite(block_features(page_blocks("a<p>b"))).all()

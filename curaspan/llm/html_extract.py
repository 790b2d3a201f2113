"""Main text of web pages from flat blocks and a small decision tree.

A page is cut into blocks of text at block-level tags. Each block is described by its
number of words and its link density, by those of its neighbours, and by the elements
around it; the names of these are one count among others. A decision tree learned from the small labelled table below says which
blocks belong to the article.
"""

from __future__ import annotations

import functools
import html
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from curaspan.llm.common import map_texts

# Elements that end a block. Other tags are part of the running text.
_BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt"
    " fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html"
    " iframe input label legend li link main menu meta nav object ol optgroup option output p pre"
    " section select summary table tbody td textarea tfoot th thead title tr ul video audio".split()
)
# Elements that say where a block stands; only these are kept on the stack.
_CONTAINERS = frozenset(
    "article aside body button details dialog div dl fieldset figure footer form header label main"
    " menu nav ol section select table td th tr ul li p blockquote title".split()
)
# A paragraph or list item ends where the next one starts, closed or not.
_SELF_CLOSING = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr"}}
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_SKIPPED = "script|style|noscript|template|svg|iframe|object|textarea|select|title|math"
_FURNITURE_TAGS = frozenset(
    "nav header footer aside form menu button dialog select label fieldset title".split()
)
_FURNITURE_WORD = (
    r"(?:ads?|advert\w*|banner|breadcrumbs?|byline|comments?|consent|cookies?|copyright|disqus|footer"
    r"|foot|gdpr|header|legal|login|masthead|menu|modal|nav|navbar|navigation|newsletter|notices?"
    r"|pagination|pager|popup|promo\w*|related|replies|reply|respond|search|share|sharing|sidebar"
    r"|signup|skip|social|sponsor\w*|subscribe|tags|toolbar|widget\w*)"
)
# A whole class name or id: one of these words, also with a word for the box it is.
_FURNITURE_NAME = re.compile(
    _FURNITURE_WORD
    + r"(?:[_-]?(?:area|bar|block|body|box|container|form|item|links?|list|section|thread|wrap|wrapper))?\d*"
)
# A part of a name, but not where the name tells a state of something else.
_FURNITURE_PART = re.compile(
    rf"(?!(?:has|no|is|with|without|tag|category|post|entry|page|single)[_-])(?:.*[_-])?{_FURNITURE_WORD}(?:[_\d-].*)?"
)
_ARTICLE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:article|post|entry|story|main|content)[\s_-]?(?:body|content|text)?(?=$|[\s_-])"
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({_SKIPPED})\b(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)",
    re.S | re.I,
)
_NAME_ATTRIBUTE = re.compile(
    r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I
)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=$|[\s=/])|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)

# A line above a reader's comment: who wrote it and when.
_BYLINE = re.compile(
    r"\b(?:says|wrote|replied|reply|ago)\b|\b\d{4}-\d\d-\d\d\b|\b\d{1,2}:\d\d\b"
    r"|\b(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.? \d{1,2}\b|\b\d{1,2}[./]\d{1,2}[./]\d{2,4}\b",
    re.I,
)
_BYLINE_WORDS = 8
_NOTICE = re.compile(r"(?:\u00a9|\(c\)|\bcopyright)\s*\d{4}\b|\ball rights reserved\b", re.I)
_NOTICE_WORDS = 30

FEATURES = (
    "words", "link_density", "words_before", "links_before", "words_after", "links_after",
    "furniture_tags", "furniture_names", "in_article", "in_thread", "is_notice", "ends_like_prose",
)


@dataclass
class Block:
    """A block of text and what is around it."""

    text: str
    link_density: float
    element: int
    furniture_tags: int = 0
    furniture_names: int = 0
    in_article: bool = False
    in_thread: bool = False


class _Elements:
    """The containers of a page as they open; each knows the one around it, element 0 is the page."""

    def __init__(self) -> None:
        self.tag, self.parent = [""], [0]
        self.own_tag, self.article = [0], [0]
        self.whole_name, self.part_name = [False], [False]
        self.holds_article = [False]

    def open(self, tag: str, attributes: str, parent: int) -> int:
        names = [
            name
            for found in _NAME_ATTRIBUTE.findall(attributes)
            for name in next(filter(None, found), "").lower().split()
        ]
        is_article = tag in ("article", "main")
        own_article = is_article or any(map(_ARTICLE_NAMES.search, names))
        # A header inside an article holds its headline.
        own_tag = tag in _FURNITURE_TAGS and not (tag == "header" and self.article[parent])
        outer = tag in ("body", "html")
        self.tag.append(tag)
        self.parent.append(parent)
        self.own_tag.append(int(own_tag or bool(_HIDDEN.search(attributes))))
        self.article.append(self.article[parent] + own_article)
        self.whole_name.append(not outer and any(map(_FURNITURE_NAME.fullmatch, names)))
        self.part_name.append(
            not outer and not own_article and any(map(_FURNITURE_PART.fullmatch, names))
        )
        self.holds_article.append(is_article)
        if is_article:
            while parent and not self.holds_article[parent]:
                self.holds_article[parent] = True
                parent = self.parent[parent]
        return len(self.tag) - 1

    def describe(self, blocks: list[Block]) -> None:
        """Fill in what the elements around each block say, once the page is read."""
        tags, names, threads = [0], [0], [False]
        thread = self._threads(blocks)
        for e in range(1, len(self.tag)):
            above = self.parent[e]
            # A part of a name says nothing about an element that is or holds an article.
            named = self.whole_name[e] or (self.part_name[e] and not self.holds_article[e])
            tags.append(tags[above] + self.own_tag[e])
            names.append(names[above] + named)
            threads.append(threads[above] or e in thread)
        for block in blocks:
            e = block.element
            block.furniture_tags, block.furniture_names = tags[e], names[e]
            block.in_article, block.in_thread = self.article[e] > 0, threads[e]

    def _threads(self, blocks: list[Block]) -> set[int]:
        """Elements with two or more items that each are a byline and a text below it."""
        items: dict[int, set[int]] = {}
        for line, text in zip(blocks, blocks[1:]):
            words = len(line.text.split())
            if not (1 < words <= _BYLINE_WORDS and _BYLINE.search(line.text)) or line.text[-1] in ".!?":
                continue
            # The innermost element around both.
            around = {line.element}
            e = line.element
            for _ in range(3):
                e = self.parent[e]
                around.add(e)
            item = text.element
            for _ in range(3):
                if item in around:
                    break
                item = self.parent[item]
            if item and item in around and self.tag[item] not in ("body", "html", "main"):
                items.setdefault(self.parent[item], set()).add(item)
        return {
            e for e, own in items.items() if e and len(own) > 1 and self.tag[e] not in ("body", "html", "main")
        }


def page_blocks(page: str) -> list[Block]:
    """Every block with text, in page order."""
    blocks: list[Block] = []
    elements = _Elements()
    stack: list[int] = []
    pieces: list[str] = []
    linked: list[str] = []
    in_link = False

    def close() -> None:
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            words = len(text.split())
            links = len(html.unescape(" ".join(linked)).split())
            blocks.append(Block(text, min(1.0, links / words), stack[-1] if stack else 0))
        pieces.clear()
        linked.clear()

    def text_until(end: int) -> None:
        if end > at:
            pieces.append(page[at:end])
            if in_link:
                linked.append(page[at:end])

    at = 0
    for token in _TOKEN.finditer(page):
        text_until(token.start())
        at = token.end()
        if token.group(3) is None:
            continue
        tag = token.group(3).lower()
        closing = bool(token.group(2))
        if tag == "a":
            in_link = not closing
        elif tag == "br":
            pieces.append(" ")
        if tag not in _BLOCK_TAGS:
            continue
        close()
        in_link = False
        if tag in _VOID or tag not in _CONTAINERS:
            continue
        if closing:
            for depth in range(len(stack) - 1, -1, -1):
                if elements.tag[stack[depth]] == tag:
                    del stack[depth:]
                    break
        else:
            while stack and elements.tag[stack[-1]] in _SELF_CLOSING.get(tag, ()):
                stack.pop()
            stack.append(elements.open(tag, token.group(4), stack[-1] if stack else 0))
    text_until(len(page))
    close()
    elements.describe(blocks)
    return blocks


def block_features(blocks: list[Block]) -> np.ndarray:
    """One row of ``FEATURES`` per block; outside the page there are no words and no links."""
    if not blocks:
        return np.zeros((0, len(FEATURES)))
    words = np.array([len(b.text.split()) for b in blocks], float)
    links = np.array([b.link_density for b in blocks])
    before = lambda x: np.r_[0, x[:-1]]
    after = lambda x: np.r_[x[1:], 0]
    notices = [n <= _NOTICE_WORDS and bool(_NOTICE.search(b.text)) for n, b in zip(words, blocks)]
    around = [
        (b.furniture_tags, b.furniture_names, b.in_article, b.in_thread, notice, b.text[-1] in ".!?:;\"'”»…)")
        for b, notice in zip(blocks, notices)
    ]
    return np.column_stack(
        [words, links, before(words), before(links), after(words), after(links), np.array(around, float)]
    )


# The labelled table: pages, and for each of their blocks whether it is main text.
_SENTENCE = "The river rose again last night and the old bridge had to be closed for all traffic."
_SHORT = "It opened at noon."
_LINKS = "<ul><li><a href=/a>Home</a></li><li><a href=/b>World news</a></li></ul>"
_LONG = " ".join([_SENTENCE] * 4)
_AUTHOR = "Ann Lee, 3 days ago"
_RIGHTS = "Copyright 2024 The Daily River and its partners. All rights reserved. Do not reprint."
LABELLED = [
    # Headline and paragraphs in an article, menu, advert and footer around it.
    (
        f"<nav>{_LINKS}</nav><div class='ad'>{_SENTENCE}</div><article><h1>Bridge closed</h1>"
        f"<p>{_LONG}</p><p>{_SHORT}</p></article><footer>&copy; 2024 {_SENTENCE}</footer>",
        "000 111 0",
    ),
    (
        f"<header><h1>Daily</h1>{_LINKS}</header><main><h2>Bridge closed</h2><p>{_SHORT}</p>"
        f"<p>{_SENTENCE} <a href=/c>More</a></p></main><aside>{_LONG}</aside>",
        "000 111 0",
    ),
    # Reader comments and forms, also inside the article.
    (
        f"<article><p>{_LONG}</p><p>{_SENTENCE}</p><section class='comments'><p>{_LONG}</p>"
        f"<p>{_SHORT}</p></section></article><form><label>Name</label>{_SENTENCE}</form>",
        "11 00 00",
    ),
    (
        f"<div id='cookie-notice'>{_SENTENCE}</div><div class='post-content'><p>{_SENTENCE}</p>"
        f"<ul><li>{_SHORT}</li><li>Two boats</li></ul></div><div class='sidebar'><p>{_LONG}</p></div>",
        "0 111 0",
    ),
    # No elements that tell: words and links decide.
    (
        f"<div>{_LINKS}</div><div><p>{_LONG}</p><p>{_SENTENCE}</p><p>{_LONG}</p></div>"
        f"<div><a href=/d>Terms of use</a></div><div>Contact us</div>",
        "00 111 00",
    ),
    (
        f"<table><tr><td><a href=/e>Sport</a></td><td><a href=/f>Weather today</a></td></tr></table>"
        f"<div>{_LONG}</div><div>{_LONG}</div><div><a href=/g>{_SENTENCE}</a></div><div>Login</div>",
        "00 11 00",
    ),
    (
        f"<div>Log in</div><div>Sign up</div><p>{_LONG}</p><p>{_SHORT}</p><p>{_LONG}</p>"
        f"<div><a href=/h>Next</a> <a href=/i>Back to the list</a></div>",
        "00 111 0",
    ),
    (f"<p>{_SENTENCE}</p>", "1"),
    (f"<div>{_SENTENCE} {_SENTENCE}</div><div>{_LONG}</div>", "11"),
    (f"<article><p>{_SHORT}</p></article>", "1"),
    (f"<article><p><a href=/j>{_SENTENCE}</a></p><p>{_LONG}</p></article>", "11"),
    (f"<article>{_LINKS}<p>{_LONG}</p></article>", "111"),
    (f"<nav>{_SENTENCE}</nav><footer>{_LONG}</footer>", "00"),
    # Short calls at the edges of a page without telling elements.
    (f"<div>{_LONG}</div><div>{_LONG}</div><div>All rights reserved.</div>", "11 0"),
    (f"<div>Welcome, guest!</div><div>Buy now!</div><div>{_LONG}</div><div>{_LONG}</div>", "00 11"),
    (
        f"<p>{_LONG}</p><p>{_SHORT}</p><p>{_LONG}</p><div>Sign up today!</div><div>See you soon.</div>",
        "111 00",
    ),
    (
        f"<div>Latest posts from our editors</div><div>Most read this week</div><p>{_LONG}</p>"
        f"<h2>What the engineers say</h2><p>{_LONG}</p><div>Follow us on all channels</div>",
        "00 111 0",
    ),
    # In an article blocks without a full stop count as well, wherever they stand.
    ("<article><p>A list of words without a mark</p></article>", "1"),
    (
        f"<nav>{_LINKS}</nav><article><h1>Bridge closed after the heavy rain of Monday</h1>"
        "<p>Photo taken from the bank of the river by our reader</p></article>"
        "<footer>Write to the editors</footer>",
        "00 11 0",
    ),
    (
        f"<main><p>What is left of the bridge today and what it once was like in summer</p>"
        f"<p>{_LONG}</p><p>With pictures by the town archive</p></main><aside>Most read</aside>",
        "111 0",
    ),
    (
        f"<article><h1>Bridge closed after flood</h1><h2>By the river once again</h2><p>{_LONG}</p>"
        "<p>Five words without a mark</p><p>Four words and none</p></article>",
        "11111",
    ),
    # Paragraphs of an article may be of any length.
    (
        f"<article><h1>Flood</h1><p>{_LONG}</p><p>Why?</p><p>{_SENTENCE}</p><p>He left.</p><p>{_LONG}</p>"
        f"<p>No one came.</p><p>Rain, rain, rain.</p><p>{_LONG}</p><h2>What was lost</h2><p>{_SHORT}</p></article>",
        "1111111111 1",
    ),
    (
        f"<nav><a href=/a>Start</a> Menu</nav><main><h1>The old bridge</h1><p>Much was lost.</p><p>{_LONG}</p>"
        "<p>Not all.</p><ul><li>Two boats</li><li>One old mill</li></ul></main><footer>Write to us</footer>",
        "0 111111 0",
    ),
    # Comment lists that only their repeated bylines give away, inside and outside the article.
    (
        f"<article><p>{_LONG}</p><p>{_SENTENCE}</p></article><div><div><p>{_AUTHOR}</p><p>{_SENTENCE}</p></div>"
        f"<div><p>Ben Ash, May 4</p><p>{_LONG}</p></div></div>",
        "11 0000",
    ),
    (
        f"<article><p>{_LONG}</p><ol><li><div>{_AUTHOR}</div><p>{_LONG}</p></li>"
        f"<li><div>Ben Ash wrote:</div><p>{_SHORT}</p></li></ol></article>",
        "1 0000",
    ),
    (
        f"<div><p>{_LONG}</p><p>{_SENTENCE}</p></div><ul><li><div>{_AUTHOR}</div><p>{_LONG}</p></li>"
        f"<li><div>Ben Ash 10:45</div><p>{_SENTENCE}</p></li></ul>",
        "11 0000",
    ),
    # Names that say what a box is; names that tell a state of an article.
    (f"<article class='post has-share tag-notices'><p>{_LONG}</p><p>{_SHORT}</p></article>", "11"),
    (f"<div class='has-nav page'><article><p>{_SENTENCE}</p></article></div>", "1"),
    (f"<div class='content'><p>{_LONG}</p><div class='adsbox'>{_SENTENCE}</div><p>{_LONG}</p></div>", "101"),
    (f"<div class='content'><p>{_LONG}</p><div class='adsbox'>{_LONG}</div><p>{_SHORT}</p></div>", "101"),
    (f"<div><p>{_LONG}</p><p>{_LONG}</p></div><div class='site-promo'><p>{_LONG}</p></div>", "110"),
    (f"<main><p>{_LONG}</p><ol class='commentlist'><li>{_LONG}</li><li>{_SHORT}</li></ol></main>", "100"),
    # Notices of rights, long ones too; one inside the article is part of its text.
    (f"<div>{_LONG}</div><div>{_LONG}</div><div>{_RIGHTS}</div>", "11 0"),
    (f"<article><p>{_LONG}</p><p>{_RIGHTS}</p></article>", "11"),
    (f"<main><p>{_RIGHTS}</p><p>{_LONG}</p></main><div>{_RIGHTS}</div>", "11 0"),
    (f"<div>{_RIGHTS}</div><p>{_LONG}</p><p>{_LONG}</p>", "0 11"),
    (f"<p>{_LONG}</p><p>{_SENTENCE}</p><p>{_LONG}</p><div>{_RIGHTS} {_SHORT} {_SHORT} {_SHORT}</div>", "111 0"),
    (f"<div>{_RIGHTS} {_SHORT} {_SHORT} {_SHORT}</div><div>{_LONG}</div><div>{_SENTENCE}</div>", "0 11"),
]
# The same boxes of furniture with texts of any length, before, between and after the text.
_BOXES = [
    "nav", "header", "footer", "aside", "form", "div class=sidebar", "div class=comments",
    "div id=cookie-notice", "section class=related", "div hidden",
]
for _box in _BOXES:
    _tag = _box.split()[0]
    for _text in (_LONG, _SENTENCE, _SHORT):
        _furniture = f"<{_box}><p>{_text}</p><p>{_LONG}</p><p>{_text}</p></{_tag}>"
        _body = f"<p>{_LONG}</p><p>{_SENTENCE}</p><p>{_LONG}</p>"
        LABELLED += [
            (f"{_furniture}<div>{_body}</div>", "000 111"),
            (f"<div>{_body}</div>{_furniture}", "111 000"),
            (f"<article>{_body}</article>{_furniture}", "111 000"),
        ]
        if _tag != "header":
            LABELLED.append((f"<main>{_body}{_furniture}{_body}</main>", "111 000 111"))
MAX_DEPTH = 10


def learn_tree(x: np.ndarray, y: np.ndarray, depth: int = MAX_DEPTH):
    """Nested (feature, threshold, below, above) with 0 or 1 at the leaves, by Gini impurity."""
    if depth == 0 or y.min() == y.max():
        return int(2 * y.sum() >= len(y))
    best = None
    for feature in range(x.shape[1]):
        values = np.unique(x[:, feature])
        for threshold in (values[1:] + values[:-1]) / 2:
            low = x[:, feature] < threshold
            score = sum(len(s) * s.mean() * (1 - s.mean()) for s in (y[low], y[~low]))
            if best is None or score < best[0] - 1e-12:
                best = (score, feature, float(threshold), low)
    if best is None:
        return int(2 * y.sum() >= len(y))
    _, feature, threshold, low = best
    return (
        feature, threshold, learn_tree(x[low], y[low], depth - 1), learn_tree(x[~low], y[~low], depth - 1),
    )


@functools.lru_cache(maxsize=1)
def default_tree():
    """The tree of the labelled table."""
    x, y = [], []
    for page, labels in LABELLED:
        x.append(block_features(page_blocks(page)))
        y += [int(c) for c in labels.replace(" ", "")]
    return learn_tree(np.vstack(x), np.array(y, float))


def classify(x: np.ndarray, tree) -> np.ndarray:
    """Whether each row of features is main text."""
    if not isinstance(tree, tuple):
        return np.full(len(x), bool(tree))
    feature, threshold, below, above = tree
    low = x[:, feature] < threshold
    out = np.zeros(len(x), bool)
    out[low] = classify(x[low], below)
    out[~low] = classify(x[~low], above)
    return out


def main_texts(pages: list[bytes], tree) -> list[str]:
    """Main text of every page; empty if no block belongs to it."""
    blocks = [page_blocks(p.decode()) for p in pages]
    kept = classify(np.vstack([block_features(b) for b in blocks]), tree)
    out, at = [], 0
    for own in blocks:
        out.append(" ".join(b.text for b, k in zip(own, kept[at : at + len(own)]) if k))
        at += len(own)
    return out


def extract_text(
    pages: DataFrame,
    id_col: str = "page_id",
    html_col: str = "html",
    keep: tuple[str, ...] = ("url",),
    tree=None,
) -> DataFrame:
    """Main text of every page: ``id_col``, the columns of ``keep``, text, n_chars.

    NULL and empty pages, and pages without main text, have an empty text. A page without
    markup is one block. Broken markup is read as far as it goes: comments, scripts and
    tags without an end run to the end of the page. Rows are independent, so NULL ids and
    repeated rows make no difference; other columns are not read.
    """
    tree = default_tree() if tree is None else tree

    def run(texts: list[bytes]) -> list[list]:
        found = main_texts(texts, tree)
        return [found, [len(t) for t in found]]

    return map_texts(pages, [id_col, *keep], html_col, "text string, n_chars long", run)

"""Phrase collocations by stripes.

Every prefix keys an associative counter of the words after it, its stripe. A task adds
up the stripes of its own rows, Spark brings those of one prefix together, and they are
merged element by element. One merged stripe gives the extensions of its prefix with
their counts, the count of the prefix itself (the sum of the stripe, ends of pieces
included) and the most frequent extension, which decides whether the prefix is subsumed.

Stripes are built level by level. A phrase can only be frequent if both phrases one word
shorter are, so the frequent ones of each level go to all tasks as a bitmap of hashes.
The bitmap only saves work: what it lets through too much is counted out all the same.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curaspan.llm.common import raw_texts, text_slices, written
from curaspan.session import broadcast_if_small

MIN_COUNT = 30
MAX_WORDS = 4
SCALE = 2_000_000
# A phrase goes if a longer one has at least this share of its count.
SUBSUMED = (4, 5)
TOP = 2000
UNKNOWN = "und"
# A task hands on its counters when they hold so many entries or words.
HELD_ENTRIES = 2_000_000
HELD_WORDS = (1 << 21) - 1
# Bits per frequent phrase in a bitmap, and the largest bitmap (32 MB).
BITS_PER_PHRASE, MAX_BITMAP_BITS = 16, 28
# A stripe is dealt out by its next words so that no part counts more occurrences than
# this, or than a millionth of all words. So at most a million prefixes are dealt out.
STRIPE_PART = 1 << 20
MOST_DEALT = 1 << 20
# Long texts are cut at ends of pieces near this size.
PART_BYTES = 4_000_000
# Prefix counts up to this number and size go to every executor.
BROADCAST_PREFIXES, BROADCAST_BYTES = 300_000, 16 << 20

_PRIME = np.uint64(0x9E3779B185EBCA87)
_UPPER = bytes(range(65, 91))
_CUTS = b".,;:!?\x0b\x0c\r"
_PLAIN = bytes.maketrans(_CUTS + b"\t" + _UPPER, b"\n" * len(_CUTS) + b" " + _UPPER.lower())
# No word holds an upper-case letter, so this one can stand for the end of a piece.
_END = b"A"


def tokens(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Words of all texts in turn, with an ``_END`` after each piece, in parts of bounded size."""
    for raw in texts:
        raw = raw.translate(_PLAIN)
        at = 0
        while at < len(raw):
            stop = len(raw)
            if stop - at > PART_BYTES:
                cut = raw.rfind(b"\n", at, at + PART_BYTES)
                cut = cut if cut >= 0 else raw.find(b"\n", at + PART_BYTES)
                stop = cut + 1 if cut >= 0 else stop
            found = raw[at:stop].replace(b"\n", b" A ").split()
            found.append(_END)
            yield found
            at = stop


class _Words(dict):
    """Own number of every word of a task; the end of a piece is -1."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self) - 1
        return number

    @classmethod
    def new(cls) -> _Words:
        return cls({_END: -1})


class _Counters:
    """Stripes of one language in one task, before they are handed on."""

    def __init__(self, lang: str):
        self.words = _Words.new()
        self.seed = xxhash.xxh32_intdigest(lang.encode())
        self.hashes = np.zeros(0, np.uint64)
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.entries = 0

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))

    def word_hashes(self) -> np.ndarray:
        """Hash of every numbered word; the last entry, -1, stands for an end."""
        known = max(0, len(self.hashes) - 1)
        new = itertools.islice(self.words, known + 1, None)
        made = np.array([xxhash.xxh64_intdigest(w, self.seed) for w in new], np.uint64)
        self.hashes = np.concatenate([self.hashes[:known], made, [np.uint64(0)]])
        return self.hashes


    def added_up(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if len(self.parts) > 1:
            self.parts = [_added_up(*(np.concatenate(c) for c in zip(*self.parts)))]
            self.entries = len(self.parts[0][0])
        return self.parts[0] if self.parts else (np.zeros(0, np.int64),) * 3


def phrase_hash(parts: list[np.ndarray]) -> np.ndarray:
    """Hash of phrases from the hashes of their words, one array per place."""
    out = parts[0]
    for more in parts[1:]:
        out = out * _PRIME + more
    return (out ^ (out >> np.uint64(29))) * _PRIME


class Known(NamedTuple):
    """What a level has to know of the frequent phrases one word shorter."""

    bits: int
    bitmap: np.ndarray
    # Sorted hashes of the prefixes whose stripes are dealt out, and into how many parts.
    dealt: np.ndarray
    n_parts: np.ndarray

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        return (self.bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0

    def parts_of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.dealt):
            return np.ones(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.dealt, hashes), len(self.dealt) - 1)
        return np.where(self.dealt[at] == hashes, self.n_parts[at], 1)


def _source(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN))
    return docs.select(lang.alias("lang"), F.col(text_col).alias("text"))


def _by_language(part: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    texts = raw_texts(part.column(1))
    langs = part.column(0).to_pylist()
    for lang in dict.fromkeys(langs):
        yield lang, [raw for raw, own in zip(texts, langs) if own == lang]


def word_counts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, phrase, f) of every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[_Words, np.ndarray]] = {}

        def hand_on(lang: str) -> pa.RecordBatch:
            words, total = held.pop(lang)
            names = pa.array(list(words)[1:], pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(names), pa.string()), names, pa.array(total[: len(names)])],
                names=["lang", "phrase", "f"],
            )

        for part in text_slices(batches, 1):
            for lang, texts in _by_language(part):
                for found in tokens(texts):
                    words, total = held.get(lang, (None, None))
                    if words is None:
                        words, total = held[lang] = _Words.new(), np.zeros(1, np.int64)
                    own = np.fromiter(map(words.__getitem__, found), np.int64, len(found))
                    counted = np.bincount(own[own >= 0], minlength=len(words))
                    if len(counted) > len(total):
                        total = np.concatenate([total, np.zeros(len(counted), np.int64)])
                    total[: len(counted)] += counted
                    held[lang] = words, total
                    if len(words) > HELD_WORDS:
                        yield hand_on(lang)
        for lang in list(held):
            yield hand_on(lang)

    source = _source(docs, text_col, lang_col)
    found = source.mapInArrow(run, "lang string, phrase string, f long")
    return found.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def stripes(docs: DataFrame, text_col: str, lang_col: str, width: int, known: Known) -> DataFrame:
    """Stripes of all tasks (lang, prefix, part, words, counts) of prefixes of ``width`` words.

    The empty word counts ends of pieces and words that cannot make a frequent phrase.
    """
    model = docs.sparkSession.sparkContext.broadcast(known)

    def count(own: _Counters, numbers: np.ndarray, known: Known) -> None:
        n = len(numbers) - width
        if n <= 0:
            return
        hashes = own.word_hashes()[numbers]
        inside = numbers >= 0
        # runs of ``width`` words that are frequent phrases, by their first place
        good = inside[: n + 1].copy()
        for k in range(1, width):
            good &= inside[k : n + 1 + k]
        good &= known.holds(phrase_hash([hashes[k : n + 1 + k] for k in range(width)]))
        at = np.flatnonzero(good[:n])
        code = numbers[at]
        for k in range(1, width):
            code = (code << 21) | numbers[at + k]
        follower = np.where(good[at + 1] & inside[at + width], numbers[at + width], -1)
        own.parts.append(_added_up(code, follower, np.ones(len(at), np.int64)))
        own.entries += len(own.parts[-1][0])

    def hand_on(lang: str, own: _Counters, known: Known) -> Iterator[pa.RecordBatch]:
        code, follower, counts = own.added_up()
        if not len(code):
            return
        hashes = own.word_hashes()
        new = np.r_[True, code[1:] != code[:-1]]
        first = np.flatnonzero(new)
        places = [(code[first] >> (21 * (width - 1 - k))) & HELD_WORDS for k in range(width)]
        n_parts = known.parts_of(phrase_hash([hashes[p] for p in places]))
        prefix = np.cumsum(new) - 1
        part = (hashes[follower] % n_parts[prefix].astype(np.uint64)).astype(np.int64)
        order = np.lexsort((part, prefix))
        prefix, part, follower, counts = prefix[order], part[order], follower[order], counts[order]
        starts = np.flatnonzero(np.r_[True, (prefix[1:] != prefix[:-1]) | (part[1:] != part[:-1])])
        names = pa.array([*list(own.words)[1:], b""], pa.binary()).cast(pa.string())
        spelled = [names.take(pa.array(p[prefix[starts]])) for p in places]
        text = pc.binary_join_element_wise(*spelled, " ") if width > 1 else spelled[0]
        offsets = pa.array(np.r_[starts, len(prefix)].astype(np.int32))
        follower = np.where(follower < 0, len(names) - 1, follower)
        whole = pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(starts), pa.string()),
                text,
                pa.array(part[starts]),
                pa.ListArray.from_arrays(offsets, names.take(pa.array(follower))),
                pa.ListArray.from_arrays(offsets, pa.array(counts)),
            ],
            names=["lang", "prefix", "part", "words", "counts"],
        )
        for k in range(0, whole.num_rows, 50_000):
            yield whole.slice(k, 50_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        held: dict[str, _Counters] = {}
        for slice_ in text_slices(batches, 1):
            for lang, texts in _by_language(slice_):
                pending: list[bytes] = []
                for found in tokens(texts):
                    pending += found
                    if len(pending) * 6 < PART_BYTES:
                        continue
                    count(held.setdefault(lang, _Counters(lang)), held[lang].numbers(pending), known)
                    pending = []
                own = held.setdefault(lang, _Counters(lang))
                count(own, own.numbers(pending), known)
                if own.entries > HELD_ENTRIES:
                    own.added_up()
                if len(own.words) > HELD_WORDS // 2 or own.entries > HELD_ENTRIES // 2:
                    yield from hand_on(lang, held.pop(lang), known)
        for lang, own in held.items():
            yield from hand_on(lang, own, known)

    return _source(docs, text_col, lang_col).mapInArrow(
        run, "lang string, prefix string, part long, words array<string>, counts array<long>"
    )


def _added_up(code: np.ndarray, follower: np.ndarray, counts: np.ndarray):
    """Every different (code, follower) once, in order, with the sum of its counts."""
    order = np.lexsort((follower, code))
    code, follower, counts = code[order], follower[order], counts[order]
    if not len(code):
        return code, follower, counts
    first = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (follower[1:] != follower[:-1])])
    return code[first], follower[first], np.add.reduceat(counts, first)


def merged_stripes(found: DataFrame, width: int, min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, prefix, total, best, words, counts, hashes) of every prefix and part of its stripe.

    ``total`` counts the prefix in this part. Only extensions seen ``min_count`` times or
    more are listed; ``best`` is the most frequent of them, with its count.
    """

    def merge(table: pa.RecordBatch) -> pa.RecordBatch:
        lang, prefix, part, words, counts = table.columns
        new = np.r_[True, _changes(lang, prefix, part)]
        first = np.flatnonzero(new)
        group = np.repeat(np.cumsum(new) - 1, words.value_lengths().to_numpy(zero_copy_only=False))
        coded = words.flatten().dictionary_encode()
        names = coded.dictionary
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        group, code, sums = _added_up(group, code, counts.flatten().to_numpy())
        total = np.zeros(len(first), np.int64)
        np.add.at(total, group, sums)
        empty = np.flatnonzero(pc.equal(names, "").to_numpy(zero_copy_only=False))
        kept = (sums >= min_count) & ~np.isin(code, empty)
        group, code, sums = group[kept], code[kept], sums[kept]
        best = np.zeros(len(first), np.int64)
        np.maximum.at(best, group, sums)
        lang, prefix = lang.take(pa.array(first)), prefix.take(pa.array(first))
        after = names.take(pa.array(code))
        hashes = _hashes(lang.take(pa.array(group)), prefix.take(pa.array(group)), after, width)
        offsets = pa.array(np.searchsorted(group, np.arange(len(first) + 1)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, v) for v in (after, pa.array(sums), pa.array(hashes))]
        return pa.RecordBatch.from_arrays(
            [lang, prefix, pa.array(total), pa.array(best), *lists],
            names=["lang", "prefix", "total", "best", "words", "counts", "hashes"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows arrive sorted; the last stripe may go on in the next batch.
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            change = _changes(*batch.columns[:3])
            cut = int(np.flatnonzero(change)[-1]) + 1 if change.any() else 0
            if held and _differ(held[-1], batch):
                yield merge(pa.concat_batches(held))
                held = []
            if cut:
                yield merge(pa.concat_batches([*held, batch.slice(0, cut)]))
                held = [batch.slice(cut)]
            else:
                held.append(batch)
        if held:
            yield merge(pa.concat_batches(held))

    keys = ["lang", "prefix", "part"]
    return (
        found.repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(
            run,
            "lang string, prefix string, total long, best long, words array<string>,"
            " counts array<long>, hashes array<long>",
        )
    )


def _changes(*columns: pa.Array) -> np.ndarray:
    """Whether each row differs from the row before it, from the second row on."""
    out = np.zeros(len(columns[0]) - 1, bool)
    for c in columns:
        out |= pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False)
    return out


def _differ(before: pa.RecordBatch, after: pa.RecordBatch) -> bool:
    last = before.num_rows - 1
    return any(before.column(i)[last] != after.column(i)[0] for i in range(3))


def _hashes(lang: pa.Array, prefix: pa.Array, after: pa.Array, width: int) -> np.ndarray:
    """Hashes of phrases as ``phrase_hash`` makes them, as signed longs."""
    seeds: dict[str, int] = {}
    cache: dict[tuple[str, str], int] = {}
    out = np.zeros((width + 1, len(after)), np.uint64)
    for i, (tag, head, last) in enumerate(zip(lang.to_pylist(), prefix.to_pylist(), after.to_pylist())):
        if tag not in seeds:
            seeds[tag] = xxhash.xxh32_intdigest(tag.encode())
        for k, word in enumerate([*head.split(" "), last]):
            if (tag, word) not in cache:
                cache[tag, word] = xxhash.xxh64_intdigest(word.encode(), seeds[tag])
            out[k, i] = cache[tag, word]
    return phrase_hash(list(out)).view(np.int64) if len(after) else np.zeros(0, np.int64)


def known_phrases(frequent: DataFrame, all_words: int) -> Known:
    """Bitmap of the phrases of ``frequent`` (f, h), and the stripes to be dealt out.

    A bitmap of at most 32 MB comes to the driver in rows of 4 KB, and at most
    ``MOST_DEALT`` prefixes with their counts.
    """
    n = frequent.count()
    bits = min(MAX_BITMAP_BITS, max(15, (BITS_PER_PHRASE * max(1, n) - 1).bit_length()))
    place = F.shiftrightunsigned("h", 64 - bits) + 1
    rows = (
        frequent.select(place.alias("place"))
        .groupBy(F.bitmap_bucket_number("place").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bitmap"))
        .collect()
    )
    bitmap = np.zeros(1 << (bits - 3), np.uint8)
    for row in rows:
        start = (row["bucket"] - 1) * 4096
        bitmap[start : start + 4096] = np.frombuffer(row["bitmap"], np.uint8)
    limit = max(STRIPE_PART, -(-all_words // MOST_DEALT))
    dealt = sorted(
        (r["h"] % (1 << 64), -(-r["f"] // limit)) for r in frequent.where(F.col("f") > limit).collect()
    )
    return Known(
        bits,
        bitmap,
        np.array([h for h, _ in dealt], np.uint64),
        np.array([parts for _, parts in dealt], np.int64),
    )


def _frequent_words(counted: DataFrame, min_count: int) -> DataFrame:
    """(f, h) of the frequent words of ``counted`` (lang, phrase, f)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, phrase, f = batch.columns
            hashes = np.array(
                [
                    xxhash.xxh64_intdigest(w.encode(), xxhash.xxh32_intdigest(tag.encode()))
                    for tag, w in zip(lang.to_pylist(), phrase.to_pylist())
                ],
                np.uint64,
            )
            yield pa.RecordBatch.from_arrays(
                [f, pa.array(phrase_hash([hashes]).view(np.int64))], names=["f", "h"]
            )

    return counted.where(F.col("f") >= min_count).mapInArrow(run, "f long, h long")


def mine_phrases(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    min_count: int = MIN_COUNT,
    top: int = TOP,
) -> DataFrame:
    """The ``top`` phrases of every language: lang, rank, phrase, a, l, r, n, score.

    Counts cover whole texts of all rows, repeated rows each time. NULL and empty texts
    have no words; a NULL language is ``und``, together with rows that say so. Ties are
    settled by ``a`` and then by the bytes of the phrase, so ranks are unique. An empty
    table, or one without a frequent phrase, gives an empty result. Texts of any length
    are counted in parts cut at ends of pieces. Other columns are ignored, whatever their
    names. All sums are longs, products are decimals.
    """
    counted = written(word_counts(docs, text_col, lang_col), "word-counts")
    sizes = written(counted.groupBy("lang").agg(F.sum("f").alias("n")), "language-words")
    all_words = sizes.agg(F.sum("n")).first()[0] or 0
    frequent = written(_frequent_words(counted, min_count), "frequent-words")
    prefixes, extensions = [], []
    for width in range(1, MAX_WORDS):
        known = known_phrases(frequent, all_words)
        found = stripes(docs, text_col, lang_col, width, known)
        merged = written(merged_stripes(found, width, min_count), f"stripes-{width}")
        prefixes.append(merged.select("lang", "prefix", "total", "best"))
        frequent = merged.select(
            "lang", "prefix", F.explode(F.arrays_zip("words", "counts", "hashes")).alias("e")
        ).select(
            "lang", "prefix", F.col("e.words").alias("word"), F.col("e.counts").alias("f"), F.col("e.hashes").alias("h")
        )
        extensions.append(frequent.withColumn("size", F.lit(width + 1)))
    totals = _union(prefixes).groupBy("lang", F.col("prefix").alias("phrase"))
    totals = totals.agg(F.sum("total").alias("f"), F.max("best").alias("best"))
    totals = written(totals, "prefix-totals")
    phrases = written(
        _union(extensions).select(
            "lang", F.concat_ws(" ", "prefix", "word").alias("phrase"), F.col("f").alias("a"), "size"
        ),
        "phrases",
    )
    return _ranked(_scored(_not_subsumed(phrases, totals), totals), sizes, top)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _exact(column: Column) -> Column:
    return column.cast("decimal(19,0)")


def _not_subsumed(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """Phrases without a longer one that is nearly as frequent.

    One more word on either side is enough to look at: no longer phrase around it is
    more frequent. The right side is the best of the phrase's own stripe.
    """
    right = totals.select("lang", "phrase", F.col("best").alias("right"))
    rest = F.expr("substring_index(phrase, ' ', 1 - size)")
    left = written(
        phrases.where("size > 2").groupBy("lang", rest.alias("phrase")).agg(F.max("a").alias("left")),
        "left-extensions",
    )
    share = F.lit(SUBSUMED[0]).cast("decimal(3,0)"), F.lit(SUBSUMED[1]).cast("decimal(3,0)")
    longer = F.greatest(F.coalesce("right", F.lit(0)), F.coalesce("left", F.lit(0)))
    return (
        phrases.join(right, ["lang", "phrase"], "left")
        .join(left, ["lang", "phrase"], "left")
        .where(_exact(longer) * share[1] < _exact(F.col("a")) * share[0])
        .select("lang", "phrase", "a", "size")
    )


def _scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """Phrases with l, r and score of their lowest-scoring cut."""
    size = F.col("size")
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1))).select(
        "*",
        F.expr("substring_index(phrase, ' ', k)").alias("first"),
        F.expr("substring_index(phrase, ' ', k - size)").alias("rest"),
    )
    own = broadcast_if_small(totals.select("lang", "phrase", "f"), BROADCAST_PREFIXES, BROADCAST_BYTES)
    first = own.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rest = own.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    cut = cuts.join(first, ["lang", "first"]).join(rest, ["lang", "rest"])
    cut = cut.withColumn(
        "score", F.expr(f"(cast(a as decimal(19,0)) * cast({SCALE} as decimal(7,0))) div (cast(l as decimal(19,0)) + r)")
    )
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("m")
    return cut.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "m.l", "m.r", "m.score")


def _ranked(scored: DataFrame, sizes: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score"
    )

"""Ranked lexical search by best-first intervals over range-maximum tables.

Spark counts documents, terms and document frequencies, and deals the documents out in
shards. A shard keeps one posting list for each wanted term with a sparse table over the
impacts in it. A search starts with the interval of all documents of a shard. The sum of
the range maxima of its terms bounds every document inside; the interval with the largest
bound is split at its document of maximum impact, which is scored, and intervals whose
bound is below the current k-th score are dropped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curaspan.llm.common import raw_texts, text_slices, written

TOP = 10
# Items are searched in blocks of about this many bytes of different terms; only one
# block at a time is on the driver and the executors. A larger item is a block of its own.
BLOCK_BYTES = 4 << 20
# A shard is full with so many documents or postings.
SHARD_DOCS = 2048
SHARD_POSTINGS = 400_000
# Entries of a shard's table of ranks (2 bytes each).
RANK_ENTRIES = 1 << 24
# Intervals that are split in one step, and terms times intervals in it.
BATCH, BATCH_ENTRIES = 256, 1 << 19
# Fixed values of the score.
SCALE, SATURATION, LENGTH_BASE, LENGTH_PART = 1_000_000_000, 1000, 10, 90

_TERMS = bytes(
    c if c >= 128 else (ord(chr(c).lower()) if chr(c).isalnum() else 32) for c in range(256)
)


def terms_of(raw: bytes) -> list[bytes]:
    """Runs of ASCII letters and digits and of all other characters, A to Z lower-cased."""
    return raw.translate(_TERMS).split()


def item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item, term): the different terms of every item; rows of one id are one item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, 1):
            for i, raw in enumerate(raw_texts(part.column(1))):
                own = list(set(terms_of(raw)))
                if own:
                    item = part.column(0).take(pa.array([i] * len(own)))
                    yield pa.RecordBatch.from_arrays(
                        [item, pa.array(own, pa.binary())], names=["item", "term"]
                    )

    source = items.select(F.col(item_col).cast("long").alias("item"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, "item long, term binary").distinct()


def wanted_terms(docs: DataFrame, id_col: str, text_col: str, vocabulary: list[bytes]) -> DataFrame:
    """(doc_id, n, terms, counts): length of every document and its terms of the vocabulary."""
    known = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = known.value.get
        size = max(1, len(known.value))
        for part in text_slices(batches, 1):
            lengths, codes = [], []
            for i, raw in enumerate(raw_texts(part.column(1))):
                words = terms_of(raw)
                lengths.append(len(words))
                own = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
                codes.append(own[own >= 0] + i * size)
            code, count = np.unique(np.concatenate(codes), return_counts=True)
            edges = np.searchsorted(code, np.arange(len(lengths) + 1) * size).astype(np.int32)
            offsets = pa.array(edges)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(lengths, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array((code % size).astype(np.int32))),
                    pa.ListArray.from_arrays(offsets, pa.array(count.astype(np.int64))),
                ],
                names=["doc_id", "n", "terms", "counts"],
            )

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(
        run, "doc_id long, n long, terms array<int>, counts array<long>"
    )


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Shard:
    """Posting lists of some documents, one after the other, with their sparse tables."""

    def __init__(self, size: np.ndarray, term: np.ndarray, tf: np.ndarray, m: np.ndarray, weights: np.ndarray):
        """``size`` terms of every document, ``term`` and ``tf`` of all of them in turn."""
        doc = np.repeat(np.arange(len(size)), size)
        impact = weights[term] * ((SCALE * tf) // (SATURATION * tf + 8 * m[doc]))
        order = np.argsort(term, kind="stable")
        self.n_docs = len(size)
        self.doc, self.impact = doc[order], impact[order]
        self.terms, self.start, counts = np.unique(term[order], return_index=True, return_counts=True)
        list_of = np.repeat(np.arange(len(self.terms)), counts)
        # rank[t, d]: postings of list t before document d
        self.rank = np.zeros((len(self.terms), self.n_docs + 1), np.uint16)
        self.rank[list_of, self.doc + 1] = 1
        np.cumsum(self.rank, axis=1, dtype=np.uint16, out=self.rank)
        # table[j, p]: place of the largest impact from p on within 2^j postings
        levels = [np.arange(len(doc), dtype=np.int32)]
        half = 1
        while 2 * half <= (counts.max() if len(counts) else 0):
            last = levels[-1]
            new = last.copy()
            right = last[half:]
            new[:-half] = np.where(
                self.impact[right] > self.impact[last[:-half]], right, last[:-half]
            )
            levels.append(new)
            half *= 2
        self.table = np.stack(levels)
        self.log = np.zeros(self.n_docs + 2, np.int64)
        self.log[1:] = np.frexp(np.arange(1, self.n_docs + 2))[1] - 1

    def lists(self, terms: np.ndarray) -> np.ndarray:
        """Own lists of sorted different ``terms``."""
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return at[self.terms[at] == terms]

    def bounds(self, lists: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Sum of the range maxima of every interval, and its document of maximum impact."""
        before = self.rank[lists[:, None], low].astype(np.int64)
        n = self.rank[lists[:, None], high] - before
        first = self.start[lists][:, None] + before
        level = self.log[n]
        last = len(self.doc) - 1
        p = self.table[level, np.minimum(first, last)]
        q = self.table[level, np.minimum(first + n - (1 << level), last)]
        best = np.where(self.impact[q] > self.impact[p], q, p)
        value = np.where(n > 0, self.impact[best], 0)
        top = value.argmax(0)
        return value.sum(0), self.doc[best[top, np.arange(len(low))]]

    def scores(self, lists: np.ndarray, docs: np.ndarray) -> np.ndarray:
        before = self.rank[lists[:, None], docs].astype(np.int64)
        here = self.rank[lists[:, None], docs + 1] > before
        place = np.minimum(self.start[lists][:, None] + before, len(self.doc) - 1)
        return np.where(here, self.impact[place], 0).sum(0)

    def search(self, terms: np.ndarray, ids: np.ndarray, best: np.ndarray, k: int) -> np.ndarray:
        """The ``k`` best (score, id) rows of ``best`` and this shard, ties to smaller ids."""
        lists = self.lists(terms)
        if not len(lists):
            return best
        cap = max(1, min(BATCH, BATCH_ENTRIES // len(lists)))
        low, high = np.zeros(1, np.int64), np.full(1, self.n_docs)
        bound, split = self.bounds(lists, low, high)
        step = 1
        while True:
            floor = best[0, -1] if best.shape[1] >= k else 1
            open_ = np.flatnonzero(bound >= floor)
            if not len(open_):
                return best
            if len(open_) > step:
                part = np.argpartition(-bound[open_], step - 1)
                now, later = open_[part[:step]], open_[part[step:]]
            else:
                now, later = open_, open_[:0]
            step = min(2 * step, cap)
            at = split[now]
            best = best_of(best, self.scores(lists, at), ids[at], k)
            new_low = np.concatenate([low[now], at + 1])
            new_high = np.concatenate([at, high[now]])
            some = new_low < new_high
            new_low, new_high = new_low[some], new_high[some]
            new_bound, new_split = self.bounds(lists, new_low, new_high)
            low, high = np.concatenate([low[later], new_low]), np.concatenate([high[later], new_high])
            bound, split = np.concatenate([bound[later], new_bound]), np.concatenate([split[later], new_split])


def best_of(best: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    good = scores > 0
    rows = np.concatenate([best, np.stack([scores[good], ids[good]])], axis=1)
    return rows[:, np.lexsort((rows[1], -rows[0]))[:k]]


# A NULL id is shown to a search as the largest one.
_NO_ID = np.iinfo(np.int64).max


def search_shards(
    indexed: DataFrame, weights: np.ndarray, items: list[tuple[int | None, np.ndarray]], k: int
) -> DataFrame:
    """(item_id, doc_id, score): the best ``k`` of every task for every item.

    ``indexed`` has doc_id, m, terms and counts. The k-th scores of one shard go on into
    the next shard of the task.
    """
    model = indexed.sparkSession.sparkContext.broadcast((weights, items))
    docs_of_shard = max(64, min(SHARD_DOCS, RANK_ENTRIES // max(1, len(weights))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, items = model.value
        best = [np.zeros((2, 0), np.int64) for _ in items]

        def close(parts: list[tuple]) -> None:
            ids, m, size, term, tf = (np.concatenate(c) for c in zip(*parts))
            # documents of like length side by side: their impacts are alike too
            order = np.argsort(m, kind="stable")
            ends = np.cumsum(size)
            own = size[order]
            moved = np.repeat(ends[order] - own - (np.cumsum(own) - own), own) + np.arange(own.sum())
            shard = Shard(own, term[moved], tf[moved], m[order], weights)
            for i, (_, terms) in enumerate(items):
                best[i] = shard.search(terms, ids[order], best[i], k)

        held: list[tuple] = []
        n_docs = n_postings = 0
        for batch in batches:
            ids = batch.column(0).fill_null(_NO_ID).to_numpy()
            m = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            size = batch.column(2).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            term = batch.column(2).flatten().to_numpy().astype(np.int64)
            tf = batch.column(3).flatten().to_numpy()
            ends = np.cumsum(size)
            at = 0
            while at < len(ids):
                before = ends[at - 1] if at else 0
                fit = int(np.searchsorted(ends, before + SHARD_POSTINGS - n_postings, "right"))
                stop = min(max(fit, at + (not held)), at + docs_of_shard - n_docs, len(ids))
                if stop > at:
                    end = ends[stop - 1]
                    held.append((ids[at:stop], m[at:stop], size[at:stop], term[before:end], tf[before:end]))
                    n_docs += stop - at
                    n_postings += int(end - before)
                    at = stop
                if at < len(ids):
                    close(held)
                    held, n_docs, n_postings = [], 0, 0
        if held:
            close(held)
        for (item, _), rows in zip(items, best):
            n = rows.shape[1]
            if n:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([item] * n, pa.int64()),
                        pa.array(rows[1], pa.int64(), mask=rows[1] == _NO_ID),
                        pa.array(rows[0], pa.int64()),
                    ],
                    names=["item_id", "doc_id", "score"],
                )

    source = indexed.select("doc_id", "m", "terms", "counts")
    return source.mapInArrow(run, "item_id long, doc_id long, score long")


def _ranked_block(
    docs: DataFrame, id_col: str, text_col: str, pairs: list[tuple[int | None, bytes]], k: int
) -> DataFrame:
    """Best documents of each task for the items of one block of (item, term) pairs."""
    vocabulary = sorted({bytes(term) for _, term in pairs})
    place = {term: i for i, term in enumerate(vocabulary)}
    grouped: dict[int | None, list[int]] = {}
    for item, term in pairs:
        grouped.setdefault(item, []).append(place[bytes(term)])
    items = [(item, np.array(sorted(own), np.int64)) for item, own in grouped.items()]
    found = written(wanted_terms(docs, id_col, text_col, vocabulary), "ranked-postings")
    total = found.agg(
        F.coalesce(F.sum((F.col("n") > 0).cast("long")), F.lit(0)).alias("docs"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("terms"),
    ).first()
    # One row for each term of the block.
    counted = found.select(F.explode("terms").alias("term")).groupBy("term").count().toPandas()
    weights = np.zeros(len(vocabulary), np.int64)
    for term, df in zip(counted["term"], counted["count"]):
        weights[term] = term_weight(total["docs"], int(df))
    whole = F.col("n").cast("decimal(19,0)") * F.lit(LENGTH_PART) * F.lit(total["docs"]).cast("decimal(13,0)")
    indexed = found.where(F.size("terms") > 0).select(
        "doc_id",
        whole.alias("whole"),
        "terms",
        "counts",
    )
    indexed = indexed.withColumn(
        "m", F.expr(f"{LENGTH_BASE} + cast(whole div cast({max(1, total['terms'])} as decimal(19,0)) as long)")
    )
    return written(search_shards(indexed, weights, items, k), "ranked-found")


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    k: int = TOP,
) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best documents of every item.

    Ids are integers. NULL, empty and termless texts score nothing and are found for
    nothing; they do not count as documents either. Whole texts of any length count.
    Repeated documents are ranked row by row; a NULL id counts as the largest in ties.
    Rows of one item id, also of the NULL one, are one item with the terms of all of them,
    so repeated items change nothing. Empty tables give an empty result. Other columns are
    ignored, whatever their names.
    """
    pairs = written(item_terms(items, item_col, item_text_col), "ranked-items")
    size = pairs.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES)
    block_of = F.pmod(F.xxhash64("item"), F.lit(max(1, blocks)))
    found = docs.sparkSession.createDataFrame([], "item_id long, doc_id long, score long")
    for block in range(blocks):
        own = [(r["item"], r["term"]) for r in pairs.where(block_of == block).collect()]
        if own:
            found = found.unionByName(_ranked_block(docs, id_col, text_col, own, k))
    order = Window.partitionBy("item_id").orderBy(
        F.col("score").desc(), F.col("doc_id").asc_nulls_last()
    )
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")

"""Near-duplicates by SimHash fingerprints and a Gray-order hierarchical index.

Different fingerprints are dealt out by masked parts: two fingerprints that differ in
at most three bits agree in all but three of ``k`` blocks. What shares such a part is
sorted by Gray rank, so that neighbours differ little, and consecutive fingerprints
are factored into nodes that hold the bits all their members share. A search walks
pairs of nodes from the top and drops a pair as soon as the shared bits alone differ
too often.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curaspan.llm.common import map_texts, with_plain_names, written
from curaspan.llm.components import connected_components
from curaspan.session import broadcast_if_small

SHINGLE_WORDS = 3
MAX_BITS = 3
HASH_SEED = 42
# Children of an index node.
FANOUT = 8
# A part with more fingerprints is cut into chunks that are searched two by two.
CHUNK = 1024
# With more fingerprints than this for each value of a part, more blocks are used.
PER_PART = 256
# Large parts up to this count (some 32 bytes each) go to every executor.
BROADCAST_PARTS = 200_000


def fingerprints(texts: list[bytes], width: int = SHINGLE_WORDS) -> np.ndarray:
    """64-bit fingerprint of every text; zero for a text without words."""
    digest = xxhash.xxh64_intdigest
    out = np.zeros(len(texts), np.uint64)
    for i, raw in enumerate(texts):
        words = raw.lower().split()
        if not words:
            continue
        joined = b" ".join(words)
        n = max(1, len(words) - width + 1)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(sizes) - 1
        starts = (ends - sizes + 1)[:n].tolist()
        ends = ends[-n:].tolist()
        hashes = [digest(joined[a:b], HASH_SEED) for a, b in zip(starts, ends)]
        bits = np.zeros(64, np.int64)
        for part in range(0, n, 100_000):
            h = np.array(hashes[part : part + 100_000], "<u8").view(np.uint8).reshape(-1, 8)
            bits += np.unpackbits(h, axis=1, bitorder="little").sum(0, dtype=np.int64)
        out[i] = np.packbits(2 * bits > n, bitorder="little").view("<u8")[0]
    return out


def document_fingerprints(
    docs: DataFrame, id_col: str, text_col: str, width: int = SHINGLE_WORDS
) -> DataFrame:
    """``id_col`` and ``fp``, the fingerprint as a signed long, of every row."""
    return map_texts(
        docs, [id_col], text_col, "fp long", lambda t: [fingerprints(t, width).view(np.int64)]
    )


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in Gray order."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _pairs_of_children(a, b, start, end):
    """All pairs of children of node pairs; below a node with itself each pair once."""
    na, nb = end[a] - start[a], end[b] - start[b]
    which = np.repeat(np.arange(len(a)), na * nb)
    at = np.arange(len(which)) - np.repeat(np.cumsum(na * nb) - na * nb, na * nb)
    ca = start[a][which] + at // nb[which]
    cb = start[b][which] + at % nb[which]
    once = (a[which] != b[which]) | (ca <= cb)
    return ca[once], cb[once]


def close_pairs(codes: np.ndarray, group: np.ndarray, limit: int = MAX_BITS):
    """Index pairs of codes of the same group with at most ``limit`` differing bits.

    ``group`` is sorted. Returns two arrays of indexes; a code is never paired with itself.
    """
    order = np.lexsort((gray_rank(codes), group))
    codes, group = codes[order], group[order]
    # Levels from the codes up to one node per group: shared ones, shared zeros, children.
    levels = [(codes, codes, None, None)]
    owner = group
    while len(owner) and (owner[1:] == owner[:-1]).any():
        both, either = levels[-1][:2]
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        size = np.diff(np.r_[first, len(owner)])
        place = np.arange(len(owner)) - np.repeat(first, size)
        start = np.flatnonzero(place % FANOUT == 0)
        end = np.r_[start[1:], len(owner)]
        levels.append(
            (np.bitwise_and.reduceat(both, start), np.bitwise_or.reduceat(either, start), start, end)
        )
        owner = owner[start]
    a = b = np.arange(len(owner))
    for depth in range(len(levels) - 1, 0, -1):
        a, b = _pairs_of_children(a, b, *levels[depth][2:])
        both, either = levels[depth - 1][:2]
        shared = ~(both[a] ^ either[a]) & ~(both[b] ^ either[b])
        near = np.bitwise_count((both[a] ^ both[b]) & shared) <= limit
        a, b = a[near], b[near]
    other = a != b
    return order[a[other]], order[b[other]]


def _stars(codes: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each linked code with the first code of its component."""
    label = np.arange(len(codes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    linked = np.flatnonzero(label != np.arange(len(codes)))
    return codes[linked], codes[label[linked]]


def part_masks(n_codes: int) -> list[int]:
    """Masks of the parts by which fingerprints are dealt out, as signed longs.

    With ``k`` blocks, each mask keeps ``k - MAX_BITS`` of them.
    """
    k = MAX_BITS + 1
    while n_codes > PER_PART << (64 * (k - MAX_BITS) // k) and k < 2 * MAX_BITS:
        k += 1
    edges = [64 * i // k for i in range(k + 1)]
    blocks = [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:])]
    masks = [sum(kept) for kept in itertools.combinations(blocks, k - MAX_BITS)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def fingerprint_links(distinct: DataFrame) -> DataFrame:
    """Links (u, v) that connect all fingerprints of ``distinct`` (fp) within ``MAX_BITS``.

    Inside a part, a component is linked as a star, not as all of its pairs.
    """
    masks = part_masks(distinct.count())
    parts = F.array(
        *[
            F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("part"))
            for i, m in enumerate(masks)
        ]
    )
    dealt = distinct.select("fp", F.inline(parts))
    sizes = dealt.groupBy("t", "part").count()
    large = written(
        sizes.where(F.col("count") > CHUNK).select(
            "t", "part", F.ceil(F.col("count") / CHUNK).cast("int").alias("chunks")
        ),
        "large-parts",
    )
    dealt = dealt.join(broadcast_if_small(large, BROADCAST_PARTS), ["t", "part"], "left")
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    others = F.when(F.col("chunks").isNull(), F.array(F.lit(0))).otherwise(
        F.sequence(F.lit(0), F.col("chunks") - 1)
    )
    tasks = (
        dealt.withColumn("own", F.coalesce(own, F.lit(0)))
        .withColumn("other", F.explode(others))
        .select("t", "part", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "fp")
    )
    keys = ["t", "part", "p", "q"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The rows of a task arrive sorted; the last group may go on in the next batch.
        held = np.zeros((5, 0), np.int64)
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                new = np.array([c.to_numpy(zero_copy_only=False) for c in batch.columns], np.int64)
                rows = np.hstack([held, new])
            else:
                rows = held
            if not rows.shape[1]:
                continue
            change = np.flatnonzero((rows[:4, 1:] != rows[:4, :-1]).any(0)) + 1
            done = rows.shape[1] if batch is None else (change[-1] if len(change) else 0)
            held = rows[:, done:]
            if not done:
                continue
            group = np.zeros(done, np.int64)
            group[change[change < done]] = 1
            codes = rows[4, :done].view(np.uint64)
            u, v = _stars(codes, *close_pairs(codes, np.cumsum(group)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"]
            )

    return (
        tasks.repartition(*keys)
        .sortWithinPartitions(*keys)
        .selectExpr("cast(t as long) t", "part", "cast(p as long) p", "cast(q as long) q", "fp")
        .mapInArrow(search, "u long, v long")
    )


def fingerprint_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS
) -> DataFrame:
    """``id_col``, fp and component_id (the smallest id of the component) of every row.

    Texts are lower-cased (A to Z) and cut at ASCII white space. NULL and empty texts
    have the fingerprint zero and are linked like any other. Repeated rows and repeated
    ids are kept row by row. A NULL id is never the smallest one; a component of NULL
    ids only has a NULL component_id. An empty table gives an empty result.
    """
    rows = written(document_fingerprints(docs, id_col, text_col, width), "fingerprints")
    distinct = written(rows.groupBy("fp").agg(F.min(id_col).alias("__low")), "fingerprint-ids")
    links = written(fingerprint_links(distinct.select("fp")), "fingerprint-links")
    roots = written(connected_components(links), "fingerprint-roots")
    named = written(
        distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
            "fp", "__low", F.coalesce("root", "fp").alias("root")
        ),
        "fingerprint-named",
    )
    lowest = written(
        named.groupBy("root").agg(F.min("__low").alias("component_id")), "component-ids"
    )
    classes = written(named.join(lowest, "root").select("fp", "component_id"), "classes")
    return rows.join(classes, "fp").select(id_col, "fp", "component_id")


def simhash_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, fingerprint (16 hex digits) and component_id of every row.

    NULL, empty, very long and repeated texts, NULL ids and empty tables are treated as in
    ``fingerprint_components``; other columns are ignored, whatever their names.
    """
    found = fingerprint_components(docs, id_col, text_col)
    return found.select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", null_ids: bool = False
) -> DataFrame:
    """One row of each group of near copies stays, all its columns kept.

    Groups are the components of fingerprints of three-word shingles that differ in at
    most ``MAX_BITS`` bits, as in ``fingerprint_components``; NULL, empty and wordless
    texts are one group, and whole texts of any length count. The row with the smallest
    id stays, of equal ids that with the smallest hash of its text and then of all its
    columns; of wholly equal rows one stays. Rows without an id stay by default; with
    ``null_ids`` they are rows like all others, after those with an id. An empty table
    gives an empty result. Columns may have any name.
    """

    def first(df: DataFrame, own_id: str, text: str) -> DataFrame:
        if null_ids:
            return _first_of_each(df, own_id, text)
        kept = _first_of_each(df.where(F.col(own_id).isNotNull()), own_id, text)
        return kept.unionByName(df.where(F.col(own_id).isNull()))

    return with_plain_names(docs, id_col, text_col, first)


def _first_of_each(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    columns = docs.columns
    # A map has no hash; rows that differ in nothing else are taken as repeated.
    hashed = [c for c, kind in docs.dtypes if "map<" not in kind]
    key = [id_col, "__text_hash", "__row_hash"]
    named = docs.withColumn("__text_hash", F.xxhash64(F.coalesce(text_col, F.lit("")))).withColumn(
        "__row_hash", F.xxhash64(*hashed)
    )
    prints = written(
        map_texts(named, key, text_col, "fp long", lambda t: [fingerprints(t).view(np.int64)]),
        "row-prints",
    )
    place = F.struct(F.col(id_col).isNull().alias("no_id"), *key)
    lowest = written(prints.groupBy("fp").agg(F.min(place).alias("low")), "print-rows")
    links = written(fingerprint_links(lowest.select("fp")), "print-links")
    roots = written(connected_components(links), "print-roots")
    first = written(
        lowest.join(roots, lowest["fp"] == roots["node"], "left")
        .groupBy(F.coalesce("root", "fp").alias("root"))
        .agg(F.min("low").alias("low"))
        .select(*[F.col(f"low.{c}").alias(f"__first_{i}") for i, c in enumerate(key)]),
        "first-rows",
    )
    same = F.lit(True)
    for i, c in enumerate(key):
        same &= F.col(c).eqNullSafe(F.col(f"__first_{i}"))
    return named.join(first, same, "left_semi").dropDuplicates(key).select(*columns)

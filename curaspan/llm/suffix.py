"""Exact removal of repeated 100-byte strings, by suffix grouping.

A string is removed where it also starts earlier. All places of an equal string meet
through content: of the 32-byte grams inside a 100-byte window the one with the
smallest hash, its anchor, depends on the window alone. What is settled by whole
contexts around an anchor (unique, or the same everywhere) never goes further. The
rest is sorted as suffixes, in shards of contexts that share their core; the core is
one symbol, so a context of over 100 bytes has some thirty symbols.

The suffix order comes from linear grouping: groups of suffixes with the same Lyndon
prefix are processed from the highest down, each moves its previous smaller
suffixes up behind their own group, and a last pass emits every group in order
along the same pointers. Nothing is renamed and no recursion is needed.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curaspan.llm.common import map_texts, raw_texts, text_slices, with_plain_names, written

WINDOW = 100
GRAM = 32
# Grams inside a window.
SPAN = WINDOW - GRAM + 1
# Neighbouring windows that are looked at together; they share a core.
STEP = 16
CORE = WINDOW - STEP + 1
# A core with more different contexts is not sorted in one task, see _by_windows.
MAX_CONTEXTS = 512
# Symbols that a task sorts at a time.
SORTED_SYMBOLS = 400_000
# Powers for the hashes of grams that a worker keeps.
KEPT_POWERS = 1 << 18

_MULTIPLIER = 0x9E3779B97F4A7C15
_U64 = np.uint64


# --- suffix order ---------------------------------------------------------------


def suffix_order(symbols: list[int]) -> list[int]:
    """Starts of the suffixes of ``symbols`` in lexicographic order, by linear grouping."""
    n = len(symbols)
    if not n:
        return []
    order = np.argsort(np.array(symbols), kind="stable").tolist()
    place = [0] * n
    first = [0] * n  # of a suffix: where its group starts in ``order``
    last = [0] * n  # by the start of a group: where it ends
    start = 0
    for at, suffix in enumerate(order):
        place[suffix] = at
        if at and symbols[suffix] != symbols[order[at - 1]]:
            start = at
        first[suffix] = start
        last[start] = at
    smaller = [-1] * n  # the nearest earlier suffix of a lower group

    end = n - 1
    while end >= 0:
        start = first[order[end]]
        group = order[start : end + 1]
        if len(group) > 1:
            group.sort()
        for suffix in group:
            p = suffix - 1
            while p >= 0 and first[p] >= start:
                p = smaller[p]
            smaller[suffix] = p
        # A suffix followed by this group several times has the longer Lyndon prefix.
        followed = Counter([smaller[suffix] for suffix in group])
        followed.pop(-1, None)
        by_times: dict[int, list[int]] = {}
        for p, times in followed.items():
            by_times.setdefault(times, []).append(p)
        for times in sorted(by_times, reverse=True):
            touched = set()
            for p in by_times[times]:
                own = first[p]
                to = last[own]
                other, at = order[to], place[p]
                order[at], order[to] = other, p
                place[other], place[p] = at, to
                last[own] = to - 1
                touched.add(own)
            # What moved behind the rest of a group is a group of its own.
            new_end = {}
            for p in by_times[times]:
                new_end[first[p]] = max(new_end.get(first[p], -1), place[p])
            for p in by_times[times]:
                own = first[p]
                first[p] = last[own] + 1 if own in touched else own
            for own in touched:
                last_of_new = new_end[own]
                new_start = last[own] + 1
                if new_start == own:
                    last[own] = last_of_new
                else:
                    last[new_start] = last_of_new
        end = start - 1

    # Emit: a suffix follows, in its group, in the order of its next smaller suffix.
    front = first[:]
    free = list(range(n))  # by the start of a group: its next free place
    sorted_out = [-1] * n
    placed = bytearray(n)

    def emit(following: int) -> None:
        s = following - 1
        while s >= 0 and not placed[s]:
            group = front[s]
            at = free[group]
            sorted_out[at] = s
            free[group] = at + 1
            placed[s] = 1
            s = smaller[s]

    emit(n)
    for at in range(n):
        emit(sorted_out[at])
    return sorted_out


# --- anchors --------------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U64(31))) * _U64(0x7FB5D329728EA185)
    return (x ^ (x >> _U64(27))) * _U64(0x81DADEF4BC2DD44D)


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, from the first."""
    inverse = np.full(n, _U64(pow(_MULTIPLIER, -1, 1 << 64)))
    return np.cumprod(np.full(n, _U64(_MULTIPLIER))), np.cumprod(inverse)


def anchors(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, first window, last window) of every anchor of a text.

    The anchor of a window is its leftmost gram with the smallest hash. Its windows
    are neighbours. Hashes only propose: equal grams always have equal ones.
    """
    n = len(raw)
    if n < WINDOW:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    # Kept for texts of usual length.
    power, inverse = _powers(KEPT_POWERS) if n <= KEPT_POWERS else _powers.__wrapped__(n)
    sums = np.zeros(n + 1, np.uint64)
    letters = np.frombuffer(raw, np.uint8).astype(np.uint64)
    letters += _U64(1)
    letters *= power[:n]
    np.cumsum(letters, out=sums[1:])
    grams = sums[GRAM:] - sums[:-GRAM]
    grams *= inverse[: n - GRAM + 1]
    grams = _mixed(grams)
    # Half a hash with the place below it: the smallest one is the leftmost of the smallest.
    low = (grams & _U64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while width < SPAN:
        step = min(width, SPAN - width)
        low = np.minimum(low[:-step], low[step:])
        width += step
    at = low.astype(np.uint32)
    change = np.flatnonzero(at[1:] != at[:-1]) + 1
    start = np.r_[0, change]
    end = np.r_[change - 1, len(at) - 1]
    place = at[start].astype(np.int64)
    return grams[place].view(np.int64), place, start, end


def _text_anchors(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``__id``, ``__tie``, ``__digest``, ``__bytes`` and the anchor hashes of every row."""

    def run(texts: list[bytes]) -> list[list]:
        return [
            [xxhash.xxh3_128_digest(t) for t in texts],
            [len(t) for t in texts],
            [anchors(t)[0] for t in texts],
        ]

    source = _keyed(docs, id_col, text_col)
    schema = "__digest binary, __bytes long, __anchors array<bigint>"
    return map_texts(source, ["__id", "__tie"], "__text", schema, run)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id, text, and a hash of the text that tells documents with the same id apart."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("__id"), F.xxhash64(text).alias("__tie"), text.alias("__text")
    )


def _on_document(df: DataFrame, keyed: DataFrame, how: str = "inner") -> DataFrame:
    """``df`` joined to a table with the same ``__id`` (NULL included) and ``__tie``."""
    other = keyed.withColumnsRenamed({"__id": "__id2", "__tie": "__tie2"})
    same = df["__id"].eqNullSafe(other["__id2"]) & (df["__tie"] == other["__tie2"])
    return df.join(other, same, how).drop("__id2", "__tie2")


# A place is the number of a document and a position in it, as one number: sums and
# smallest values of numbers are kept in place by Spark's hash aggregation.
_POSITIONS = 1 << 40


def _place(position: str) -> Column:
    return F.col("__doc").cast("decimal(20,0)") * F.lit(_POSITIONS) + F.col(position)


def _doc_of(place: str) -> Column:
    return F.expr(f"{place} div {_POSITIONS}L").cast("long").alias("__doc")


def _position_in(place: str) -> Column:
    return F.expr(f"{place} % {_POSITIONS}L").cast("long")


def _numbered(keys: DataFrame) -> DataFrame:
    """Documents with a number ``__doc`` that follows their order: by id, NULL first, then tie."""
    order = [F.col("__id").asc_nulls_first(), F.col("__tie")]
    ranged = keys.repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.withColumn("__doc", F.monotonically_increasing_id())


# --- contexts -------------------------------------------------------------------

_CONTEXT = "__doc long, __hash long, __own long, __start long, __windows long, __anchor long"


def _contexts(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The windows around chosen anchors, one row per anchor.

    ``chosen`` has the documents with ``__doc`` and ``__chosen``, numbers of a text's anchors.
    Result: ``__doc``, ``__hash`` of the anchor, ``__own`` hash of the bytes that the windows
    cover, ``__start`` of the first window, ``__windows``, ``__anchor``, the place of the anchor.
    """
    source = _on_document(docs, chosen).select("__text", "__doc", "__chosen")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, 0):
            docs_of, owners, columns = part.column(1).to_numpy(), [], []
            for i, raw in enumerate(raw_texts(part.column(0))):
                numbers = part.column(2)[i].values.to_numpy(zero_copy_only=False)
                found = [x[numbers] for x in anchors(raw)]
                spans = zip(found[2].tolist(), (found[3] + WINDOW).tolist())
                own = [xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in spans]
                own = np.array(own, np.uint64).view(np.int64)
                columns.append((found[0], own, found[2], found[3] - found[2] + 1, found[1]))
                owners.append(np.full(len(own), docs_of[i]))
            arrays = [np.concatenate(owners), *map(np.concatenate, zip(*columns))]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=_names(_CONTEXT))

    return source.mapInArrow(run, _CONTEXT)


def _names(schema: str) -> list[str]:
    return [field.strip().split(" ")[0] for field in schema.split(",")]


_PARTS = "__doc long, __core binary, __left binary, __right binary, __at long"


def _parts(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """Contexts cut into cores with the bytes on either side of them.

    ``chosen`` has the documents with ``__doc`` and ``__contexts`` (start, windows, anchor).
    All windows that start 16 * i to 16 * i + 15 bytes in front of an anchor share a
    core. ``__left`` and ``__right`` are what these windows add to it, ``__at`` is the
    position in the text where ``__left`` starts.
    """
    source = _on_document(docs, chosen).select("__text", "__doc", "__contexts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, 0):
            rows = []
            docs_of = part.column(1).to_pylist()
            contexts = part.column(2).to_pylist()
            for doc, own, raw in zip(docs_of, contexts, raw_texts(part.column(0))):
                for context in own:
                    start, windows, anchor = context.values()
                    end = start + windows - 1 + WINDOW
                    nearest, farthest = anchor - start - windows + 1, anchor - start
                    for step in range(max(nearest, 0) // STEP, farthest // STEP + 1):
                        core = anchor - step * STEP
                        left = max(start, core - STEP + 1)
                        digest = xxhash.xxh3_128_digest(raw[core : core + CORE])
                        right = raw[core + CORE : min(core + WINDOW, end)]
                        rows.append((doc, digest, raw[left:core], right, left))
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
            columns = zip(*rows) if rows else [[]] * 5
            arrays = [pa.array(v, k) for v, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=_names(_PARTS))

    return source.mapInArrow(run, _PARTS)


_FOUND = "__doc long, __start long, __windows long"


def repeated_windows(lefts: list[bytes], rights: list[bytes], cores: list[int]):
    """Equal windows among parts, as arrays (part, offset, class) of those that repeat.

    A part is its left bytes, its core as one symbol, and its right bytes. Windows are
    its strings of ``STEP`` symbols; ``class`` numbers the different ones.
    """
    symbols: list[int] = []
    starts = []
    for left, right, core in zip(lefts, rights, cores):
        starts.append(len(symbols))
        symbols.extend([b + 1 for b in left])
        symbols.append(257 + core)
        symbols.extend([b + 1 for b in right])
        symbols.append(0)
    sizes = np.diff(np.r_[starts, len(symbols)])
    part = np.repeat(np.arange(len(starts)), sizes)
    offset = np.arange(len(symbols)) - np.repeat(starts, sizes)
    full = offset + STEP <= (sizes - 1)[part]
    order = np.array(suffix_order(symbols))
    order = order[full[order]]
    text = np.array(symbols)
    window = text[order[:, None] + np.arange(STEP)] if len(order) else np.zeros((0, STEP))
    new = np.r_[True, (window[1:] != window[:-1]).any(1)] if len(order) else np.zeros(0, bool)
    classes = np.cumsum(new) - 1
    again = np.bincount(classes, minlength=1)[classes] > 1
    return part[order][again], offset[order][again], classes[again]


def _sorted_parts(parts: DataFrame) -> DataFrame:
    """Repeated windows of parts, found core by core: ``__doc``, ``__start``, ``__windows``."""

    def settle(table: pa.Table) -> pa.RecordBatch:
        digests = table.column(0).to_pylist()
        cores = np.cumsum([0, *(a != b for a, b in zip(digests, digests[1:]))]).tolist()
        part, offset, classes = repeated_windows(
            table.column(3).to_pylist(), table.column(4).to_pylist(), cores
        )
        # Rows are in the order of places, so the first part of a class stays.
        by = np.lexsort((offset, part, classes))
        part, offset, classes = part[by], offset[by], classes[by]
        later = np.r_[False, classes[1:] == classes[:-1]] if len(by) else np.zeros(0, bool)
        part, offset = part[later], offset[later]
        docs, starts = (table.column(c).to_numpy()[part] for c in (1, 2))
        arrays = [docs, starts + offset, np.ones(len(part), np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=_names(_FOUND))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                held.append(batch)
                if sum(b.num_rows for b in held) * 2 * STEP < SORTED_SYMBOLS:
                    continue
            if not held:
                continue
            table = pa.Table.from_batches(held)
            # The last core may go on in the next batch; cores are bounded.
            digests = table.column(0).to_pylist()
            done = len(digests)
            if batch is not None:
                while done and digests[done - 1] == digests[-1]:
                    done -= 1
            edges = [0]
            for i in range(1, done):
                if digests[i] != digests[i - 1] and (i - edges[-1]) * 2 * STEP > SORTED_SYMBOLS:
                    edges.append(i)
            for a, b in zip(edges, [*edges[1:], done]):
                if b > a:
                    yield settle(table.slice(a, b - a))
            held = table.slice(done).to_batches()

    # With a number of its own: few bytes but much work, so tasks are not to be merged.
    tasks = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        parts.repartition(tasks, "__core")
        .sortWithinPartitions("__core", "__doc", "__at")
        .select("__core", "__doc", "__at", "__left", "__right")
        .mapInArrow(run, _FOUND)
    )


def _by_windows(parts: DataFrame) -> DataFrame:
    """The same for cores with very many contexts: windows are grouped one by one.

    Groups are only ever reduced to their first place, so none has to fit into a task.
    """
    offsets = F.length("__left") + F.length("__right") - (STEP - 1)
    cut = parts.where(offsets >= 0).withColumn("__o", F.explode(F.sequence(F.lit(0), offsets)))
    left = F.expr("substring(__left, __o + 1)")
    right = F.expr(f"substring(__right, 1, {STEP - 1} - (octet_length(__left) - __o))")
    windows = cut.select(
        "__core",
        left.alias("__l"),
        right.alias("__r"),
        "__doc",
        (F.col("__at") + F.col("__o")).alias("__start"),
    )
    windows = written(windows, "windows")
    keys = ["__core", "__l", "__r"]
    firsts = windows.groupBy(*keys).agg(
        F.min(_place("__start")).alias("__first"), F.count(F.lit(1)).alias("__n")
    )
    firsts = written(firsts.where("__n > 1").drop("__n"), "window-firsts")
    return (
        windows.join(firsts, keys)
        .where(_place("__start") > F.col("__first"))
        .select("__doc", "__start", F.lit(1).cast("long").alias("__windows"))
    )


# --- the operator ---------------------------------------------------------------


def repeated_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(__id, __tie, __ranges): per document the windows that also start earlier.

    A range is a first window and a number of windows, each of ``WINDOW`` bytes. Documents
    without such windows have no row.
    """
    rows = _keyed(docs, id_col, text_col)
    texts = written(_text_anchors(docs, id_col, text_col), "anchors")
    # Repeated rows are one document.
    keys = texts.select("__id", "__tie", "__digest", "__bytes").where(F.col("__bytes") >= WINDOW)
    numbered = written(_numbered(keys.dropDuplicates(["__tie", "__id"])), "documents")
    # Of equal texts the first stays, all windows of the others repeat.
    firsts = written(
        numbered.groupBy("__digest").agg(F.min("__doc").alias("__first")), "first-texts"
    )
    marked = numbered.join(firsts, "__digest").withColumn(
        "__is_first", F.col("__doc") == F.col("__first")
    )
    marked = written(marked.select("__id", "__tie", "__doc", "__bytes", "__is_first"), "marked")
    copies = marked.where("not __is_first").select(
        "__doc",
        F.lit(0).cast("long").alias("__start"),
        (F.col("__bytes") - (WINDOW - 1)).alias("__windows"),
    )
    own = marked.where("__is_first").select("__id", "__tie", "__doc")
    own_anchors = _on_document(texts.select("__id", "__tie", "__anchors"), own)
    own_anchors = written(own_anchors.select("__doc", "__anchors"), "own-anchors")
    shared = (
        own_anchors.select(F.explode("__anchors").alias("__hash"))
        .groupBy("__hash")
        .agg(F.count(F.lit(1)).alias("__n"))
        .where("__n > 1")
        .select("__hash")
    )
    shared = written(shared, "shared-anchors")
    places = own_anchors.select("__doc", F.posexplode("__anchors").alias("__number", "__hash"))
    chosen = (
        places.join(shared, "__hash", "left_semi")
        .groupBy("__doc")
        .agg(F.collect_set("__number").alias("__chosen"))
        .join(own, "__doc")
    )
    contexts = written(_contexts(rows, written(chosen, "chosen-anchors")), "contexts")

    # Equal contexts: all windows of all but the first repeat.
    groups = contexts.groupBy("__hash", "__own").agg(F.min(_place("__start")).alias("__first"))
    groups = written(groups, "context-groups")
    later = (
        contexts.join(groups, ["__hash", "__own"])
        .where(_place("__start") > F.col("__first"))
        .select("__doc", "__start", "__windows")
    )
    later = written(later, "equal-contexts")
    # Contexts that differ around the same anchor: cut them and sort what is left.
    unlike = groups.groupBy("__hash").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    unlike = written(unlike.select("__hash"), "unlike-anchors")
    leaders = groups.join(unlike, "__hash", "left_semi").select(
        _doc_of("__first"), _position_in("__first").alias("__start"), "__hash"
    )
    leaders = written(leaders, "leaders")
    cut = (
        contexts.join(leaders, ["__doc", "__start", "__hash"], "left_semi")
        .groupBy("__doc")
        .agg(F.collect_set(F.struct("__start", "__windows", "__anchor")).alias("__contexts"))
        .join(own, "__doc")
    )
    parts = written(_parts(rows, written(cut, "chosen-contexts")), "parts")
    same = ["__core", "__left", "__right"]
    part_groups = parts.groupBy(*same).agg(F.min(_place("__at")).alias("__first"))
    part_groups = written(part_groups, "part-groups")
    windows = F.octet_length("__left") + F.octet_length("__right") - (STEP - 2)
    later_parts = (
        parts.join(part_groups, same)
        .where(_place("__at") > F.col("__first"))
        .select("__doc", F.col("__at").alias("__start"), windows.cast("long").alias("__windows"))
        .where("__windows > 0")
    )
    later_parts = written(later_parts, "equal-parts")
    unlike_parts = part_groups.groupBy("__core").agg(F.count(F.lit(1)).alias("__n"))
    unlike_parts = written(unlike_parts.where("__n > 1"), "unlike-cores")
    mixed = part_groups.join(unlike_parts, "__core").select(
        *same, "__n", _doc_of("__first"), _position_in("__first").alias("__at")
    )
    mixed = written(mixed, "mixed-parts")
    few = written(_sorted_parts(mixed.where(F.col("__n") <= MAX_CONTEXTS)), "sorted-parts")
    many = _by_windows(mixed.where(F.col("__n") > MAX_CONTEXTS))
    found = copies.union(later).union(later_parts).union(few).union(many)
    ranges = found.groupBy("__doc").agg(
        F.collect_list(F.struct("__start", "__windows")).alias("__ranges")
    )
    return ranges.join(marked, "__doc").select("__id", "__tie", "__ranges")


def removed_spans(n_bytes: int, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by the windows of ``ranges``."""
    spans: list[tuple[int, int]] = []
    for start, windows in sorted(ranges):
        end = min(start + windows - 1 + WINDOW, n_bytes)
        if spans and start <= spans[-1][1]:
            if end > spans[-1][1]:
                spans[-1] = (spans[-1][0], end)
        else:
            spans.append((start, end))
    return spans


def _remaining(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for span in spans for x in span), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))


def _span_lists(part: pa.RecordBatch, text: int, ranges: int):
    column = part.column(ranges).to_pylist()
    for raw, own in zip(raw_texts(part.column(text)), column):
        found = [(r["__start"], r["__windows"]) for r in own or []]
        yield raw, removed_spans(len(raw), found)


def _with_ranges(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """All columns of ``docs`` with ``__text`` and ``__ranges``."""
    ranges = written(repeated_ranges(docs, id_col, text_col), "ranges")
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.withColumn("__text", text).withColumn("__tie", F.xxhash64("__text"))
    return _on_document(source.withColumn("__id", F.col(id_col)), ranges, "left")


def repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What is removed of every document, and a hash of what is left.

    Result: ``id_col``, n_bytes, n_removed, n_spans, kept_sha256. Documents are ordered by
    id, NULL first, and by a hash of the text where ids repeat. Rows with the same id
    and text are one document: they all get its result. NULL and empty texts, and those
    under 100 bytes, keep everything. An empty table gives an empty result.
    """
    source = _with_ranges(docs.select(id_col, text_col), id_col, text_col)
    source = source.select(id_col, "__text", "__ranges")
    schema = source.select(id_col).schema
    for name in ("n_bytes", "n_removed", "n_spans"):
        schema = schema.add(name, "long")
    schema = schema.add("kept_sha256", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, 1):
            rows = []
            for raw, spans in _span_lists(part, 1, 2):
                kept = hashlib.sha256(_remaining(raw, spans)).hexdigest()
                rows.append((len(raw), sum(b - a for a, b in spans), len(spans), kept))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            arrays = [pa.array(v, k) for v, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays([part.column(0), *arrays], names=schema.names)

    return source.mapInArrow(run, schema)


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the repeated bytes; all rows and columns stay.

    A character of which a byte is removed is removed whole. A NULL text stays NULL.
    """
    return with_plain_names(docs, id_col, text_col, _cut)


def _cut(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    columns = docs.columns
    source = _with_ranges(docs, id_col, text_col)
    at = len(columns)
    schema = docs.schema.add("__kept", "string")
    source = source.select(*columns, "__text", "__ranges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, at):
            kept = [
                _remaining(raw, spans).decode(errors="ignore") if spans else raw.decode()
                for raw, spans in _span_lists(part, at, at + 1)
            ]
            arrays = [part.column(i) for i in range(at)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(kept, pa.string())], names=schema.names)

    cut = source.mapInArrow(run, schema)
    text = F.when(F.col(text_col).isNull(), F.lit(None)).otherwise(F.col("__kept"))
    return cut.withColumn(text_col, text).select(*columns)

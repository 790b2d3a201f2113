"""Class-based bigram language model with exchange clustering.

Every word has a class. Exchange on the driver gives the most frequent words and groups
of words that share an ending their first classes. Then every word that occurs more than
once moves by itself, in batches of words: what stands before and after it is counted by
class in Spark, and it goes to the class that gains most class-bigram likelihood. Words
seen once or never keep the class of their ending. A text's score adds, per token, the
log probability of its class after the class before, and of the word in its class.

Only counts whose number has a fixed bound reach the driver or every executor: the
frequent words, the bigrams of units and the class tables. Bigrams with another word, and
counts and classes of all other words, stay in tables and are joined. Texts are cut into
words once more after the exchange and kept as keys; bigrams of two frequent words are
counted by class inside the tasks that read them.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curaspan.llm.common import key_remainder, raw_texts, text_slices, written

LEARN_MODULUS = 7
HELD_OUT_REMAINDER = 2
# Units of the first exchange: frequent words, and groups of word endings for all others.
FREQUENT_UNITS = 400
ENDING_GROUPS = 128
ENDING_BYTES = 3
CLASSES = 40
EXCHANGE_ROUNDS = 12
# Words seen at least this often move by themselves, in so many batches, so many times.
MOVED_COUNT = 2
BATCHES = 2
WORD_ROUNDS = 1
# Tokens whose bigrams a task counts before it hands them on, and words it moves at once.
HELD_TOKENS = 2_000_000
MOVED_AT_ONCE = 2048
# Entries of contexts that a task adds up, or looks at for words to move, at a time.
HELD_ENTRIES = 1_000_000
# Words whose counts go to every executor (some 20 bytes each).
HEAD_WORDS = 65_536
# Weight of the class unigram in a class transition.
BACKOFF = 5.0
# Different words a task holds before it hands their counts on.
HELD_WORDS = 200_000
# The end of a text is a token that no word can be equal to.
END = b"\n"


def tokens(raw: bytes) -> list[bytes]:
    """Lower-cased words (A to Z only, cut at ASCII white space), then the end."""
    words = raw.lower().split()
    words.append(END)
    return words


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) over the one text column of ``texts``; ``word`` is binary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def hand_on() -> pa.RecordBatch:
            arrays = [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["word", "c"])

        for part in text_slices(batches, 0):
            for raw in raw_texts(part.column(0)):
                held.update(tokens(raw))
            if len(held) > HELD_WORDS:
                yield hand_on()
        yield hand_on()

    return texts.mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Units(dict):
    """Unit of a word: its own number if it is frequent, else the group of its ending.

    Unit 0 is the end of a text, which also stands in front of the first word.
    """

    def __init__(self, frequent: list[bytes]):
        super().__init__({END: 0})
        for word in frequent:
            if word != END:
                self[word] = len(self)
        self.n_own = len(self)

    def __missing__(self, word: bytes) -> int:
        return self.n_own + zlib.crc32(word[-ENDING_BYTES:]) % ENDING_GROUPS

    def __reduce__(self):
        return Units, (list(self)[1:],)

    @property
    def n(self) -> int:
        return self.n_own + ENDING_GROUPS


def unit_bigrams(texts: DataFrame, units: Units) -> np.ndarray:
    """Counts of (unit before, unit) over all texts, a matrix of fixed size."""
    n = units.n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n * n, np.int64)
        get = units.__getitem__
        for part in text_slices(batches, 0):
            words = [w for raw in raw_texts(part.column(0)) for w in tokens(raw)]
            ids = np.fromiter(map(get, words), np.int64, len(words))
            # Texts end with unit 0, so the unit in front of a text is 0 as well.
            total += np.bincount(np.r_[0, ids[:-1]] * n + ids, minlength=n * n)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["i", "c"])

    sums = texts.mapInArrow(run, "i long, c long").groupBy("i").agg(F.sum("c").alias("c"))
    out = np.zeros(n * n)
    found = sums.toPandas()  # n * n rows at most
    out[found["i"].to_numpy()] = found["c"].to_numpy()
    return out.reshape(n, n)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange_classes(bigrams: np.ndarray, n_classes: int = CLASSES) -> np.ndarray:
    """Class of every unit. Unit 0, the end, has class 0 alone.

    Starts with the units dealt out by frequency. A unit is taken out of its class and
    put where the class-bigram likelihood is highest; ties go to the lower class.
    """
    n = len(bigrams)
    k = max(2, min(n_classes, n))
    weight = bigrams.sum(0)
    classes = np.zeros(n, np.int64)
    by_weight = np.argsort(-weight[1:], kind="stable") + 1
    classes[by_weight] = 1 + np.arange(n - 1) % (k - 1)
    member = np.zeros((n, k))
    member[np.arange(n), classes] = 1
    table = member.T @ bigrams @ member
    for _ in range(EXCHANGE_ROUNDS):
        moved = 0
        for unit in by_weight:
            if not weight[unit] and not bigrams[unit].any():
                continue
            old = classes[unit]
            after = bigrams[unit] @ member  # unit -> class
            before = bigrams[:, unit] @ member  # class -> unit
            own = bigrams[unit, unit]
            after[old] -= own
            before[old] -= own
            table[old] -= after
            table[:, old] -= before
            table[old, old] -= own
            # Likelihood change of joining each class: rows, columns and the shared cell.
            # What comes before and after the unit is in the sums wherever it goes.
            rows, columns = table.sum(1) + before, table.sum(0) + after
            gain = (_xlogx(table + after[None, :]) - _xlogx(table)).sum(1)
            gain += (_xlogx(table + before[:, None]) - _xlogx(table)).sum(0)
            cell = np.diag(table)
            gain -= _xlogx(cell + after) + _xlogx(cell + before) - _xlogx(cell)
            gain += _xlogx(cell + after + before + own)
            out_n, in_n = after.sum() + own, before.sum() + own
            gain -= _xlogx(rows + out_n) - _xlogx(rows) + _xlogx(columns + in_n) - _xlogx(columns)
            gain[0] = -np.inf
            new = int(np.argmax(gain))
            after[new] += own
            before[new] += own
            table[new] += after
            table[:, new] += before
            table[new, new] -= own
            if new != old:
                member[unit, old], member[unit, new] = 0, 1
                classes[unit] = new
                moved += 1
        if not moved:
            break
    return classes


def transition_logs(bigrams: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """log10 p(class | class before), smoothed by the class unigram with one added."""
    k = int(classes.max()) + 1 if len(classes) else 1
    member = np.eye(k)[classes]
    table = member.T @ bigrams @ member
    unigram = (table.sum(0) + 1) / (table.sum() + k)
    return np.log10((table + BACKOFF * unigram) / (table.sum(1, keepdims=True) + BACKOFF))


def word_key(word: bytes) -> int:
    """A negative number for a word that is no head word; those have their rank."""
    return (xxhash.xxh64_intdigest(word) | 1 << 63) - (1 << 64)


class Keys(dict):
    """Key of a word: 0 for the end, the rank of a head word, else ``word_key``."""

    def __missing__(self, word: bytes) -> int:
        return word_key(word)


def token_rows(rows: DataFrame, keys: Keys, units: Units, unit_classes: np.ndarray) -> DataFrame:
    """Keys of the tokens of every text of ``rows`` (__id, __learn, __text).

    ``rare`` and ``n`` hold the words that are no head words and their counts, ``ending`` the
    classes of their endings in the order of their keys.
    """
    schema = rows.select("__id", "__learn").schema
    kinds = "keys array<long>, rare array<binary>, n array<long>, ending array<int>"
    for field in T._parse_datatype_string(kinds).fields:
        schema = schema.add(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, 2):
            words, ends = [], [0]
            for raw in raw_texts(part.column(2)):
                words += tokens(raw)
                ends.append(len(words))
            own = np.fromiter(map(keys.__getitem__, words), np.int64, len(words))
            low = np.flatnonzero(own < 0)
            cuts = np.searchsorted(low, ends).tolist()
            low, low_keys = low.tolist(), own[low].tolist()
            rare, n, ending = [], [], []
            for a, b in zip(cuts, cuts[1:]):
                found = Counter([words[i] for i in low[a:b]])
                by_key = dict(zip(low_keys[a:b], [words[i] for i in low[a:b]]))
                rare.append(list(found))
                n.append(list(found.values()))
                ending.append([int(unit_classes[units[by_key[x]]]) for x in sorted(by_key)])
            arrays = [
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(own)),
                pa.array(rare, pa.list_(pa.binary())),
                pa.array(n, pa.list_(pa.int64())),
                pa.array(ending, pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), *arrays], names=schema.names
            )

    return rows.select("__id", "__learn", "__text").mapInArrow(run, schema)


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(key before, key) of all tokens, of some ``HELD_TOKENS`` at a time."""
    for batch in batches:
        if not batch.num_rows:
            continue
        part = np.cumsum(batch.column(0).value_lengths().to_numpy()) // HELD_TOKENS
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for start, end in zip(edges, edges[1:]):
            ids = batch.column(0).slice(start, end - start).flatten().to_numpy()
            # Texts end with the end, which also stands in front of the first one.
            yield np.r_[0, ids[:-1]], ids


def rare_bigrams(learned: DataFrame) -> DataFrame:
    """(a, b, c): how often key ``b`` follows key ``a``, where one of them is no head word's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, b in _steps(batches):
            rare = (a < 0) | (b < 0)
            a, b = a[rare], b[rare]
            used, ids = np.unique(np.r_[a, b], return_inverse=True)
            pairs, c = np.unique(ids[: len(a)] * len(used) + ids[len(a) :], return_counts=True)
            columns = [used[pairs // len(used)], used[pairs % len(used)], c] if len(a) else [a, b, a]
            arrays = [pa.array(x.astype(np.int64)) for x in columns]
            yield pa.RecordBatch.from_arrays(arrays, names=["a", "b", "c"])

    found = learned.select("keys").mapInArrow(run, "a long, b long, c long")
    # Rows of a word that is no head word lie together, so that its key takes little room.
    found = found.withColumn("t", F.least("a", "b")).repartition("t")
    sums = found.groupBy("t", "a", "b").agg(F.sum("c").alias("c"))
    return sums.sortWithinPartitions("t", "a").select("a", "b", "c")


def head_contexts(learned: DataFrame, classes: np.ndarray, words: np.ndarray, k: int) -> DataFrame:
    """(w, code, n): what stands before and after each of the head ``words``, by class.

    Only bigrams of two head words count; ``classes`` are those of all head words.
    """
    place = np.full(len(classes), -1, np.int64)
    place[words] = np.arange(len(words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(words) * 3 * k, np.int64)
        for a, b in _steps(batches):
            plain = (a >= 0) & (b >= 0)
            a, b = a[plain], b[plain]
            same = a == b
            for side, word, near in ((0, b, a), (1, a, b)):
                at = place[word]
                used = (at >= 0) & ~same
                total += np.bincount((at[used] * 3 + side) * k + classes[near[used]], minlength=len(total))
            at = place[a[same]]
            total += np.bincount((at[at >= 0] * 3 + 2) * k, minlength=len(total))
        found = np.flatnonzero(total)
        columns = [words[found // (3 * k)], (found % (3 * k)).astype(np.int32), total[found]]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["w", "code", "n"])

    return learned.select("keys").mapInArrow(run, "w long, code int, n long")


def head_table(learned: DataFrame, classes: np.ndarray, k: int) -> np.ndarray:
    """Bigrams of classes over the bigrams of two head words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k * k, np.int64)
        for a, b in _steps(batches):
            plain = (a >= 0) & (b >= 0)
            total += np.bincount(classes[a[plain]] * k + classes[b[plain]], minlength=k * k)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k)), pa.array(total)], names=["i", "c"])

    table = np.zeros(k * k)
    sums = learned.select("keys").mapInArrow(run, "i long, c long").groupBy("i").agg(F.sum("c").alias("c"))
    for row in sums.collect():
        table[row["i"]] = row["c"]
    return table.reshape(k, k)


def best_classes(
    table: np.ndarray, old: np.ndarray, word: np.ndarray, side: np.ndarray, near: np.ndarray, n: np.ndarray
) -> np.ndarray:
    """Best class of every word if it alone moves, given the bigrams ``table`` of classes.

    ``old`` has the class of each word. Entry e says that a token of class ``near[e]``
    stands ``n[e]`` times before (side 0) or after (side 1) ``word[e]``, or that the word
    follows itself (side 2). Entries are sorted by word.
    """
    k, m = len(table), np.arange(len(old))
    before, after = np.zeros((len(old), k)), np.zeros((len(old), k))
    own = np.bincount(word[side == 2], n[side == 2], len(old))
    np.add.at(before, (word[side == 0], near[side == 0]), n[side == 0])
    np.add.at(after, (word[side == 1], near[side == 1]), n[side == 1])
    gain = np.zeros((len(old), k))
    # Likelihood change of joining each class, with the word taken out of its own first.
    for which, cells, others in ((0, table, after), (1, table.T, before)):
        e = np.flatnonzero(side == which)
        if not len(e):
            continue
        w, c = word[e], n[e][:, None]
        base = cells[near[e]].astype(float)
        base[np.arange(len(e)), old[w]] -= n[e]
        inside = np.flatnonzero(near[e] == old[w])
        base[inside] -= others[w[inside]]
        base[inside, old[w[inside]]] -= own[w[inside]]
        change = _xlogx(base + c) - _xlogx(base)
        # The shared cell of both sides is added below.
        change[np.arange(len(e)), near[e]] = 0
        first = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
        gain[w[first]] += np.add.reduceat(change, first, axis=0)
    cell = np.tile(np.diag(table).astype(float), (len(old), 1))
    cell[m, old] -= after[m, old] + before[m, old] + own
    gain += _xlogx(cell + after + before + own[:, None]) - _xlogx(cell)
    for total, moved in ((table.sum(1), after.sum(1) + own), (table.sum(0), before.sum(1) + own)):
        rest = np.tile(total.astype(float), (len(old), 1))
        rest[m, old] -= moved
        gain -= _xlogx(rest + moved[:, None]) - _xlogx(rest)
    gain[:, 0] = -np.inf
    return np.argmax(gain, axis=1)


def _in_batch(word: Column, batch: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BATCHES)) == batch


def _combined(entries: DataFrame) -> DataFrame:
    """Add up (w, code, n) inside the tasks, so that a frequent word has few rows in each."""

    def added(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        w, code, n = (np.concatenate([b.column(i).to_numpy() for b in held]) for i in range(3))
        used, at = np.unique(w, return_inverse=True)
        width = int(code.max()) + 1
        found, at = np.unique(at * width + code, return_inverse=True)
        sums = np.bincount(at, n).astype(np.int64)
        columns = [used[found // width], (found % width).astype(np.int32), sums]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["w", "code", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= HELD_ENTRIES:
                yield added(held)
                held, rows = [], 0
        if held:
            yield added(held)

    return entries.mapInArrow(run, "w long, code int, n long")


def _contexts(
    bigrams: DataFrame, classes: DataFrame, head: DataFrame, between: DataFrame, batch: int, k: int
) -> DataFrame:
    """(w, code, n) of the words of a batch, all rows of a word one after the other in a task.

    ``code`` is side * ``k`` + class for what stands next to the word. Words that move have a row
    with -1 less their own class. ``between`` has the entries of head words next to head words.
    """
    movable = classes.where((F.col("c") >= MOVED_COUNT) & (F.col("w") != 0) & _in_batch(F.col("w"), batch))
    tail = classes.where("w < 0").select("w", "k")
    head = F.broadcast(head.select("w", "k"))
    entries = bigrams.where((F.col("a") == F.col("b")) & _in_batch(F.col("a"), batch))
    entries = entries.selectExpr("a w", f"{2 * k} code", "c n")
    for side, near, word in ((0, "a", "b"), (1, "b", "a")):
        mine = bigrams.where((F.col("a") != F.col("b")) & _in_batch(F.col(word), batch))
        for own, known in ((f"{near} >= 0", head), (f"{near} < 0", tail)):
            rows = mine.where(own).select(F.col(word).alias("__w"), F.col(near).alias("w"), "c")
            found = rows.join(known, "w").selectExpr("__w w", f"{side * k} + k code", "c n")
            entries = entries.unionByName(found)
    own = movable.selectExpr("w", "-1 - k code", "c n")
    found = _combined(entries).unionByName(between).unionByName(own)
    return found.repartition("w").sortWithinPartitions("w")


def class_table(bigrams: DataFrame, classes: DataFrame, head: DataFrame, k: int) -> np.ndarray:
    """Bigrams of classes, by way of (class before, word): at most k times k rows come back."""
    tail = classes.where("w < 0").select("w", "k")
    head = F.broadcast(head.select("w", "k"))
    rows = bigrams
    for word, found in (("a", "i"), ("b", "j")):
        rest = [c for c in ("b", "i", "c") if c in rows.columns and c != word]
        parts = []
        for own, known in ((f"{word} >= 0", head), (f"{word} < 0", tail)):
            named = known.select(F.col("w").alias(word), F.col("k").alias(found))
            parts.append(rows.where(own).join(named, word).select(*rest, found))
        rows = parts[0].unionByName(parts[1])
        keys = [c for c in rows.columns if c != "c"]
        rows = rows.groupBy(*keys).agg(F.sum("c").alias("c"))
    table = np.zeros((k, k))
    for row in rows.collect():
        table[row["i"], row["j"]] = row["c"]
    return table


def log_likelihood(table: np.ndarray) -> float:
    """Of the class bigrams, in nats, up to what the words in their classes add."""
    return float(_xlogx(table).sum() - _xlogx(table.sum(1)).sum() - _xlogx(table.sum(0)).sum())


def _moved(contexts: DataFrame, table: np.ndarray) -> DataFrame:
    """(w, new) of the words that a class other than their own suits better."""
    width = 3 * len(table)

    def moves(w: np.ndarray, code: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        own = code < 0
        words, first = np.unique(w[own], return_index=True)
        old = -1 - code[own][first].astype(np.int64)
        w, code, n = w[~own], code[~own], n[~own]
        at = np.searchsorted(words, w)
        here = np.flatnonzero(at < len(words))
        here = here[words[at[here]] == w[here]]
        found, each = np.unique(at[here] * width + code[here], return_inverse=True)
        sums = np.bincount(each, n[here], len(found))
        for start in range(0, len(words), MOVED_AT_ONCE):
            part = slice(*np.searchsorted(found, [start * width, (start + MOVED_AT_ONCE) * width]))
            word, codes = found[part] // width - start, found[part] % width
            block = slice(start, start + MOVED_AT_ONCE)
            side, near = codes // len(table), codes % len(table)
            new = best_classes(table, old[block], word, side, near, sums[part])
            other = new != old[block]
            arrays = [pa.array(words[block][other]), pa.array(new[other].astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, names=["w", "new"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append([batch.column(i).to_numpy() for i in range(3)])
            rows += batch.num_rows
            if rows >= HELD_ENTRIES:
                w, code, n = map(np.concatenate, zip(*held))
                # The last word may go on in the next batch.
                end = int(np.searchsorted(w, w[-1]))
                yield from moves(w[:end], code[:end], n[:end])
                held, rows = [[w[end:], code[end:], n[end:]]], len(w) - end
        if rows:
            yield from moves(*map(np.concatenate, zip(*held)))

    return contexts.mapInArrow(run, "w long, new int")


class ClassModel:
    """Transitions, class totals, the classes of head words, and ``words`` with all classes."""

    def __init__(self, texts: DataFrame, counts: DataFrame, rows: DataFrame | None = None):
        """``rows`` are (__id, __learn, __text) of all texts, ``texts`` those to learn from."""
        totals = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
        self.n_tokens = totals["n"] or 0
        self.n_words = totals["v"]
        top = counts.orderBy(F.desc("c"), "word").limit(HEAD_WORDS).collect()
        self.head = {bytes(r["word"]): r["c"] for r in top}
        self.units = Units(list(self.head)[:FREQUENT_UNITS])
        end = counts.where(F.col("word") == F.lit(bytearray(END))).first()
        if end:  # also where many words are more frequent
            self.head[END] = end["c"]
        unit_table = unit_bigrams(texts, self.units)
        self.unit_classes = exchange_classes(unit_table)
        self.keys = Keys({END: 0})
        for word in self.head:
            if word != END:
                self.keys[word] = len(self.keys)
        k = int(self.unit_classes.max()) + 1
        words = written(self._first_classes(counts), "word-classes")
        if rows is None:
            rows = texts.toDF("__text").selectExpr("0 __id", "true __learn", "__text")
        made = token_rows(rows, self.keys, self.units, self.unit_classes)
        # Rows get a number of their own, so that repeated ids stay apart.
        self.tokens = written(made.withColumn("__row", F.monotonically_increasing_id()), "tokens")
        learned = self.tokens.where("__learn")
        bigrams = written(rare_bigrams(learned), "word-bigrams")
        # At first all words have the classes of their units.
        member = np.eye(k)[self.unit_classes]
        table = member.T @ unit_table @ member
        self.likelihoods = [log_likelihood(table)]
        self.head_classes, batches = self._of_head(words)
        for move in range(WORD_ROUNDS * BATCHES):
            batch = move % BATCHES
            moving = np.flatnonzero((batches == batch) & (np.arange(len(batches)) > 0))
            between = head_contexts(learned, self.head_classes, moving, k)
            contexts = _contexts(bigrams, words, words.where("w >= 0"), between, batch, k)
            moved = written(_moved(contexts, table), "words-moved")
            new = F.coalesce("new", "k").alias("k")
            tried = written(words.join(moved, "w", "left").select("word", "w", "c", new), "word-classes")
            tried_head, _ = self._of_head(tried)
            tried_table = class_table(bigrams, tried, tried.where("w >= 0"), k)
            tried_table += head_table(learned, tried_head, k)
            # All words of a batch move by the same table; together they must gain as well.
            if log_likelihood(tried_table) <= self.likelihoods[-1]:
                continue
            words, table, self.head_classes = tried, tried_table, tried_head
            self.likelihoods.append(log_likelihood(table))
        self.words = words
        self.transitions = transition_logs(table, np.arange(k))
        n, v = np.zeros(k), np.zeros(k)
        sums = words.groupBy("k").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"))
        for row in sums.collect():
            n[row["k"]], v[row["k"]] = row["n"], row["v"]
        # p(word | class) = (c + 1) / (n + v + 1): one share is left for unseen words.
        self.emission_logs = np.log10(n + v + 1)

    def _of_head(self, words: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Classes and batches of the head words."""
        classes, batches = np.zeros((2, len(self.keys)), np.int64)
        batch = F.pmod(F.xxhash64("w"), F.lit(BATCHES)).alias("batch")
        for row in words.where("w >= 0").select("w", "k", batch).collect():
            classes[row["w"]], batches[row["w"]] = row["k"], row["batch"]
        return classes, batches

    def _first_classes(self, counts: DataFrame) -> DataFrame:
        """(word, w, c, k) of every word, with the class of its unit."""
        units, classes, keys = self.units, self.unit_classes, self.keys

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                words = batch.column(0).to_pylist()
                w = np.fromiter(map(keys.__getitem__, words), np.int64, len(words))
                k = classes[np.fromiter(map(units.__getitem__, words), np.int64, len(words))]
                arrays = [batch.column(0), pa.array(w), batch.column(1), pa.array(k.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(arrays, names=["word", "w", "c", "k"])

        return counts.select("word", "c").mapInArrow(run, "word binary, w long, c long, k int")


def _document_parts(tokens_: DataFrame, model: ClassModel) -> DataFrame:
    """Per row: id, what head words give alone, its rare words, and its pairs with one.

    ``keys``, ``ending`` and ``n`` hold the rare words by key, with the classes of their endings
    and their counts. ``first`` and ``second`` are pairs of tokens: the class of a head word, or
    the number of classes plus the place of a rare word in ``keys``.
    """
    head_classes, transitions, emissions = model.head_classes, model.transitions, model.emission_logs
    head_logs = np.full(len(model.keys), np.nan)
    for word, c in model.head.items():
        head_logs[model.keys[word]] = np.log10(c + 1)
    n_classes = len(emissions)
    source = tokens_.select("__id", "__row", "ending", "keys")
    schema = source.select("__id", "__row").schema
    kinds = (
        "n_tokens long, known long, logs double, path double, ending array<int>,"
        " keys array<long>, n array<int>, first array<int>, second array<int>"
    )
    for field in T._parse_datatype_string(kinds).fields:
        schema = schema.add(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            lists = batch.column(3)
            edges = np.r_[0, np.cumsum(lists.value_lengths().to_numpy())].tolist()
            all_keys = lists.flatten().to_numpy()
            for start, end in zip(edges, edges[1:]):
                own = all_keys[start:end]
                is_head = own >= 0
                heads = own[is_head]
                coded = np.empty(len(own), np.int64)
                coded[is_head] = head_classes[heads]
                rare, at, n = np.unique(own[~is_head], return_inverse=True, return_counts=True)
                coded[~is_head] = n_classes + at
                last = np.r_[0, coded[:-1]]
                plain = (coded < n_classes) & (last < n_classes)
                path = transitions[last[plain], coded[plain]].sum()
                path -= emissions[head_classes[heads]].sum()
                logs = head_logs[heads]
                known = logs[~np.isnan(logs)].tolist()
                rows.append((len(own), len(known), sum(known), path, rare, n, last[~plain], coded[~plain]))
            made = list(zip(*rows)) or [[]] * len(_PART_TYPES)
            arrays = [pa.array(v, t) for v, t in zip(made, _PART_TYPES)]
            arrays.insert(4, batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *arrays], names=schema.names
            )

    return source.mapInArrow(run, schema)


_PART_TYPES = [
    pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.int64()),
    pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int32()),
]


def _with_rare_paths(parts: DataFrame, model: ClassModel) -> DataFrame:
    """Add ``rare_path``: emissions of rare words, and transitions from and to them.

    ``found`` of ``parts`` lists (w, k), the classes of the rare words that were learned.
    """
    transitions, emissions = model.transitions, model.emission_logs
    lists = ["keys", "ending", "n", "first", "second"]
    kept = [c for c in parts.columns if c not in (*lists, "found")]
    source = parts.select(*kept, *lists, F.col("found.w").alias("w"), F.col("found.k").alias("k"))
    schema = source.select(*kept).schema.add("rare_path", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = []
            for at in range(batch.num_rows):
                keys, ending, n, first, second, w, k = (
                    np.array(batch.column(c)[at].as_py() or [], np.int64)
                    for c in range(len(kept), batch.num_columns)
                )
                classes = ending.copy()
                classes[np.searchsorted(keys, w)] = k
                of = np.r_[np.arange(len(emissions)), classes]
                paths.append(transitions[of[first], of[second]].sum() - (n * emissions[classes]).sum())
            arrays = [*batch.columns[: len(kept)], pa.array(paths, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return source.mapInArrow(run, schema)


def score_texts(
    docs: DataFrame,
    learn: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Log10 probability of every text under the class model and under word counts.

    ``learn`` selects the rows to learn from (by default those whose id's crc32 is not
    2 modulo 7). Result: ``id_col``, held_out, n_tokens, n_known, train_tokens,
    base_score, score. NULL and empty texts are the end token alone. A NULL id is learned
    from. Repeated rows are learned from and scored row by row. With nothing to learn
    from, all words are unseen. An empty table gives an empty result.
    """
    held_out = key_remainder(F.col(id_col), LEARN_MODULUS) == HELD_OUT_REMAINDER
    texts = docs.where(~held_out if learn is None else learn).select(F.col(text_col).alias("__text"))
    counts = written(word_counts(texts), "word-counts")
    learned = (~held_out if learn is None else learn).alias("__learn")
    rows = docs.select(F.col(id_col).alias("__id"), learned, F.col(text_col).alias("__text"))
    model = ClassModel(texts, counts, rows)
    parts = _document_parts(model.tokens, model)
    rare = model.tokens.select(
        "__row", F.inline(F.arrays_zip(F.col("rare").alias("word"), F.col("n").alias("n")))
    )
    tail = (
        rare.join(model.words, "word")
        .groupBy("__row")
        .agg(
            F.sum("n").alias("__n"),
            F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("__logs"),
            F.collect_list(F.struct("w", "k")).alias("found"),
        )
    )
    # Written before the other parts of the rows are shuffled, so that both need not be on disk.
    tail = written(tail, "rare-words")
    logs = F.col("logs") + F.coalesce("__logs", F.lit(0.0))
    total = model.n_tokens + model.n_words + 1
    scored = _with_rare_paths(parts.join(tail, "__row", "left"), model)
    return scored.select(
        F.col("__id").alias(id_col),
        (key_remainder(F.col("__id"), LEARN_MODULUS) == HELD_OUT_REMAINDER).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("__n", F.lit(0))).alias("n_known"),
        F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(float(np.log10(total)))).alias("base_score"),
        (logs + F.col("path") + F.col("rare_path")).alias("score"),
    )

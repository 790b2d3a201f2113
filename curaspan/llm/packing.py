"""Best-fit packing of tokenized documents, planned over counts per length.

Documents are cut into pieces of at most one sequence. The plan never looks at
single documents: best-fit runs over the histogram of piece lengths (at most
``SEQUENCE_TOKENS`` numbers) and hands out runs of slots per length. A piece then
takes the slot of its rank among the pieces of its length, through a join.
"""

from __future__ import annotations

import array
import bisect
import functools
import json
import os
import re
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curaspan.llm.common import map_texts, written

SEQUENCE_TOKENS = 2048
END_ID = 0
# Cached ids of a worker: so many different words, none of them longer than this.
CACHED_WORDS = 300_000
CACHED_LENGTH = 64
SPECIAL = "<|endoftext|>"
# Fixed value: how byte-level vocabularies of this kind split a text.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Ranks are counted in this many parts of a length at least, and about this many rows each.
LEAST_PARTS = 256
ROWS_PER_PART = 50_000

_SPACE_RUN = re.compile(r" \s")
_WORD_START = re.compile(r" (?=\S)")


class _WordIds:
    """Ids of whole texts, made from the ids of their space-separated words.

    The tokenizer never joins characters across a space that a visible character
    follows; a word keeps its leading space. Ids are little-endian 32-bit bytes.
    Merge ranks are read from the tokenizer's file. Where they follow the ids, words
    are merged by tiktoken, several times faster than by tokenizers, with the same
    result; otherwise, and for texts that hold the special token, by tokenizers.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merged = _by_ranks(path)
        # Words of the current and of the last generation; those in use are carried over.
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array.array("I", ids).tobytes()

    def _word(self, text: str) -> bytes:
        if self.merged is None:
            return self._whole(text)
        return array.array("I", self.merged.encode_ordinary(text)).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        out = []
        for text in texts:
            if SPECIAL in text:
                out.append(self._whole(text))
                continue
            words = _WORD_START.split(text) if _SPACE_RUN.search(text) else text.split(" ")
            head = words.pop(0)
            out.append((self._word(head) if head else b"") + b"".join(map(self._known, words)))
        return out

    def _known(self, word: str) -> bytes:
        ids = self.known.get(word)
        if ids is None:
            ids = self.before.get(word)
            if ids is None:
                ids = self._word(" " + word)
            if len(word) <= CACHED_LENGTH:
                if len(self.known) >= CACHED_WORDS:
                    self.before, self.known = self.known, {}
                self.known[word] = ids
        return ids


def _by_ranks(path: str):
    """The vocabulary of a byte-level file as tiktoken ranks; None if its merges disagree."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    # The printable stand-ins of byte-level vocabularies: visible Latin-1 characters
    # stand for themselves, the other bytes for the characters from 256 on.
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    byte_of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
    vocabulary = model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [vocabulary.get("".join(pair)) for pair in pairs]
    if None in made or made != sorted(made) or len(set(made)) != len(made):
        return None
    ranks = {
        bytes(byte_of[c] for c in token): i for token, i in vocabulary.items() if token != SPECIAL
    }
    return tiktoken.Encoding(
        os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@functools.lru_cache(maxsize=2)
def _word_ids(path: str) -> _WordIds:
    return _WordIds(path)


def first_piece(n_tokens: Column) -> Column:
    """Length of the first piece; all later ones are full."""
    rest = n_tokens % SEQUENCE_TOKENS
    return F.when(rest == 0, F.lit(SEQUENCE_TOKENS)).otherwise(rest).cast("long")


def token_pieces(docs: DataFrame, tokenizer: str, id_col: str, text_col: str) -> DataFrame:
    """Pieces of every document: ``id_col``, piece, start, length, ids_crc32."""
    size = 4 * SEQUENCE_TOKENS
    end = np.array([END_ID], dtype="<u4").tobytes()

    def cut(texts: list[bytes]) -> list[list]:
        lengths, sums = [], []
        for ids in _word_ids(tokenizer).encode([t.decode() for t in texts]):
            ids += end
            first = len(ids) % size or size
            edges = [0, *range(first, len(ids) + 1, size)]
            lengths.append(len(ids) // 4)
            sums.append(np.array([zlib.crc32(ids[a:b]) for a, b in zip(edges, edges[1:])], float))
        return [lengths, sums]

    tokens = map_texts(docs, [id_col], text_col, "__n long, __crc array<double>", cut)
    head = first_piece(F.col("__n"))
    return tokens.select(
        id_col, head.alias("__head"), F.posexplode("__crc").alias("piece", "__sum")
    ).select(
        id_col,
        "piece",
        F.when(F.col("piece") == 0, F.lit(0).cast("long"))
        .otherwise(F.col("__head") + (F.col("piece") - 1) * F.lit(SEQUENCE_TOKENS).cast("long"))
        .alias("start"),
        F.when(F.col("piece") == 0, F.col("__head"))
        .otherwise(F.lit(SEQUENCE_TOKENS).cast("long"))
        .alias("length"),
        F.col("__sum").cast("long").alias("ids_crc32"),
    )


def plan_slots(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts per length.

    Returns runs of slots (length, first rank, end rank, first sequence, slots in each
    sequence, offset of the first slot). Sequences with the same content so far
    are one group, so the plan's size depends on the number of lengths only.
    """
    open_groups: dict[int, list[tuple[int, int]]] = {}  # free tokens -> (first sequence, count)
    free: list[int] = []
    runs = []
    sequences = 0

    def put(left: int, first: int, n: int) -> None:
        if not left or not n:
            return
        if left not in open_groups:
            open_groups[left] = []
            bisect.insort(free, left)
        open_groups[left].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect.bisect_left(free, length)
            if at < len(free):
                room = free[at]
                first, n = open_groups[room].pop()
                if not open_groups[room]:
                    del open_groups[room]
                    free.pop(at)
            else:
                room = capacity
                first, n = sequences, -(-left // (capacity // length))
                sequences += n
            each = room // length
            full = min(n, left // each)
            if full:
                runs.append((length, rank, rank + full * each, first, each, capacity - room))
                rank, left = rank + full * each, left - full * each
                put(room - each * length, first, full)
            if full < n and left:
                # Fewer pieces are left than fit into one sequence.
                runs.append((length, rank, rank + left, first + full, left, capacity - room))
                put(room - left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            put(room, first + full, n - full)
    return runs


def pack(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Place every piece of every document in a sequence.

    Result: ``id_col``, piece, start, length, ids_crc32, sequence_id, offset. A document
    is its ids and one end id, so NULL and empty texts are one piece of one token.
    Repeated rows and repeated or NULL ids are packed row by row. Only the id and the
    text are read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    pieces = written(token_pieces(docs, tokenizer, id_col, text_col), "pieces")
    # At most SEQUENCE_TOKENS rows.
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    n = sum(counts.values())
    parts = max(LEAST_PARTS, -(-n // ROWS_PER_PART))
    own = Window.partitionBy("length", "__part").orderBy(id_col, "piece", "ids_crc32")
    parted = pieces.withColumn("__part", F.pmod(F.xxhash64(id_col, "piece", "ids_crc32"), F.lit(parts)))
    before = Window.partitionBy("length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        parted.groupBy("length", "__part")
        .agg(F.count(F.lit(1)).alias("__n"))
        .select("length", "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    )
    ranked = (
        parted.withColumn("__own", F.row_number().over(own))
        .join(bases, ["length", "__part"])
        .withColumn("__rank", F.col("__base") + F.col("__own") - 1)
    )
    runs = spark.createDataFrame(
        plan_slots(counts, SEQUENCE_TOKENS),
        "length long, __from long, __to long, __first long, __each long, __start long",
    )
    slot = F.col("__rank") - F.col("__from")
    placed = ranked.join(
        F.broadcast(runs),  # some thousand rows, whatever the input
        (ranked["length"] == runs["length"])
        & (F.col("__rank") >= F.col("__from"))
        & (F.col("__rank") < F.col("__to")),
    )
    return placed.select(
        id_col,
        "piece",
        "start",
        ranked["length"],
        "ids_crc32",
        (F.col("__first") + F.floor(slot / F.col("__each"))).alias("sequence_id"),
        (F.col("__start") + F.pmod(slot, F.col("__each")) * ranked["length"]).alias("offset"),
    )

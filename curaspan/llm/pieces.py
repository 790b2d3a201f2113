"""Sampled SentencePiece segmentations without replacement, and their decoding.

All segmentations of a text into vocabulary pieces form a lattice with a probability
for each. The ``k`` segmentations with the largest log probability plus Gumbel noise
are ``k`` distinct samples. They are found from the top, as in A-star search: a state
is a partial segmentation, its priority the largest perturbed value among all its
completions. That value is drawn first and handed down: the best child keeps it, its
siblings get the values of Gumbels that are bound to be lower. The noise is a hash of
the row key and the place, so a row has the same samples in every run.
"""

from __future__ import annotations

import collections
import functools
import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curaspan.llm.common import raw_texts, text_slices

SPACE = "▁"
SAMPLES = 3
# Text that a worker walks through at a time.
SLICE_BYTES = 1_000_000
# Characters of chunks whose lattices a worker keeps for its next slices (some 60 bytes each).
KEPT_CHARACTERS = 4_000_000
# Siblings are looked at in this many chunks first; more only where that may not suffice.
FIRST_CHUNKS = 512
# Steps of a text whose siblings tell which of the others may be among the best, and how far
# below the best of its place such a sibling is at least.
FIRST_STEPS = 24
SMALL_GAP = 1e-3
# No Gumbel value drawn here, and no correction of one, is larger than this.
LARGEST = 40.0

_CHUNK = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_U64 = np.uint64
_NO_EDGES = np.zeros(0, np.int64)
_EDGE_STEP = _U64(0x8CB92BA72F3D8DD7)


class Vocabulary:
    """Pieces of a model file with log weights; characters without a piece become bytes."""

    def __init__(self, path: str, alpha: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        scores = np.array([model.get_score(i) for i in range(n)])
        normal = [
            i for i in range(n)
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        if all(float(s).is_integer() for s in scores[normal]):
            # Merge ranks, not probabilities: frequency falls about as one over the rank.
            weights = -np.log(1 - np.minimum(scores, 0) + 1)
        else:
            weights = scores
        weights = alpha * weights
        self.pieces = {model.id_to_piece(i): (i, float(weights[i])) for i in normal}
        self._build_tree()
        byte_ids = {int(model.id_to_piece(i)[3:5], 16): i for i in range(n) if model.is_byte(i)}
        self.byte_ids = [byte_ids.get(b, model.unk_id()) for b in range(256)]
        self.byte_weight = float(alpha * -np.log(n))
        self.text = [b""] * n
        for piece, (i, _) in self.pieces.items():
            self.text[i] = piece.replace(SPACE, " ").encode()
        for b, i in byte_ids.items():
            self.text[i] = bytes([b])
        self.spelled = pa.array(self.text, pa.large_binary())
        # Pieces that end a run of characters with a space would cross chunks.
        self.crossing = any(SPACE in p.lstrip(SPACE) for p in self.pieces)

    def _build_tree(self) -> None:
        """Prefix tree of the pieces: (node, character) keys with their child nodes."""
        letters = sorted({c for p in self.pieces for c in p})
        self.letter = np.full(0x110000, -1, np.int64)
        self.letter[[ord(c) for c in letters]] = np.arange(len(letters))
        self.n_letters = max(1, len(letters))
        nodes = {"": 0}
        edges = []
        for piece in sorted(self.pieces):
            for n in range(1, len(piece) + 1):
                if piece[:n] not in nodes:
                    nodes[piece[:n]] = len(nodes)
                    parent = nodes[piece[: n - 1]]
                    key = parent * self.n_letters + int(self.letter[ord(piece[n - 1])])
                    edges.append((key, nodes[piece[:n]]))
        keys = np.array([k for k, _ in edges], np.int64)
        children = np.array([c for _, c in edges], np.int64)
        # Children of the root, by letter.
        self.first_child = np.full(self.n_letters, -1, np.int64)
        roots = keys < self.n_letters
        self.first_child[keys[roots]] = children[roots]
        # The others by a hash of their key; where that place is taken, at the next free one.
        keys, children = keys[~roots], children[~roots]
        self.tree_shift = _U64(64 - max(1, (8 * len(keys)).bit_length()))
        size = 1 << (64 - int(self.tree_shift))
        self.tree_key = np.full(size + 1, -1, np.int64)
        self.tree_child = np.full(size + 1, -1, np.int64)
        left, slot = np.arange(len(keys)), self._slots(keys)
        while len(left):
            free = np.flatnonzero(self.tree_key[slot] < 0)
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.tree_key[slot[put]], self.tree_child[slot[put]] = keys[left[put]], children[left[put]]
            rest = np.ones(len(left), bool)
            rest[put] = False
            left, slot = left[rest], (slot[rest] + 1) % size
        self.node_piece = np.full(len(nodes), -1, np.int64)
        self.node_log = np.zeros(len(nodes))
        for piece, (i, log) in self.pieces.items():
            self.node_piece[nodes[piece]], self.node_log[nodes[piece]] = i, log

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _U64(0x9E3779B97F4A7C15)) >> self.tree_shift).astype(np.int64)

    def _children(self, keys: np.ndarray) -> np.ndarray:
        """Node of each key of the prefix tree, -1 where it has none."""
        slot = self._slots(keys)
        held = self.tree_key[slot]
        child = np.where(held == keys, self.tree_child[slot], -1)
        on = np.flatnonzero((held != keys) & (held >= 0))
        while len(on):
            slot[on] = (slot[on] + 1) % (len(self.tree_key) - 1)
            held = self.tree_key[slot[on]]
            hit = held == keys[on]
            child[on[hit]] = self.tree_child[slot[on[hit]]]
            on = on[~hit & (held >= 0)]
        return child

    def chunks(self, text: str) -> list[str]:
        """Parts of the text that no piece crosses; the text has a space in front."""
        if not text:
            return []
        marked = SPACE + text.replace(" ", SPACE)
        return [marked] if self.crossing else _CHUNK.findall(marked)

    def words(self, text: str) -> list[str]:
        """The chunks, all without the space they begin with."""
        if text and not self.crossing and SPACE not in text:
            words = text.split(" ")
            if "" not in words:
                return words
        return [chunk[1:] for chunk in self.chunks(text)]

    def edges(self, chunks: list[str]):
        """Edges of the lattices of all chunks: character, length, piece, log weight.

        Sorted by character and length, the characters of all chunks numbered in a row. All
        places go down the prefix tree together. A character without a piece has one
        edge, whose piece is minus its code point.
        """
        codes = np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32).astype(np.int64)
        size = np.fromiter(map(len, chunks), np.int64, len(chunks))
        end = np.repeat(np.cumsum(size), size)
        letters = self.letter[codes]
        at, node = np.arange(len(codes)), np.zeros(len(codes), np.int64)
        found = []
        single = np.zeros(len(codes), bool)
        length = 0
        while len(at):
            here = at + length
            inside = here < end[at]
            at, node, here = at[inside], node[inside], here[inside]
            letter = letters[here]
            if length == 0:
                child = np.where(letter >= 0, self.first_child[letter], -1)
            else:
                known = np.flatnonzero(letter >= 0)
                at, node, letter = at[known], node[known], letter[known]
                child = self._children(node * self.n_letters + letter)
            fits = np.flatnonzero(child >= 0)
            at, node = at[fits], child[fits]
            length += 1
            full = np.flatnonzero(self.node_piece[node] >= 0)
            where = at[full]
            if length == 1:
                single[where] = True
                spelled = np.flatnonzero(~single)
                n_bytes = 1 + (codes[spelled] > 0x7F) + (codes[spelled] > 0x7FF) + (codes[spelled] > 0xFFFF)
                found.append((spelled, np.ones_like(spelled), -codes[spelled], n_bytes * self.byte_weight))
            lengths = np.full(len(where), length)
            found.append((where, lengths, self.node_piece[node[full]], self.node_log[node[full]]))
        if not found:
            return size, *[np.zeros(0, np.int64)] * 4
        degree = np.zeros(len(codes), np.int64)
        for where, *_ in found:  # no place twice in one of them
            degree[where] += 1
        free = np.cumsum(degree) - degree
        n_edges = int(degree.sum())
        columns = [np.empty(n_edges, c.dtype) for c in found[0][:3]] + [np.empty(n_edges)]
        for part in found:
            put = free[part[0]]
            free[part[0]] += 1
            for column, values in zip(columns, part):
                column[put] = values
        return size, *columns

    def decode(self, ids) -> str:
        """Text of a list of piece ids, without the space in front."""
        raw = b"".join(map(self.text.__getitem__, ids))
        return raw.decode(errors="replace").removeprefix(" ")

    def decoded(self, ids: np.ndarray) -> tuple[np.ndarray, memoryview]:
        """Bytes of all pieces one after the other, and where those of each begin."""
        found = self.spelled.take(pa.array(ids))
        if not len(found):
            return np.zeros(1, np.int64), memoryview(b"")
        _, offsets, data = found.buffers()
        return np.frombuffer(offsets, np.int64, len(found) + 1), memoryview(data).cast("B")

    def expand(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids with single characters in place of codes spelled out in bytes.

        ``ends`` are places in ``ids``; returned are the ids and the same places in them.
        """
        codes = np.flatnonzero(ids < 0)
        if not len(codes):
            return ids, ends
        characters, which = np.unique(ids[codes], return_inverse=True)
        spelled = [[self.byte_ids[b] for b in chr(-i).encode()] for i in characters.tolist()]
        n = np.array([len(x) for x in spelled], np.int64)
        begin = (np.cumsum(n) - n)[which]
        n = n[which]
        size = np.ones(len(ids), np.int64)
        size[codes] = n
        out = np.repeat(ids, size)
        put = np.flatnonzero(out < 0)
        number = np.arange(len(put)) - np.repeat(np.cumsum(n) - n, n)
        out[put] = np.array([b for x in spelled for b in x])[np.repeat(begin, n) + number]
        return out, np.concatenate(([0], np.cumsum(size)))[ends]


@functools.lru_cache(maxsize=2)
def vocabulary(path: str, alpha: float = 1.0) -> Vocabulary:
    return Vocabulary(path, alpha)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U64(30))
    x *= _U64(0xBF58476D1CE4E5B9)
    x ^= x >> _U64(27)
    x *= _U64(0x94D049BB133111EB)
    x ^= x >> _U64(31)
    return x


def _uniform(bits: np.ndarray) -> np.ndarray:
    uniform = (bits >> _U64(11)).astype(np.float64)
    uniform += 0.5
    uniform *= 2.0**-53
    return uniform


def _gumbel(bits: np.ndarray) -> np.ndarray:
    x = _uniform(bits)
    for _ in range(2):
        np.log(x, out=x)
        np.negative(x, out=x)
    return x


def _order(keys: np.ndarray) -> np.ndarray:
    """Stable order of small numbers; two bytes are sorted by their digits."""
    short = len(keys) and keys.max() < 1 << 16
    return np.argsort(keys.astype(np.uint16) if short else keys, kind="stable")


class _Kept:
    """Lattices of chunks in flat arrays, each made at the first use of its chunk.

    A place stands in front of each character and one at the end of each chunk. ``degree``,
    ``first_edge``, ``place``, ``top_edge`` and ``top`` are by place, ``piece``, ``next`` and
    ``log`` by edge; the edges of a place lie together, in the order of their lengths.
    """

    PLACES = {"degree": np.int32, "first_edge": np.int32, "place": np.uint32, "top_edge": np.int32, "top": float}
    EDGES = {"piece": np.int32, "next": np.int32, "log": float}

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        # Room that is not used takes no memory.
        for kinds, room in ((self.PLACES, KEPT_CHARACTERS * 3 // 2), (self.EDGES, KEPT_CHARACTERS * 4)):
            for name, kind in kinds.items():
                setattr(self, name, np.empty(room, kind))
        self.starts = np.empty(0, np.int64)
        self.clear()

    def clear(self) -> None:
        # Number of each chunk, in the order of their first use.
        self.numbers = collections.defaultdict(itertools.count().__next__)
        self.n_chunks = self.n_places = self.n_edges = 0

    def _append(self, name: str, at: int, values: np.ndarray) -> None:
        column = getattr(self, name)
        if at + len(values) > len(column):
            larger = np.empty(max(at + len(values), len(column) * 3 // 2), column.dtype)
            larger[:at] = column[:at]
            setattr(self, name, larger)
            column = larger
        column[at : at + len(values)] = values

    def number(self, words: list[str]) -> list[int]:
        """Numbers of the chunks of ``words``; those without a lattice get one with ``make``."""
        return list(map(self.numbers.__getitem__, words))

    def make(self) -> None:
        """Make the lattices of the chunks that were numbered since the last call."""
        new = list(itertools.islice(reversed(self.numbers), len(self.numbers) - self.n_chunks))
        new = [SPACE + word for word in reversed(new)]
        size_of, at, lengths, piece, weight = self.vocab.edges(new)
        n_chars = int(size_of.sum())
        chunk_of = np.repeat(np.arange(len(size_of)), size_of)
        owner = at + chunk_of[at]
        degree = np.bincount(owner, minlength=n_chars + len(size_of))
        first_edge = np.cumsum(degree) - degree
        next_ = owner + lengths
        base = np.cumsum(size_of + 1) - size_of - 1
        place = np.arange(len(degree)) - np.repeat(base, size_of + 1)
        inner = np.flatnonzero(degree)
        # From the ends of all chunks: the log weight of all ways on from a place. Divided
        # by it, that of the ways over an edge is the probability of the edge.
        left = np.cumsum(size_of)[chunk_of] - np.arange(n_chars)
        by_left = _order(left)
        places = inner[by_left]
        sizes = degree[places]
        firsts = np.cumsum(sizes) - sizes
        edge = np.repeat(first_edge[places] - firsts, sizes) + np.arange(len(at))
        groups = np.concatenate(([0], np.cumsum(np.bincount(left)))).tolist() if n_chars else [0]
        onward = np.zeros(len(degree))
        ends, weights = next_[edge], weight[edge]
        logs = np.empty(len(at))
        stops = np.append(firsts, len(at))
        for g, h in zip(groups[:-1], groups[1:]):
            if g == h:
                continue
            a, b = int(stops[g]), int(stops[h])
            ways = weights[a:b] + onward[ends[a:b]]
            first, size_here = firsts[g:h] - a, sizes[g:h]
            highest = np.maximum.reduceat(ways, first)
            sums = np.add.reduceat(np.exp(ways - np.repeat(highest, size_here)), first)
            total = highest + np.log(sums)
            onward[places[g:h]] = total
            logs[a:b] = ways - np.repeat(total, size_here)
        log = np.empty(len(at))
        log[edge] = logs
        probability = np.exp(log)
        # The likeliest edge of each place.
        top_edge = np.zeros(len(degree), np.int64)
        top = np.zeros(len(degree))
        if len(inner):
            top[inner] = np.maximum.reduceat(probability, first_edge[inner])
            hit = np.flatnonzero(probability == top[owner])
            top_edge[owner[hit[::-1]]] = hit[::-1]
        for name, values in (
            ("degree", degree), ("first_edge", first_edge + self.n_edges), ("place", place),
            ("top_edge", top_edge + self.n_edges), ("top", top),
        ):
            self._append(name, self.n_places, values)
        for name, values in (
            ("piece", piece), ("next", next_ + self.n_places), ("log", log),
        ):
            self._append(name, self.n_edges, values)
        self._append("starts", self.n_chunks, base + self.n_places)
        self.n_chunks += len(new)
        self.n_places += len(degree)
        self.n_edges += len(at)


class _Lattices:
    """The lattices of all chunks of a slice."""

    def __init__(self, vocab: Vocabulary, texts: list[str], kept: _Kept | None = None):
        kept = _Kept(vocab) if kept is None else kept
        if kept.n_places > KEPT_CHARACTERS:
            kept.clear()
        token_chunk, size = [], []
        for text in texts:
            words = vocab.words(text)
            size.append(len(words))
            token_chunk += kept.number(words)
        kept.make()
        for name in (*kept.PLACES, *kept.EDGES):
            setattr(self, name, getattr(kept, name))
        self.start = kept.starts[np.array(token_chunk, np.int64)]
        self.size = np.array(size, np.int64)
        self.doc = np.repeat(np.arange(len(texts)), self.size)
        self.first_token = np.cumsum(self.size) - self.size
        self.index = (np.arange(len(self.doc)) - self.first_token[self.doc]).astype(np.uint64)

    def _drawn(self, node: np.ndarray, share: np.ndarray) -> np.ndarray:
        """First edge of each place with which the edges but the likeliest reach the given share.

        ``share`` is that of their probability together; the last edge reaches all.
        """
        edge = self.first_edge[node].astype(np.int64)
        last = edge + self.degree[node] - 1
        top = self.top_edge[node]
        left = share * (1 - self.top[node])
        on = np.arange(len(edge))
        while len(on):
            left[on] -= np.where(edge[on] == top[on], 0, np.exp(self.log[edge[on]]))
            on = on[(left[on] > 0) & (edge[on] < last[on])]
            edge[on] += 1
        return edge

    def walk(self, token: np.ndarray, node: np.ndarray, seed: np.ndarray, noted: np.ndarray):
        """Choose a way through each given chunk, from the given node to its end.

        Returns the steps in text order (token, edge, largest perturbed value), and for
        ``noted`` chunks the edges not taken (number of the step, edge, perturbed value).
        There every edge gets Gumbel noise and the highest wins; in the other chunks an
        edge is drawn by its probability, which is the same.
        """
        seed = _mix(seed + self.index[token] * _U64(0x9E3779B97F4A7C15))
        steps, others = [], []
        n_steps = taken = 0
        # Chunks in the order of their lattices, so that equal ones are read together.
        at = np.argsort(node)
        node = node[at]
        while True:
            degree = self.degree[node]
            open_ = np.flatnonzero(degree)
            if len(open_) < len(at):
                at, node, degree = at[open_], node[open_], degree[open_]
            if not len(at):
                break
            bits = seed[at] + self.place[node] * _U64(0xD1B54A32D192ED03)
            chosen, best = np.empty(len(at), np.int64), np.zeros(len(at))
            mine = noted[at]
            own, drawn = np.flatnonzero(mine), np.flatnonzero(~mine)
            if len(drawn):
                uniform = _uniform(_mix(bits[drawn]))
                places = node[drawn]
                top, edge = self.top[places], self.top_edge[places]
                lower = np.flatnonzero(uniform >= top)
                if len(lower):
                    share = (uniform[lower] - top[lower]) / (1 - top[lower])
                    share = np.clip(share, 1e-9, 1 - 2e-9)
                    edge[lower] = self._drawn(places[lower], share)
                chosen[drawn] = edge
            if len(own):
                sizes = degree[own]
                begin = np.cumsum(sizes) - sizes
                first = self.first_edge[node[own]].astype(np.int64)
                edge = np.repeat(first - begin, sizes) + np.arange(begin[-1] + sizes[-1])
                # The noise of an edge is that of its place and its number there, from one.
                noise = bits[own] - (first - 1).astype(np.uint64) * _EDGE_STEP
                noise = np.repeat(noise, sizes) + edge.astype(np.uint64) * _EDGE_STEP
                value = self.log[edge] + _gumbel(_mix(noise))
                high = np.maximum.reduceat(value, begin)
                hit = np.flatnonzero(value == np.repeat(high, sizes))
                if len(hit) > len(own):
                    owner = np.searchsorted(begin, hit, "right")
                    hit = hit[np.concatenate(([True], owner[1:] != owner[:-1]))]
                chosen[own], best[own] = edge[hit], high
                rest = np.ones(len(edge), bool)
                rest[hit] = False
                others.append((np.repeat(own + n_steps, sizes - 1), edge[rest], value[rest]))
            steps.append((at, chosen, best))
            n_steps += len(at)
            node = self.next[chosen]
            taken += 1
        none = np.zeros(0, np.int64)
        if not steps:
            return (none, none, none.astype(float)), (none, none, none.astype(float))
        length = np.bincount(np.concatenate([s[0] for s in steps]), minlength=len(token))
        begin = np.cumsum(length) - length
        position = np.concatenate([begin[s[0]] + i for i, s in enumerate(steps)])
        found = [np.repeat(token, length)]
        for i in (1, 2):
            values = np.concatenate([s[i] for s in steps])
            found.append(np.empty_like(values))
            found[-1][position] = values
        if not others:
            return tuple(found), (none, none, none.astype(float))
        owner, edge, value = (np.concatenate(x) for x in zip(*others))
        return tuple(found), (position[owner], edge, value)


def _values(bound: float, plain: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """Perturbed values of siblings, given that none is above ``bound``, that of the best.

    ``plain`` are the values as drawn, ``gap`` how far each is below the best as drawn.
    """
    with np.errstate(divide="ignore"):
        v = bound - plain + np.log1p(-np.exp(np.minimum(gap, 0)))
    return bound - np.maximum(v, 0) - np.log1p(np.exp(-np.abs(v)))


def _floor(
    own: np.ndarray, start: np.ndarray, sums: np.ndarray, owner: np.ndarray, value: np.ndarray, k: int
) -> np.ndarray:
    """Per step, a value below which no sibling with more than a small gap is among the best k.

    They come after the ``k`` largest of the first steps alone, even with the largest
    correction that ``_values`` has for such a gap.
    """
    early = np.arange(len(own)) - start[own] < FIRST_STEPS
    some = np.flatnonzero(early[owner])
    text, ahead = own[owner[some]], sums[owner[some]] + value[some]
    order = np.lexsort((-ahead, text))
    count = np.bincount(text, minlength=len(start))
    enough = np.flatnonzero(count >= k)
    least = np.full(len(start), -np.inf)
    least[enough] = ahead[order[(np.cumsum(count) - count)[enough] + k - 1]]
    return least[own] + np.log(-np.expm1(-SMALL_GAP)) - 1e-6 - sums[:-1]


class _Text:
    """The search for one text: its paths and the states that wait."""

    def __init__(self, number: int, seed: np.uint64, value: float):
        self.number, self.seed = number, seed
        self.paths: list[tuple] = []  # (tokens, edges, log probability, value)
        self.waiting: list[tuple] = []  # (value, path, step, edge)
        # The state to go on from; at first that is the start, with the value of the whole.
        self.state: tuple | None = (value, None, 0, None)

    def begin(self, lattices: _Lattices):
        """Chunks and nodes still to walk, and the path so far (tokens, edges, log probability)."""
        first = int(lattices.first_token[self.number])
        end = first + int(lattices.size[self.number])
        _, path, step, edge = self.state
        if path is None:
            token = np.arange(first, end)
            none = np.zeros(0, np.int64)
            return token, lattices.start[token], (none, none, 0.0)
        old_tokens, old_edges = self.paths[path][:2]
        token = np.arange(int(old_tokens[step]), end)
        node = lattices.start[token]
        node[0] = lattices.next[edge]
        edges = np.append(old_edges[:step], edge)
        return token, node, (old_tokens[: step + 1], edges, float(lattices.log[edges].sum()))


def _walk_texts(lattices: _Lattices, texts: list[_Text], round_: int, k: int, whole: bool):
    """One more path for every text; returns the texts whose siblings were not all looked at."""
    parts = [t.begin(lattices) for t in texts]
    sizes = np.fromiter((len(p[0]) for p in parts), np.int64, len(parts))
    token = np.concatenate([p[0] for p in parts])
    node = np.concatenate([p[1] for p in parts])
    which = np.repeat(np.arange(len(texts)), sizes)
    order_in = np.arange(len(token)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    noted = np.ones(len(token), bool) if whole else order_in < FIRST_CHUNKS
    noise = _U64((round_ + 1) * 0xE7037ED1A0B428DB % (1 << 64))
    seeds = np.array([t.seed for t in texts], np.uint64)
    (token, edge, top), (owner, other, value) = lattices.walk(
        token, node, _mix(seeds[which] + noise), noted
    )
    # Steps are in the order of texts, and tokens belong to one text.
    number_of = {t.number: i for i, t in enumerate(texts)}
    lookup = np.full(len(lattices.size), -1)
    lookup[list(number_of)] = list(number_of.values())
    own = lookup[lattices.doc[token]]
    start = np.searchsorted(own, np.arange(len(texts)))
    end = np.searchsorted(own, np.arange(len(texts)), "right")
    log = lattices.log[edge]
    sums = np.concatenate(([0.0], np.cumsum(log)))
    gap = value - top[owner]
    able = np.flatnonzero((value >= _floor(own, start, sums, owner, value, k)[owner]) | (gap > -SMALL_GAP))
    owner, other, value, gap = owner[able], other[able], value[able], gap[able]
    of = own[owner]
    by_text = _order(of)
    owner, other, value, gap = owner[by_text], other[by_text], value[by_text], gap[by_text]
    high = np.cumsum(np.bincount(of, minlength=len(texts)))
    low = np.concatenate(([0], high[:-1]))
    ahead = sums[owner] + value
    again = []
    for i, text in enumerate(texts):
        a, b = int(start[i]), int(end[i])
        tokens, edges, above = parts[i][2]
        bound = text.state[0]
        s = slice(int(low[i]), int(high[i]))
        at, options = owner[s], other[s]
        plain = ahead[s] + (above - sums[a])
        if not whole and sizes[i] > FIRST_CHUNKS:
            # The first step that was not looked at, and the most its siblings may reach.
            last = int(parts[i][0][FIRST_CHUNKS - 1])
            step = a + int(np.searchsorted(token[a:b], last, "right"))
            most = above + sums[step] - sums[a] + 2 * LARGEST
            least = np.sort(plain)[-k] if len(plain) >= k else -np.inf
            if most > min(bound, least) - 1:
                again.append(text)
                continue
        values = _values(bound, plain, gap[s])
        text.paths.append(
            (
                np.concatenate((tokens, token[a:b])),
                np.concatenate((edges, edge[a:b])),
                above + float(sums[b] - sums[a]),
                bound,
            )
        )
        # No more than k of the new siblings can ever be taken.
        take = np.argpartition(-values, k - 1)[:k] if len(values) > k else np.arange(len(values))
        for j in take.tolist():
            step = len(edges) + int(at[j]) - a
            text.waiting.append((float(values[j]), len(text.paths) - 1, step, int(options[j])))
        text.waiting.sort(key=lambda w: -w[0])
        del text.waiting[k:]
        text.state = text.waiting.pop(0) if text.waiting else None
    return again


def sample_texts(
    vocab: Vocabulary, texts: list[str], seeds: np.ndarray, k: int, kept: _Kept | None = None
):
    """Up to ``k`` distinct segmentations of every text, best perturbed value first.

    Returns per text a list of (piece ids, log probability, perturbed value, log
    inclusion probability). The last one is taken at the first value not sampled.
    ``kept`` has lattices of earlier calls and gets those of this one.
    """
    lattices = _Lattices(vocab, texts, kept)
    best = _gumbel(_mix(seeds ^ _U64(0xA0761D6478BD642F)))
    searches = [_Text(i, seeds[i], float(best[i])) for i in range(len(texts))]
    for round_ in range(k):
        active = [t for t in searches if t.state is not None]
        if not active:
            break
        again = _walk_texts(lattices, active, round_, k, whole=False)
        if again:
            _walk_texts(lattices, again, round_, k, whole=True)
    edges = [path[1] for text in searches for path in text.paths]
    ends = np.cumsum([0, *map(len, edges)])
    ids, ends = vocab.expand(lattices.piece[np.concatenate([_NO_EDGES, *edges])], ends)
    ends = iter(zip(ends[:-1].tolist(), ends[1:].tolist()))
    out = []
    for text in searches:
        after = text.state[0] if text.state is not None else -np.inf
        rows = []
        for _, _, log, value in text.paths:
            odds = log - after  # log(1 - exp(-exp(odds)))
            share = np.log(-np.expm1(-np.exp(odds))) if -30 < odds < 30 else min(odds, 0.0)
            rows.append((ids[slice(*next(ends))], log, value, float(share)))
        out.append(rows)
    return out


def row_seeds(keys: list) -> np.ndarray:
    """Seed of each row from its key; equal keys have equal seeds, NULL is a key as well."""
    text = ["" if key is None else str(key) for key in keys]
    return np.array([xxhash.xxh64_intdigest(t.encode(), 8) for t in text], np.uint64)


_SAMPLE = (
    "sample int, ids array<int>, log_prob double, perturbed double, log_inclusion double"
)


def _sampled(docs: DataFrame, model: str, id_col: str, text_col: str, k, alpha, fields, columns):
    schema = docs.select(id_col).schema
    for field in docs.sparkSession.createDataFrame([], fields).schema:
        schema = schema.add(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model, alpha)
        kept = _Kept(vocab)
        kinds = _ARROW[fields].types
        for part in text_slices(batches, 1, SLICE_BYTES):
            raw = raw_texts(part.column(1))
            seeds = row_seeds(part.column(0).to_pylist())
            found = sample_texts(vocab, [r.decode() for r in raw], seeds, k, kept)
            owner = [i for i, samples in enumerate(found) for _ in samples]
            number = [n for samples in found for n in range(len(samples))]
            samples = list(zip(*[sample for samples in found for sample in samples]))
            made = columns(vocab, [raw[i] for i in owner], *samples)
            arrays = [part.column(0).take(pa.array(owner, pa.int64()))]
            arrays += [pa.array(v, t) for v, t in zip([number, *made], kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return docs.select(F.col(id_col), F.col(text_col).alias("__text")).mapInArrow(run, schema)


def sample_pieces(
    docs: DataFrame,
    model: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = SAMPLES,
    alpha: float = 1.0,
) -> DataFrame:
    """``k`` distinct sampled segmentations of every text.

    Result: ``id_col``, sample (from 0), ids, log_prob, perturbed (the value it was drawn
    by), log_inclusion (log probability that a text's samples hold it). ``alpha`` sharpens
    or flattens the distribution. A text with fewer than ``k`` segmentations has all
    of them, with log_inclusion 0; a NULL or empty text has one without pieces. Rows with
    the same id and text get the same samples. Other columns are not read.
    """

    def columns(vocab, raw, ids, *values):
        return [x.tolist() for x in ids], *values

    return _sampled(docs, model, id_col, text_col, k, alpha, _SAMPLE, columns)


def decode_pieces(df: DataFrame, model: str, ids_col: str = "ids", output: str = "text") -> DataFrame:
    """``df`` with the text of its piece ids as ``output``. NULL ids have a NULL text.

    The visible space character of the vocabulary always decodes to a space.
    """
    kept = [c for c in df.columns if c != output]
    source = df.select(*kept, F.col(ids_col).alias("__ids"))
    schema = source.drop("__ids").schema.add(output, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model)
        for part in batches:
            lists = part.column(len(kept)).to_pylist()
            texts = [None if ids is None else vocab.decode(ids) for ids in lists]
            arrays = [part.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(texts, pa.string())], names=schema.names)

    return source.mapInArrow(run, schema)


_DIGEST = (
    "sample int, n_pieces long, ids_crc32 long, log_prob double, perturbed double,"
    " log_inclusion double, decodes boolean"
)
_ARROW = {
    _SAMPLE: pa.schema(
        [("a", pa.int32()), ("b", pa.list_(pa.int32())), *[(c, pa.float64()) for c in "cde"]]
    ),
    _DIGEST: pa.schema(
        [
            ("a", pa.int32()), ("b", pa.int64()), ("c", pa.int64()),
            *[(c, pa.float64()) for c in "def"], ("g", pa.bool_()),
        ]
    ),
}


def sample_digest(
    docs: DataFrame,
    model: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = SAMPLES,
    alpha: float = 1.0,
) -> DataFrame:
    """``sample_pieces`` with counts and a checksum in place of the ids.

    ``decodes`` tells whether the ids give the text back; texts that hold the vocabulary's
    visible space character do not.
    """

    def columns(vocab, raw, ids, *values):
        crcs = [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]
        begin, data = vocab.decoded(np.concatenate(ids))
        ends = begin[np.cumsum([0, *map(len, ids)])].tolist()
        decodes = []
        for text, x, a, b in zip(raw, ids, ends, ends[1:]):
            # The text has a space in front.
            same = b - a == len(text) + 1 and data[a] == 32 and data[a + 1 : b] == text
            decodes.append(same or vocab.decode(x.tolist()) == text.decode())
        return [len(x) for x in ids], crcs, *values, decodes

    return _sampled(docs, model, id_col, text_col, k, alpha, _DIGEST, columns)

"""SentencePiece encoding, decoding, and distinct sampled segmentations.

Encoding. No piece of the vocabulary has a word mark behind another character, and none holds a line end. A text can
therefore be cut before every run of word marks and around line ends, and each chunk encoded for itself: the ids are
those of the whole text. Chunks repeat, so a task keeps the ids of frequent ones. (A vocabulary with other pieces is
encoded by whole texts.) Decoding joins the bytes of the pieces; every row says whether the text came back exactly.

Sampling. The lattice of a chunk has the places between characters as nodes and all pieces that match as edges; a
character without a piece has one edge of its bytes. Weights w(piece) are the model's probabilities or, for a merge
vocabulary whose scores are ranks only, 1 / (rank + SHIFT) by Zipf's law, to the power SMOOTHING. Backward sums give every edge its conditional
probability, so a prefix of a segmentation has a known mass. A text's segmentations are drawn without replacement by a
perturbed A* search: a subtree's largest perturbed log probability is a Gumbel variable at the log of its mass; the
child that attains it is drawn by its probability, and what remains of the node, its other children together, gets a
Gumbel variable truncated at the parent's. The open remainders are a queue whose head is the next best segmentation, so
k pops give the Gumbel top-k. The inclusion score is log(1 - exp(-exp(log_prob - kappa))), kappa being the next value in
the queue. Remainders below exp(CUT) of the text's mass are not queued: one would come up with probability exp(CUT / 2)
or less. Randomness comes from (seed, id) alone.

Defined cases: a null or empty text has no ids, no samples and one row of rank 0; a text with fewer than k segmentations
gives all of them, with inclusion score 0; a chunk of any length has one lattice, its backward sums being logs; texts with
a word mark of their own (U+2581) decode to a space and are reported as not exact; rows repeat as in the input, with
equal samples; a null id seeds as the word null; an empty table gives an empty result; further columns are passed over.
"""

from __future__ import annotations

import ctypes
import heapq
import math
import random
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalmill.llm import tokens
from fiscalmill.llm.common import own_columns

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
SHIFT, SMOOTHING = 2.7, 0.4
CUT = -60.0
REMEMBERED = 400_000
"""Chunks whose ids a task keeps."""
SAMPLE_CHARACTERS = 1_000_000
"""Characters of texts whose lattices are built together. A longer text is on its own."""
WINDOW = 256
"""Edges of a path among which the end of its mass is looked for first."""
SLOT_BITS, MULTIPLIER = 20, 0xC4CEB9FE1A85EC53
"""Of the table of all beginnings of pieces."""
MARK = "▁"


class Numbers:
    """Numbers of 64-bit keys, many at a time: a table of slots in which a key takes the first free one from its own on."""

    def __init__(self) -> None:
        self.size = 0
        self._room(1 << 16)

    def _room(self, slots: int) -> None:
        self.keys, self.found = np.zeros(slots, np.uint64), np.full(slots, -1, np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(65 - len(self.keys).bit_length())).astype(np.int64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of keys, -1 for those that are not there."""
        slots, out = self._slots(keys), np.full(len(keys), -1, np.int64)
        going = np.arange(len(keys))
        while len(going):
            found = self.found[slots]
            hit = self.keys[slots] == keys[going]
            out[going] = np.where(hit, found, -1)
            further = ~hit & (found >= 0)
            going, slots = going[further], (slots[further] + 1) & (len(self.keys) - 1)
        return out

    def add(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        """Distinct keys that are not there yet."""
        self.size += len(keys)
        if 3 * self.size > len(self.keys):
            there = self.found >= 0
            keys, numbers = np.concatenate([self.keys[there], keys]), np.concatenate([self.found[there], numbers])
            self._room(1 << (8 * self.size).bit_length())
        slots = self._slots(keys)
        while len(keys):
            free = self.found[slots] < 0
            self.keys[slots[free]], self.found[slots[free]] = keys[free], numbers[free]
            further = self.found[slots] != numbers
            keys, numbers, slots = keys[further], numbers[further], (slots[further] + 1) & (len(self.keys) - 1)


class Growing:
    """An array that values are added to."""

    def __init__(self, kind: type) -> None:
        self.room, self.size = np.empty(1024, kind), 0

    def add(self, values: np.ndarray) -> None:
        size = self.size + len(values)
        if size > len(self.room):
            room = np.empty(max(size, 2 * len(self.room)), self.room.dtype)
            room[: self.size] = self.values
            self.room = room
        self.room[self.size : size] = values
        self.size = size

    @property
    def values(self) -> np.ndarray:
        return self.room[: self.size]


class Known:
    """Chunks that were met, by number: their code points and their ids, and where those of each end."""

    def __init__(self) -> None:
        self.numbers, self.by_text = Numbers(), {}
        self.points, self.point_ends = Growing(np.uint32), Growing(np.int64)
        self.ids, self.id_ends = Growing(np.int32), Growing(np.int64)
        self.point_ends.add(np.zeros(1, np.int64))
        self.id_ends.add(np.zeros(1, np.int64))

    @property
    def size(self) -> int:
        return self.point_ends.size - 1

    def add_points(self, points: np.ndarray, sizes: np.ndarray) -> None:
        self.point_ends.add(self.points.size + np.cumsum(sizes))
        self.points.add(points)

    def points_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code points of chunks, joined, and how many each has."""
        ends = self.point_ends.values
        sizes = ends[numbers + 1] - ends[numbers]
        return self.points.values[ragged(ends[numbers], sizes)], sizes

    def ids_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks, joined, and where those of each end."""
        ends = self.id_ends.values
        sizes = ends[numbers + 1] - ends[numbers]
        return self.ids.values[ragged(ends[numbers], sizes)], np.cumsum(sizes)


@dataclass
class Cut:
    """Texts in which words are marked, joined, as code points, with the chunks they are cut into and how many each text has."""

    text: str
    points: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    counts: np.ndarray

    def chunk(self, i: int) -> str:
        return self.text[self.starts[i] : self.starts[i] + self.sizes[i]]


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs that begin at `starts`, run by run."""
    total = int(sizes.sum())
    kind = np.int32 if total < 1 << 30 and int(starts.max(initial=0)) < 1 << 30 else np.int64
    return np.repeat((starts - (np.cumsum(sizes) - sizes)).astype(kind), sizes) + np.arange(total, dtype=kind)


class Pieces:
    """A vocabulary with what encoding and sampling need."""

    def __init__(self, path: str) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(n)]
        special = [self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_unused(i) for i in range(n)]
        byte = {int(names[i][3:5], 16): i for i in range(n) if self.model.is_byte(i)}
        self.byte_ids = byte
        plain = [i for i in range(n) if not special[i] and not self.model.is_byte(i)]
        scores = np.array([self.model.get_score(i) for i in range(n)])
        ranked = all(float(s).is_integer() for s in scores[plain])
        order = {i: r for r, i in enumerate(plain)}
        value = [-math.log(order[i] + SHIFT) if ranked else scores[i] for i in plain]
        self.log_weight = np.full(n, -math.log(n + SHIFT) - math.log(len(byte) + 1))
        self.log_weight[plain] = value
        self.log_weight *= SMOOTHING
        self.mark_ids = [i for i in plain if names[i] == MARK] or self.model.encode(MARK)
        self.longest = max(len(names[i]) for i in plain)
        self.bytes = [b"" if special[i] else names[i].replace(MARK, " ").encode() for i in range(n)]
        for value_, i in byte.items():
            self.bytes[i] = bytes([value_])
        self.separable = not any(MARK in names[i].lstrip(MARK) or "\n" in names[i] for i in plain)
        self.known = Known()
        self.byte_ends = np.cumsum([len(b) for b in self.bytes])
        self.byte_sizes = np.diff(self.byte_ends, prepend=0)
        self.joined_bytes = np.frombuffer(b"".join(self.bytes), np.uint8)
        self._index({names[i]: i for i in plain})
        self.lead = tuple(self.model.encode("\n"))

    def cut(self, texts: list[str]) -> Cut:
        """Chunks of texts: a chunk begins at a run of word marks, at a line end and behind it. An empty text has none."""
        marked = [MARK + t.replace(" ", MARK) if t else "" for t in texts]
        text = "".join(marked)
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        begins = np.concatenate([[0], np.cumsum([len(t) for t in marked], dtype=np.int64)])
        starting = np.zeros(len(points) + 1, bool)
        starting[begins] = True
        if self.separable:
            line, mark = points == 10, points == ord(MARK)
            starting[:-1] |= line
            starting[1:-1] |= line[:-1] | (mark[1:] & ~mark[:-1])
        edges = np.flatnonzero(starting)
        counts = np.diff(np.searchsorted(edges, begins))
        return Cut(text, points, edges[:-1], np.diff(edges), counts)

    def chunks(self, text: str) -> list[str]:
        cut = self.cut([text])
        return [cut.chunk(i) for i in range(len(cut.starts))]

    def _index(self, pieces: dict[str, int]) -> None:
        """Every beginning of a piece by its hash: the piece that it is, and whether a longer one begins with it."""
        owners = {name[:n]: -1 for name in pieces for n in range(1, len(name) + 1)} | pieces
        longer = {name[:n] for name in pieces for n in range(1, len(name))}
        joined = np.frombuffer("".join(owners).encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
        sizes = np.array([len(name) for name in owners])
        places = ragged(np.zeros(len(sizes), np.int64), sizes)
        hashes = np.add.reduceat(joined * tokens.powers(tokens.BASE, self.longest)[places], np.cumsum(sizes) - sizes)
        slots = slots_of(hashes)
        order = np.argsort(slots)
        slots = slots[order]
        self.hashes = np.concatenate([hashes[order], np.zeros(1, np.uint64)])
        self.hash_ids = np.array([*owners.values(), -1])[[*order.tolist(), -1]]
        self.goes_on = np.array([*[name in longer for name in owners], False])[[*order.tolist(), -1]]
        self.most = int(np.bincount(slots).max())
        self.slots = np.full(1 << SLOT_BITS, len(slots), np.int64)
        self.slots[slots[::-1]] = np.arange(len(slots))[::-1]
        self.characters = self.find(np.arange(1, (1 << 16) + 1, dtype=np.uint64))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Places of hashes in the index; its last place for those that are not there."""
        end = len(self.hashes) - 1
        at = self.slots[slots_of(hashes)]
        other = np.flatnonzero(self.hashes[at] != hashes)
        for _ in range(self.most - 1):
            at[other] = np.minimum(at[other] + 1, end)
            other = other[self.hashes[at[other]] != hashes[other]]
        at[other] = end
        return at

    def of_character(self, points: np.ndarray) -> np.ndarray:
        """`find` of single characters."""
        common = self.characters[np.minimum(points, len(self.characters) - 1)]
        rare = np.flatnonzero(points >= len(self.characters))
        common[rare] = self.find(points[rare].astype(np.uint64) + np.uint64(1))
        return common

    def numbers(self, cut: Cut) -> np.ndarray:
        """Numbers of chunks. They hold until the next call, which may forget them.

        Chunks are looked up by hash and then compared with what is known under their number. One that differs is looked up
        by its text.
        """
        if self.known.size > REMEMBERED:
            self.known = Known()
        known = self.known
        sums = prefix_sums(cut.points.astype(np.uint64))
        own = (sums[cut.starts + cut.sizes] - sums[cut.starts]) * tokens.powers(tokens.INVERSE, len(sums))[cut.starts]
        hashes = tokens.mix(own + cut.sizes.astype(np.uint64))
        for i in np.flatnonzero(cut.sizes > tokens.LONG_WORD).tolist():
            hashes[i] = xxhash.xxh3_64_intdigest(cut.points[cut.starts[i] : cut.starts[i] + cut.sizes[i]].tobytes())
        found = known.numbers.of(hashes)
        unknown = np.flatnonzero(found < 0)
        keys, first, which = np.unique(hashes[unknown], return_index=True, return_inverse=True)
        known.numbers.add(keys, known.size + np.arange(len(keys)))
        found[unknown] = known.size + which
        new = unknown[first]
        known.add_points(cut.points[ragged(cut.starts[new], cut.sizes[new])], cut.sizes[new])
        texts = [cut.chunk(i) for i in new.tolist()]
        ends = known.point_ends.values
        other = ends[found + 1] - ends[found] != cut.sizes
        alike = np.flatnonzero(~other)
        same = known.points_of(found[alike])[0] == cut.points[ragged(cut.starts[alike], cut.sizes[alike])]
        if not same.all():
            other[alike[np.searchsorted(np.cumsum(cut.sizes[alike]), np.flatnonzero(~same), "right")]] = True
        for i in np.flatnonzero(other).tolist():
            text, count = cut.chunk(i), known.size
            found[i] = known.by_text.setdefault(text, count)
            if found[i] == count:
                texts.append(text)
                known.add_points(cut.points[cut.starts[i] : cut.starts[i] + cut.sizes[i]], cut.sizes[i : i + 1])
        if self.separable:
            self._learn(texts)
        return found

    def _learn(self, new: list[str]) -> None:
        """The ids of new chunks. A chunk without a word mark is encoded behind a line end, whose ids are then left out."""
        given = [c[1:].replace(MARK, " ") if c[0] == MARK else "\n" + c for c in new]
        found = self.model.encode(given, num_threads=1)
        for i in [i for i, text in enumerate(given) if not text]:
            found[i] = self.mark_ids
        left_out = np.array([0 if c[0] == MARK else len(self.lead) for c in new], np.int64)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum()))
        kept = sizes - left_out
        self.known.id_ends.add(self.known.ids.size + np.cumsum(kept))
        self.known.ids.add(ids[ragged(np.cumsum(sizes) - kept, kept)])

    def encode(self, text: str) -> list[int]:
        """The ids of a text, as the model itself gives them."""
        if not self.separable:
            return self.model.encode(text)
        return self.known.ids_of(self.numbers(self.cut([text])))[0].tolist()

    def decode(self, ids: list[int]) -> str:
        """The text of ids: bytes joined, without the space in front that encoding adds."""
        joined = b"".join(map(self.bytes.__getitem__, ids))
        return joined[1:].decode("utf-8", "replace") if joined[:1] == b" " else joined.decode("utf-8", "replace")

    def come_back(self, ids: np.ndarray, ends: np.ndarray, texts: list[str]) -> list[bool]:
        """Whether rows of ids, joined in `ids`, decode to their texts. All are decoded at once, and compared as bytes."""
        sizes = self.byte_sizes[ids]
        decoded = self.joined_bytes[ragged(self.byte_ends[ids] - sizes, sizes)].tobytes()
        bounds = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], ends])].tolist()
        rows, exact = np.concatenate([[0], ends]).tolist(), []
        given = {text: _valid(text) for text in texts}
        for i, text in enumerate(texts):
            start = bounds[i] + (decoded[bounds[i] : bounds[i] + 1] == b" " and bounds[i] < bounds[i + 1])
            # Equal bytes that are valid are the text. Of others, what is not valid is replaced before comparing.
            same = decoded[start : bounds[i + 1]] == given[text]
            exact.append(same or self.decode(ids[rows[i] : rows[i + 1]].tolist()) == text)
        return exact

    def expand(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of edges, and where those of each edge end: a negative one stands for the bytes of the character -1 - id."""
        below = ids < 0
        if not below.any():
            return ids, np.arange(1, len(ids) + 1)
        points, which = np.unique(ids[below], return_inverse=True)
        parts = [self.character(-1 - p) for p in points.tolist()]
        sizes = np.ones(len(ids), np.int64)
        sizes[below] = np.array([len(x) for x in parts])[which]
        out = np.repeat(ids, sizes)
        starts = np.cumsum(sizes) - sizes
        for i, part in enumerate(parts):
            at = starts[below][which == i]
            for j, x in enumerate(part):
                out[at + j] = x
        return out, np.cumsum(sizes)

    def character(self, point: int) -> list[int]:
        return [self.byte_ids[b] for b in chr(point).encode("utf-8", "surrogatepass")]


def keep_memory() -> None:
    """Arrays of some MB are made and dropped all the time: the allocator keeps their pages instead of returning each."""
    try:
        allocator = ctypes.CDLL("libc.so.6")
        allocator.mallopt(-3, 32 << 20)  # from this size on, memory of its own
        allocator.mallopt(-1, 256 << 20)  # free memory at the end that is kept
    except (OSError, AttributeError):  # another allocator
        pass


def _valid(text: str) -> bytes | None:
    """A text in UTF-8, None if it has characters that UTF-8 has not."""
    try:
        return text.encode()
    except UnicodeEncodeError:
        return None


class Lattices:
    """Lattices of many chunks at once. A node is a place in a chunk, the last one `n` is the end of all chunks.

    Nodes are numbered by what is left of their chunk, and then by chunk, longer ones first: places with at least so many
    characters left are one range, and so are the edges of all nodes at one distance from the end.
    """

    def __init__(self, pieces: Pieces, numbers: np.ndarray) -> None:
        given = pieces.known.point_ends.values[numbers + 1] - pieces.known.point_ends.values[numbers]
        by_size = np.argsort(-given, kind="stable")
        points, sizes = pieces.known.points_of(numbers[by_size])
        n = self.n = len(points)
        longest = int(sizes.max(initial=0))
        wide = np.searchsorted(-sizes, -np.arange(1, longest + 1), "right")  # chunks with so many characters at least
        base = np.concatenate([[0, 0], np.cumsum(wide)])  # first node with so many characters left
        self.left = np.repeat(np.arange(1, longest + 1), wide)
        rank = np.arange(n) - base[self.left]
        place = (np.cumsum(sizes))[rank] - self.left if n else np.zeros(0, np.int64)
        self.entry = np.empty(len(numbers), np.int64)
        self.entry[by_size] = base[sizes] + np.arange(len(sizes))

        single = pieces.of_character(points)[place]
        alone = -1 - points[place].astype(np.int64)
        points = points.astype(np.uint64) + np.uint64(1)
        nodes, lengths = np.arange(n), range(1, min(pieces.longest, longest) + 1)
        last, hashes = place, points[place]
        count, found = np.ones(n, np.int32), []
        for length in lengths:
            if length == 1:
                at = single
                ids = pieces.hash_ids[at]
                found.append((nodes, np.where(ids < 0, alone, ids)))
            else:
                longer = int(np.searchsorted(nodes, base[length]))
                nodes, last = nodes[longer:], last[longer:] + 1
                hashes = hashes[longer:] + points[last] * tokens.powers(tokens.BASE, pieces.longest)[length - 1]
                at = pieces.find(hashes)
                ids = pieces.hash_ids[at]
                hit = np.flatnonzero(ids >= 0)
                found.append((nodes[hit], ids[hit]))
                count[found[-1][0]] += 1
            going = np.flatnonzero(pieces.goes_on[at])
            nodes, last, hashes = nodes[going], last[going], hashes[going]
        self.first = np.concatenate([[0], np.cumsum(count)])
        edges, free = int(self.first[-1]), self.first[:-1].copy()
        self.ids, self.end = np.empty(edges, np.int32), np.empty(edges, np.int64)
        for length, (nodes, ids) in zip(lengths, found, strict=True):
            slot, rest = free[nodes], self.left[nodes] - length
            self.ids[slot] = ids
            self.end[slot] = np.where(rest > 0, base[rest] + rank[nodes], n)
            free[nodes] += 1
        self.start = np.repeat(np.arange(n, dtype=np.int32), count)

        weight = pieces.log_weight[np.maximum(self.ids, 0)]
        alone = np.flatnonzero(self.ids < 0)
        if len(alone):
            kinds, which = np.unique(self.ids[alone], return_inverse=True)
            weight[alone] = np.array([sum(pieces.log_weight[i] for i in pieces.character(-1 - k)) for k in kinds.tolist()])[which]
        total = np.zeros(n + 1)
        parts = base[1:].tolist()
        bounds = self.first[base[1:]].tolist()
        for low, high, a, b in zip(bounds[:-1], bounds[1:], parts[:-1], parts[1:], strict=True):
            logs, at = weight[low:high] + total[self.end[low:high]], self.first[a:b] - low
            most = np.maximum.reduceat(logs, at)
            total[a:b] = most + np.log(np.add.reduceat(np.exp(logs - np.repeat(most, count[a:b])), at))
        self.log_share = np.minimum(weight + total[self.end] - total[self.start], 0.0)
        self.share = np.exp(self.log_share)
        reached = np.concatenate([[0.0], np.cumsum(self.share)])
        self.within = reached[1:] - reached[self.first[self.start]]
        self.within[self.first[1:] - 1] = 1.0

    def step(self, nodes: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge out of each node, by its probability."""
        edge = self.first[nodes]
        going = np.flatnonzero(self.within[edge] <= u)
        while len(going):
            edge[going] += 1
            going = going[self.within[edge[going]] <= u[going]]
        return edge

    def one_step(self, node: int, u: float) -> int:
        """`step` of one node."""
        edge = int(self.first[node])
        while self.within[edge] <= u:
            edge += 1
        return edge

    def walk(self, chunk: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Random paths through chunks, all in step: the edges, path by path, and where each path begins."""
        nodes, going = self.entry[chunk], np.arange(len(chunk))
        size, count = self.left[nodes], np.zeros(len(chunk), np.int64)
        taken = []
        while len(going):
            edge = self.step(nodes, uniform(seeds[going], size[going] - self.left[nodes]))
            taken.append((going, edge))
            count[going] += 1
            nodes = self.end[edge]
            further = nodes < self.n
            nodes, going = nodes[further], going[further]
        begins = np.concatenate([[0], np.cumsum(count)])
        edges = np.empty(int(begins[-1]), np.int64)
        for turn, (going, edge) in enumerate(taken):
            edges[begins[going] + turn] = edge
        return edges, begins


def prefix_sums(points: np.ndarray) -> np.ndarray:
    out = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points + np.uint64(1)) * tokens.powers(tokens.BASE, len(points)), out=out[1:])
    return out


def slots_of(hashes: np.ndarray) -> np.ndarray:
    return ((hashes * np.uint64(MULTIPLIER)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def uniform(seeds: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) that depend on seed and place alone."""
    mixed = tokens.mix(seeds + (places.astype(np.uint64) + np.uint64(1)) * np.uint64(tokens.BASE))
    return (mixed >> np.uint64(11)) * 2.0**-53


def seed_of(name: str) -> int:
    return xxhash.xxh64_intdigest(name)


class Drawn:
    """Segmentations of texts: ids joined, where those of each end, how many a text has, and their scores."""

    def __init__(self, pieces: Pieces, lattices: Lattices | None, found: list[list[tuple[np.ndarray, float, float]]]) -> None:
        rows = [row for own in found for row in own]
        edges = np.concatenate([row[0] for row in rows]) if rows else np.zeros(0, np.int64)
        last = np.cumsum([len(row[0]) for row in rows], dtype=np.int64)
        self.ids, ends = (edges.astype(np.int32), last) if lattices is None else pieces.expand(lattices.ids[edges])
        self.ends = np.concatenate([[0], ends])[last]
        self.counts = [len(own) for own in found]
        self.log_prob, self.log_inclusion = [row[1] for row in rows], [row[2] for row in rows]


def draw(pieces: Pieces, chunk: np.ndarray, counts: np.ndarray, names: list[str], k: int) -> Drawn:
    """Up to k distinct segmentations of every text, best perturbed log probability first.

    `chunk` has the numbers of the texts' chunks, text by text, and `counts` how many a text has.
    """
    if not len(chunk):
        return Drawn(pieces, None, [[] for _ in names])
    used = np.flatnonzero(np.bincount(chunk))
    lattices = Lattices(pieces, used)
    place_of = np.zeros(int(used[-1]) + 1, np.int64)
    place_of[used] = np.arange(len(used))
    chunk = place_of[chunk]
    offsets = np.concatenate([[0], np.cumsum(counts)])
    text_of = np.repeat(np.arange(len(names)), counts)
    place = (np.arange(len(chunk)) - offsets[text_of]).astype(np.uint64)
    seeds = np.array([seed_of(n) for n in names], np.uint64)
    fresh = []
    for s in range(k):
        own = tokens.mix(tokens.mix(seeds[text_of] + np.uint64(2 * s + 1)) + place * np.uint64(tokens.INVERSE))
        fresh.append(lattices.walk(chunk, own))
    searches = [
        Search(lattices, fresh, a, b, seed, k) for a, b, seed in zip(offsets[:-1].tolist(), offsets[1:].tolist(), seeds.tolist(), strict=True)
    ]
    first_remainders(lattices, *fresh[0], [s for s in searches if s.high > s.low], k)
    return Drawn(pieces, lattices, [s.run() if s.high > s.low else [] for s in searches])


def first_remainders(lattices: Lattices, edges: np.ndarray, begins: np.ndarray, searches: list[Search], k: int) -> None:
    """`Search.remainders` of the first paths of all texts at once, but for those whose mass ends beyond the window."""
    low, high = (begins[np.array([getattr(s, side) for s in searches])] for side in ("low", "high"))
    places = np.arange(WINDOW)
    at = low[:, None] + places
    there = at < high[:, None]
    own = edges[np.minimum(at, len(edges) - 1)]
    logs = np.where(there, lattices.log_share[own], 0.0)
    before = np.concatenate([np.zeros((len(low), 1)), np.cumsum(logs, axis=1)], axis=1)
    near = -before < -CUT
    done = (high - low <= WINDOW) | ~near[:, -1]
    nodes = lattices.start[own]
    text, t = np.nonzero(there & near[:, :-1] & (lattices.first[nodes + 1] - lattices.first[nodes] > 1))
    best = np.array([s.best for s in searches])
    seeds = np.array([s.seed for s in searches], np.uint64)
    values = np.full(logs.shape, -np.inf)
    values[text, t] = masses(before[text, t], logs[text, t], uniform(seeds[text], t), best[text])
    order = np.argsort(-values, axis=1)[:, : k + 1]
    found = np.take_along_axis(values, order, axis=1)
    chosen = np.take_along_axis(own, order, axis=1)
    for s, ready, value, place, edge in zip(searches, done.tolist(), found.tolist(), order.tolist(), chosen.tolist(), strict=True):
        if ready:
            s.queue = [(-v, 0, p, (e,)) for v, p, e in zip(value, place, edge, strict=True) if v > -np.inf]
            heapq.heapify(s.queue)
        s.ready = ready


def masses(before: np.ndarray, logs: np.ndarray, u: np.ndarray, best: np.ndarray | float) -> np.ndarray:
    """Perturbed log masses of what is left of nodes, below `best`."""
    left = before + np.log(np.maximum(-np.expm1(logs), 1e-300))
    free = left - np.log(-np.log(np.maximum(u, 1e-300)))
    return left - np.logaddexp(left - best, left - free)


def sampled(pieces: Pieces, texts: list[str], names: list[str], k: int) -> list[list[tuple[np.ndarray, float, float]]]:
    """For every text up to k distinct segmentations, best perturbed log probability first: (ids, log_prob, log_inclusion)."""
    cut = pieces.cut(texts)
    drawn = draw(pieces, pieces.numbers(cut), cut.counts, names, k)
    parts = np.split(drawn.ids, drawn.ends[:-1]) if len(drawn.ends) else []
    rows = iter(zip(parts, drawn.log_prob, drawn.log_inclusion, strict=True))
    return [[next(rows) for _ in range(n)] for n in drawn.counts]


class Search:
    """Perturbed A* search over the lattice of one text, whose chunks are those from `low` up to `high`."""

    def __init__(self, lattices: Lattices, fresh: list, low: int, high: int, seed: int, k: int) -> None:
        self.lattices, self.fresh, self.low, self.high, self.k = lattices, fresh, low, high, k
        self.draw, self.seed = random.Random(seed).random, seed & ((1 << 62) - 1)
        self.best, self.ready = gumbel(self.draw), False
        """Perturbed log probability of the first path, and whether what is left beside it is queued already."""
        self.queue: list = []
        self.paths: list[tuple[np.ndarray, np.ndarray]] = []
        """Edges, and where each chunk begins in them."""

    def remainders(self, edges: np.ndarray, since: int, best: float) -> None:
        """Queues what is left of the nodes of a path from the edge `since` on, as far as their mass reaches."""
        window = WINDOW
        while True:
            near = edges[:window]
            logs = self.lattices.log_share[near]
            before = np.concatenate([[0.0], np.cumsum(logs)])
            reach = int(np.searchsorted(-before, -CUT))  # masses only fall
            if reach <= len(near) or len(near) == len(edges):
                break
            window *= 4
        own = self.lattices.start[near[since:reach]]
        at = since + np.flatnonzero(self.lattices.first[own + 1] - self.lattices.first[own] > 1)
        if not len(at):
            return
        u = uniform(np.full(len(at), self.seed + len(self.paths), np.uint64), at)
        values = masses(before[at], logs[at], u, best)
        for i in np.argsort(-values)[: self.k + 1].tolist():
            t = int(at[i])
            heapq.heappush(self.queue, (-float(values[i]), len(self.paths), t, (int(edges[t]),)))

    def branch(self, item: tuple) -> None:
        """The best segmentation of a remainder: another child of its node, then fresh steps to the end."""
        lattices = self.lattices
        negative, parent, t, taken = item
        edges, begins = self.paths[parent]
        node = int(lattices.start[edges[t]])
        others = [e for e in range(int(lattices.first[node]), int(lattices.first[node + 1])) if e not in taken]
        shares = [float(lattices.share[e]) for e in others]
        goal, chosen = self.draw() * sum(shares), others[-1]
        for e, share in zip(others, shares, strict=True):
            goal -= share
            if goal < 0:
                chosen = e
                break
        mass = float(lattices.log_share[edges[:t]].sum())
        rest = sum(s for e, s in zip(others, shares, strict=True) if e != chosen)
        if len(others) > 1 and rest > 0 and mass + math.log(rest) > CUT:
            left = mass + math.log(rest)
            heapq.heappush(self.queue, (-truncated(gumbel(self.draw) + left, -negative, left), parent, t, (*taken, chosen)))
        path, at = [chosen], int(lattices.end[chosen])
        while at < lattices.n:
            path.append(lattices.one_step(at, self.draw()))
            at = int(lattices.end[path[-1]])
        following = int(np.searchsorted(begins, t, "right"))  # the chunk after that of the edge
        new, new_begins = self.own(len(self.paths))
        tail = int(new_begins[following])
        joined = np.concatenate([edges[:t], path, new[tail:]]).astype(np.int64)
        shifted = np.concatenate([begins[:following], new_begins[following:] + (t + len(path) - tail)])
        self.add(joined, shifted, t + 1, -negative)

    def own(self, s: int) -> tuple[np.ndarray, np.ndarray]:
        """The text's part of the walks number s."""
        edges, begins = self.fresh[s]
        begins = begins[self.low : self.high + 1]
        return edges[begins[0] : begins[-1]], begins - begins[0]

    def add(self, edges: np.ndarray, begins: np.ndarray, since: int, best: float) -> None:
        if self.paths or not self.ready:
            self.remainders(edges, since, best)
        self.paths.append((edges, begins))

    def run(self) -> list[tuple[np.ndarray, float, float]]:
        """(edges, log_prob, log_inclusion) of the segmentations."""
        self.add(*self.own(0), 0, self.best)
        while self.queue and len(self.paths) < self.k:
            self.branch(heapq.heappop(self.queue))
        kappa = -self.queue[0][0] if self.queue else -math.inf
        out = []
        for path, _ in self.paths:
            log_prob = min(0.0, float(self.lattices.log_share[path].sum()))
            inclusion = 0.0 if kappa == -math.inf else _inclusion(log_prob - kappa)
            out.append((path, log_prob, inclusion))
        return out


def gumbel(draw) -> float:
    return -math.log(-math.log(max(draw(), 1e-300)))


def truncated(free: float, most: float, place: float) -> float:
    """A Gumbel variable at `place` limited to values below `most`, from a free one."""
    a, b = place - most, place - free
    high = max(a, b)
    return place - (high + math.log(math.exp(a - high) + math.exp(b - high)))


def _inclusion(x: float) -> float:
    """log(1 - exp(-exp(x)))"""
    if x < -30:
        return x
    return math.log(-math.expm1(-math.exp(min(x, 50.0))))


RESULT = "doc_id long, rank int, n_tokens int, ids array<int>, log_prob double, log_inclusion double, exact boolean"
COLUMNS = ["doc_id", "rank", "n_tokens", "ids", "log_prob", "log_inclusion", "exact"]


def encoded(pieces: Pieces, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The chunks of texts as numbers, how many a text has, the texts' ids joined, and where those of each end."""
    cut = pieces.cut(texts)
    chunk = pieces.numbers(cut)
    if pieces.separable:
        ids, ends = pieces.known.ids_of(chunk)
        return chunk, cut.counts, ids, np.concatenate([[0], ends])[np.cumsum(cut.counts)]
    found = [pieces.encode(t) for t in texts]
    joined = np.array([i for own in found for i in own], np.int32)
    return chunk, cut.counts, joined, np.cumsum([len(own) for own in found], dtype=np.int64)


def rows_of(pieces: Pieces, doc_ids: list[int | None], texts: list[str], names: list[str], k: int) -> pa.RecordBatch:
    """The rows of `segmentations` for some texts."""
    chunk, counts, ids, ends = encoded(pieces, texts)
    drawn = draw(pieces, chunk, counts, names, k)
    # The model's own encodings stand before all samples; `order` puts each text's rows together.
    more = np.array(drawn.counts, np.int64)
    text_of = np.concatenate([np.arange(len(texts)), np.repeat(np.arange(len(texts)), more)])
    rank = np.concatenate([np.zeros(len(texts), np.int64), 1 + ragged(np.zeros(len(texts), np.int64), more)])
    order = np.lexsort((rank, text_of))
    joined, last = np.concatenate([ids, drawn.ids]), np.concatenate([ends, len(ids) + drawn.ends])
    exact = pieces.come_back(joined, last, [texts[i] for i in text_of.tolist()])
    sizes = np.diff(last, prepend=0)
    values = joined[ragged((last - sizes)[order], sizes[order])]
    offsets = np.concatenate([[0], np.cumsum(sizes[order])])
    none = [None] * len(texts)
    scores = [pa.array([(none + column)[i] for i in order.tolist()], pa.float64()) for column in (drawn.log_prob, drawn.log_inclusion)]
    columns = [
        pa.array([doc_ids[i] for i in text_of[order].tolist()], pa.int64()),
        pa.array(rank[order], pa.int32()),
        pa.array(sizes[order], pa.int32()),
        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32())),
        *scores,
        pa.array(np.array(exact, bool)[order]),
    ]
    return pa.RecordBatch.from_arrays(columns, names=COLUMNS)


def segmentations(docs: DataFrame, model: str = MODEL, k: int = SAMPLES, seed: int = 1) -> DataFrame:
    """A row per document and segmentation: rank 0 is the model's own encoding, ranks 1 to k are the samples.

    `exact` says whether the ids decode to the text. The model file is read in the tasks, from the same path everywhere.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_memory()
        pieces = Pieces(model)
        for part in parts:
            doc_ids, texts = part.column("doc_id").to_pylist(), [t or "" for t in part.column("text").to_pylist()]
            names = [f"{seed}:{'null' if x is None else x}" for x in doc_ids]
            for a, b in tokens.batches([len(t) for t in texts], SAMPLE_CHARACTERS):
                yield rows_of(pieces, doc_ids[a:b], texts[a:b], names[a:b], k)

    own = own_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return own.mapInArrow(run, RESULT)

"""Near-duplicate groups by SimHash fingerprints, with an inverted index over byte positions.

1. Every text gives a fingerprint of 64 bits: a bit is set if it is set in over half the hashes of the text's word
   shingles, repeats included. Texts with equal fingerprints are one class; from here on each fingerprint is there once.
2. Two fingerprints that differ in at most d bits differ in at most d of their eight bytes. So they share at least 8 - d
   positional bytes (position, value): the guaranteed minimum of the count filter. The index has one posting list for
   every choice of 8 - d positions and their values; a pair reaches the minimum exactly if some list holds both. A list
   can hold no more than 256 ** d fingerprints, since only d bytes are free: 65,536 for d = 2, whatever the data.
3. Lists are dealt out by their key and read in order. On a list, the positional bytes that a pair shares are tallied;
   pairs at the minimum are on this list only, pairs above it are on several and are looked at on the first of them. They
   are verified by the number of differing bits. Long lists look up the neighbours of each fingerprint instead of meeting
   all pairs. A list gives one link for each member that is not its component's smallest, not one for each pair.
4. Components of the links give the groups.

Defined cases: a null or empty text, and one without words, has fingerprint zero, which is linked like any other; with
fewer words than a shingle the whole sequence is the one shingle; a null id is no smallest id unless all ids of a group
are null; rows that repeat, in text, id or both, are rows of their own; an empty table gives an empty result; texts of any
length are read in portions; further columns are passed over.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalmill.llm.common import own_columns
from fiscalmill.llm.graph import components
from fiscalmill.llm.word_runs import LOWER, word_runs
from fiscalmill.operators.lookup import salted_join
from fiscalmill.sources.staging import stage

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
GAP = re.compile(rb"[\x20\x09-\x0D]")
SEED = 42
BYTES = 8
SHORT_LIST = 48
"""A list with more members looks up neighbours; below, comparing members is quicker. Both find the same pairs."""


@dataclass(frozen=True)
class Likeness:
    """Words of a shingle, and differing bits up to which fingerprints are linked (1 to 3)."""

    words: int = 3
    bits: int = 2

    @property
    def free(self) -> list[tuple[int, ...]]:
        """The positions that each kind of posting list leaves free."""
        return list(combinations(range(BYTES), self.bits))


CONTRACT = Likeness()


def shingle_hashes(text: bytes, k: int) -> Iterator[np.ndarray]:
    """Hashes of the k-word shingles of a lower-case text, in portions."""
    seen = False
    for run in word_runs(text, WORD, GAP, overlap=k - 1):
        joined = b" ".join(run)
        ends = list(accumulate(len(w) + 1 for w in run))
        starts = [0, *ends]
        if len(run) >= k:
            seen = True
            each = zip(starts, ends[k - 1 :], strict=False)
            yield np.array([xxhash.xxh64_intdigest(joined[a : b - 1], SEED) for a, b in each], np.uint64)
    if not seen and (words := WORD.findall(text)):
        yield np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)


def fingerprint(text: bytes | None, k: int = CONTRACT.words) -> int:
    """Majority of the shingle hashes, bit by bit."""
    votes, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes((text or b"").translate(LOWER), k):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, BYTES), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int.from_bytes(np.packbits(2 * votes > n, bitorder="little").tobytes(), "little", signed=True)


def _printed(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = pa.array([fingerprint(t.as_py(), k) for t in batch.column("text")], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), prints], names=["doc_id", "print"])

    return run


def _mask(free: tuple[int, ...]) -> int:
    """All bits but those of the free positions, as a signed number. Position 0 is the lowest byte."""
    kept = b"".join(b"\x00" if p in free else b"\xff" for p in range(BYTES))
    return int.from_bytes(kept, "little", signed=True)


def postings(prints: DataFrame, like: Likeness) -> DataFrame:
    """(list, shared, print): every fingerprint on each of its posting lists."""
    each = [
        F.struct(F.lit(i).cast("byte").alias("list"), F.col("print").bitwiseAND(F.lit(_mask(free))).alias("shared"))
        for i, free in enumerate(like.free)
    ]
    return prints.select("print", F.explode(F.array(*each)).alias("p")).select("p.list", "p.shared", "print")


def tally(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of positional bytes that fingerprints share."""
    return (a[:, None].view(np.uint8) == b[:, None].view(np.uint8)).sum(axis=1)


def _first_list(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """The first list that holds a pair: it leaves the differing positions free and then the lowest others."""
    differs = a[:, None].view(np.uint8) != b[:, None].view(np.uint8)
    chosen = np.sort(np.argsort(~differs, axis=1, kind="stable")[:, :bits], axis=1)
    number = np.zeros((BYTES,) * bits, np.int64)
    for i, free in enumerate(combinations(range(BYTES), bits)):
        number[free] = i
    return number[tuple(chosen.T)]


def _neighbours(prints: np.ndarray, free: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places in one long list whose fingerprints differ in at most `bits` bits. `prints` are sorted."""
    places = [8 * p + i for p in free for i in range(8)]
    flips = [sum(1 << x for x in c) for n in range(1, bits + 1) for c in combinations(places, n)]
    left, right, own = [], [], np.arange(len(prints))
    for flip in flips:
        wanted = prints ^ np.uint64(flip)
        at = np.minimum(np.searchsorted(prints, wanted), len(prints) - 1)
        hit = (prints[at] == wanted) & (own < at)
        left.append(own[hit])
        right.append(at[hit])
    return np.concatenate(left), np.concatenate(right)


def _close_pairs(prints: np.ndarray, first: np.ndarray, sizes: np.ndarray, kinds: np.ndarray, like: Likeness) -> tuple[np.ndarray, np.ndarray]:
    """Places of the verified pairs of many lists; list i has sizes[i] members from first[i] on, each list sorted."""
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    short = np.repeat((sizes > 1) & (sizes <= SHORT_LIST), sizes)
    list_of = np.repeat(np.arange(len(sizes)), sizes)
    for step in range(1, min(SHORT_LIST, int(sizes.max(initial=1)))):
        a = np.flatnonzero(short[:-step] & (list_of[:-step] == list_of[step:]))
        if not len(a):
            break
        left.append(a)
        right.append(a + step)
    for i in np.flatnonzero(sizes > SHORT_LIST):
        a, b = _neighbours(prints[first[i] : first[i] + sizes[i]], like.free[kinds[i]], like.bits)
        left.append(a + first[i])
        right.append(b + first[i])
    a, b = np.concatenate(left), np.concatenate(right)
    shared = tally(prints[a], prints[b])
    enough = (shared >= BYTES - like.bits) & (np.bitwise_count(prints[a] ^ prints[b]) <= like.bits)
    a, b, shared = a[enough], b[enough], shared[enough]
    here = shared == BYTES - like.bits
    here[~here] = _first_list(prints[a[~here]], prints[b[~here]], like.bits) == kinds[list_of[a[~here]]]
    return a[here], b[here]


def _lowest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For every place the smallest place of its component."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        following = label.copy()
        np.minimum.at(following, a, low)
        np.minimum.at(following, b, low)
        following = following[following]
        if (following == label).all():
            return label
        label = following


def _linked(like: Likeness) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Links (a, b) of posting lists that arrive in order; a list may run over several batches."""

    def links(rows: np.ndarray) -> pa.RecordBatch:
        kinds, shared, prints = rows["list"], rows["shared"], np.ascontiguousarray(rows["print"])
        starts = np.ones(len(rows), bool)
        starts[1:] = (kinds[1:] != kinds[:-1]) | (shared[1:] != shared[:-1])
        first = np.flatnonzero(starts)
        sizes = np.diff(np.append(first, len(rows)))
        # Within a list the rows come in signed order; neighbours are looked up in unsigned order.
        order = np.lexsort((prints, np.repeat(np.arange(len(sizes)), sizes)))
        prints = prints[order]
        a, b = _close_pairs(prints, first, sizes, kinds[first], like)
        label = _lowest(len(prints), a, b)
        member = np.flatnonzero(label != np.arange(len(prints)))
        signed = prints.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(signed[member]), pa.array(signed[label[member]])], names=["a", "b"])

    kind = np.dtype([("list", np.int64), ("shared", np.int64), ("print", np.uint64)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_list = np.zeros(0, kind)
        for batch in batches:
            rows = np.zeros(batch.num_rows, kind)
            for name in ("list", "shared"):
                rows[name] = batch.column(name).to_numpy(zero_copy_only=False)
            rows["print"] = batch.column("print").to_numpy(zero_copy_only=False).view(np.uint64)
            rows = np.concatenate([open_list, rows])
            if not len(rows):
                continue
            last = (rows["list"] == rows["list"][-1]) & (rows["shared"] == rows["shared"][-1])
            open_list = rows[last]
            yield links(rows[~last])
        yield links(open_list)

    return run


def links(prints: DataFrame, like: Likeness = CONTRACT) -> DataFrame:
    """Links (a, b) between different fingerprints; their components are those of all pairs within `like.bits` bits."""
    lists = postings(prints, like).repartition("list", "shared").sortWithinPartitions("list", "shared", "print")
    return lists.mapInArrow(_linked(like), "a long, b long")


def groups(docs: DataFrame, like: Likeness = CONTRACT) -> DataFrame:
    """doc_id, fingerprint and component_id (the smallest id of the row's group) of every document."""
    own = own_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    printed = own.mapInArrow(_printed(like.words), "doc_id long, print long").withColumn("place", F.monotonically_increasing_id())
    printed = stage(printed, "fingerprints")
    classes = stage(printed.groupBy("print").agg(F.min("doc_id").alias("low")), "classes")
    roots = components(links(classes.select("print"), like))
    rooted = classes.join(roots, classes["print"] == roots["id"], "left").select("print", "low", F.coalesce("root", "print").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    found = stage(rooted.join(lowest, "root").select("print", "component_id"), "components")
    joined = salted_join(printed, found, ["print"], ["place"])
    return joined.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")

"""Repeats of a fixed length across a corpus, narrowed down to contexts of shared anchors.

A document is a sequence of symbols (bytes or words). An anchor is a run of `anchor` symbols that has the smallest hash
of some window of `length` symbols (a minimiser). Two equal windows choose the same anchors, so every repeat of `length`
symbols shares an anchor with its copy. The context of an anchor is what all windows around it cover.

`occurrences` finds the anchors that occur at least twice, with a hash of their contexts. Equal contexts form a class,
which later steps treat once. Texts are compressed before they are shuffled by document; later joins by document use the
same exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fiscalmill.llm import tokens
from fiscalmill.llm.common import own_columns

NO_ID = (1 << 63) - 1
"""Stands for a null id: larger than every other."""


@dataclass(frozen=True)
class Shape:
    """Symbols in a repeat and in an anchor, and whether a symbol is a word (else a byte)."""

    length: int
    anchor: int
    words: bool

    @property
    def window(self) -> int:
        return self.length - self.anchor + 1

    @property
    def margin(self) -> int:
        return self.length - self.anchor


@dataclass
class Symbols:
    """Symbols of a batch of texts: hashes of all, prefix sums of their polynomial, offsets of the texts."""

    offsets: np.ndarray
    summed: np.ndarray
    words: tokens.Words | None

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of the runs of symbols [start, end)."""
        return tokens.mix((self.summed[end] - self.summed[start]) * tokens.powers(tokens.INVERSE, len(self.summed))[start] + (end - start).astype(np.uint64))


def symbols_of(texts: list[bytes], words: bool) -> Symbols:
    if words:
        found = tokens.words_of(texts)
        values, offsets = found.hashes, found.offsets
    else:
        found = None
        values = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64) + np.uint64(1)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    summed = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * tokens.powers(tokens.BASE, len(values)), out=summed[1:])
    return Symbols(offsets, summed, found)


def sliding(x: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """`best` (minimum or maximum) of every run of `width` values."""
    size, y = 1, x
    while 2 * size <= width:
        y = best(y[:-size], y[size:])
        size *= 2
    return best(y[: len(x) - width + 1], y[width - size :][: len(x) - width + 1])


def anchors_in(symbols: Symbols, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place in the text, hash) of all anchors of a batch. Texts shorter than a repeat have none."""
    n = len(symbols.summed) - 1
    none = np.zeros(0, np.int64)
    if n < shape.length:
        return none, none, np.zeros(0, np.uint64)
    grams = symbols.summed[shape.anchor :] - symbols.summed[: -shape.anchor]
    grams *= tokens.powers(tokens.INVERSE, len(grams))
    grams = tokens.mix(grams + np.uint64(shape.anchor)) | np.uint64(1)
    least = sliding(grams, shape.window, np.minimum)
    for end in symbols.offsets[1:].tolist():  # windows that run over the end of a text
        least[max(0, end - shape.length + 1) : end] = 0
    padded = np.concatenate([np.zeros(shape.window - 1, np.uint64), least, np.zeros(shape.window - 1, np.uint64)])
    chosen = np.flatnonzero(sliding(padded, shape.window, np.maximum) == grams)
    text = np.searchsorted(symbols.offsets, chosen, "right") - 1
    return text, chosen - symbols.offsets[text], grams[chosen]


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _anchor_rows(shape: Shape) -> Callable:
    """Rows (route, key, pos, sure). What repeats inside a batch is sure; one row of it still stands for the batch."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            texts, keys = [tokens.encode(t) for t in part["text"]], part["key"].to_numpy(np.int64)
            for start, end in tokens.batches([len(t) for t in texts]):
                text, pos, h = anchors_in(symbols_of(texts[start:end], shape.words), shape)
                _, first, which, count = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
                sure = count[which] > 1
                alone = sure.copy()
                alone[first] = False
                place = tokens.mix(h + tokens.mix(pos.astype(np.uint64) + (text.astype(np.uint64) + np.uint64(start)) * np.uint64(tokens.BASE)))
                key = keys[start:end][text] if len(text) else np.zeros(0, np.int64)
                yield pd.DataFrame({"route": _signed(np.where(alone, place, h)), "key": key, "pos": pos.astype(np.int32), "sure": sure})

    return run


def keyed(docs: DataFrame, ordered: bool) -> DataFrame:
    """doc_id, a key and the text. The key is the id where documents have an order, else a hash of id and text."""
    key = F.coalesce("doc_id", F.lit(NO_ID)).cast("long") if ordered else F.xxhash64("doc_id", "text")
    return own_columns(docs, "doc_id", "text").select("doc_id", key.alias("key"), "text")


def _pack(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    squeeze = zstandard.ZstdCompressor(level=1)
    for part in parts:
        yield pd.DataFrame({"doc_id": part["doc_id"], "key": part["key"], "packed": [squeeze.compress(tokens.encode(t)) for t in part["text"]]})


def unpack(packed: pd.Series) -> list[bytes]:
    open_up = zstandard.ZstdDecompressor()
    return [open_up.decompress(p) for p in packed]


def packed_texts(docs: DataFrame, ordered: bool = True) -> DataFrame:
    """doc_id, key and the compressed text."""
    return keyed(docs, ordered).mapInPandas(_pack, "doc_id long, key long, packed binary")


def repeated_anchors(docs: DataFrame, shape: Shape, ordered: bool = True) -> DataFrame:
    """(key, places): the places of each document's anchors that occur at least twice in the corpus."""
    rows = keyed(docs, ordered).select("key", "text").mapInPandas(_anchor_rows(shape), "route long, key long, pos int, sure boolean")
    # A batch sends one row for an anchor that it repeats, so a hot anchor has a row per batch here.
    counted = rows.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("route"))).where("sure or n > 1")
    return counted.groupBy("key").agg(F.collect_set("pos").alias("places"))


OCCURRENCES = "h long, ctx long, before long, after long, key long, tag int, pos int"


def tag_of(text: bytes) -> int:
    """Tells apart texts under one id."""
    return xxhash.xxh32_intdigest(text) >> 1


def context(pos: np.ndarray, size: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the contexts of anchors in texts of some sizes."""
    return np.maximum(0, pos - shape.margin), np.minimum(size, pos + shape.length)


def _occurrence_rows(shape: Shape) -> Callable:
    """Contexts of the repeated anchors, and hashes of the anchor with half a margin before and after it (0 if cut)."""
    half = shape.margin // 2

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            part = part.reset_index(drop=True)
            texts = unpack(part["packed"])
            for first, last in tokens.batches([len(t) for t in texts]):
                symbols = symbols_of(texts[first:last], shape.words)
                sizes = np.diff(symbols.offsets)
                places = [np.unique(np.asarray(p, np.int64)) for p in part["places"].iloc[first:last]]
                places = [p[p + shape.anchor <= s] if s >= shape.length else p[:0] for p, s in zip(places, sizes, strict=True)]
                text = np.repeat(np.arange(last - first), [len(p) for p in places])
                if not len(text):
                    continue
                pos = np.concatenate(places)
                base, size = symbols.offsets[text], sizes[text]
                start, end = context(pos, size, shape)
                h = symbols.hash(base + pos, base + pos + shape.anchor)
                ctx = tokens.mix(symbols.hash(base + start, base + end) + (pos - start).astype(np.uint64))
                pieces = []
                for low, high in ((pos - half, pos + shape.anchor), (pos, pos + shape.anchor + half)):
                    whole = (low >= 0) & (high <= size)
                    piece = symbols.hash(base + np.maximum(low, 0), base + np.minimum(high, size)) | np.uint64(1)
                    pieces.append(_signed(np.where(whole, piece, np.uint64(0))))
                tags = np.array([tag_of(t) for t in texts[first:last]], np.int32)
                keys = part["key"].to_numpy(np.int64)[first:last]
                yield pd.DataFrame({
                    "h": _signed(h), "ctx": _signed(ctx), "before": pieces[0], "after": pieces[1], "key": keys[text], "tag": tags[text], "pos": pos.astype(np.int32),
                })

    return run


def occurrences(docs: DataFrame, texts: DataFrame, shape: Shape, ordered: bool = True) -> DataFrame:
    """Every occurrence of a repeated anchor with the hash of its context."""
    joined = texts.join(repeated_anchors(docs, shape, ordered), "key")
    return joined.select("doc_id", "key", "packed", "places").mapInPandas(_occurrence_rows(shape), OCCURRENCES)

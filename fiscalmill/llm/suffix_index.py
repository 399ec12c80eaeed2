"""Removal of long repeated byte strings with run-length compressed suffix indexes.

1. Only contexts of anchors that occur at least twice can hold a repeat of LENGTH bytes (see `anchors`). Contexts that
   are equal as a whole form a class; a class of two or more occurrences repeats every byte of its context.
2. A repeat of LENGTH bytes that two classes share contains, beside the anchor, a half of the margin before or after it.
   Classes of one anchor therefore meet in two groups, by the anchor with half a margin before and with half a margin
   after. Groups of one class are done. The contexts of the others go, once per class, to shards of bounded size.
3. A shard's contexts, each place of a text once, are indexed: the Burrows-Wheeler transform is kept as runs, with the
   suffix array sampled at the run ends. Longest matches with the neighbours in suffix order are computed only at run
   ends; between them the matching statistics fall by one per place, so one pass streams them over the shard's text.
   Places that match LENGTH bytes elsewhere are the repeats.
4. A group of more than HOT classes is no shard of bounded size. It is split by longer extensions of its anchor: the
   distances that a repeat may start before the anchor are cut into runs, and what all repeats of a run share (LENGTH
   less the run, plus one) names a smaller group. There only the part of a context that these repeats cover counts, so
   most contexts of a hot group are equal now. One context stands for each class; groups of one class are done, others
   go to shards, and those that are still larger than HOT are split again, into shorter runs, the last of one distance.

Matches are compared byte by byte in shards; between documents they meet by 64-bit hashes of anchor and context.

Defined cases: a null text is empty; texts shorter than LENGTH lose nothing; a null id is an id like others (texts meet
their marks by a hash of id and text, so rows without an id do not gather); rows that repeat an id and text are copies of
each other; an empty table gives an empty result; further columns are passed over by
`repeats` and kept by `remove_repeats`, which drops characters that lose a byte and keeps rows whose text becomes empty.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalmill.llm import tokens
from fiscalmill.llm.anchors import Shape, context, occurrences, packed_texts, symbols_of, tag_of, unpack
from fiscalmill.llm.common import free_name
from fiscalmill.sources.staging import COMPRESSION, new_folder, run_scope, stage

LENGTH = 200
SHAPE = Shape(LENGTH, 64, words=False)
SHARD_CONTEXTS = 1500
"""Contexts in a shard on average; about half a megabyte of text."""
PAIRS_AT_ONCE = 1 << 14
HOT = 3000
"""Classes in a group from which on it is split by longer extensions."""
RUNS = (24, 8, 1)
"""Distances in a run, split by split. At one distance a group has one class."""
HALF = SHAPE.margin // 2


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling. Equal suffixes must not exist (a unique symbol ends each part)."""
    n = len(symbols)
    bits = max(1, int(symbols.max(initial=0)).bit_length())
    depth = max(1, 62 // bits)
    key = np.zeros(n, np.uint64)
    padded = np.concatenate([symbols.astype(np.uint64), np.zeros(depth, np.uint64)])
    for i in range(depth):
        key = (key << np.uint64(bits)) | padded[i : i + n]
    sa = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)
    slots = np.arange(n)
    new = np.concatenate([[True], key[sa][1:] != key[sa][:-1]])
    while True:
        heads = np.maximum.accumulate(np.where(new, slots, -1))
        rank[sa[slots]] = heads
        single = new & np.concatenate([new[1:], [True]])
        slots = slots[~single]
        if not len(slots):
            return sa
        some = sa[slots]
        follow = np.where(some + depth < n, rank[np.minimum(some + depth, n - 1)] + 1, 0)
        order = np.lexsort((follow, rank[some]))
        some, follow = some[order], follow[order]
        sa[slots] = some
        groups = rank[some]
        new = np.concatenate([[True], (groups[1:] != groups[:-1]) | (follow[1:] != follow[:-1])])
        depth *= 2


class RunLengthIndex:
    """Runs of the Burrows-Wheeler transform of a text, with the suffix array sampled at both ends of every run."""

    def __init__(self, text: np.ndarray) -> None:
        sa = suffix_array(text)
        bwt = text[sa - 1]
        ends = np.concatenate([[True], bwt[1:] != bwt[:-1]])
        self.text = text
        self.heads = np.flatnonzero(ends)
        self.symbols = bwt[self.heads]
        self.first = sa[self.heads]
        self.last = sa[np.concatenate([self.heads[1:], [len(sa)]]) - 1]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of suffix pairs. All pairs differ before the text ends.

        Over the run ends of a text these lengths sum to n log n at most.
        """
        out = np.zeros(len(a), np.int64)
        step = 16
        padded = np.concatenate([self.text, np.zeros(step, self.text.dtype)])
        reach = np.arange(step)
        for low in range(0, len(a), PAIRS_AT_ONCE):
            going = np.arange(low, min(len(a), low + PAIRS_AT_ONCE))
            while len(going):
                differs = padded[a[going, None] + out[going, None] + reach] != padded[b[going, None] + out[going, None] + reach]
                equal = np.where(differs.any(axis=1), differs.argmax(axis=1), step)
                out[going] += equal
                going = going[equal == step]
        return out

    def matching_statistics(self, most: int) -> np.ndarray:
        """For every place the longest match of what starts there with another place, up to `most`.

        The neighbours in suffix order give it. Inside a run the value is that of the place before, less one; only
        the places sampled at run ends are compared with the text.
        """
        n = len(self.text)
        lead = self.common(self.first[1:], self.last[:-1])
        best = np.zeros(n, np.int64)
        for places, values in ((self.first, np.concatenate([[0], lead])), (self.last, np.concatenate([lead, [0]]))):
            sampled = np.full(n, -1, np.int64)
            sampled[places] = places
            value = np.zeros(n, np.int64)
            value[places] = values
            source = np.maximum.accumulate(sampled)
            known = source >= 0
            falling = np.where(known, value[np.maximum(source, 0)] - (np.arange(n) - source), 0)
            best = np.maximum(best, falling)
        return np.minimum(best, most)


def merged_text(keys: np.ndarray, starts: np.ndarray, contents: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One text of all contexts in which every place of a document occurs once, and where each context begins in it.

    Overlapping contexts of one document are joined. Each part ends with a symbol of its own.
    """
    order = np.lexsort((starts, keys))
    begins = np.zeros(len(contents), np.int64)
    pieces: list[np.ndarray] = []
    total, part_key, part_start, part_end, parts = 0, None, 0, 0, 0
    for i in order:
        start, end = int(starts[i]), int(starts[i]) + len(contents[i])
        if part_key is None or keys[i] != part_key or start > part_end:
            if part_key is not None:
                pieces.append(np.array([parts + 1], np.int64))
                parts += 1
                total += 1
            part_key, part_start, part_end = keys[i], start, start
            offset = total - start
        begins[i] = start + offset
        if end > part_end:
            pieces.append(np.frombuffer(contents[i][part_end - start :], np.uint8).astype(np.int64) | (1 << 40))
            total += end - part_end
            part_end = end
    pieces.append(np.array([parts + 1], np.int64))
    text = np.concatenate(pieces)
    is_byte = text >= 1 << 40
    return np.where(is_byte, (text & 255) + parts + 2, text).astype(np.int32), begins


SPANS = "h long, ctx long, low int, high int"


def search_shard(part: pd.DataFrame) -> pd.DataFrame:
    """The span of every content, relative to its context's start, that repeats elsewhere in the shard.

    A content has fewer than LENGTH windows, so its repeats overlap and make one span.
    """
    part = part.assign(size=part["content"].str.len()).drop_duplicates(["h", "ctx", "shift", "size"])
    contents, shift = part["content"].tolist(), part["shift"].to_numpy(np.int64)
    names = (part["key"].to_numpy(np.int64).astype(np.uint64) * np.uint64(tokens.BASE)) ^ part["tag"].to_numpy(np.uint64)
    text, begins = merged_text(names, part["start"].to_numpy(np.int64), contents)
    marks = np.flatnonzero(RunLengthIndex(text).matching_statistics(LENGTH) >= LENGTH)
    inside = np.maximum(0, np.array([len(c) for c in contents], np.int64) - LENGTH + 1)
    first, last = np.searchsorted(marks, begins), np.searchsorted(marks, begins + inside) - 1
    found = first <= last
    low = marks[first[found]] - begins[found] + shift[found]
    high = marks[last[found]] + LENGTH - begins[found] + shift[found]
    return pd.DataFrame({"h": part["h"][found], "ctx": part["ctx"][found], "low": low, "high": high})


CONTENTS = "group long, h long, ctx long, key long, tag int, start int, lead int, content binary"


def _content_rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes of the wanted contexts of each text, `lead` of them before the anchor. `wanted` holds (group, h, ctx, tag, pos)."""
    names = ["group", "h", "ctx", "key", "tag", "start", "lead", "content"]
    for part in parts:
        rows = []
        for key, text, wanted in zip(part["key"], unpack(part["packed"]), part["wanted"], strict=True):
            tag = tag_of(text)
            for w in wanted:
                if w["tag"] == tag:
                    start, end = context(np.int64(w["pos"]), np.int64(len(text)), SHAPE)
                    rows.append((w["group"], w["h"], w["ctx"], key, tag, int(start), int(w["pos"] - start), text[start:end]))
                    if len(rows) == 20000:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
        yield pd.DataFrame(rows, columns=names)


PARTS = "core long, part long, h long, ctx long, low int, high int, near int, far int"


def _part_rows(run: int) -> Callable:
    """Contexts by longer extensions: one row for each run of the distances `near` to `far` before the anchor.

    `core` names what all repeats of the run share, `part` what they cover together, from `low` to `high` in the context.
    """

    def rows_of(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in parts:
            symbols = symbols_of(rows["content"].tolist(), False)
            base, size = symbols.offsets[:-1], np.diff(symbols.offsets)
            lead, near, far, h, ctx = (rows[c].to_numpy(np.int64) for c in ("lead", "near", "far", "h", "ctx"))
            for shift in range(0, int((far - near).max(initial=-1)) + 1, run):
                first, last = near + shift, np.minimum(near + shift + run - 1, far)
                # Distances at which the text cuts a repeat do not exist.
                nearest, farthest = np.maximum(first, lead + LENGTH - size), np.minimum(last, lead)
                some = np.flatnonzero(nearest <= farthest)
                first, last, nearest, farthest = (x[some] for x in (first, last, nearest, farthest))
                zero = (base + lead)[some]
                core = symbols.hash(zero - first, zero - last + LENGTH)
                part = symbols.hash(zero - farthest, zero - nearest + LENGTH)
                yield pd.DataFrame({
                    "core": tokens.mix(core + first.astype(np.uint64)).view(np.int64),
                    "part": tokens.mix(part + farthest.astype(np.uint64)).view(np.int64),
                    "h": h[some], "ctx": ctx[some], "low": lead[some] - farthest, "high": lead[some] - nearest + LENGTH, "near": first, "far": last,
                })

    return rows_of


def _spans_of_hot(hot: DataFrame) -> DataFrame:
    """Spans of the contexts of hot groups (h, ctx, key, tag, start, lead, content, near, far)."""
    contexts = hot.drop("near", "far")
    found = []
    for run in RUNS:
        rows = stage(hot.select("h", "ctx", "lead", "content", "near", "far").mapInPandas(_part_rows(run), PARTS), "hot-parts")
        one = F.min(F.struct("h", "ctx", "low", "high", "near", "far")).alias("one")
        classes = stage(rows.groupBy("core", "part").agg(F.count(F.lit(1)).alias("n"), one), "hot-classes")
        found.append(rows.join(classes.where("n > 1").select("core", "part"), ["core", "part"]).select("h", "ctx", "low", "high"))
        # As above, a group is open if it has several classes and one of them is not known to repeat as a whole.
        sizes = classes.groupBy("core").agg(F.count(F.lit(1)).alias("classes"), F.min("n").alias("least")).where("classes > 1 and least = 1")
        met = classes.select("core", "one.*").join(sizes.select("core", "classes"), "core")
        met = stage(met.join(contexts.dropDuplicates(["h", "ctx"]), ["h", "ctx"]), "hot-open")
        is_cold = F.col("classes") <= HOT
        cold, still_hot = met.agg(F.count_if(is_cold), F.count_if(~is_cold)).first()
        shards = max(1, cold // SHARD_CONTEXTS)
        cut = met.where(is_cold).select(
            F.pmod("core", F.lit(shards)).alias("group"), "h", "ctx", "key", "tag", (F.col("start") + F.col("low")).alias("start"),
            F.col("low").alias("shift"), F.expr("substring(content, low + 1, high - low)").alias("content"),
        )
        if cold:
            found.append(cut.groupBy("group").applyInPandas(search_shard, SPANS))
        if not still_hot:
            break
        hot = met.where(~is_cold)
    return reduce(DataFrame.union, found)


def runs_covered(parts: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Disjoint runs of covered places, from a flat list of starts and ends."""
    if not len(parts):
        return []
    edges = np.zeros(size + 1, np.int64)
    np.add.at(edges, parts[0::2], 1)
    np.add.at(edges, parts[1::2], -1)
    covered = np.cumsum(edges)[:size] > 0
    change = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]])))
    return list(zip(change[0::2].tolist(), change[1::2].tolist(), strict=True))


def spans_of(text: bytes, marks: list | None) -> list[tuple[int, int]]:
    """Runs to remove from a text, from (tag, pos, spans); empty spans mean the whole context of the anchor at pos."""
    tag, flat = tag_of(text), []
    for m in marks if marks is not None else ():
        if m["tag"] == tag:
            start, end = context(np.int64(m["pos"]), np.int64(len(text)), SHAPE)
            flat.append(np.array([start, end]) if m["spans"] is None else np.asarray(m["spans"], np.int64) + start)
    return runs_covered(np.concatenate(flat) if flat else np.zeros(0, np.int64), len(text))


def rest_of(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    edges = [0, *[x for run in runs for x in run], len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[0::2], edges[1::2], strict=True))


def _stage_spans(texts: DataFrame, classes: DataFrame, path: str) -> None:
    """Writes the spans (h, ctx, low, high) that repeat in contexts of single classes."""
    side = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("before").alias("part")), F.struct(F.lit(1).alias("side"), F.col("after").alias("part"))))
    halves = classes.select("h", "ctx", "at", "n", side.alias("s")).where("s.part <> 0")
    halves = halves.select(F.xxhash64("h", "s.side", "s.part").alias("group"), "s.side", "h", "ctx", "at", "n")
    # A group is open if it has several classes and one of them is not known to repeat as a whole.
    counts = halves.groupBy("group").agg(F.count(F.lit(1)).alias("classes"), F.min("n").alias("least")).where("classes > 1 and least = 1")
    met = stage(halves.drop("n").join(counts.drop("least"), "group"), "groups")
    cold = met.where(F.col("classes") <= HOT)
    shards = max(1, cold.count() // SHARD_CONTEXTS)
    target = F.when(F.col("classes") <= HOT, F.pmod("group", F.lit(shards))).otherwise(-1 - F.col("side")).cast("long")
    wanted = met.select(target.alias("group"), "h", "ctx", "at").distinct()
    by_text = wanted.groupBy("at.key").agg(F.collect_list(F.struct("group", "h", "ctx", "at.tag", "at.pos")).alias("wanted"))
    contents = texts.join(by_text, "key").select("key", "packed", "wanted").mapInPandas(_content_rows, CONTENTS)
    contents = stage(contents, "contexts")
    cold_rows = contents.where("group >= 0").select("group", "h", "ctx", "key", "tag", "start", F.lit(0).alias("shift"), "content")
    indexed = cold_rows.groupBy("group").applyInPandas(search_shard, SPANS)
    # A repeat holds the half margin before its anchor if it starts HALF bytes or more before it, else the one after.
    before = F.col("group") == -1
    near, far = F.when(before, HALF).otherwise(0).alias("near"), F.when(before, SHAPE.margin).otherwise(HALF - 1).alias("far")
    hot = stage(contents.where("group < 0").select("h", "ctx", "key", "tag", "start", "lead", "content", near, far), "hot-contexts")
    indexed.union(_spans_of_hot(hot)).write.option("compression", COMPRESSION).parquet(path)


def marked_texts(docs: DataFrame) -> DataFrame:
    """doc_id, key, packed text and marks (tag, pos, spans) of every document."""
    spark = docs.sparkSession
    texts = packed_texts(docs, ordered=False)
    found = stage(occurrences(docs, texts, SHAPE, ordered=False), "occurrences")
    place = F.struct("key", "tag", "pos")
    classes = found.groupBy("h", "ctx").agg(F.count(F.lit(1)).alias("n"), F.first("before").alias("before"), F.first("after").alias("after"), F.min(place).alias("at"))
    classes = stage(classes, "classes")
    path = new_folder(spark, "spans")
    # Contexts are only read by the search: they go before the marks are joined to the texts.
    with run_scope(spark, uuid.uuid4().hex):
        _stage_spans(texts, classes, path)
    spans = spark.read.schema(SPANS).parquet(path)
    several = classes.where("n > 1").select("h", "ctx", F.lit(None).cast("array<int>").alias("spans"))
    single = spans.groupBy("h", "ctx").agg(F.flatten(F.collect_list(F.array("low", "high"))).alias("spans"))
    single = single.join(classes.where("n > 1").select("h", "ctx"), ["h", "ctx"], "left_anti")
    marks = found.select("h", "ctx", "key", "tag", "pos").join(several.union(single), ["h", "ctx"])
    by_key = marks.groupBy("key").agg(F.collect_set(F.struct("tag", "pos", "spans")).alias("marks"))
    return texts.join(by_key, "key", "left").select("doc_id", "packed", "marks")


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def repeats(docs: DataFrame) -> DataFrame:
    """What repeats in every document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""

    def report(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for doc_id, text, marks in zip(part["doc_id"].astype("Int64"), unpack(part["packed"]), part["marks"], strict=True):
                runs = spans_of(text, marks)
                rest = rest_of(text, runs)
                rows.append((doc_id, len(text), len(text) - len(rest), len(runs), hashlib.sha256(rest).hexdigest()))
            yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return marked_texts(docs).mapInPandas(report, RESULT)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """The documents without their repeats, with all their columns; n_chars counts the text that is left."""
    row, rest = free_name(docs, "row"), free_name(docs, "rest")
    numbered = stage(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    own = numbered.select(F.col(row).alias("doc_id"), "text")

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            texts = [rest_of(t, spans_of(t, m)).decode("utf-8", "ignore") for t, m in zip(unpack(part["packed"]), part["marks"], strict=True)]
            yield pd.DataFrame({row: part["doc_id"], rest: texts})

    left = marked_texts(own).mapInPandas(cut, f"`{row}` long, `{rest}` string")
    joined = numbered.join(left, row)
    text = F.when(F.col("text").isNull(), F.col("text")).otherwise(F.col(rest))
    changed = {"text": text, "n_chars": F.char_length(text).cast("long")}
    return joined.select(*[changed.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])

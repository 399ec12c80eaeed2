"""Removal of word sequences that an earlier document has, with prefix-partitioned suffix trees.

1. Only contexts of anchors that occur at least twice can hold a repeat of LENGTH words (see `anchors`). Equal contexts
   form a class. In a class every document but the first one repeats the whole context.
2. What is open is whether a class's first document repeats a window of another class of the same anchor. The suffixes
   of the contexts of such classes, cut at LENGTH words, are the suffixes of the trees.
3. Suffixes are split by prefixes of variable length into groups: by their first 4 words, and where these have more
   suffixes than GROUP_SUFFIXES by 8 or all LENGTH words. Prefixes are counted on a sixteenth of the documents, by hash
   of the id; the count decides about sizes only. Each group is one subtree. It is built by sorting its suffixes: the
   common prefixes of neighbours are the depths of its internal nodes. Nodes as deep as LENGTH words are repeats; every
   suffix below one whose document is not the node's first one is marked. Groups are read in order, so that a task
   holds one batch of them.
4. A batch of documents sends an equal suffix once, for its first document; for the others the answer is known.
   A passage that a third of all documents share is thus as many rows as there are batches.

Windows meet by 64-bit hashes of 4, 4 and 5 words (192 bits).

Defined cases: a null text has no words; documents with fewer than LENGTH words lose nothing; a null id counts as larger
than all others; equal ids are no smaller ids, so rows that repeat an id keep their text; an empty table gives an
empty result; further columns are passed over.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fiscalmill.llm import tokens
from fiscalmill.llm.anchors import Shape, context, occurrences, packed_texts, symbols_of, tag_of, unpack
from fiscalmill.llm.suffix_index import runs_covered
from fiscalmill.sources.staging import stage

LENGTH = 13
SHAPE = Shape(LENGTH, 4, words=True)
LEVELS = [(0, 4), (4, 8), (8, LENGTH)]
GROUP_SUFFIXES = 200_000
MOST_SPLIT = 1024
"""Prefixes that are made longer, at most: the limit rises with the number of suffixes."""
SAMPLE = 16

SUFFIXES = "s0 long, s1 long, s2 long, class long, key long, at int, sure boolean"


def _suffix_rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Suffixes of the wanted contexts. `wanted` holds (class, tag, pos); `at` counts from the context's start."""
    for part in parts:
        part = part.reset_index(drop=True)
        texts = unpack(part["packed"])
        for first, last in tokens.batches([len(t) for t in texts]):
            symbols = symbols_of(texts[first:last], True)
            sizes = np.diff(symbols.offsets)
            rows = []
            for i in range(last - first):
                tag = tag_of(texts[first + i])
                rows += [(i, w["class"], w["pos"]) for w in part["wanted"][first + i] if w["tag"] == tag]
            if not rows:
                continue
            text, of, pos = (np.array(c, np.int64) for c in zip(*rows, strict=True))
            start, end = context(pos, sizes[text], SHAPE)
            count = np.maximum(0, end - start - LENGTH + 1)
            which = np.repeat(np.arange(len(rows)), count)
            at = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
            begin = symbols.offsets[text][which] + start[which] + at
            s = [symbols.hash(begin + a, begin + b).view(np.int64) for a, b in LEVELS]
            keys = part["key"].to_numpy(np.int64)[first:last][text][which]
            out = pd.DataFrame({"s0": s[0], "s1": s[1], "s2": s[2], "class": of[which], "key": keys, "at": at.astype(np.int32)})
            out["sure"] = out["key"] > out.groupby(["s0", "s1", "s2"])["key"].transform("min")
            spread = tokens.mix(begin.astype(np.uint64) + keys.astype(np.uint64) * np.uint64(tokens.BASE)).view(np.int64)
            out["s0"] = np.where(out["sure"], spread, out["s0"])
            yield out


def subtree_depths(suffixes: np.ndarray) -> np.ndarray:
    """For sorted suffixes [row, level] the words that each has in common with the one before."""
    same = suffixes[1:] == suffixes[:-1]
    depth = np.zeros(len(suffixes), np.int64)
    reached = np.ones(len(suffixes) - 1, bool) if len(suffixes) else np.zeros(0, bool)
    for level, (_, end) in enumerate(LEVELS):
        reached &= same[:, level]
        depth[1:][reached] = end
    return depth


def _deep_nodes(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(class, at) of suffixes below a node of full depth whose first document is an earlier one.

    Rows come sorted by suffix and document. What is kept from batch to batch is the last suffix and its first document.
    """
    last, first_key = None, 0
    for part in parts:
        if not len(part):
            continue
        rows = part[["s0", "s1", "s2"]].to_numpy(np.int64)
        keys = part["key"].to_numpy(np.int64)
        depth = subtree_depths(rows)
        opens = depth < LENGTH
        goes_on = last is not None and bool((rows[0] == last).all())
        opens[0] = True
        node = np.cumsum(opens) - 1
        firsts = keys[opens]
        if goes_on:
            firsts[0] = first_key
        marked = part["sure"].to_numpy(bool) | (keys > firsts[node])
        last, first_key = rows[-1], firsts[-1]
        yield part.loc[marked, ["class", "at"]]


def _grouped(suffixes: DataFrame, sampled: DataFrame) -> DataFrame:
    """The suffixes with the prefix, of variable length, that names their group."""
    total = F.sum("n").over(Window.partitionBy())
    prefixes = sampled.where("not sure").groupBy(F.col("s0").alias("p0")).agg((F.count(F.lit(1)) * SAMPLE).alias("n")).where(F.col("n") > GROUP_SUFFIXES // 2)
    heavy = prefixes.withColumn("all", total).where((F.col("n") > GROUP_SUFFIXES) & (F.col("n") * MOST_SPLIT > F.col("all"))).select("p0", "n")
    found = suffixes.join(F.broadcast(heavy), suffixes["s0"] == heavy["p0"], "left")
    longer = F.when(F.col("n") > 64 * GROUP_SUFFIXES, F.xxhash64("s0", "s1", "s2")).otherwise(F.xxhash64("s0", "s1"))
    return found.withColumn("prefix", F.when(F.col("n").isNull(), F.col("s0")).otherwise(longer)).drop("p0", "n")


def marked_texts(docs: DataFrame) -> DataFrame:
    """doc_id, key, packed text and marks (tag, pos, at) of every document."""
    texts = packed_texts(docs)
    found = stage(occurrences(docs, texts, SHAPE).drop("before", "after"), "occurrences")
    classes = found.groupBy("h", "ctx").agg(F.min(F.struct("key", "tag", "pos")).alias("first"), F.count(F.lit(1)).alias("n"))
    classes = stage(classes, "classes")
    several = classes.groupBy(F.col("h").alias("anchor")).agg(F.count(F.lit(1)).alias("classes")).where("classes > 1").select("anchor")
    # Open classes go by a number from here on, which is shorter than their hashes and packs well.
    numbered = classes.join(several, F.col("h") == F.col("anchor")).select(F.monotonically_increasing_id().alias("class"), "h", "ctx", "first.*")
    numbered = stage(numbered, "open-classes")
    by_text = numbered.groupBy("key").agg(F.collect_list(F.struct("class", "tag", "pos")).alias("wanted"))
    by_text = stage(by_text, "wanted")

    def suffixes_of(wanted: DataFrame) -> DataFrame:
        return texts.join(wanted, "key").select("key", "packed", "wanted").mapInPandas(_suffix_rows, SUFFIXES)

    sampled = suffixes_of(by_text.where(F.pmod(F.xxhash64("key"), F.lit(SAMPLE)) == 0))
    grouped = _grouped(suffixes_of(by_text), sampled)
    ordered = grouped.repartition("prefix").sortWithinPartitions("s0", "s1", "s2", "key")
    deep = ordered.select("s0", "s1", "s2", "class", "key", "at", "sure").mapInPandas(_deep_nodes, "class long, at int")
    deep = deep.groupBy("class").agg(F.collect_set("at").alias("at"))
    deep = stage(deep.join(numbered.select("class", "h", "ctx", F.col("key").alias("first_key")), "class").drop("class"), "deep-nodes")
    later = found.join(classes.where("n > 1").select("h", "ctx", F.col("first.key").alias("first_key")), ["h", "ctx"]).where("key > first_key")
    marks = later.select("key", "tag", "pos", F.lit(None).cast("array<int>").alias("at")).union(
        found.join(deep, ["h", "ctx"]).where("key = first_key").select("key", "tag", "pos", "at")
    )
    by_key = marks.groupBy("key").agg(F.collect_list(F.struct("tag", "pos", "at")).alias("marks"))
    return texts.join(by_key, "key", "left").select("doc_id", "packed", "marks")


def runs_of(text: bytes, words: int, marks: list | None) -> list[tuple[int, int]]:
    """Runs of words to remove, from (tag, pos, at); no `at` means the whole context of the anchor at pos."""
    tag, flat = tag_of(text), []
    for m in marks if marks is not None else ():
        if m["tag"] == tag:
            start, end = context(np.int64(m["pos"]), np.int64(words), SHAPE)
            if m["at"] is None:
                flat.append(np.array([start, end]))
            else:
                at = np.asarray(m["at"], np.int64) + start
                flat.append(np.stack([at, at + LENGTH], axis=1).ravel())
    return runs_covered(np.concatenate(flat) if flat else np.zeros(0, np.int64), words)


def repeats(docs: DataFrame) -> DataFrame:
    """What every document repeats of earlier ones: doc_id, n_words, n_removed, kept_sha256."""

    def report(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for doc_id, text, marks in zip(part["doc_id"].astype("Int64"), unpack(part["packed"]), part["marks"], strict=True):
                words = text.split()  # at the six separators of words
                edges = [0, *[x for run in runs_of(text, len(words), marks) for x in run], len(words)]
                kept = [w for a, b in zip(edges[0::2], edges[1::2], strict=True) for w in words[a:b]]
                rows.append((doc_id, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            yield pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return marked_texts(docs).mapInPandas(report, "doc_id long, n_words long, n_removed long, kept_sha256 string")


ORACLE = r"""
WITH t AS (
  SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
starts AS (SELECT row_no, doc_id, unnest(generate_series(1, len(words) - 12)) AS pos, words FROM t WHERE len(words) >= 13),
windows AS (SELECT row_no, doc_id, pos, md5(array_to_string(words[pos:pos + 12], ' ')) AS w FROM starts),
firsts AS (SELECT w, min(doc_id) AS first_id FROM windows GROUP BY w HAVING count(*) > 1),
covered AS (
  SELECT DISTINCT row_no, pos + k AS place
  FROM windows JOIN firsts USING (w), (SELECT unnest(generate_series(0, 12)) AS k) WHERE doc_id > first_id),
places AS (SELECT row_no, list(place) AS removed FROM covered GROUP BY row_no),
kept AS (
  SELECT doc_id, words, coalesce(removed, []) AS removed,
    list_filter(list_transform(words, lambda x, i: CASE WHEN list_contains(coalesce(removed, []), i) THEN NULL ELSE x END), lambda x: x IS NOT NULL) AS rest
  FROM t LEFT JOIN places USING (row_no))
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(removed) AS BIGINT) AS n_removed,
  sha256(array_to_string(rest, ' ')) AS kept_sha256
FROM kept
"""

"""Near-duplicate groups with SetSketch registers.

1. Every text gives its set of k-word shingles (64-bit hashes) and a sketch: register i is the smallest of the set's
   values under hash i, turned into an exponential variable and kept as its exponent on the base B, cut to 16 bits.
   Exponents are exponentially spaced and truncated, so sketches of unions are register-wise maxima. Texts with equal
   sets are one class; classes are represented once from here on.
2. Registers are cut into BANDS bands of ROWS values. Classes that agree on a band share a bucket. Every bucket gets a
   leader, chosen by a hash of (band, class), and links its members to the leader only: one row per member, not one per
   pair. With ROWS = 5 and BANDS = 40 a pair at similarity 0.85 misses all buckets with probability 1e-10, one at 0.80
   with probability 2e-7.
3. Candidates are first judged by the joint likelihood of their sketches: the counts of registers that are larger,
   smaller or equal, with both set sizes known, give the likelihood of every similarity. Only pairs for which the wanted
   similarity is less likely than the best one by exp(-30) are put aside. All others are verified on their full sets.
4. A class first meets the leader that it shares most buckets with, then the next one of another component.
   What remains are families (classes joined by buckets) of several verified components. Within these, all pairs of
   classes in different components, with at least one outside the largest, are compared in blocks of two chunks; only
   links come out. So no link is lost, and a large group of copies costs its size and not its square.

Defined cases: a text without words has an empty set, size 0, and is linked with nothing; with fewer than k words the
whole sequence is the one shingle; a null id is no smallest id unless all ids of a group are null; `kept` compares ids
null-safe; rows that repeat an id and text belong to one group; an empty table gives an empty result; further columns
are passed over by `groups` and kept by `deduplicate` and `one_of_each_group`. `kept` is a flag of ids, so all rows of
a group under its smallest id have it; `one_of_each_group` goes by rows and leaves one of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalmill.llm import tokens
from fiscalmill.llm.common import own_columns
from fiscalmill.llm.graph import components
from fiscalmill.sources.staging import stage

ROWS, BANDS = 5, 40
REGISTERS = ROWS * BANDS
B, RATE, TOP = 1.001, 20.0, 65535
MARGIN = 30.0
STAR_ROUNDS = 2
CHUNK = 128
MEMBERS = 64
"""Classes in a chunk of a family, and members that meet their leader in one group."""


@dataclass(frozen=True)
class Likeness:
    """Words in a shingle, whether A-Z are lower-cased, and the least similarity in hundredths."""

    words: int = 5
    lower: bool = True
    percent: int = 80


CONTRACT = Likeness(3, True, 85)
MULTIPLIERS = np.random.default_rng(20240501).integers(0, 1 << 31, REGISTERS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def shingle_sets(texts: list[bytes], like: Likeness) -> list[np.ndarray]:
    """The sorted shingle hashes of every text."""
    words = tokens.words_of(texts, like.lower)
    rows = tokens.sequences(words.hashes, like.words)
    out = []
    for start, end in zip(words.offsets[:-1], words.offsets[1:], strict=True):
        n = end - start
        if n >= like.words:
            own = np.sort(rows[start : end - like.words + 1])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        else:
            out.append(tokens.sequences(words.hashes[start:end], n) if n else np.zeros(0, np.uint64))
    return out


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Register values [set, register] of non-empty sets."""
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]]).astype(np.int64)
    high = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(sets), REGISTERS), np.uint16)
    for i in range(REGISTERS):
        least = np.minimum.reduceat(high * MULTIPLIERS[i], offsets)
        exponential = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
        out[:, i] = np.clip(np.floor(1 - np.log(exponential) / np.log(B)), 0, TOP)
    return out


def digest(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def _sketched(like: Likeness):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            texts = [tokens.encode(t) for t in part["text"]]
            for start, end in tokens.batches([len(t) for t in texts]):
                sets = shingle_sets(texts[start:end], like)
                full = [s for s in sets if len(s)]
                registers = iter(sketches(full)) if full else iter(())
                rows = [(len(s), digest(s), next(registers).tobytes()) if len(s) else (0, None, None) for s in sets]
                out = pd.DataFrame(rows, columns=["n_shingles", "class", "sketch"])
                out.insert(0, "doc_id", part["doc_id"].iloc[start:end].to_numpy())
                yield out

    return run


def likelihood_keeps(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, percent: int) -> np.ndarray:
    """Whether the wanted similarity is still plausible, for pairs of sketches [pair, register] and set sizes."""
    above, below = (a > b).sum(axis=1), (a < b).sum(axis=1)
    equal = REGISTERS - above - below
    u = (size_a / (size_a + size_b))[:, None]
    grid = np.linspace(0.0, 1.0, 101)[None, :]
    possible = grid <= np.minimum(u, 1 - u) / np.maximum(u, 1 - u) + 0.01
    p = lambda x: -np.log1p(-np.clip(x, 1e-9, 1) * (B - 1) / B) / np.log(B)
    p_above, p_below = p(u - (1 - u) * grid), p((1 - u) - u * grid)
    p_equal = np.clip(1 - p_above - p_below, 1e-9, 1)
    log = above[:, None] * np.log(p_above) + below[:, None] * np.log(p_below) + equal[:, None] * np.log(p_equal)
    log = np.where(possible, log, -np.inf)
    wanted = log[:, grid[0] >= percent / 100 - 1e-9].max(axis=1)
    return wanted >= log.max(axis=1) - MARGIN


def links_in_block(left: list, right: list, like: Likeness, same: bool) -> Iterator[tuple[bytes, bytes]]:
    """Verified links between classes (class, component, sketch, set) of two chunks that join their components.

    A link joins its components at once, so no pair is compared or sent that earlier links of the block connect already.
    """
    if not left or not right:
        return
    all_right = np.concatenate([r[3] for r in right])
    names = np.unique(all_right)
    places = np.searchsorted(names, all_right)
    sizes = np.array([len(r[3]) for r in right])
    offsets = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    registers = np.stack([r[2] for r in right])
    number = {c: i for i, c in enumerate(dict.fromkeys(r[1] for r in left + right))}
    joined = np.array([number[r[1]] for r in left + right])
    groups = joined[len(left) :]
    marked = np.zeros(len(names), np.int32)
    for i, (name, _, sketch, own) in enumerate(left):
        open_to = (groups != joined[i]) & (100 * np.minimum(sizes, len(own)) >= like.percent * np.maximum(sizes, len(own)))
        if same:
            open_to[: i + 1] = False
        some = np.flatnonzero(open_to)
        if len(some):
            kept = likelihood_keeps(np.broadcast_to(sketch, registers[some].shape), registers[some], np.full(len(some), len(own)), sizes[some], like.percent)
            some = some[kept]
        if not len(some):
            continue
        at = np.searchsorted(names, own)
        at = at[(at < len(names)) & (names[np.minimum(at, len(names) - 1)] == own)]
        marked[at] = 1
        both = np.add.reduceat(marked[places], offsets)[some]
        marked[at] = 0
        for j in some[100 * both >= like.percent * (len(own) + sizes[some] - both)]:
            if groups[j] != joined[i]:
                joined[joined == groups[j]] = joined[i]
                yield name, right[j][0]


def _with_sets(part: pd.DataFrame, like: Likeness) -> list:
    part = part.drop_duplicates("class")
    out = []
    texts = [tokens.encode(t) for t in part["text"]]
    for start, end in tokens.batches([len(t) for t in texts]):
        some = part.iloc[start:end]
        for name, group, sketch, own in zip(some["class"], some["component"], some["sketch"], shingle_sets(texts[start:end], like), strict=True):
            out.append((bytes(name), bytes(group), np.frombuffer(sketch, np.uint16), own))
    return out


LINKS = "a binary, b binary"


def _verified(like: Likeness):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        """Rows of side 0 against rows of side 1; within side 2 (a chunk against itself) all pairs."""
        chunks = {side: _with_sets(rows, like) for side, rows in part.groupby("side")}
        found = list(links_in_block(chunks.get(0, []), chunks.get(1, []), like, False))
        found += list(links_in_block(chunks.get(2, []), chunks.get(2, []), like, True))
        return pd.DataFrame(found, columns=["a", "b"])

    return run


def _star_edges(classes: DataFrame) -> DataFrame:
    """(member, leader, shared): every class with each leader of its buckets, and in how many buckets."""
    width = 2 * ROWS
    bands = [F.struct(F.lit(i).alias("band"), F.xxhash64(F.lit(i), F.substring("sketch", 1 + i * width, width)).alias("bucket")) for i in range(BANDS)]
    rows = classes.select("class", F.explode(F.array(*bands)).alias("in")).select("class", "in.band", "in.bucket")
    first = F.min_by("class", F.xxhash64("band", "class"))
    leaders = rows.groupBy("band", "bucket").agg(first.alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1")
    met = rows.join(leaders.select("band", "bucket", "leader"), ["band", "bucket"]).where(F.col("class") != F.col("leader"))
    return met.groupBy(F.col("class").alias("member"), "leader").agg(F.count(F.lit(1)).alias("shared"))


def _labelled(names: DataFrame, links: DataFrame | None) -> DataFrame:
    """(class, component) of all names, from verified links."""
    if links is None:
        return names.select("class", F.col("class").alias("component"))
    found = components(links)
    return names.join(found, names["class"] == found["id"], "left").select("class", F.coalesce("root", "class").alias("component"))


def _check(wanted: DataFrame, candidates: DataFrame, like: Likeness) -> DataFrame:
    """Verified links of the groups (g1, g2) in `wanted` (class, component, side, g1, g2)."""
    rows = wanted.join(candidates, "class").select("class", "component", "side", "g1", "g2", "sketch", "text")
    return rows.groupBy("g1", "g2").applyInPandas(_verified(like), LINKS)


def _star_round(edges: DataFrame, labels: DataFrame, candidates: DataFrame, tried: DataFrame | None, like: Likeness) -> tuple[DataFrame, DataFrame]:
    """Every class against its best untried leader of another component: (verified links, pairs tried)."""
    of = lambda c: labels.select(F.col("class").alias(c), F.col("component").alias(f"{c}_component"))
    crossing = edges.join(of("member"), "member").join(of("leader"), "leader").where("member_component <> leader_component")
    if tried is not None:
        crossing = crossing.join(tried, ["member", "leader"], "left_anti")
    picked = crossing.groupBy("member", "member_component").agg(F.max_by(F.struct("leader", "leader_component"), F.struct("shared", "leader")).alias("l"))
    picked = stage(picked.select("member", "member_component", "l.*", F.pmod(F.xxhash64("member"), F.lit(1 << 16)).alias("salt")), "pairs")
    sizes = picked.groupBy(F.col("leader").alias("g1")).agg(F.ceil(F.count(F.lit(1)) / MEMBERS).alias("groups"))
    chunk = F.pmod("salt", "groups").cast("long")
    members = picked.join(sizes, picked["leader"] == sizes["g1"]).select(
        F.col("member").alias("class"), F.col("member_component").alias("component"), F.lit(1).alias("side"), "g1", chunk.alias("g2"),
        "leader", "leader_component",
    )
    leaders = members.select(F.col("leader").alias("class"), F.col("leader_component").alias("component"), F.lit(0).alias("side"), "g1", "g2").distinct()
    wanted = members.drop("leader", "leader_component").union(leaders)
    return stage(_check(wanted, candidates, like), "links"), picked.select("member", "leader")


def _rest(edges: DataFrame, labels: DataFrame, candidates: DataFrame, like: Likeness) -> DataFrame:
    """Links between different components of one family, compared in blocks.

    Families are found on the graph of the verified components, in which a large group of copies is a few vertices.
    """
    of = lambda c, name: labels.select(F.col("class").alias(c), F.col("component").alias(name))
    crossing = edges.join(of("member", "a"), "member").join(of("leader", "b"), "leader").where("a <> b").select("a", "b")
    families = components(crossing)
    placed = labels.join(families, labels["component"] == families["id"], "left")
    placed = placed.select("class", "component", F.coalesce("root", "component").alias("family"))
    sizes = placed.groupBy("family", "component").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("family").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.count(F.lit(1)).alias("parts"))
    open_families = largest.where("parts > 1").drop("parts")
    mixed = stage(placed.join(open_families, "family").withColumn("inner", F.col("component") == F.col("main")), "families")
    chunks = mixed.groupBy("family").agg(
        F.ceil(F.count_if("inner") / CHUNK).alias("main_chunks"), F.ceil(F.count_if(~F.col("inner")) / CHUNK).alias("other_chunks")
    )
    salt = F.pmod(F.xxhash64("class"), F.lit(1 << 40))
    known = mixed.join(chunks, "family").withColumn("chunk", F.when(F.col("inner"), -1 - salt % F.col("main_chunks")).otherwise(salt % F.col("other_chunks")))
    outer = known.where(~F.col("inner"))
    key = lambda a, b: F.concat_ws(":", F.hex("family"), a.cast("string"), b.cast("string")).alias("g1")
    row = lambda df, side, a, b: df.select("class", "component", F.lit(side).alias("side"), key(a, b), F.lit(0).cast("long").alias("g2"))
    own = F.col("chunk")
    up = outer.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("other_chunks") - 1)))
    other = F.col("other")
    wanted = (
        row(outer, 2, own, own)
        .union(row(up.where(own < other), 0, own, other))
        .union(row(up.where(own > other), 1, other, own))
        .union(row(outer.withColumn("other", F.explode(F.sequence(-F.col("main_chunks"), F.lit(-1).cast("long")))), 0, own, other))
        .union(row(known.where("inner").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("other_chunks") - 1))), 1, other, own))
    )
    return stage(_check(wanted, candidates, like), "links")


def groups(docs: DataFrame, like: Likeness = CONTRACT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    own = own_columns(docs, "doc_id", "text")
    sketched = stage(own.mapInPandas(_sketched(like), "doc_id long, n_shingles long, class binary, sketch binary"), "sketches")
    classes = sketched.where("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("low"), F.first("sketch").alias("sketch"))
    classes = stage(classes, "classes")
    edges = stage(_star_edges(classes), "stars")
    names = stage(edges.select(F.col("member").alias("class")).union(edges.select("leader")).distinct(), "candidates")
    told = classes.join(names, "class")
    ids = told.select(F.col("low").alias("doc_id")).distinct()
    texts = own.join(ids, own["doc_id"].eqNullSafe(ids["doc_id"])).select(own["doc_id"], "text")
    named = texts.mapInPandas(_named(like), "class binary, text string")
    candidates = stage(named.join(told.select("class", "sketch"), "class"), "candidate-texts")
    links, tried = None, None
    for _ in range(STAR_ROUNDS):
        labels = stage(_labelled(names, links), "labels")
        found, pairs = _star_round(edges, labels, candidates, tried, like)
        links = found if links is None else links.union(found)
        tried = pairs if tried is None else tried.union(pairs)
    labels = stage(_labelled(names, links), "labels")
    links = links.union(_rest(edges, labels, candidates, like))
    roots = stage(_labelled(classes, links).join(classes.select("class", "low"), "class"), "components")
    lowest = roots.groupBy("component").agg(F.min("low").alias("component_id"))
    found = roots.join(lowest, "component").select("class", "component_id")
    joined = sketched.drop("sketch").join(found, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def _named(like: Likeness):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            texts = [tokens.encode(t) for t in part["text"]]
            for start, end in tokens.batches([len(t) for t in texts]):
                sets = shingle_sets(texts[start:end], like)
                yield pd.DataFrame({"class": [digest(s) for s in sets], "text": part["text"].iloc[start:end].to_numpy()})

    return run


def deduplicate(docs: DataFrame, like: Likeness | None = None) -> DataFrame:
    """All rows with an id that `groups` marks as kept, with all their columns; rows that share such an id all stay."""
    kept = groups(docs, like or Likeness()).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    kept = stage(kept, "kept-ids")
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi")


def one_of_each_group(docs: DataFrame, like: Likeness | None = None) -> DataFrame:
    """One row of each near-duplicate group, with all its columns: the smallest id, null last, of equal ids any one row.

    Groups are made of rows by a number that is staged with them. A row without words is a group of its own.
    """
    row = "row_number"
    while row in map(str.lower, docs.columns):
        row += "_"
    numbered = stage(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    grouped = groups(numbered.select(F.col(row).alias("doc_id"), "text"), like or Likeness())
    ids = numbered.select(F.col(row).alias("of"), F.col("doc_id").alias("id"))
    members = grouped.join(ids, grouped["doc_id"] == ids["of"])
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "of")).alias("first")
    kept = stage(members.groupBy("component_id").agg(first).select(F.col("first.of").alias("kept_row")), "kept-rows")
    return numbered.join(kept, numbered[row] == kept["kept_row"], "left_semi").drop(row)

"""Mixing sources to target weights by hierarchical budgeting. DataFrame functions only.

Documents are the leaves' rows of a tree domain > language > source. A token budget enters at the root. Every node
shares its budget among its children by weight; a child that cannot use its share (its documents, read at most
`max_epochs` times, have fewer tokens) returns the rest to its siblings. A node's capacity is the sum of its children's,
so a shortage is made up among siblings first and reaches the ancestor's siblings only when the whole branch is short.

Sharing is exact integer arithmetic in windows over the children of a node, ordered by capacity per weight: the first
children up to the one that can use its whole share get their capacity, the others share what is left by weight.

A leaf reads whole epochs and then a token prefix of one more epoch. Each epoch has its own order of the leaf's
documents, by the hash of (seed, epoch, id). The place where the prefix ends is found without sorting the leaf: tokens
are summed by hash bucket, which finds the bucket of the cut, and only that bucket is ordered. A leaf that holds a third
of all rows thus costs a partial sum per task and one bucket. What is left is one row per leaf with the cut, and every
document compares itself with its leaf's row.

Defined cases: null language or source is the name `none`; a null text has no tokens and is never read; a null id is
ordered as an empty name; rows of one leaf that share id and token count are one unit at the cut and get equal
prefixes; documents without tokens are in no prefix; an empty table gives an empty result; further columns are kept by
`mix` and passed over by `plan_documents`. Weights are whole numbers from 0 on; a branch of weight 0 gets nothing.
Rounding down leaves at most one token per node unread.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fiscalmill.llm.common import words_of
from fiscalmill.sources.staging import stage

LEVELS = ["domain", "language", "source_name"]
BUCKET_DIGITS = 3
"""Hexadecimal digits of the hash that name a bucket: 4,096 buckets per leaf at most."""
N_DOMAINS = 4
WHOLE = "decimal(38,0)"


@dataclass(frozen=True)
class Target:
    """Weights by level and name, 1 where none is given; budget as a share of all tokens, in hundredths."""

    weights: dict[str, dict[str, int]] = field(default_factory=dict)
    percent: int = 100
    max_epochs: int = 2
    seed: int = 7


PRODUCTION = Target({"domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1}, "language": {"en": 6, "de": 2, "fr": 2, "es": 1}}, percent=80, max_epochs=3)
"""Parameters of the registered query."""
PIPELINE = Target(percent=100, max_epochs=2)
"""Parameters of the pipeline's stage: equal weights at every level, so that the hot source gives way to the others."""


def domain_of(source: Column) -> Column:
    """Default domain of a source: one of four, by the first two digits of its hash."""
    return F.concat(F.lit("d"), (F.conv(F.substring(F.md5(source), 1, 2), 16, 10).cast("int") % N_DOMAINS).cast("string"))


def named(docs: DataFrame) -> DataFrame:
    """The documents with the names of their leaf and their tokens, which are words."""
    source = F.coalesce("source", F.lit("none"))
    return docs.withColumns({
        "domain": domain_of(source),
        "language": F.coalesce("lang", F.lit("none")),
        "source_name": source,
        "tokens": F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long"),
    })


def _weight(level: str, target: Target) -> Column:
    found = F.lit(1)
    for name, weight in target.weights.get(level, {}).items():
        found = F.when(F.col(level) == name, F.lit(weight)).otherwise(found)
    return found.cast(WHOLE)


def share(children: DataFrame, parents: list[str], level: str) -> DataFrame:
    """Adds `given`, the child's part of the parent's `budget`, from `capacity` and `weight` of all its children."""
    name = [F.col(level)]
    by_need = Window.partitionBy(*parents).orderBy((F.col("capacity").cast("double") / F.col("weight").cast("double")).asc(), *name)
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    after = by_need.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    open_to = children.where("weight > 0")
    summed = open_to.withColumns({
        "spent": F.coalesce(F.sum("capacity").over(before), F.lit(0)).cast(WHOLE),
        "heavier": F.sum("weight").over(after).cast(WHOLE),
    })
    filled = F.col("capacity") * F.col("heavier") <= (F.col("budget") - F.col("spent")) * F.col("weight")
    marked = summed.withColumn("filled", filled)
    siblings = Window.partitionBy(*parents)
    left = F.col("budget") - F.coalesce(F.sum(F.when(F.col("filled"), F.col("capacity"))).over(siblings), F.lit(0))
    rest = F.sum(F.when(~F.col("filled"), F.col("weight"))).over(siblings)
    part = F.expr("left_over * weight div nullif(rest, 0)").cast(WHOLE)
    return (
        marked.withColumns({"left_over": left.cast(WHOLE), "rest": rest.cast(WHOLE)})
        .withColumn("given", F.when(F.col("filled"), F.col("capacity")).otherwise(F.least("capacity", part)))
        .drop("spent", "heavier", "filled", "left_over", "rest", "budget", "weight")
    )


def budgets(leaves: DataFrame, target: Target) -> DataFrame:
    """From (leaf names, leaf_tokens): the leaf's budget, its whole epochs and the tokens of its last, partial one."""
    weighed = leaves.where("leaf_tokens > 0").withColumn("capacity", (F.col("leaf_tokens") * target.max_epochs).cast(WHOLE))
    above: DataFrame | None = None
    parents: list[str] = []
    for level in LEVELS:
        names = [*parents, level]
        children = weighed.groupBy(*names).agg(
            F.sum("capacity").cast(WHOLE).alias("capacity"), F.sum("leaf_tokens").cast(WHOLE).alias("own_tokens")
        )
        if above is None:
            everything = Window.partitionBy()  # over the few names of the top level
            wanted = (F.sum("own_tokens").over(everything) * target.percent).cast(WHOLE)
            children = children.withColumn("wanted", wanted).withColumn("most", F.sum("capacity").over(everything).cast(WHOLE))
            children = children.withColumn("budget", F.least(F.expr("wanted div 100").cast(WHOLE), "most")).drop("wanted", "most")
        else:
            children = children.join(above, parents)
        children = children.drop("own_tokens").withColumn("weight", _weight(level, target))
        above = share(children, parents, level).select(*names, F.col("given").alias("budget"))
        parents = names
    found = above.join(weighed.select(*LEVELS, "leaf_tokens"), LEVELS)
    epochs = F.expr("cast(budget div leaf_tokens as int)")
    return found.select(*LEVELS, "leaf_tokens", F.col("budget").cast("long"), epochs.alias("epochs")).withColumn(
        "partial", F.expr("cast(budget - epochs * leaf_tokens as long)")
    )


def order_of(seed: int, epoch: Column) -> Column:
    """Place of a document in an epoch of its leaf: a hash, compared as text."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def cuts(slim: DataFrame, target: Target) -> DataFrame:
    """One row per leaf: budget, whole epochs, and where its partial epoch ends (hash, id, tokens there and how many)."""
    leaves = slim.groupBy(*LEVELS).agg(F.sum("tokens").alias("leaf_tokens"))
    given = stage(budgets(leaves, target), "leaf-budgets")
    ordered = slim.where("tokens > 0").join(given, LEVELS).where("partial > 0")
    ordered = ordered.withColumn("place", order_of(target.seed, F.col("epochs"))).withColumn("bucket", F.substring("place", 1, BUCKET_DIGITS))
    sums = ordered.groupBy(*LEVELS, "bucket", "partial").agg(F.sum("tokens").alias("bucket_tokens"))
    along = Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = sums.withColumn("reached", F.sum("bucket_tokens").over(along))
    cut_bucket = reached.where("reached >= partial and reached - bucket_tokens < partial")
    cut_bucket = cut_bucket.select(*LEVELS, "bucket", (F.col("reached") - F.col("bucket_tokens")).alias("before"))
    units = (
        ordered.join(cut_bucket, [*LEVELS, "bucket"])
        .groupBy(*LEVELS, "partial", "before", "place", F.coalesce("doc_id", F.lit(-1)).alias("unit_id"), "tokens")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    inside = Window.partitionBy(*LEVELS).orderBy("place", "unit_id", "tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = units.withColumn("to", F.col("before") + F.sum(F.col("tokens") * F.col("copies")).over(inside))
    ends = placed.where("to >= partial and to - tokens * copies < partial").select(
        *LEVELS,
        F.col("place").alias("cut_place"),
        F.col("unit_id").alias("cut_id"),
        F.col("tokens").alias("cut_tokens"),
        F.expr("(partial - (to - tokens * copies)) div copies").cast("long").alias("cut_taken"),
    )
    return given.join(ends, LEVELS, "left")


def taken(rows: DataFrame, cut: DataFrame, target: Target) -> DataFrame:
    """Every row as often as it is read: `epoch` from 0, `n_taken` its tokens read then."""
    joined = rows.where("tokens > 0").join(cut, LEVELS).withColumn("place", order_of(target.seed, F.col("epochs")))
    here = F.struct("place", F.coalesce("doc_id", F.lit(-1)).alias("i"), F.col("tokens").alias("t"))
    end = F.struct(F.col("cut_place").alias("place"), F.col("cut_id").alias("i"), F.col("cut_tokens").alias("t"))
    last = F.when(F.col("cut_place").isNull(), 0).when(here < end, F.col("tokens")).when(here == end, F.col("cut_taken")).otherwise(0)
    counted = joined.withColumn("in_last", last.cast("long"))
    reads = F.col("epochs") + F.when(F.col("in_last") > 0, 1).otherwise(0)
    return (
        counted.where(reads > 0)
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), reads - 1)))
        .withColumn("n_taken", F.when(F.col("epoch") < F.col("epochs"), F.col("tokens")).otherwise(F.col("in_last")))
    )


def slim_table(docs: DataFrame) -> DataFrame:
    """Id, leaf and tokens of every document, staged, so that the texts are read once for all counts."""
    return stage(named(docs).select("doc_id", *LEVELS, "tokens"), "mixing-tokens")


def plan_documents(docs: DataFrame, target: Target = PRODUCTION) -> DataFrame:
    """Which documents are read in which epoch, and how many of their first tokens."""
    slim = slim_table(docs)
    read = taken(slim, stage(cuts(slim, target), "leaf-cuts"), target)
    return read.select("doc_id", *LEVELS, "epoch", F.col("tokens").alias("n_tokens"), "n_taken")


def mix(docs: DataFrame, target: Target = PIPELINE) -> DataFrame:
    """The documents as the mix reads them, repeated by epoch, with their own columns.

    Only a leaf's last document can be cut; its text is then its first words joined by single spaces.
    """
    cut = stage(cuts(slim_table(docs), target), "leaf-cuts")
    wanted = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in wanted]).alias("whole"), "doc_id", "text", "lang", "source")
    read = taken(named(packed), cut, target)
    prefix = F.array_join(F.slice(words_of(F.col("text")), F.lit(1), F.col("n_taken").cast("int")), " ")
    text = F.when(F.col("n_taken") < F.col("tokens"), prefix).otherwise(F.col("text"))
    own = {"text": text, "n_chars": F.when(F.col("n_taken") < F.col("tokens"), F.char_length(prefix).cast("long")).otherwise(F.col("whole.n_chars"))}
    return read.select(*[own.get(c, F.col(f"whole.`{c}`")).alias(c) for c in wanted])


def _share_sql(level: str, parents: list[str]) -> str:
    """The SQL of one level of sharing."""
    keys, names = ", ".join(parents), ", ".join([*parents, level])
    weight = " ".join(f"WHEN {level} = '{n}' THEN {w}" for n, w in PRODUCTION.weights.get(level, {}).items())
    over = f"PARTITION BY {keys} " if parents else ""
    order = f"{over}ORDER BY CAST(capacity AS DOUBLE) / CAST(weight AS DOUBLE), {level}"
    above = f"JOIN b_{parents[-1]} USING ({keys})" if parents else "CROSS JOIN b_root"
    return f"""
c_{level} AS (
  SELECT {names}, capacity, budget, CAST({f"CASE {weight} ELSE 1 END" if weight else "1"} AS HUGEINT) AS weight
  FROM (SELECT {names}, CAST(sum(capacity) AS HUGEINT) AS capacity FROM leaf GROUP BY {names}) {above}),
s_{level} AS (
  SELECT *, CAST(coalesce(sum(capacity) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS HUGEINT) AS spent,
    CAST(sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS HUGEINT) AS heavier
  FROM c_{level} WHERE weight > 0),
f_{level} AS (SELECT *, capacity * heavier <= (budget - spent) * weight AS filled FROM s_{level}),
r_{level} AS (
  SELECT *, budget - CAST(coalesce(sum(CASE WHEN filled THEN capacity END) OVER ({over}), 0) AS HUGEINT) AS left_over,
    CAST(sum(CASE WHEN NOT filled THEN weight END) OVER ({over}) AS HUGEINT) AS rest
  FROM f_{level}),
b_{level} AS (
  SELECT {names}, CASE WHEN filled THEN capacity ELSE least(capacity, left_over * weight // nullif(rest, 0)) END AS budget
  FROM r_{level}),"""


_KEYS = ", ".join(LEVELS)
ORACLE = f"""
WITH named AS (
  SELECT doc_id, 'd' || (CAST('0x' || substr(md5(coalesce(source, 'none')), 1, 2) AS INT) % {N_DOMAINS}) AS domain,
    coalesce(lang, 'none') AS language, coalesce(source, 'none') AS source_name,
    CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS tokens
  FROM documents),
leaf AS (
  SELECT {_KEYS}, CAST(sum(tokens) AS HUGEINT) AS leaf_tokens, CAST(sum(tokens) * {PRODUCTION.max_epochs} AS HUGEINT) AS capacity
  FROM named GROUP BY {_KEYS} HAVING sum(tokens) > 0),
b_root AS (
  SELECT least(CAST(sum(leaf_tokens) AS HUGEINT) * {PRODUCTION.percent} // 100, CAST(sum(capacity) AS HUGEINT)) AS budget FROM leaf),
{"".join(_share_sql(level, LEVELS[:i]) for i, level in enumerate(LEVELS))}
given AS (
  SELECT {_KEYS}, leaf_tokens, budget // leaf_tokens AS epochs, budget % leaf_tokens AS partial
  FROM b_source_name JOIN leaf USING ({_KEYS})),
placed AS (
  SELECT *, md5('{PRODUCTION.seed}:' || epochs || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place
  FROM named JOIN given USING ({_KEYS}) WHERE tokens > 0),
summed AS (
  SELECT *, sum(tokens) OVER (PARTITION BY {_KEYS} ORDER BY place, doc_id, tokens ROWS UNBOUNDED PRECEDING) AS upto FROM placed),
counted AS (
  SELECT *, CAST(greatest(0, least(tokens, partial - (upto - tokens))) AS BIGINT) AS in_last FROM summed),
reads AS (
  SELECT *, unnest(generate_series(0, CAST(epochs AS BIGINT) - 1 + CASE WHEN in_last > 0 THEN 1 ELSE 0 END)) AS epoch FROM counted)
SELECT doc_id, {_KEYS}, CAST(epoch AS INT) AS epoch, tokens AS n_tokens,
  CASE WHEN epoch < epochs THEN tokens ELSE in_last END AS n_taken
FROM reads
"""

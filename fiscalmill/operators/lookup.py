"""Left joins to lookup tables: broadcast behind a row count, salted shuffle beyond it.

A lookup table may hold several rows per key; as in SQL, every match gives a row.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import cached_property, reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalmill.sources.staging import stage_counted

BROADCAST_ROWS = 200_000
"""A lookup table is broadcast only up to this many counted rows (a few narrow string columns each)."""

HOT_ROWS = 1_000_000
"""A key with more rows than this is split. At most total / HOT_ROWS keys can qualify, which bounds the list."""

HASH_BUCKETS = 8192
"""Buckets in which rows are counted before keys are."""


@dataclass(frozen=True)
class Lookup:
    """A lookup table whose size is known from staging it, or counted once when a join first asks."""

    frame: DataFrame
    known_rows: int | None = None
    broadcast_rows: int = BROADCAST_ROWS
    hot_rows: int = HOT_ROWS

    @cached_property
    def rows(self) -> int:
        return self.frame.count() if self.known_rows is None else self.known_rows

    @property
    def small(self) -> bool:
        return self.rows <= self.broadcast_rows

    def where(self, condition: Column) -> Lookup:
        """Fewer rows; a known size stays as the upper bound it is."""
        return replace(self, frame=self.frame.where(condition))

    def only(self, column: str, keys: DataFrame) -> Lookup:
        """The rows whose key is among `keys`, a frame of one column in which keys may repeat. The size is counted anew."""
        distinct = keys.toDF(column).where(F.col(column).isNotNull()).distinct()
        return replace(self, frame=self.frame.join(distinct, column, "left_semi"), known_rows=None)

    def staged(self, name: str) -> Lookup:
        """Written once with its row count, so that later joins neither recompute nor count it."""
        frame, rows = stage_counted(self.frame, name)
        return replace(self, frame=frame, known_rows=rows)


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys above `hot_rows` with the number of parts each is split into. Pre-aggregated before the shuffle."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    parts = F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int")
    return counts.where(F.col("_n") > hot_rows).select(*keys, parts.alias("_parts"))


def hot_keys_if_any(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """`hot_keys`, staged; None when there are none.

    Rows are counted by hash buckets first, which all but combine before the shuffle. Keys are counted only in the
    buckets that exceed the limit: where none does, no key can.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(HASH_BUCKETS))
    counts = df.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    crowded = [r["_bucket"] for r in counts.where(F.col("_n") > hot_rows).collect()]
    if not crowded:
        return None
    hot, found = stage_counted(hot_keys(df.where(bucket.isin(crowded)), keys, hot_rows), "hot-keys")
    return hot if found else None


def _with_parts(df: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """Adds _parts, one for ordinary keys. Null keys compare equal here, so a hot null key is split too."""
    renamed = hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], "_parts")
    condition = [df[k].eqNullSafe(renamed[f"_hot_{k}"]) for k in keys]
    joined = df.join(F.broadcast(renamed), condition, "left")
    return joined.select(*[df[c] for c in df.columns], F.coalesce(renamed["_parts"], F.lit(1)).alias("_parts"))


def salted(
    df: DataFrame,
    keys: list[str],
    spread: list[str],
    hot_rows: int = HOT_ROWS,
    rows: int | None = None,
    counted: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Rows with a _salt column that splits hot keys evenly by the hash of `spread`, and the hot keys.

    The keys are counted over `counted`, a cheaper frame with the same key columns, else over the rows themselves.
    When `rows`, the known number of rows, is itself below the limit, no key can exceed it and nothing is split. Else the
    hot keys are found once and staged; mostly there are none, and the rows stay as they are.
    """
    if rows is not None and rows <= hot_rows:
        return df.withColumn("_salt", F.lit(0)), None
    hot = hot_keys_if_any(df if counted is None else counted, keys, hot_rows)
    if hot is None:
        return df.withColumn("_salt", F.lit(0)), None
    salt = F.pmod(F.xxhash64(*spread), F.col("_parts").cast("bigint")).cast("int")
    return _with_parts(df, hot, keys).withColumn("_salt", salt).drop("_parts"), hot


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    spread: list[str],
    hot_rows: int = HOT_ROWS,
    how: str = "left",
    left_rows: int | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Left or inner join on equally named keys in which no key is wholly in one task.

    Right rows of a hot key are repeated once per part; all other rows go through once.
    """
    spread_left, hot = salted(left, keys, spread, hot_rows, left_rows, counted)
    if hot is None:
        return left.join(right, keys, how)
    part = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_salt")
    repeated = _with_parts(right, hot, keys).select(*right.columns, part)
    return spread_left.join(repeated, [*keys, "_salt"], how).drop("_salt")


def left_lookup(
    left: DataFrame,
    lookup: Lookup,
    on: dict[str, Column],
    take: dict[str, str],
    spread: list[str],
    guard: Column | None = None,
    base: DataFrame | None = None,
    nulls_apart: bool = False,
) -> DataFrame:
    """Left join that adds columns of a lookup table.

    on      lookup column -> expression over `left`
    take    new column name -> lookup column
    spread  columns of `left` that tell its rows apart, used only to split hot keys
    guard   condition over `left` under which a row may match at all; the key is nulled otherwise, which keeps
            the join a pure equi-join while unmatched rows stay in the result
    base    frame that `left` grew from and over which the key expressions hold as well; hot keys are counted
            there, so that a chain of lookups does not repeat itself in every count
    nulls_apart
            rows with a null key, which match nothing, are not shuffled. For keys that are mostly null, and a `left`
            that is cheap to read twice
    """
    names = {c: f"_key_{c}" for c in on}
    keys = {names[c]: e if guard is None else F.when(guard, e) for c, e in on.items()}
    keyed = left.withColumns(keys)
    right = lookup.frame.select(
        *[F.col(c).alias(names[c]) for c in on], *[F.col(c).alias(new) for new, c in take.items()]
    )
    if lookup.small:
        joined = keyed.join(F.broadcast(right), list(keys), "left")
    else:
        counted = (left if base is None else base).select(*[e.alias(k) for k, e in keys.items()])
        filled = reduce(and_, [F.col(k).isNotNull() for k in keys])
        if nulls_apart:
            alone = keyed.where(~filled)
            keyed, counted = keyed.where(filled), counted.where(filled)
        joined = salted_join(keyed, right, list(keys), spread, lookup.hot_rows, counted=counted)
        if nulls_apart:
            joined = joined.unionByName(alone, allowMissingColumns=True)
    return joined.drop(*keys)

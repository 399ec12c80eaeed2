"""Resampling of documents towards a target distribution.

Features are hashed into BUCKETS buckets. The gain of a bucket says how much likelier it is in the target texts than in
the documents; gains are one array, and a document's weight is the mean of the array's entries at its features. Gumbel
noise from the row's key is added, and the highest scores are drawn, which samples without replacement in proportion to
exp(weight / 1000). The order of all scores comes from `regular_sampling`.

Texts are tokenised once: the features are staged as bucket numbers of two bytes. Counting and scoring read these.
Counts cover all documents and all target texts; the array of gains has BUCKETS entries at any size of the data.

Defined cases: a null or empty text, and one without words, has no features and weight 0; a null id is hashed as the
empty text and comes last among equal scores; rows that repeat are counted, scored and ranked each on their own; an empty
table of documents gives an empty result; without target texts all their counts are 0; texts of any length are read in
portions; further columns are passed over.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalmill.llm.common import own_columns
from fiscalmill.llm.regular_sampling import ranked
from fiscalmill.llm.word_runs import LOWER, word_runs
from fiscalmill.sources.staging import stage

BUCKETS = 10000
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
GAP = re.compile(rb"[^0-9a-z\x80-\xff]")


@dataclass(frozen=True)
class Draw:
    """How many rows are drawn, from which, and with which noise."""

    percent: int = 25
    least_words: int = 20
    seed: str = "7"


CONTRACT = Draw()


def features(text: bytes | None) -> tuple[int, np.ndarray]:
    """Number of words of a text, and the bucket of each word and each pair of neighbours."""
    words, found = 0, []
    for i, run in enumerate(word_runs((text or b"").translate(LOWER), WORD, GAP, overlap=1)):
        single = list(map(crc32, run))
        pairs = list(map(crc32, [b" " + w for w in run[1:]], single))
        new = single if i == 0 or words == 0 else single[1:]
        words += len(new)
        found.append(np.array(new + pairs, np.uint32) % BUCKETS)
    return words, np.concatenate(found or [np.zeros(0)]).astype(np.uint16)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [features(t.as_py()) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array([n for n, _ in found], pa.int64()), pa.array([f.tobytes() for _, f in found], pa.binary())],
            names=["id", "n_words", "features"],
        )


def featured(rows: DataFrame, name: str) -> DataFrame:
    """id, n_words and features (bucket numbers of two bytes) of every row."""
    own = own_columns(rows, name, "text").select(F.col(f"`{name}`").cast("long").alias("id"), F.col("text").cast("binary").alias("text"))
    return own.mapInArrow(_featured, "id long, n_words long, features binary")


def _joined(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The features of a batch in one array, and how many each row has."""
    parts = batch.column("features").to_pylist()
    return np.frombuffer(b"".join(parts), np.uint16), np.array([len(p) // 2 for p in parts], np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        total += np.bincount(_joined(batch)[0], minlength=BUCKETS)
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found], pa.int64())], names=["bucket", "n"])


def counts(rows: DataFrame) -> list[int]:
    """How often each bucket occurs. One row per bucket and task is summed."""
    summed = rows.select("features").mapInArrow(_counted, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = [0] * BUCKETS
    for bucket, n in summed.collect():
        out[bucket] = n
    return out


def gains(documents: list[int], target: list[int]) -> np.ndarray:
    """Gain of every bucket, in thousandths of a nat, rounded down."""
    all_documents, all_target = float(sum(documents) + BUCKETS), float(sum(target) + BUCKETS)
    each = zip(documents, target, strict=True)
    return np.array([math.floor(1000 * math.log(float(t + 1) * all_documents / (float(s + 1) * all_target))) for s, t in each], np.int64)


def _weighed(gain: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, sizes = _joined(batch)
            summed = np.concatenate([[0], np.cumsum(gain[flat])])
            ends = np.cumsum(sizes)
            weight = (summed[ends] - summed[ends - sizes]) // np.maximum(sizes, 1)
            arrays = [batch.column("id"), batch.column("n_words"), pa.array(sizes), pa.array(weight)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "n_features", "weight"])

    return run


def noise(name: Column, seed: str) -> Column:
    """Gumbel noise in thousandths, rounded down, from the hash of a seed and a row's key."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(name.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def resample(documents: DataFrame, target: DataFrame, draw: Draw = CONTRACT, target_id: str = "item_id") -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document; the rank is null where it is not drawn."""
    found = stage(featured(documents, "doc_id"), "features")
    gain = gains(counts(found), counts(featured(target, target_id)))
    weighed = found.mapInArrow(_weighed(gain), "doc_id long, n_words long, n_features long, weight long")
    scored = stage(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), draw.seed)), "scores")
    enough, names = F.col("n_words") >= draw.least_words, ["doc_id", "n_features", "weight", "score"]
    order, n = ranked(scored.where(enough).select(*names), "score", "doc_id", "rank")
    drawn = order.withColumn("rank", F.when(F.col("rank") <= draw.percent * n // 100, F.col("rank")))
    return drawn.unionByName(scored.where(~enough).select(*names, F.lit(None).cast("long").alias("rank")))


LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

ORACLE = rf"""
with recursive shifted(i, c, k) as (
  select i, i, 0 from range(256) t(i)
  union all
  select i, case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end, k + 1 from shifted where k < 8
),
entry as (select i, c from shifted where k = 8),
texts as (
  select 'd' as kind, row_number() over () as r, doc_id as id, text from documents
  union all select 'b', row_number() over (), item_id, text from benchmark
),
lists as (
  select kind, r, id, regexp_extract_all(translate(coalesce(text, ''), '{LETTERS}', '{LETTERS.lower()}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from texts
),
word as (select kind, r, unnest(words) as w, generate_subscripts(words, 1) as nth from lists),
feature as (
  select kind, r, w as f from word
  union all
  select kind, r, w || ' ' || following from (
    select kind, r, w, lead(w) over (partition by kind, r order by nth) as following from word
  ) where following is not null
),
folded(f, h, c, k) as (
  select f, hex(encode(f)), 4294967295::bigint, 0 from (select distinct f from feature)
  union all
  select f, h, xor(x.c // 256, entry.c), k + 1 from (
    select *, (strpos('0123456789ABCDEF', h[2 * k + 1]) - 1) * 16 + strpos('0123456789ABCDEF', h[2 * k + 2]) - 1 as b
    from folded where 2 * k < length(h)
  ) x join entry on entry.i = xor(x.c % 256, x.b)
),
bucketed as (select f, xor(c, 4294967295) % {BUCKETS} as bucket from folded where 2 * k = length(h)),
placed as (select kind, r, bucket from feature join bucketed using (f)),
total as (
  select coalesce(sum(case when kind = 'd' then 1 end), 0)::double as s,
    coalesce(sum(case when kind = 'b' then 1 end), 0)::double as t from placed
),
gain as (
  select bucket, floor(1000 * ln(
    (count(*) filter (kind = 'b') + 1)::double * (any_value(total.s) + {BUCKETS})
    / ((count(*) filter (kind = 'd') + 1)::double * (any_value(total.t) + {BUCKETS}))))::bigint as g
  from placed, total group by bucket
),
weighed as (
  select r, count(*) as n, floor(sum(g) / count(*))::bigint as weight
  from placed join gain using (bucket) where kind = 'd' group by r
),
scored as (
  select l.id as doc_id, len(l.words) as n_words, coalesce(w.n, 0) as n_features, coalesce(w.weight, 0) as weight,
    coalesce(w.weight, 0) + floor(-1000 * ln(-ln((
      ('0x' || substr(sha256('{CONTRACT.seed}:' || coalesce(l.id::varchar, '')), 1, 8))::bigint + 0.5::double) / 4294967296::double)))::bigint as score
  from lists l left join weighed w on l.r = w.r where l.kind = 'd'
),
ranked as (
  select *, row_number() over (partition by n_words >= {CONTRACT.least_words} order by score desc, doc_id nulls last) as place,
    count(*) over (partition by n_words >= {CONTRACT.least_words}) as n
  from scored
)
select doc_id, n_features::bigint as n_features, weight, score,
  case when n_words >= {CONTRACT.least_words} and place <= {CONTRACT.percent} * n // 100 then place end as rank
from ranked
"""

"""Quality rules as a short-circuit cascade. DataFrame functions only.

Each rule is a boolean column that is true where the rule rejects. On a seeded sample the cascade measures what each
rule costs and how many rows it rejects, and then orders the rules by rejections per second. A cost is the time of
repeated evaluations, less that of the same job without a rule. Evaluation stops at the
first rule that rejects, so the order changes the time that a run takes and never its verdicts.

Defined cases: a null text counts as empty; an empty text has no words and is rejected by `short`; rows repeat in the
result as often as in the input; an empty table gives an empty result; further columns are passed over by `statistics`
and kept by `keep`.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalmill.llm.common import free_name, let, own_columns, words_of

SAMPLE_ROWS = 400
"""Rows of the sample, on average, on which costs and selectivities are measured. They set the order only."""

SEED = 7
REPEATS = 20
"""Evaluations of a rule on every row of the sample."""

LEAST_COST = 1e-4
"""Seconds that every rule costs at least; smaller differences are noise."""

SYMBOLS = r"[#*$%&|<>]"

WINDOW = 5
"""Words in a window of the repetition count."""


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Column


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def window_hashes(hashes: Column) -> Column:
    """A 64-bit hash of every window of five words, from the hashes of the words."""
    each = F.transform(hashes, lambda x, i: F.xxhash64(x, *[F.get(hashes, i + F.lit(k)) for k in range(1, WINDOW)]))
    return F.slice(each, F.lit(1), F.greatest(F.size(hashes) - F.lit(WINDOW - 1), F.lit(0)))


def repeated_words(windows: Column) -> Column:
    """Words inside windows that occur twice or more in the text, the first occurrence included.

    Windows of one text are compared by their hashes. The costly part runs only for texts that repeat a window.
    """
    none = F.lit(0).cast("long")
    ordered = F.array_sort(F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))

    def starts_of(s: Column) -> Column:
        same = lambda x, i: F.coalesce(F.get(s, i)["h"] == x["h"], F.lit(False))
        repeated = F.filter(s, lambda x, i: same(x, i + F.lit(1)) | ((i > F.lit(0)) & same(x, i - F.lit(1))))
        return F.array_sort(F.transform(repeated, lambda x: x["at"]))

    def length(p: Column) -> Column:
        following = lambda i: F.coalesce(F.get(p, i + F.lit(1)), F.lit(1 << 30))
        gaps = F.transform(p, lambda x, i: F.least(F.lit(WINDOW), following(i) - x))
        return F.aggregate(gaps, none, lambda a, g: a + g)

    covered = let(ordered, lambda s: let(starts_of(s), length))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), none).otherwise(covered)


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda a: (F.size(a) - F.size(F.array_distinct(a))).cast("long"))


def with_words(docs: DataFrame, text: Column) -> DataFrame:
    """The words and the hashes of their windows beside the other columns; each is made once for all that use it."""
    split = docs.withColumn("__words", words_of(text)).withColumn("__hashes", word_hashes(F.col("__words")))
    return split.withColumn("__windows", window_hashes(F.col("__hashes"))).drop("__hashes")


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, text and the counts that the base rules use, for every row."""
    own = own_columns(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    return with_words(own, F.col("text")).select(
        "doc_id",
        "text",
        F.size("__words").cast("long").alias("n_words"),
        F.char_length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        duplicate_lines(F.col("text")).alias("n_dup_lines"),
        repeated_words(F.col("__windows")).alias("n_repeat_words"),
    )


def rules(n_words: Column, word_chars: Column, n_symbols: Column, n_dup_lines: Column, n_repeat: Column, text: Column) -> list[Rule]:
    """All rules, the base rules first. The columns may be stored counts or the expressions that make them."""
    capitals = F.regexp_count(text, F.lit(r"\p{Lu}"))
    exclamations = F.char_length(text) - F.char_length(F.replace(text, F.lit("!"), F.lit("")))
    lines = F.size(F.split(text, "\n"))
    return [
        Rule("short", n_words < 10),
        Rule("repetitive", 100 * n_repeat > 20 * n_words),
        Rule("symbols", 10 * n_symbols > 3 * n_words),
        Rule("duplicate_lines", (10 * n_dup_lines > 3 * lines) & (n_dup_lines > 3)),
        Rule("word_length", (word_chars < 2 * n_words) | (word_chars > 20 * n_words)),
        Rule("shouting", (2 * capitals > word_chars) & (n_words >= 10)),
        Rule("exclamations", 10 * exclamations > 3 * n_words),
    ]


def sample_of(docs: DataFrame, rows: int) -> DataFrame:
    """About `rows` rows from all over the table, in one partition. The table is counted and read once more."""
    return docs.sample(fraction=min(1.0, rows / max(1, docs.count())), seed=SEED).repartition(1)


def order(sample: DataFrame, found: list[Rule]) -> list[Rule]:
    """The rules by rejections per second on the sample, the best first. A rule that rejects nothing comes last."""
    sample = sample.persist(StorageLevel.MEMORY_AND_DISK)
    repeated = sample.withColumn(free_name(sample, "again"), F.explode(F.sequence(F.lit(1), F.lit(REPEATS))))

    def timed(rejects: Column) -> tuple[int, float]:
        """Rejections and the shorter time of two runs, the first of which may compile."""
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            rejections = repeated.agg(F.count_if(rejects)).first()[0]
            runs.append(time.perf_counter() - start)
        return rejections, min(runs)

    try:
        sample.count()
        _, idle = timed(F.lit(False))
        measured = []
        for rule in found:
            rejections, seconds = timed(rule.rejects)
            measured.append((rejections / max(seconds - idle, LEAST_COST), rule))
    finally:
        sample.unpersist()
    return [rule for _, rule in sorted(measured, key=lambda x: -x[0])]


def rejected(ordered: list[Rule]) -> Column:
    """True where a rule rejects. CASE evaluates its conditions in order and stops at the first that holds."""
    cascade = F.lit(False)
    for rule in reversed(ordered):
        cascade = F.when(F.coalesce(rule.rejects, F.lit(False)), F.lit(True)).otherwise(cascade)
    return cascade


def judge(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Counts and verdict of every document: base_failed by the base rules, kept by the whole cascade."""
    counted = statistics(docs)
    columns = [F.col(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "text")]
    base, further = rules(*columns)[:2], rules(*columns)[2:]
    further = order(statistics(sample_of(own_columns(docs, "doc_id", "text"), sample_rows)), further)
    failed = base[0].rejects | base[1].rejects
    return counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~F.when(failed, F.lit(True)).otherwise(rejected(further))).alias("kept"),
    )


def keep(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that no rule rejects, with all their columns.

    Here every count is made only when the cascade comes to the rule that needs it; words and windows are made once.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    names = [free_name(docs, n) for n in ("__words", "__hashes", "__windows")]
    words, hashes, windows = map(F.col, names)
    # A filter is not moved below explode: it would make the words anew for each word.
    held = lambda rows, name, value: rows.withColumn(name, F.explode(F.array(value)))
    hashed = lambda rows: held(held(rows, names[0], words_of(text)), names[1], word_hashes(words))
    split = lambda rows: held(hashed(rows), names[2], window_hashes(hashes)).drop(names[1])
    lazily = rules(
        F.size(words).cast("long"),
        F.char_length(F.array_join(words, "")).cast("long"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        duplicate_lines(text),
        repeated_words(windows),
        text,
    )
    ordered = order(split(sample_of(docs, sample_rows)), lazily)
    return split(docs).where(~rejected(ordered)).drop(names[0], names[2])


ORACLE = r"""
WITH t AS (
  SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents),
starts AS (
  SELECT row_no, unnest(generate_series(1, len(words) - 4)) AS pos, words FROM t WHERE len(words) >= 5),
windows AS (SELECT row_no, pos, words[pos:pos + 4] AS w FROM starts),
repeated AS (SELECT row_no, pos, count(*) OVER (PARTITION BY row_no, w) AS n FROM windows),
covered AS (
  SELECT row_no, count(DISTINCT pos + k) AS n_repeat_words
  FROM repeated, (SELECT unnest(generate_series(0, 4)) AS k) WHERE n >= 2 GROUP BY row_no),
counted AS (
  SELECT doc_id, text, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
      - len(list_distinct(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines,
    len(regexp_extract_all(text, '\p{Lu}')) AS upper_letters,
    len(regexp_extract_all(text, '!')) AS exclamations
  FROM t LEFT JOIN covered USING (row_no)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > 3 * n_words OR (10 * n_dup_lines > 3 * n_lines AND n_dup_lines > 3)
    OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR (2 * upper_letters > word_chars AND n_words >= 10)
    OR 10 * exclamations > 3 * n_words) AS kept
FROM judged
"""

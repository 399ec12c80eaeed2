"""Chat formatting after collapsing cumulative snapshots. DataFrame functions only.

A chat log often holds every state of a growing conversation: each entry repeats all turns before it. Every turn gets a
rolling hash of the turns up to it. A conversation is a snapshot if its last hash is also the hash of a proper prefix of
another one; an anti join on (turns, hash) leaves the maximal conversations, which are then rendered.

The rolling hash is the running XOR of two independently salted 64-bit hashes of (place, role, text), 128 bits together,
so it needs neither text comparison nor a pass per prefix length. Both sides of the anti join are collapsed first: all
equal prefixes to one row, all equal conversations to their smallest id and their number. A first turn or a whole
conversation shared by a third of the log is therefore one row there. One conversation is rendered in one row, so its
length is bounded by what a row can hold.

Defined cases: turns are ordered by (turn, role, text), nulls first, and repeated rows count as further turns; a null
text is empty; a null or blank role is `unknown`; roles compare trimmed and in lower case; rows without conv_id form one
conversation; markers of the template inside a text are broken up by a space, so that no text can open or close a turn;
an empty table gives an empty result; further columns are passed over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fiscalmill.llm.common import own_columns

START, END = "<|im_start|>", "<|im_end|>"
"""Markers of the default template."""

SALTS = (17, 40503)
KEY = ["n_turns", "h0", "h1"]


def turns_of(conversations: DataFrame) -> DataFrame:
    """Turns with their place, cleaned role and text, the rolling hashes, and whether a turn is the last one."""
    own = own_columns(conversations, "conv_id", "turn", "role", "text")
    role = F.coalesce(F.nullif(F.lower(F.trim(F.col("role"))), F.lit("")), F.lit("unknown"))
    clean = own.select("conv_id", "turn", role.alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = Window.partitionBy("conv_id").orderBy(*[F.col(c).asc_nulls_first() for c in ("turn", "role", "text")])
    so_far = whole.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = clean.withColumn("n_turns", F.row_number().over(whole)).withColumn("last", F.lead(F.lit(1)).over(whole).isNull())
    for i, salt in enumerate(SALTS):
        placed = placed.withColumn(f"x{i}", F.xxhash64(F.lit(salt), "n_turns", F.lit(salt), "role", F.lit(salt), "text"))
    rolling = [F.bit_xor(f"x{i}").over(so_far).alias(f"h{i}") for i in range(len(SALTS))]
    return placed.select("conv_id", "role", "text", "n_turns", "last", *rolling)


def maximal(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns and n_copies of the conversations that are no proper prefix of another.

    Of equal conversations the one with the smallest id stays (one without an id only if no other has one).
    """
    prefixes = turns.where(~F.col("last")).select(*KEY).distinct()
    whole = turns.where("last").groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies"))
    return whole.join(prefixes, KEY, "left_anti").select("conv_id", "n_turns", "n_copies")


def render(role: Column, text: Column, start: str = START, end: str = END) -> Column:
    """One turn in the template's form."""
    for marker in (start, end):
        text = F.replace(text, F.lit(marker), F.lit(f"{marker[:2]} {marker[2:]}"))
    return F.concat(F.lit(start), role, F.lit("\n"), text, F.lit(f"{end}\n"))


def format_chats(conversations: DataFrame, start: str = START, end: str = END) -> DataFrame:
    """One row per maximal conversation: conv_id, n_turns, n_copies, n_chars and the rendered chat."""
    turns = turns_of(conversations)
    lines = turns.select(
        F.col("conv_id").alias("id"), F.struct("n_turns", render(F.col("role"), F.col("text"), start, end).alias("line")).alias("t")
    )
    chats = lines.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("t")), lambda t: t["line"]), "").alias("chat"))
    kept = maximal(turns)
    found = kept.join(chats, kept["conv_id"].eqNullSafe(chats["id"]))
    return found.select("conv_id", F.col("n_turns").cast("long"), "n_copies", F.char_length("chat").cast("long").alias("n_chars"), "chat")


ORACLE = """
WITH placed AS (
  SELECT conv_id, turn, coalesce(nullif(lower(trim(role)), ''), 'unknown') AS role, coalesce(text, '') AS text
  FROM conversations),
whole AS (
  SELECT conv_id, count(*) AS n_turns,
    list([role, text] ORDER BY turn NULLS FIRST, role, text) AS turns
  FROM placed GROUP BY conv_id),
prefixes AS (
  SELECT DISTINCT turns[1:n] AS turns
  FROM (SELECT turns, unnest(generate_series(1, n_turns - 1)) AS n FROM whole WHERE n_turns > 1)),
kept AS (
  SELECT min(conv_id) AS conv_id, n_turns, count(*) AS n_copies, turns FROM whole
  WHERE turns NOT IN (SELECT turns FROM prefixes) GROUP BY n_turns, turns),
rendered AS (
  SELECT conv_id, n_turns, n_copies, array_to_string(list_transform(turns, lambda t:
    '<|im_start|>' || t[1] || chr(10) || replace(replace(t[2], '<|im_start|>', '<| im_start|>'), '<|im_end|>', '<| im_end|>')
    || '<|im_end|>' || chr(10)), '') AS chat
  FROM kept)
SELECT conv_id, n_turns, n_copies, CAST(length(chat) AS BIGINT) AS n_chars, chat FROM rendered
"""

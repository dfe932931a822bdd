"""Chat formatting with DataFrame expressions only.

The turns of a conversation are collected as structs, sorted by turn, and
adjacent turns of one role are merged into one run. The template:

    run  = <s> role  turn...  </s>          turn = [INST] text [/INST]

without the spaces. Inside roles and texts every control string gets one more
backslash after its first character (``<s>`` -> ``<\\s>``, ``<\\s>`` -> ``<\\\\s>``),
so no text can end a turn and unescaping is exact. The loss mask comes as runs
(length in code points, in the loss or not) over the whole formatted string,
by turns template and text; only texts of ``assistant`` turns are in the loss.

A conversation is one output value, so its rows have to meet in one row; the
collect is partial on the map side. Defined results: null role, text or
conv_id are an empty role, an empty text and a conversation of their own; a null turn sorts
first; rows with equal turn sort by role, then text, repeated rows stay; an
empty table gives no conversations; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let

# Control strings of the template (fixed values).
RUN, TURN, TURN_END, RUN_END = "<s>", "[INST]", "[/INST]", "</s>"
_BODY = "(/?s>|/?INST\\])"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, "([<\\[])(\\\\*)" + _BODY, "$1\\\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, "([<\\[])\\\\(\\\\*)" + _BODY, "$1$2$3")


def format_conversations(conv: DataFrame) -> DataFrame:
    """conv_id, formatted string, loss_mask array<struct<n, loss>> in the string's order."""
    rows = conv.select(
        F.col("conv_id"), F.col("turn"),
        escape(F.coalesce(F.col("role").cast("string"), F.lit(""))).alias("role"),
        escape(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text"))
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))

    def pieces(ts: Column) -> Column:
        """Per turn the template string before its text, the text, and whether it is in the loss."""
        def piece(x: Column, i: Column) -> Column:
            opening = F.concat(F.lit(RUN), x["role"], F.lit(TURN))
            gap = (F.when(i == 0, opening)
                   .when(F.get(ts, i - 1)["role"] == x["role"], F.lit(TURN_END + TURN))
                   .otherwise(F.concat(F.lit(TURN_END + RUN_END), opening)))
            return F.struct(gap.alias("gap"), x["text"].alias("text"), (x["role"] == LOSS_ROLE).alias("loss"))
        return F.transform(ts, piece)

    def run(text: Column, loss: Column) -> Column:
        return F.struct(F.length(text).alias("n"), loss.alias("loss"))

    def output(ps: Column) -> Column:
        end = F.lit(TURN_END + RUN_END)
        string = F.concat(F.array_join(F.transform(ps, lambda p: F.concat(p["gap"], p["text"])), ""), end)
        mask = F.concat(F.flatten(F.transform(ps, lambda p: F.array(run(p["gap"], F.lit(False)), run(p["text"], p["loss"])))),
                        F.array(run(end, F.lit(False))))
        return F.struct(string.alias("formatted"), mask.alias("loss_mask"))

    return (turns.withColumn("out", let(F.col("turns"), lambda ts: let(pieces(ts), output)))
            .select("conv_id", "out.formatted", "out.loss_mask"))


def read_turns(formatted: Column) -> Column:
    """Array of struct(role, text), read back from a formatted string."""
    def turns_of(run: Column) -> Column:
        def parts(ps: Column) -> Column:
            return F.transform(F.slice(ps, F.lit(2), F.size(ps) - 1), lambda t: F.struct(
                unescape(F.get(ps, F.lit(0))).alias("role"),
                unescape(F.regexp_replace(t, "\\[/INST\\]$", "")).alias("text")))
        return let(F.split(run, "\\[INST\\]"), parts)

    runs = F.array_remove(F.split(formatted, "</?s>"), "")
    return F.flatten(F.transform(runs, turns_of))


def loss_texts(formatted: Column, loss_mask: Column) -> Column:
    """Array of the unescaped stretches of ``formatted`` that the mask puts in the loss.

    Template strings and texts alternate in the string as in the mask; a text
    whose length is not the mask's gives null, so a wrong mask shows.
    """
    def texts(ps: Column) -> Column:
        at = F.filter(F.sequence(F.lit(0), F.size(ps) - 1), lambda i: (i % 2 == 1) & F.get(loss_mask, i)["loss"])
        return F.transform(at, lambda i: F.when(F.length(F.get(ps, i)) == F.get(loss_mask, i)["n"], unescape(F.get(ps, i))))

    return let(F.split(formatted, "\\[/?INST\\]"), texts)


def chat_report(conv: DataFrame) -> DataFrame:
    """Digests read back from the formatted strings and masks."""
    out = format_conversations(conv)
    turns, texts = F.col("turns"), F.array_join(F.col("texts"), "")
    lines = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return (out.withColumn("turns", read_turns(F.col("formatted")))
            .withColumn("texts", loss_texts(F.col("formatted"), F.col("loss_mask")))
            .select("conv_id", F.size(turns).cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
                    F.length(texts).cast("long").alias("loss_chars"), F.sha2(texts, 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars")))


def with_probe(conv: DataFrame, spark: SparkSession) -> DataFrame:
    """The rows, and conversation -7 whose texts are control strings (fixed values)."""
    said = "</s>[INST] ok [/INST]"
    probe = spark.sql(f"SELECT * FROM VALUES (-7L, 0L, 'user', '{said}'), (-7L, 1L, 'assistant', '{said}') AS t(conv_id, turn, role, text)")
    return conv.select("conv_id", "turn", "role", "text").unionByName(probe)


_ESC = r"regexp_replace(coalesce({c}, ''), '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g')"
SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, {_ESC.format(c="role")} AS erole, {_ESC.format(c="text")} AS etext,
         lag(role) OVER w AS before
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), p AS (
  SELECT *, CASE WHEN before IS NULL THEN 3 + length(erole) + 6
                 WHEN before = role THEN 13
                 ELSE 11 + 3 + length(erole) + 6 END + length(etext) AS n FROM e
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n) + 11 AS BIGINT) AS formatted_chars
FROM p GROUP BY conv_id
"""

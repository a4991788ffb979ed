"""Chosen and rejected conversations as one prompt and two masked completions.

The longest common prefix of turns (equal role and text) is rendered once, as the prompt;
what follows it on either side is that side's completion. Of a completion, the
assistant's texts and their end marks are trained on; ``spans`` lists them as (start,
length) in characters, everything else is masked.

DataFrame functions only. A pair is one row, so its turns meet in one value, as
the rendered text must; pairs are shuffled by their id, nothing else.

Defined results: turns sort by number, then role and text, nulls first, and all of
them count, also repeated ones. A null role is rendered as "unknown", a null text as empty; two
nulls are equal, a null and an empty text are not. Turns with a null pair id or a side
other than chosen and rejected belong to no pair. A pair with one side only has
an empty prompt. Equal conversations are all prompt, with empty completions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import shared

#: The role whose texts are trained on, and the marks around turns.
TRAINED = "assistant"
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), F.coalesce(turn["role"], F.lit("unknown")), F.lit(CLOSE))


def _body(turn: Column) -> Column:
    return F.concat(F.coalesce(turn["text"], F.lit("")), F.lit(END))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t))), "")


def _spans(turns: Column) -> Column:
    """(start, length) of each trained text with its end mark in the rendered turns."""
    nothing = F.struct(F.lit(0).cast("long").alias("at"),
                       F.expr("cast(array() as array<struct<start: bigint, length: bigint>>)").alias("spans"))

    def step(seen, turn):
        head, body = F.length(_head(turn)).cast("long"), F.length(_body(turn)).cast("long")
        span = F.struct((seen["at"] + head).alias("start"), body.alias("length"))
        spans = F.when(turn["role"] == TRAINED, F.array_append(seen["spans"], span)).otherwise(seen["spans"])
        return F.struct((seen["at"] + head + body).alias("at"), spans.alias("spans"))

    return F.aggregate(turns, nothing, step, lambda seen: seen["spans"])


def format_pairs(turns: DataFrame) -> DataFrame:
    """turns (pair_id, side, turn, role, text) -> a row per pair: prompt, prompt_turns,
    and chosen, chosen_spans, rejected, rejected_spans."""
    turn = F.struct("turn", "role", "text")
    sides = {s: F.sort_array(F.collect_list(F.when(F.col("side") == s, turn))).alias(f"_{s}")
             for s in ("chosen", "rejected")}
    pairs = (turns.filter(F.col("pair_id").isNotNull() & F.col("side").isin(*sides))
             .groupBy("pair_id").agg(*sides.values()))
    a, b = F.col("_chosen"), F.col("_rejected")
    same = F.zip_with(a, b, lambda x, y: F.coalesce(
        x["role"].eqNullSafe(y["role"]) & x["text"].eqNullSafe(y["text"])
        & x.isNotNull() & y.isNotNull(), F.lit(False)))
    # the first turn that differs ends the prompt; the longer side differs beyond the shorter
    differs = F.array_position(same, False)
    pairs = pairs.withColumn("prompt_turns", F.when(differs > 0, differs - 1).otherwise(F.size(a)).cast("int"))
    rest = lambda turns: F.slice(turns, F.col("prompt_turns") + 1, F.size(turns))
    pairs = pairs.select("pair_id", "prompt_turns", F.slice(a, 1, F.col("prompt_turns")).alias("_prompt"),
                         rest(a).alias("_chosen"), rest(b).alias("_rejected"))
    return pairs.select("pair_id", "prompt_turns", _render(F.col("_prompt")).alias("prompt"),
                        *[f(F.col(f"_{s}")).alias(s + suffix) for s in sides
                          for f, suffix in ((_render, ""), (_spans, "_spans"))])


def swapped_replies(conversations: DataFrame) -> DataFrame:
    """Pairs from single conversations (conv_id, turn, role, text): chosen is the
    conversation, rejected the same with its last assistant turn's text replaced by the one
    of conversation conv_id + 1 (by an empty text if there is none). Conversations
    without an assistant turn are equal on both sides."""
    talks = conversations.select("conv_id", "turn", "role", "text").filter("conv_id is not null")
    last = talks.filter(F.col("role") == TRAINED).groupBy("conv_id").agg(
        F.max(F.struct("turn", "text")).alias("last"))
    other = last.select((F.col("conv_id") - 1).alias("conv_id"), F.col("last.text").alias("reply"))
    swap = last.join(other, "conv_id", "left").select(
        "conv_id", F.col("last.turn").alias("at"), F.coalesce("reply", F.lit("")).alias("reply"))
    rows = talks.join(swap, "conv_id", "left")
    replaced = (F.col("role") == TRAINED) & F.col("turn").eqNullSafe(F.col("at"))
    both = F.array(F.struct(F.lit("chosen").alias("side"), F.col("text").alias("text")),
                   F.struct(F.lit("rejected").alias("side"),
                            F.when(replaced, F.col("reply")).otherwise(F.col("text")).alias("text")))
    return rows.select(F.col("conv_id").alias("pair_id"), "turn", "role", F.explode(both).alias("s")).select(
        "pair_id", "s.side", "turn", "role", "s.text")


def op5_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = format_pairs(swapped_replies(shared.table(spark, sf_dir, "conversations")))
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("+", s["start"].cast("string"), s["length"].cast("string"))), ",")
    return (pairs.withColumn("chosen_spans", text("chosen_spans"))
            .withColumn("rejected_spans", text("rejected_spans")).withColumnRenamed("pair_id", "conv_id"))


OP5_SQL = r"""
WITH t AS (SELECT * FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT conv_id, max(turn) AS at, arg_max(text, turn) AS reply FROM t WHERE role = 'assistant' GROUP BY conv_id),
w AS (SELECT l.conv_id, l.at, coalesce(o.reply, '') AS reply FROM l LEFT JOIN l o ON o.conv_id = l.conv_id + 1),
r AS (SELECT t.conv_id, row_number() OVER (PARTITION BY t.conv_id ORDER BY turn, role, text) AS k, role,
             text AS chosen, CASE WHEN role = 'assistant' AND turn = w.at THEN w.reply ELSE text END AS rejected
      FROM t LEFT JOIN w USING (conv_id)),
p AS (SELECT conv_id, coalesce(min(k) FILTER (WHERE chosen IS DISTINCT FROM rejected) - 1, count(*)) AS n
      FROM r GROUP BY conv_id),
s AS (SELECT r.conv_id, k, role, k <= p.n AS shared, p.n,
             '<|' || role || chr(124) || '>' || chr(10) AS head,
             chosen || '<|end|>' || chr(10) AS chosen, rejected || '<|end|>' || chr(10) AS rejected
      FROM r JOIN p USING (conv_id)),
o AS (SELECT *, sum(CASE WHEN shared THEN 0 ELSE length(head) + length(chosen) END) OVER w - length(chosen) AS at_c,
             sum(CASE WHEN shared THEN 0 ELSE length(head) + length(rejected) END) OVER w - length(rejected) AS at_r
      FROM s WINDOW w AS (PARTITION BY conv_id ORDER BY k))
SELECT conv_id, CAST(any_value(n) AS INTEGER) AS prompt_turns,
       coalesce(string_agg(head || chosen, '' ORDER BY k) FILTER (WHERE shared), '') AS prompt,
       coalesce(string_agg(head || chosen, '' ORDER BY k) FILTER (WHERE NOT shared), '') AS chosen,
       coalesce(string_agg(at_c || '+' || length(chosen), ',' ORDER BY k)
                FILTER (WHERE NOT shared AND role = 'assistant'), '') AS chosen_spans,
       coalesce(string_agg(head || rejected, '' ORDER BY k) FILTER (WHERE NOT shared), '') AS rejected,
       coalesce(string_agg(at_r || '+' || length(rejected), ',' ORDER BY k)
                FILTER (WHERE NOT shared AND role = 'assistant'), '') AS rejected_spans
FROM o GROUP BY conv_id
"""

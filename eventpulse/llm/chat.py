"""Preference formatting: the longest common turn prefix as one prompt, and two masked completions.

A pair is a chosen and a rejected conversation, and comes out as one row. Turns are compared in order by role and text; those before the first
difference are rendered once, as the prompt; what follows is rendered as each side's completion, with spans [start, end)
in code points of what a model learns from: assistant texts with their end mark. Other completion turns, and the prompt, carry no loss.

Rows are first reduced to one for each turn of a side, with map-side combining, so turns repeated any number of times are spread over tasks; then a pair's
turns are put together where its row is made. A row is as large as its two conversations are, whatever their length.

Defined results: rows without conversation or turn are left out; null role is ``unknown``, null text empty. Of several rows for one turn of a side the
least by (role, text) is kept, and only kept rows are compared and rendered, so repeated rows change nothing. A missing side is an empty completion, with nothing common. Pairs
that are wholly alike have empty completions. ``<|`` in texts is escaped as ``<\\|``, so a text can't make a mark. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

END = "<|end|>"


def _head(role: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"))


def format_preferences(turns: DataFrame) -> DataFrame:
    """From turns (pair_id, side, turn, role, text), side being ``chosen`` or ``rejected``, to one row a pair."""
    escaped = lambda c: F.replace(c, F.lit("<|"), F.lit("<\\|"))
    rows = turns.where("pair_id is not null and turn is not null and side in ('chosen', 'rejected')").select(
        "pair_id", F.col("turn").cast("long").alias("turn"), "side",
        escaped(F.coalesce(F.col("role").cast("string"), F.lit("unknown"))).alias("role"), escaped(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text"),
    )
    least = rows.groupBy("pair_id", "turn", "side").agg(F.min(F.struct("role", "text")).alias("t"))
    piece = F.concat(_head(F.col("t.role")), F.col("t.text"), F.lit(END + "\n"))
    entry = F.struct("turn", piece.alias("piece"), (F.col("t.role") == "assistant").alias("learn"), F.length(_head(F.col("t.role"))).alias("lead"))
    of = lambda side: F.array_sort(F.collect_list(F.when(F.col("side") == side, entry)))
    sides = least.groupBy("pair_id").agg(of("chosen").alias("a"), of("rejected").alias("b"))
    # Equal pieces whose heads are of one length have equal roles and texts.
    same = lambda x, y: (x["turn"] == y["turn"]) & (x["lead"] == y["lead"]) & (x["piece"] == y["piece"])
    differs = F.array_position(F.transform(F.zip_with("a", "b", same), lambda s: F.coalesce(s, F.lit(False))), False).cast("int")
    common = F.when(differs > 0, differs - 1).otherwise(F.size("a"))
    rest = lambda c: F.slice(c, F.col("k") + 1, F.size(c))
    made = sides.select("pair_id", "a", "b", common.alias("k")).select("pair_id", F.slice("a", F.lit(1), F.col("k")).alias("p"), rest("a").alias("c"), rest("b").alias("r"))
    text = lambda c: F.array_join(F.transform(c, lambda x: x["piece"]), "")

    def spans(c: str) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("s"))

        def add(acc: Column, x: Column) -> Column:
            end = acc["at"] + F.length(x["piece"])
            span = F.concat((acc["at"] + x["lead"]).cast("string"), F.lit(":"), (end - 1).cast("string"))
            return F.struct(end.alias("at"), F.when(x["learn"], F.array_append(acc["s"], span)).otherwise(acc["s"]).alias("s"))

        return F.array_join(F.aggregate(c, start, add, lambda acc: acc["s"]), ",")

    return made.select(
        "pair_id", F.size("p").cast("long").alias("n_prompt_turns"), F.size("c").cast("long").alias("n_chosen_turns"), F.size("r").cast("long").alias("n_rejected_turns"),
        text("p").alias("prompt"), text("c").alias("chosen"), spans("c").alias("chosen_spans"), text("r").alias("rejected"), spans("r").alias("rejected_spans"),
    )


def op4_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations in pairs: 2k is chosen, 2k + 1 rejected."""
    turns = table(spark, sf_dir, "conversations").select(F.floor(F.col("conv_id") / 2).cast("long").alias("pair_id"), F.when(F.pmod("conv_id", F.lit(2)) == 0, "chosen").otherwise("rejected").alias("side"), "turn", "role", "text")
    return format_preferences(turns)


_ORACLE = rf"""
with t as (select floor(conv_id / 2)::bigint pair_id, turn::bigint turn, case when conv_id % 2 = 0 then 'c' else 'r' end side, replace(coalesce(role, 'unknown'), '<|', '<\|') role, replace(coalesce(text, ''), '<|', '<\|') txt
 from conversations where conv_id is not null and turn is not null),
k as (select pair_id, turn, side, min(struct_pack(a := role, b := txt)) x from t group by all),
d as (select pair_id, turn, min(x) filter (side = 'c') c, min(x) filter (side = 'r') r from k group by all),
s as (select pair_id, coalesce(min(turn) filter (c is distinct from r), 9223372036854775807) split from d group by pair_id),
p as (select pair_id, turn, side, turn < split common, '<|' || x.a || '|>' || chr(10) lead, '<|' || x.a || '|>' || chr(10) || x.b || '{END}' || chr(10) piece, x.a = 'assistant' learn from k join s using (pair_id)),
o as (select *, coalesce(sum(length(piece)) over (partition by pair_id, side, common order by turn rows between unbounded preceding and 1 preceding), 0)::bigint off from p),
z as (select *, (off + length(lead))::varchar || ':' || (off + length(piece) - 1)::varchar span from o)
select pair_id, count(*) filter (common and side = 'c') n_prompt_turns, count(*) filter (not common and side = 'c') n_chosen_turns, count(*) filter (not common and side = 'r') n_rejected_turns,
 coalesce(string_agg(piece, '' order by turn) filter (common and side = 'c'), '') prompt,
 coalesce(string_agg(piece, '' order by turn) filter (not common and side = 'c'), '') chosen, coalesce(string_agg(span, ',' order by turn) filter (not common and side = 'c' and learn), '') chosen_spans,
 coalesce(string_agg(piece, '' order by turn) filter (not common and side = 'r'), '') rejected, coalesce(string_agg(span, ',' order by turn) filter (not common and side = 'r' and learn), '') rejected_spans
from z group by pair_id"""

QUERIES = {"op4_preference_formatting": op4_preference_formatting}
ORACLES = {"op4_preference_formatting": _ORACLE}

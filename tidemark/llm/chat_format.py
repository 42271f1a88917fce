"""Preference formatting of paired conversations. DataFrame operations only.

The turns that a chosen and a rejected conversation have in common at their start become one
prompt; what follows becomes two completions, with the character spans that are trained on.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LAST_ID, let

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
TRAINED = "assistant"
TURN = "struct<turn:bigint,role:string,text:string>"


def neighbours(conversations: DataFrame) -> DataFrame:
    """Turns with pair_id and chosen: conversations 2k and 2k + 1 are pair k, the even one is
    chosen. Turns without a conv_id belong to no conversation and are left out."""
    return conversations.where("conv_id is not null").select(
        F.shiftright(F.col("conv_id").cast("long"), 1).alias("pair_id"),
        (F.pmod("conv_id", F.lit(2)) == 0).alias("chosen"), "turn", "role", "text",
    )


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit("\n"))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(
        turns, lambda t: F.concat(_head(t), t["text"], F.lit(CLOSE))), "")


def _spans(turns: Column) -> Column:
    """(start, length) in characters of what is trained on: the assistant's texts, each with
    the mark that closes it."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"),
                     F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def step(acc, t):
        head, body = F.length(_head(t)), F.length(t["text"]) + len(CLOSE)
        span = F.struct((acc["at"] + head).cast("bigint").alias("start"),
                        body.cast("bigint").alias("length"))
        return F.struct(
            (acc["at"] + head + body).cast("bigint").alias("at"),
            F.when(t["role"] == TRAINED, F.concat(acc["spans"], F.array(span)))
            .otherwise(acc["spans"]).alias("spans"),
        )

    return F.aggregate(turns, start, step, lambda acc: acc["spans"])


def _common(a: Column, b: Column) -> Column:
    """How many turns at the start have the same role and text."""
    def differ(k):
        x, y = F.get(a, k), F.get(b, k)
        return (x["role"] != y["role"]) | (x["text"] != y["text"])

    shorter = F.least(F.size(a), F.size(b))
    first = F.array_position(F.transform(F.sequence(F.lit(0), shorter - 1), differ), F.lit(True))
    return F.when(shorter == 0, F.lit(0)).when(first == 0, shorter).otherwise(first - 1).cast("int")


def format_preferences(turns: DataFrame) -> DataFrame:
    """One row for each pair_id of turns (pair_id, chosen, turn, role, text).

    prompt is the longest common prefix of turns, rendered once; chosen and rejected are the
    renderings of what follows, with the (start, length) spans of their trained characters.
    usable tells whether both have one and they differ.

    Turns are ordered by turn, role and text; a null turn comes last, a null role or text is
    empty, and a repeated turn counts once. A side without turns is empty. A null pair_id is
    left out, as is a null ``chosen``. An empty table gives an empty one.
    """
    turn = F.struct(
        F.coalesce(F.col("turn").cast("long"), F.lit(LAST_ID)).alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))

    def side(is_chosen):
        return F.sort_array(F.collect_set(F.when(F.col("chosen") == is_chosen, turn)))

    sides = turns.where("pair_id is not null and chosen is not null").groupBy("pair_id").agg(
        side(True).alias("a"), side(False).alias("b"))
    cut = sides.select("pair_id", let(F.col("a"), lambda a: let(F.col("b"), lambda b: let(
        _common(a, b), lambda n: F.struct(
            n.alias("n"), F.slice(a, 1, n).alias("p"), F.slice(a, n + 1, F.size(a)).alias("c"),
            F.slice(b, n + 1, F.size(b)).alias("r"))))).alias("x"))
    out = cut.select(
        "pair_id", F.col("x.n").alias("n_prompt_turns"), _rendered(F.col("x.p")).alias("prompt"),
        _rendered(F.col("x.c")).alias("chosen"), _spans(F.col("x.c")).alias("chosen_spans"),
        _rendered(F.col("x.r")).alias("rejected"), _spans(F.col("x.r")).alias("rejected_spans"),
    )
    return out.withColumn("usable", (F.size("chosen_spans") > 0) & (F.size("rejected_spans") > 0)
                          & (F.col("chosen") != F.col("rejected")))

"""Chat formatting by rotating perspectives.

A dialogue of several parties is rendered once for every participant: the own
turns as the assistant's, all others as turns of named users, with the
assistant's words marked for training. Built-in functions only.

A dialogue is rendered in parts of ``PART_TURNS`` turns, so that no task holds a
dialogue of unbounded length; the texts of all parts in order are the dialogue. The
turns of longer dialogues are numbered by their place in a sorted, range-partitioned
table, whatever turn numbers they have. Usual dialogues have one part and need none of that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import stored
from stationflow.operators.series import with_positions

PART_TURNS = 256
#: Long dialogues whose ids are sent to every executor; beyond, they are joined by a shuffle.
MOST_SENT = 500_000
UNNAMED = "unknown"
ASSISTANT = "<|assistant|>\n"
USER = ("<|user name=", "|>\n")
END = "<|end|>\n"


def escaped(text: Column) -> Column:
    """Markers inside a text are broken, so that no text can open or close a turn."""
    return F.replace(text, F.lit("<|"), F.lit("<\\|"))


def in_parts(said: DataFrame, part_turns: int) -> DataFrame:
    """``conv_id, turn, name, text`` with ``part``: the turn's place in its dialogue by ``part_turns``, from 0."""
    sizes = said.groupBy(F.col("conv_id").alias("of")).agg(F.count("*").alias("n"))
    long = stored(sizes.where(F.col("n") > part_turns).select("of"), "long-dialogues")
    few = long.count() <= MOST_SENT
    same = F.col("conv_id").eqNullSafe(F.col("of"))

    def sent(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if few else df

    short = said.join(sent(long), same, "left_anti").withColumn("part", F.lit(0).cast("long"))
    placed = with_positions(said.join(sent(long), same, "left_semi"), "conv_id", ["turn", "name", "text"])
    starts = placed.groupBy(F.col("conv_id").alias("of")).agg(F.min("_row").alias("start"))
    part = F.floor((F.col("_row") - F.col("start")) / part_turns).alias("part")
    return short.union(placed.join(sent(starts), same).select(*said.columns, part))


def rotate(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """``conv_id, participant, part, n_turns, messages, text, masks`` per participant and part.

    ``messages`` is an array of ``role, name, content, train``; ``masks`` holds
    the half-open character ranges of ``text`` to train on, the end marker
    included. Turns stand by number, then name, then text; repeated rows are
    kept; a null number comes first. A part has ``part_turns`` turns, the last one fewer. A null role is the participant
    ``unknown``, a null text is empty, a null ``conv_id`` is a dialogue of its
    own. Other columns are ignored; no turns, no rows.
    """
    plain = turns.select("conv_id", "turn", F.coalesce("role", F.lit(UNNAMED)).alias("name"), F.coalesce("text", F.lit("")).alias("text"))
    said = in_parts(plain, part_turns).select("conv_id", "part", F.struct("turn", "name", "text").alias("said"))
    who = plain.select(F.col("conv_id").alias("of"), F.col("name").alias("participant")).distinct()
    parts = said.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list("said")).alias("said"))
    pairs = parts.join(who, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")

    def message(turn: Column) -> Column:
        own = turn["name"] == F.col("participant")
        return F.struct(
            F.when(own, "assistant").otherwise("user").alias("role"), turn["name"].alias("name"), turn["text"].alias("content"), own.alias("train")
        )

    def rendered(m: Column) -> Column:
        head = F.when(m["train"], F.lit(ASSISTANT)).otherwise(F.concat(F.lit(USER[0]), escaped(m["name"]), F.lit(USER[1])))
        return F.struct(head.alias("head"), F.concat(escaped(m["content"]), F.lit(END)).alias("body"), m["train"].alias("train"))

    def advance(state: Column, piece: Column) -> Column:
        begin = state["at"] + F.length(piece["head"])
        end = begin + F.length(piece["body"])
        span = F.array(F.struct(begin.alias("begin"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(piece["train"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    none = F.array().cast("array<struct<begin:int,end:int>>")
    return (
        pairs.withColumn("messages", F.transform("said", message))
        .withColumn("pieces", F.transform("messages", rendered))
        .select(
            "conv_id",
            "participant",
            "part",
            F.size("said").alias("n_turns"),
            "messages",
            F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"])), "").alias("text"),
            F.aggregate("pieces", F.struct(F.lit(0).alias("at"), none.alias("spans")), advance, lambda s: s["spans"]).alias("masks"),
        )
    )

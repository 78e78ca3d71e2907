"""Chat formatting of logged conversations after their cumulative snapshots are collapsed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Turn numbers that one task numbers and hashes together.
CHUNK = 512
#: Template of a turn.
OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def _hash(salt: str, *parts: Column) -> Column:
    """64 bits of the parts, with NULL and empty text told apart."""
    shown = [x for p in parts for x in (p.isNull(), p)]
    return F.xxhash64(F.lit(salt), *shown)


def prefixes(turns: DataFrame) -> DataFrame:
    """``turns`` (``conv``, ``turn``, ``role``, ``text``, one row each) with ``place`` (from 1) and
    ``h1``, ``h2``, the rolling hash of the conversation up to there.

    The rolling hash is the exclusive-or of hashes of place, role and text, 128 bits in all, so it
    can be rolled in pieces: conversations are cut into chunks of turn numbers, which are numbered
    and rolled apart and then moved by the sums of the chunks before. A conversation however
    long is thus never in one task, and texts do not take part: only their hashes are moved.
    """
    rows = turns.select(
        "conv", "turn", F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / CHUNK).alias("chunk"),
        _hash("role and text", F.col("role"), F.col("text")).alias("said"),
        _hash("text and role", F.col("text"), F.col("role")).alias("also"),
    )
    rows = written(rows, "chat-turns")
    chunks = rows.groupBy("conv", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offset = chunks.select("conv", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inner = Window.partitionBy("conv", "chunk").orderBy(F.col("turn").asc_nulls_first(), "said", "also")
    placed = rows.join(offset, ["conv", "chunk"]).withColumn("place", F.col("offset") + F.row_number().over(inner))
    placed = placed.select(
        "conv", "turn", "chunk", "said", "also", "place",
        F.xxhash64("place", "said", "also").alias("t1"), F.xxhash64("also", "place", "said").alias("t2"),
    )
    placed = written(placed, "chat-places")
    sums = placed.groupBy("conv", "chunk").agg(F.bit_xor("t1").alias("s1"), F.bit_xor("t2").alias("s2"))
    sums = sums.select(
        "conv", "chunk",
        F.coalesce(F.bit_xor("s1").over(before), F.lit(0)).alias("s1"),
        F.coalesce(F.bit_xor("s2").over(before), F.lit(0)).alias("s2"),
    )
    upto = Window.partitionBy("conv", "chunk").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return placed.join(sums, ["conv", "chunk"]).select(
        "conv", "turn", "said", "also", "place",
        F.bit_xor("t1").over(upto).bitwiseXOR(F.col("s1")).alias("h1"),
        F.bit_xor("t2").over(upto).bitwiseXOR(F.col("s2")).alias("h2"),
    )


def maximal(rolled: DataFrame) -> DataFrame:
    """``conv``, ``turns``, ``copies`` of the conversations of ``prefixes`` that no other one begins with.

    Of conversations that are alike, the one with the smallest id stays and counts them all. One
    that is a proper prefix of another, however many log it, goes by an anti-join of its
    whole hash with the hashes of all shorter beginnings. Both sides are reduced to distinct hashes
    first, so that a conversation logged very often is one row on either side.
    """
    ends = rolled.groupBy("conv").agg(F.max("place").alias("place"))
    whole = rolled.join(ends, ["conv", "place"]).groupBy("place", "h1", "h2").agg(
        F.min("conv").alias("conv"), F.count("*").alias("copies")
    )
    inner = rolled.join(ends.withColumnRenamed("place", "last"), "conv").where("place < last")
    inner = inner.select("place", "h1", "h2").distinct()
    kept = whole.join(inner, ["place", "h1", "h2"], "left_anti")
    return kept.select("conv", F.col("place").alias("turns"), "copies")


def render(role: Column, text: Column) -> Column:
    """A turn in the template. Marks of the template inside a text are broken, so none is forged."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), r"<\|(im_start|im_end)\|>", "< |$1| >")
    return F.concat(F.lit(OPEN), F.coalesce(role, F.lit("user")), F.lit(MIDDLE), plain, F.lit(CLOSE))


def chat_turns(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The rendered turns of all maximal conversations.

    Columns: ``conv_id``, ``place`` (from 1), ``turns`` (of the conversation), ``copies`` (how often the
    same conversation was logged), ``role``, ``rendered``. The rendered turns of a conversation,
    joined by place, are its text; a conversation is left as rows, since its length has no bound.

    Turns are ordered by their number (NULL first) and, where it repeats, in a fixed order of
    their hashes; rows that repeat in all four columns count once. A NULL id is no conversation and
    its rows go. A NULL role is shown as ``user`` and a NULL text as empty, but both differ from
    those when conversations are compared. An empty table gives an empty result; other
    columns do not matter.
    """
    turns = conversations.select(
        F.col(conv_id).alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text")
    )
    turns = turns.where("conv is not null").dropDuplicates()
    rolled = written(prefixes(turns), "chat-prefixes")
    kept = written(maximal(rolled), "chat-kept")
    places = rolled.join(kept, "conv").select(
        F.col("conv").alias("c"), F.col("turn").alias("t"), "said", "also", "place", "turns", "copies"
    )
    hashed = turns.withColumn("s", _hash("role and text", F.col("role"), F.col("text"))).withColumn(
        "a", _hash("text and role", F.col("text"), F.col("role"))
    )
    same = (F.col("conv") == F.col("c")) & F.col("turn").eqNullSafe(F.col("t")) & (F.col("s") == F.col("said")) & (F.col("a") == F.col("also"))
    return hashed.join(places, same).select(
        F.col("conv").alias("conv_id"), "place", "turns", "copies", F.coalesce("role", F.lit("user")).alias("role"),
        render(F.col("role"), F.col("text")).alias("rendered"),
    )

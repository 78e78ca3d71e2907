"""Exact duplicates by progressive refinement: length, prefix hash, full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import FILTER_BITS, ascii_lower, flagged, places_of, written

#: Code points that the prefix hash covers.
PREFIX = 256


def _repeated(rows: DataFrame, *keys: str) -> DataFrame:
    """The keys that more than one row has."""
    return rows.groupBy(*keys).count().where("count > 1").select(*keys)


def exact_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    carry: dict[str, Column] | None = None,
    bits: int = FILTER_BITS,
) -> DataFrame:
    """Every row of ``docs`` with its group of equal texts.

    Texts are equal when identical after lower-casing A-Z. Columns: ``doc_id``, ``keep_id`` (the
    largest id of the group), ``group_size`` (rows), ``kept``, and what ``carry`` names, each
    computed from its row by the given expression over the columns of ``docs``.

    The first scan counts lengths, the second prefix hashes of rows whose length occurs again, and
    the third computes the full hash, only of rows whose length and prefix hash occur again; all
    others are unique and done. Only fixed-size values are shuffled, never texts: what occurs
    again comes back to the scans as a filter of 2 to the power ``bits`` places, whatever their
    number. A row that shares a place with another key is refined once more than needed, which
    changes no result; that share rises steadily with the number of repeated keys.

    A NULL text counts as empty. A group whose ids are all NULL, or a repeated row (same id and
    text), keeps exactly one row; where several rows carry the largest id one of them is kept,
    and they are alike. NULL ids lose against others. An empty table gives an empty result.
    Other columns, whatever their names, do not matter.
    """
    carry = carry or {}
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("id"),
        F.octet_length(content).alias("n"),  # lower-casing A-Z changes no length
        content.alias("content"),
        F.struct(F.lit(None).alias("_"), *(c.alias(n) for n, c in carry.items())).alias("x"),
    )
    lengths = places_of(_repeated(rows, "n"), "exact-length", bits)
    rows = flagged(rows, ("n",), lengths, "same_length", bits)
    prefix = F.xxhash64(ascii_lower(F.left(F.col("content"), F.lit(PREFIX))))
    rows = rows.withColumn("p", F.when(F.col("same_length"), prefix))
    prefixes = places_of(_repeated(rows.where("same_length"), "n", "p"), "exact-prefix", bits)
    rows = flagged(rows, ("n", "p"), prefixes, "same_prefix", bits)
    again = F.col("same_length") & F.col("same_prefix")
    rows = written(
        rows.select(
            "id",
            F.when(again, F.sha2(ascii_lower(F.col("content")), 256)).alias("key"),
            again.alias("again"),
            F.monotonically_increasing_id().alias("row"),
            "x",
        ),
        "exact-rows",
    )
    repeated = rows.where("again")
    groups = repeated.groupBy("key").agg(F.max(F.struct("id", "row")).alias("best"), F.count("*").alias("size"))
    # Written first, so that the join shuffles both sides plainly and a hot key can be split.
    groups = written(groups, "exact-groups")
    unique = rows.where("not again").select("*", F.struct("id", "row").alias("best"), F.lit(1).cast("long").alias("size"))
    return unique.drop("key").unionByName(repeated.join(groups, "key").drop("key")).select(
        F.col("id").alias("doc_id"),
        F.col("best.id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"),
        *(F.col(f"x.{n}").alias(n) for n in carry),
    )

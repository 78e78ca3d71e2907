"""Order-free digests of layers: which rows differ, found without moving rows that agree.

A cell is a date and a part of the series (by hash). Its digest is the number of its rows, and the sum
and the exclusive-or of their hashes; tasks combine digests before they are shuffled, so two
layers are compared by a few numbers per cell. Only in cells that differ are keys looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.derive import as_time, micros

DAY, PART = "cell_date", "cell_part"
ROWS, SUM, XOR = "rows", "hash_sum", "hash_xor"
PARTS = 256


def _normal(df: DataFrame, entity: Sequence[str], time: str, compared: Sequence[str], parts: int) -> DataFrame:
    """Key, cell and hash of every row; a time may be an instant or its text, which is the same."""
    instant = as_time(F.col(time))
    # an array of texts and not one joined text: no two different rows look alike
    content = F.to_json(F.array(*[F.col(c).cast("string") for c in [*entity, *compared]], micros(F.col(time)).cast("string")))
    return df.select(
        *entity, instant.alias(time), F.to_date(instant).alias(DAY),
        F.pmod(F.xxhash64(*entity), F.lit(parts)).cast("int").alias(PART), F.xxhash64(content).alias("hash"),
    )


def digest_cells(df: DataFrame, entity: Sequence[str], time: str, compared: Sequence[str] = (), parts: int = PARTS) -> DataFrame:
    """One row per cell with rows: date, part, and the digest of keys and ``compared`` columns.

    Compared columns must have the same type on both sides. Rows without a time form the cells of a NULL date.
    """
    return _digest(_normal(df, entity, time, compared, parts).groupBy(DAY, PART), F.lit(1), F.col("hash").cast("decimal(38,0)"), F.col("hash"))


def digest_dates(cells: DataFrame) -> DataFrame:
    """Digests one level up: one row per date."""
    return _digest(cells.groupBy(DAY), F.col(ROWS), F.col(SUM), F.col(XOR))


def _digest(grouped, rows: Column, total: Column, mixed: Column) -> DataFrame:
    return grouped.agg(F.sum(rows).alias(ROWS), F.sum(total).alias(SUM), F.bit_xor(mixed).alias(XOR))


def differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """Cells or dates whose digests differ, with the rows on both sides; absent on a side counts as 0 rows."""
    on = [c for c in (DAY, PART) if c in left.columns]
    digest = F.struct(ROWS, SUM, XOR)
    sides = [side.select(*on, *[(digest if name == own else F.lit(None)).alias(name) for name in ("l", "r")]) for side, own in ((left, "l"), (right, "r"))]
    both = sides[0].unionByName(sides[1]).groupBy(*on).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    counts = [F.coalesce(F.col(side)[ROWS], F.lit(0)).alias(f"{name}_rows") for side, name in (("l", "left"), ("r", "right"))]
    return both.where(~F.col("l").eqNullSafe(F.col("r"))).select(*on, *counts)


def differing_keys(
    left: DataFrame, right: DataFrame, entity: Sequence[str], time: str, compared: Sequence[str] = (), parts: int = PARTS
) -> DataFrame:
    """Keys whose rows are not the same on both sides: the key, ``left_rows``, ``right_rows`` and ``kind``.

    ``kind`` is ``missing`` (left only), ``unexpected`` (right only), ``copies`` (more rows on one side) or
    ``changed`` (other values). Digests are compared by date, then by cell within the dates that differ, and
    keys are shuffled for the cells that still differ only.
    """
    cells = [digest_cells(side, entity, time, compared, parts) for side in (left, right)]
    dates = differing(*[digest_dates(c) for c in cells]).select(F.col(DAY).alias("d"))
    within = [c.join(dates, F.col(DAY).eqNullSafe(F.col("d")), "left_semi") for c in cells]
    wrong = differing(*within).select(F.col(DAY).alias("d"), F.col(PART).alias("p"))

    def suspects(side: DataFrame, name: str) -> DataFrame:
        rows = _normal(side, entity, time, compared, parts)
        rows = rows.join(wrong, F.col(DAY).eqNullSafe(F.col("d")) & (F.col(PART) == F.col("p")), "left_semi")
        return rows.select(*entity, time, "hash", F.lit(int(name == "left")).alias("l"), F.lit(int(name == "right")).alias("r"))

    stacked = suspects(left, "left").unionByName(suspects(right, "right"))
    found = stacked.groupBy(*entity, time).agg(
        F.sum("l").alias("left_rows"), F.sum("r").alias("right_rows"),
        F.sum(F.col("hash").cast("decimal(38,0)") * (F.col("l") - F.col("r"))).alias("apart"),
    )
    kind = (
        F.when(F.col("right_rows") == 0, "missing").when(F.col("left_rows") == 0, "unexpected")
        .when(F.col("left_rows") != F.col("right_rows"), "copies").when(F.col("apart") != 0, "changed")
    )
    return found.withColumn("kind", kind).where("kind is not null").drop("apart")

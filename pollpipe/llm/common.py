"""What the operators for training data share: ASCII text rules, checked joins, scratch tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pollpipe.session import shared_dir

#: Characters between words, as a class for regular expressions: space and \t \n \v \f \r.
SPACE = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Most rows that are ever broadcast; beyond it the same join shuffles.
BROADCAST_ROWS = 500_000

#: A filter has 2 to this power places, 64 to a row: it is broadcast, and never over 262,144 rows.
FILTER_BITS = 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.char_length(text)


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lower-cased and all else as it is."""
    return F.when(is_ascii(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def word_count(text: Column) -> Column:
    """Number of words (maximal runs without white space) as a long; 0 for NULL."""
    text = F.coalesce(text, F.lit(""))
    blank = F.lit(" \t\n\x0b\f\r")
    outer = lambda c: F.when(F.instr(blank, c) > 0, 1).otherwise(0)
    inner = F.size(F.split(text, SPACE + "+")) - outer(F.left(text, F.lit(1))) - outer(F.right(text, F.lit(1)))
    return F.when(text == "", 0).otherwise(inner).cast("long")


def fresh(spark: SparkSession, label: str) -> str:
    """A new path in the folder shared by the cluster."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """``df`` as a table in the folder shared by the cluster: computed once, survives executors."""
    path = fresh(df.sparkSession, label)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def few(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a written table is small enough to be broadcast."""
    return df.count() <= rows


def places_of(keys: DataFrame, label: str, bits: int = FILTER_BITS) -> DataFrame:
    """A filter of the rows of ``keys``: the places that they hash to, as a written table of bounded size."""
    place = F.xxhash64(*keys.columns).bitwiseAND(F.lit((1 << bits) - 1))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place").bitwiseAND(F.lit(63)).cast("int"))
    words = keys.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(one).alias("bits"))
    return written(words, label)


def flagged(rows: DataFrame, keys: tuple[str, ...], places: DataFrame, name: str, bits: int = FILTER_BITS) -> DataFrame:
    """``rows`` and a boolean column: whether their place is among ``places``, so false only for keys that are not.

    The more keys a filter was made of, the more other rows are flagged too; what follows has to be
    right for those. ``rows`` may have no columns ``word`` and ``bits``.
    """
    place = F.xxhash64(*keys).bitwiseAND(F.lit((1 << bits) - 1))
    met = rows.withColumn("word", F.shiftright(place, 6)).join(F.broadcast(places), "word", "left")
    inside = F.getbit("bits", place.bitwiseAND(F.lit(63)).cast("int")) == 1
    return met.withColumn(name, F.coalesce(inside, F.lit(False))).drop("word", "bits")

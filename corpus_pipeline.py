"""From raw documents to packed sequences: the stages, and a run over one folder of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pollpipe.llm.common import table, written
from pollpipe.llm.exact import exact_groups
from pollpipe.llm.mix import mix
from pollpipe.llm.packing import pack, tokenize
from pollpipe.llm.quality import quality
from pollpipe.llm.queries import tokenizer_path
from pollpipe.llm.simhash import simhash_groups
from pollpipe.session import prepare

#: SQL cannot train a classifier, hash shingles or tokenize; tests use a plain version instead.
ORACLE_SQL = None


def _whole(docs: DataFrame, *needed: str) -> DataFrame:
    """The columns that a stage works with, and beside them each row whole as one column."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole_row")
    return docs.select("doc_id", "text", *needed, row)


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels beside the tables, does not reject."""
    scored = quality(_whole(docs), table(spark, sf_dir, "labels"), keep=("whole_row",))
    return scored.where("predicted = 1").select("whole_row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, the one with the largest id."""
    return exact_groups(_whole(docs), carry={"whole_row": F.col("whole_row")}).where("kept").select("whole_row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of close fingerprints stays, the one with the smallest id."""
    grouped = simhash_groups(_whole(docs), keep=("whole_row",))
    return grouped.where("first").select("whole_row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix of sources takes it, none up to twice."""
    mixed = mix(_whole(docs, "source"), keep=("whole_row",))
    times = F.explode(F.array_repeat(F.lit(0), F.col("copies")))
    return mixed.select("whole_row", times.alias("time")).select("whole_row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their token ids (``ids``, little-endian unsigned 32-bit) and their places.

    The pieces of a sequence by ``offset`` are its tokens. A document that comes twice is packed twice.
    """
    pieces = tokenize(docs, tokenizer_path(), numbered=True)
    placed = pack(written(pieces, "pieces", "zstd"), by_number=True)
    return placed.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality classifier", filter_quality),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, each stage working on all that the one before has kept."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)

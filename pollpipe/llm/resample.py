"""Importance resampling of documents towards a target set, over hashed word features."""

from __future__ import annotations

import math
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, written

#: What a word is made of once A-Z are lower-cased: digits, a-z and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Rows that a task works on, and hands over, together.
ROWS = 256


@lru_cache(maxsize=1)
def splitter():
    """An untrained pre-tokenizer that returns the words of a text with their offsets."""
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)


@lru_cache(maxsize=1 << 16)
def crc(feature: str) -> int:
    return zlib.crc32(feature.encode())


def bucket_counts(text: str, buckets: int, longest: int) -> tuple[int, Counter]:
    """Number of words of a lower-cased text, and how often its features fall into each bucket.

    Features are the runs of 1 to ``longest`` consecutive words. A run is given by the offsets of its first
    and last word; what lies between its words becomes one space.
    """
    offsets = [span for _, span in splitter().pre_tokenize_str(text)]
    words = [text[a:b] for a, b in offsets]
    found = Counter(words)
    for width in range(2, longest + 1):
        found.update(" ".join(words[i : i + width]) for i in range(len(words) - width + 1))
    counts = Counter()
    for feature, times in found.items():
        counts[crc(feature) % buckets] += times
    return len(words), counts


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, few at a time: what is made of them takes many times their room."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def hashed(docs: DataFrame, text: Column, keep: list[Column], buckets: int, longest: int) -> DataFrame:
    """``n_words``, ``bucket`` and ``times`` (arrays) of every row, with the columns in ``keep``; written."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            words, ends, bucket, times = [], [0], array("i"), array("q")
            for value in batch.column("text"):
                n, counts = bucket_counts(value.as_py() or "", buckets, longest)
                words.append(n)
                bucket.extend(counts.keys())
                times.extend(counts.values())
                ends.append(len(bucket))
            ends = pa.array(ends, pa.int32())
            held = (pa.array(np.array(bucket, np.int32)), pa.array(np.array(times, np.int64)))
            new = [pa.array(words, pa.int64()), *(pa.ListArray.from_arrays(ends, values) for values in held)]
            names = [name for name in batch.schema.names if name != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *new], [*names, "n_words", "bucket", "times"])

    rows = docs.select(*keep, ascii_lower(F.coalesce(text, F.lit(""))).alias("text"))
    fields = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in rows.schema if f.name != "text")
    return written(rows.mapInArrow(describe, f"{fields}n_words long, bucket array<int>, times array<long>"), "hashed-features")


def histogram(described: DataFrame, buckets: int) -> list[int]:
    """How many features each bucket holds; as many numbers reach the driver as there are buckets."""
    pairs = described.select(F.explode(F.arrays_zip("bucket", "times")).alias("p")).select("p.bucket", "p.times")
    held = [0] * buckets
    for r in pairs.groupBy("bucket").agg(F.sum("times").alias("n")).collect():
        held[r["bucket"]] = r["n"]
    return held


def gains(raw: list[int], target: list[int], unit: int = 1000) -> np.ndarray:
    """Per bucket the logarithm of target share over raw share, both smoothed by one, in whole units."""
    k, s, t = len(raw), float(sum(raw) + len(raw)), float(sum(target) + len(target))
    return np.array([math.floor(unit * math.log(float(target[i] + 1) * s / (float(raw[i] + 1) * t))) for i in range(k)], np.int64)


def resample(
    docs: DataFrame,
    target: DataFrame,
    buckets: int = 10_000,
    longest: int = 1,
    least_words: int = 20,
    percent: int = 10,
    seed: int = 2024,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Every row of ``docs`` with ``n_features``, ``weight``, ``score`` and ``rank``.

    ``weight`` adds up the gains of a document's features (0 without any), ``score`` adds Gumbel
    noise that depends on the id alone, so that the highest scores are a sample without
    replacement in proportion to exp(weight). Of the documents with at least ``least_words``
    words the highest ``percent`` in a hundred are drawn, ties to the smaller id; ``rank`` counts them
    from 1 and is NULL for all others.

    Texts are tokenized once; the counts per bucket are written and read again for the weights.
    Histograms are added up in tasks before they are shuffled. Ranks come from a sort by range,
    numbered inside each range, not from a window over all rows.

    NULL and empty texts have no features. A NULL id draws the noise of an empty id and comes before
    all others in ties. Repeated rows are rows of their own; rows with one id and score are told apart
    by their number of features, and if that is the same they are alike. Empty tables give
    empty results, an empty target a histogram of nothing. Other columns do not matter.
    """
    described = hashed(docs, F.col(text), [F.col(doc_id).alias("doc_id")], buckets, longest)
    aimed = hashed(target, F.col(text), [], buckets, longest)
    gain = gains(histogram(described, buckets), histogram(aimed, buckets))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            bucket, times = (batch.column(c) for c in ("bucket", "times"))
            each = gain[bucket.flatten().to_numpy(zero_copy_only=False)] * times.flatten().to_numpy(zero_copy_only=False)
            upto = np.concatenate([[0], np.cumsum(each)])
            features = np.concatenate([[0], np.cumsum(times.flatten().to_numpy(zero_copy_only=False))])
            ends = np.concatenate([[0], np.cumsum(bucket.value_lengths().to_numpy(zero_copy_only=False))])
            weight = upto[ends[1:]] - upto[ends[:-1]]
            noise = [math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))) for h in batch.column("h").to_pylist()]
            new = [features[ends[1:]] - features[ends[:-1]], weight, weight + np.array(noise, np.int64).reshape(-1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_words"), *(pa.array(x, pa.int64()) for x in new)],
                ["doc_id", "n_words", "n_features", "weight", "score"],
            )

    noise = F.conv(F.left(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), F.lit(8)), 16, 10)
    id_type = described.schema["doc_id"].dataType.simpleString()
    scored = described.select("doc_id", "n_words", "bucket", "times", noise.cast("long").alias("h")).mapInArrow(
        score, f"doc_id {id_type}, n_words long, n_features long, weight long, score long"
    )
    scored = written(scored, "scored")
    return ranked(scored, F.col("n_words") >= least_words, percent).select("doc_id", "n_features", "weight", "score", "rank")


def ranked(scored: DataFrame, eligible: Column, percent: int) -> DataFrame:
    """``scored`` with ``rank`` 1, 2, ... for the first ``percent`` in a hundred of the eligible rows, else NULL."""
    order = [F.col("score").desc(), F.col("doc_id").asc(), F.col("n_features").asc(), F.col("weight").asc()]
    place = F.monotonically_increasing_id()  # number of the range, then the row's number in it
    runs = scored.where(eligible).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", place)
    runs = written(runs, "ranked-runs")
    parts = runs.groupBy(F.shiftright("place", 33).alias("part")).agg(F.count("*").alias("n"))
    sizes = {r["part"]: r["n"] for r in parts.collect()}  # one number per range
    drawn, before, rows = sum(sizes.values()) * percent // 100, 0, []
    for part in sorted(sizes):
        rows.append((part, before))
        before += sizes[part]
    offsets = scored.sparkSession.createDataFrame(rows, "part long, before long")
    number = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    runs = runs.withColumn("part", F.shiftright("place", 33)).join(F.broadcast(offsets), "part").withColumn("number", number)
    first = runs.select(*scored.columns, F.when(F.col("number") <= drawn, F.col("number")).alias("rank"))
    return first.unionByName(scored.where(~eligible).withColumn("rank", F.lit(None).cast("long")))

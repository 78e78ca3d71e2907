"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import word_count, written

#: Steps into which the order of a source is cut when its sampling threshold is looked for.
STEPS = 1 << 14
#: Random numbers have this many values, all exact as doubles.
GRAIN = 1 << 52


def uniform(*parts: Column) -> Column:
    """A number above 0 and below 1 that depends on ``parts`` alone."""
    digest = F.md5(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)).cast("binary"))
    return (F.conv(F.left(digest, F.lit(13)), 16, 10).cast("double") + 0.5) / float(GRAIN)


def longer_likelier(size: Column, half: int = 100) -> Column:
    """Inclusion odds that rise with the words of a document, from 1 / ``half`` without words towards 1: a preference for :func:`mix`."""
    return (size + 1) / (size + F.lit(float(half)))


def source_targets(sources: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """``source``, ``source_size``, ``target`` from ``source``, ``source_size``.

    The k-th source by code point (NULL last) weighs ``weights[k % len(weights)]``. Targets share
    ``share`` times the total by weight, none above ``most`` times its source; what is above is
    reshared among the others. That is a common level times the weight, cut at the limit: a source
    is cut if, with the level at which it just reaches its limit, all targets together do not
    exceed the total. One row per source is all that is sorted here.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    weighed = sources.withColumn("w", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (turn + 1).cast("int")))
    limit = F.col("source_size") * float(most)
    weighed = weighed.withColumn("limit", limit).withColumn("level", F.col("limit") / F.col("w"))
    everything = Window.partitionBy()
    upto = Window.orderBy("level").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    summed = weighed.select(
        "source", "source_size", "w", "limit", "level",
        (F.sum("source_size").over(everything) * float(share)).alias("total"),
        F.sum("w").over(everything).alias("all_w"),
        F.sum("limit").over(upto).alias("limits"),
        F.sum("w").over(upto).alias("limited_w"),
    )
    cut = F.col("limits") + F.col("level") * (F.col("all_w") - F.col("limited_w")) <= F.col("total")
    flagged = summed.withColumn("cut", cut)
    given = F.coalesce(F.sum(F.when(F.col("cut"), F.col("limit"))).over(everything), F.lit(0.0))
    free = F.sum(F.when(~F.col("cut"), F.col("w"))).over(everything)
    return flagged.select(
        "source", "source_size",
        F.when(F.col("cut"), F.col("limit")).otherwise(F.col("w") * ((F.col("total") - given) / free)).alias("target"),
    )


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    most: int = 2,
    seed: int = 7,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    odds: Column | Callable[[Column], Column] | None = None,
    keep: tuple[str, ...] = (),
    steps: int = STEPS,
) -> DataFrame:
    """Every row of ``docs`` with the number of times the mix takes it.

    Columns: ``doc_id``, ``source``, ``size`` (words), ``source_size``, ``target`` (words, of the
    source), ``copies``, and the columns of ``docs`` named in ``keep``.

    A source has to be taken target/size times. The whole part of that is certain for each of its
    rows. The rest is an inclusion probability; rows are ranked by the odds of a random number
    over the odds of that probability, and the first of them are taken up to the words still
    missing: the cut is where the sum comes nearest to them, so a source misses its target by half a
    document at most. ``odds`` may give rows a preference of their own, a positive factor on
    their inclusion odds (NULL: 1): an expression over ``docs``, or a function of the size, such as
    :func:`longer_likelier`. The random number comes from the seed, id and text, so
    reruns agree whatever the partitioning; rows that repeat id and text are ordered arbitrarily
    but alike.

    The order is cut into ``steps`` steps. Sums of words by step, taken coarsely and then
    finely, give the step in which the sum passes the target; only the rows of that step are
    sorted, so a source that holds a third of all rows is not sorted in one task.

    NULL or empty texts have no words and count 0; a source without words has target 0 and
    none of its rows is taken. NULL sources are one source, last in order. NULL ids are allowed.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
        uniform(F.lit(seed), F.col(doc_id), F.md5(content.cast("binary"))).alias("u"),
        (F.coalesce(odds, F.lit(1.0)) if isinstance(odds, Column) else F.lit(1.0)).cast("double").alias("odds"),
        F.struct(F.lit(None).alias("_"), *keep).alias("kept"),
    )
    rows = written(rows, "mix-rows")
    if callable(odds) and not isinstance(odds, Column):  # words are counted once, then their odds are plain arithmetic
        rows = rows.withColumn("odds", F.coalesce(odds(F.col("size")), F.lit(1.0)).cast("double"))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = written(source_targets(sizes, weights, share, most), "mix-targets")
    rows = _with_source(rows, targets)
    ratio = F.when(F.col("source_size") > 0, F.try_divide("target", "source_size")).otherwise(0.0)
    rows = rows.withColumn("whole", F.least(F.floor(ratio), F.lit(most)).cast("int")).withColumn("part", ratio - F.col("whole"))
    rank = F.try_divide(F.col("u") / (1 - F.col("u")), F.col("odds") * F.try_divide(F.col("part"), 1 - F.col("part")))
    rows = rows.withColumn("x", F.when(F.col("part") > 0, rank / (1 + rank)))
    rows = rows.withColumn("step", F.floor(F.col("x") * steps).cast("int"))
    rows = rows.withColumn("missing", F.col("target") - F.col("whole") * F.col("source_size"))
    cuts = written(_cuts(rows, steps), "mix-cuts")
    rows = _with_source(rows, cuts)
    at_cut = rows.where("step = cut_step")
    in_order = Window.partitionBy("source").orderBy("x", "u", "id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = F.col("words_before") + F.sum("size").over(in_order) - F.col("size") / 2
    at_cut = at_cut.withColumn("extra", (middle <= F.col("missing")).cast("int"))
    clear = rows.where("step is null or cut_step is null or step <> cut_step").withColumn(
        "extra", F.when(F.col("step").isNull(), 0).when(F.col("cut_step").isNull(), 1).otherwise((F.col("step") < F.col("cut_step")).cast("int"))
    )
    return clear.unionByName(at_cut).select(
        F.col("id").alias("doc_id"), "source", "size", "source_size", "target",
        (F.col("whole") + F.col("extra")).alias("copies"), *(F.col(f"kept.`{c}`").alias(c) for c in keep),
    )


def _with_source(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    """A table of one row per source beside the rows; Spark broadcasts it if it is small enough."""
    return rows.join(
        per_source.withColumnRenamed("source", "of_source"), F.col("source").eqNullSafe(F.col("of_source")), "left"
    ).drop("of_source")


def _cuts(rows: DataFrame, steps: int) -> DataFrame:
    """For each source whose words pass what is missing: the step where they do, the words before.

    First among about the square root of the steps, then within the one found, so that
    neither sum over a source's steps is long.
    """
    wide = max(1, math.isqrt(steps))
    rows = rows.where("x is not null").select("source", "step", (F.col("step") / wide).cast("int").alias("stretch"), "size", "missing")
    coarse = _passing(rows.withColumn("words_before", F.lit(0).cast("long")), "stretch")
    coarse = written(coarse.withColumnRenamed("stretch", "cut_stretch"), "mix-stretches")
    inside = _with_source(rows, coarse).where("stretch = cut_stretch")
    return _passing(inside, "step").withColumnRenamed("step", "cut_step")


def _passing(rows: DataFrame, by: str) -> DataFrame:
    """``source``, ``by``, ``words_before``: where the words from the smallest ``by`` on pass the missing ones."""
    summed = rows.groupBy("source", by).agg(
        F.sum("size").alias("words"), F.max("missing").alias("missing"), F.max("words_before").alias("words_before")
    )
    upto = Window.partitionBy("source").orderBy(by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = summed.withColumn("upto", F.col("words_before") + F.sum("words").over(upto))
    passes = summed.where("upto > missing and upto - words <= missing")
    return passes.select("source", by, (F.col("upto") - F.col("words")).alias("words_before"))

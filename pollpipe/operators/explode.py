"""Raw polls to one row per record, with schema drift made visible.

Nothing is lost: what cannot become a record is a *rejected* row with a reason.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casting import json_kind, json_text
from ..sources.polls import poll_failure

META = ("fetched_at", "status_code", "raw_record_json", "schema_extra_fields", "schema_missing_fields")
KINDS = "field_kinds"
REASON = "reject_reason"

# Reasons for rejected payloads and records
INVALID_JSON, NO_ARRAY, NOT_OBJECT = "invalid_json", "no_data_array", "record_not_object"


def is_one_json_value(text: Column) -> Column:
    """True for exactly one JSON value.

    The JSON parsers stop after the first value, so ``{...} rest`` would pass; inside
    brackets it has to be an array of length one.
    """
    return F.coalesce(F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1, F.lit(False))


def extra_fields(keys: Column, expected: Sequence[str]) -> Column:
    """Sorted names that were not expected."""
    return F.sort_array(F.array_except(keys, _names(expected)))


def missing_fields(keys: Column, expected: Sequence[str]) -> Column:
    """Sorted expected names that are absent; a key with a null value is present."""
    return F.sort_array(F.array_except(_names(expected), keys))


def _names(expected: Sequence[str]) -> Column:
    if not expected:
        return F.array().cast("array<string>")
    return F.array(*[F.lit(n) for n in expected])


def explode_polls(polls: DataFrame, expected: Sequence[str]) -> DataFrame:
    """One row per payload record plus one per rejected poll, payload or record.

    Output: poll metadata, the record's own JSON, the two drift lists, one text column
    per expected field (NULL if absent), the JSON kind of each field in ``field_kinds``,
    and ``reject_reason``, NULL for good rows. A rejected poll or payload keeps its
    payload text in ``raw_record_json``. Columns other than the envelope's are kept.
    """
    carried = [c for c in polls.columns if c not in ("headers", "url", "payload", "error", *META)]
    failure = poll_failure(F.col("status_code"), F.col("error")) if "error" in polls.columns else (
        poll_failure(F.col("status_code"), F.lit(None).cast("string"))
    )
    data = F.from_json("payload", "data ARRAY<STRING>")["data"]
    judged = polls.select(
        *carried, "fetched_at", "status_code", "payload", data.alias("data"), failure.alias("failure")
    ).withColumn(
        REASON,
        F.coalesce(
            F.col("failure"),
            F.when(~is_one_json_value(F.col("payload")) | F.col("payload").isNull(), INVALID_JSON),
            F.when(F.col("data").isNull(), NO_ARRAY),
        ),
    )
    # An empty array is a valid poll without records. The outer form keeps Spark from adding
    # a filter on the array, which would parse every payload a second time.
    items = F.when(F.col(REASON).isNull(), F.col("data")).otherwise(F.array("payload"))
    records = (
        judged.select(*carried, "fetched_at", "status_code", REASON, F.posexplode_outer(items).alias("pos", "raw"))
        .where(F.col("pos").isNotNull())
        .withColumnRenamed("raw", "raw_record_json")
    )
    # one parse into a struct of the expected fields; of a repeated key the last value counts
    layout = ", ".join(f"`{n}` VARIANT" for n in expected)
    raw = F.when(F.col(REASON).isNull(), F.col("raw_record_json"))
    # as the column of a generator, the keys are not parsed anew by a filter on the reason
    listed = records.select("*", F.inline(F.array(F.struct(F.json_object_keys(raw).alias("keys")))))
    fields = listed.withColumn("parsed", F.from_json(raw, layout))
    return fields.select(
        *carried,
        "fetched_at",
        "status_code",
        "raw_record_json",
        extra_fields(F.col("keys"), expected).alias("schema_extra_fields"),
        missing_fields(F.col("keys"), expected).alias("schema_missing_fields"),
        *[json_text(F.col("parsed")[n]).alias(n) for n in expected],
        F.struct(*[json_kind(F.col("parsed")[n]).alias(n) for n in expected]).alias(KINDS),
        F.coalesce(F.col(REASON), F.when(F.col("keys").isNull(), NOT_OBJECT)).alias(REASON),
    )


def accepted(exploded: DataFrame) -> DataFrame:
    return exploded.where(F.col(REASON).isNull()).drop(REASON)


def rejected(exploded: DataFrame) -> DataFrame:
    """Quarantine: time, status, text and reason of everything that is not a record."""
    return exploded.where(F.col(REASON).isNotNull()).select(
        "fetched_at", "status_code", F.col("raw_record_json").alias("raw_json"), REASON
    )


def drift_counts(bronze: DataFrame) -> DataFrame:
    """One row: records with extra and with missing fields."""
    return bronze.agg(
        F.count_if(F.size("schema_extra_fields") > 0).alias("extra_field_rows"),
        F.count_if(F.size("schema_missing_fields") > 0).alias("missing_field_rows"),
    )

"""Check a table against its contract: columns, types, values, grain and freshness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.derive import micros
from ..spec import Contract

RESULT = "rule string, column_name string, violations bigint"


def governed(df: DataFrame, contract: Contract) -> DataFrame:
    """Only the columns that the contract publishes, matched without regard to case."""
    return df.select(*[F.col(name).alias(name) for name in contract.names])


def schema_violations(df: DataFrame, contract: Contract) -> list[tuple[str, str, int]]:
    """Missing, unexpected and mistyped columns, from the schema alone."""
    actual = {name.lower(): kind for name, kind in df.dtypes}
    declared = {c.name.lower(): c for c in contract.columns}
    found = [("missing_column", c.name, 1) for name, c in declared.items() if name not in actual]
    found += [("unexpected_column", name, 1) for name in df.columns if name.lower() not in declared]
    found += [
        ("wrong_type", c.name, 1) for name, c in declared.items() if name in actual and actual[name] != c.type
    ]
    return found


def check_contract(df: DataFrame, contract: Contract, as_of: Column | None = None) -> DataFrame:
    """One row per rule with the number of violations; zero means the rule holds.

    All rules on values are one aggregate pass; the grain is a second one, because only
    it has to shuffle keys.
    """
    spark = df.sparkSession
    schema_rows = schema_violations(df, contract)
    present = {name.lower() for name in df.columns}
    rules: list[tuple[str, str, Column]] = []
    for c in contract.columns:
        if c.name.lower() not in present:
            continue
        value = F.col(c.name)
        if not c.nullable:
            rules.append(("not_null", c.name, F.count_if(value.isNull())))
        if c.values:
            rules.append(("allowed_values", c.name, F.count_if(value.isNotNull() & ~value.isin(*c.values))))
    if contract.time and contract.max_lag_minutes is not None and contract.time.lower() in present:
        now = F.current_timestamp() if as_of is None else as_of
        age = (micros(now) - micros(F.max(contract.time))) / F.lit(6e7)
        late = F.when(age <= contract.max_lag_minutes, 0).otherwise(1)
        rules.append(("freshness", contract.time, late))
    report = spark.createDataFrame(schema_rows, RESULT)
    if rules:
        totals = df.agg(*[value.cast("bigint").alias(f"v{i}") for i, (_, _, value) in enumerate(rules)])
        rows = F.array(*[
            F.struct(F.lit(rule).alias("rule"), F.lit(name).alias("column_name"), F.col(f"v{i}").alias("violations"))
            for i, (rule, name, _) in enumerate(rules)
        ])
        report = report.unionByName(totals.select(F.inline(rows)))
    if all(k.lower() in present for k in contract.grain):
        # NULL is a key value like any other here, as in a GROUP BY
        copies = F.count(F.lit(1)) - F.count_distinct(F.struct(*contract.grain))
        report = report.unionByName(df.agg(copies.cast("bigint").alias("violations")).select(
            F.lit("unique_grain").alias("rule"), F.lit(",".join(contract.grain)).alias("column_name"), "violations"
        ))
    return report

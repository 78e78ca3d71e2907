"""Layer tables: parquet, partitioned by poll date, addressed by path or by name.

Writers append or replace whole date partitions. There is no transaction log, so a
table takes one writer at a time; a write job that dies leaves the table as it was,
because the files move into place only when the job commits.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import setting

DATE = "poll_date"


@dataclass(frozen=True)
class FeedTable:
    """A table of feed rows with time column ``time``.

    A ``location`` with a slash is a path, anything else a catalog name. The
    partition column is maintained here and hidden from readers. Rows are sorted inside
    each file by ``cluster_by`` and time, so that a filter on one series skips row groups.
    """

    spark: SparkSession
    location: str
    time: str
    cluster_by: tuple[str, ...] = ()

    @property
    def by_path(self) -> bool:
        return "/" in self.location

    def exists(self) -> bool:
        if not self.by_path:
            return self.spark.catalog.tableExists(self.location)
        try:
            return DATE in self.spark.read.parquet(self.location).columns
        except AnalysisException as problem:
            # any other problem must not look like a table that is still to be created
            if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return False
            raise

    def path(self) -> str:
        """Folder of the table's files."""
        if self.by_path:
            return self.location
        facts = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.location}")
        return facts.where(F.col("col_name") == "Location").first()["data_type"]

    def schema(self, with_date: bool = False) -> T.StructType:
        stored = self._stored().schema
        return stored if with_date else T.StructType([f for f in stored.fields if f.name != DATE])

    def _stored(self) -> DataFrame:
        return self.spark.read.parquet(self.location) if self.by_path else self.spark.table(self.location)

    def read(
        self,
        since: dt.datetime | None = None,
        after: dt.datetime | None = None,
        before: dt.datetime | None = None,
        until: dt.datetime | None = None,
        dates: list[dt.date | None] | None = None,
        untimed: bool = False,
    ) -> DataFrame:
        """Rows with ``time >= since``, ``> after``, ``< before`` and ``<= until``; with
        ``untimed`` also the rows whose time is missing or unreadable.

        Bounds are driver-side UTC times. Each one prunes date partitions as well, and
        on a typed time column reaches the parquet scan.
        """
        df = self._stored()
        stored_type = dict(df.dtypes)[self.time]
        # compare in the stored type, so that the bound can be pushed into the scan
        time_type = "timestamp" if stored_type == "string" else stored_type
        time = F.col(self.time).try_cast(time_type)
        outside = F.col(DATE).isNull() if untimed else F.lit(False)
        if dates is not None:
            known = F.col(DATE).isin([d for d in dates if d is not None])
            df = df.where(known | F.col(DATE).isNull() if None in dates else known)
        for bound, keep, on_date in (
            (since, lambda t: time >= t, lambda d: F.col(DATE) >= d),
            (after, lambda t: time > t, lambda d: F.col(DATE) >= d),
            (before, lambda t: time < t, lambda d: F.col(DATE) <= d),
            (until, lambda t: time <= t, lambda d: F.col(DATE) <= d),
        ):
            if bound is not None:
                # microseconds pin the instant whatever time zone the driver runs in
                instant = F.timestamp_micros(F.lit(to_micros(bound))).cast(time_type)
                df = df.where(outside | (on_date(F.lit(_utc(bound).date())) & keep(instant)))
        return df.drop(DATE)

    def newest(self) -> DataFrame:
        """Rows at the newest time; reads the last date only."""
        moment = self.max_time()
        if moment is None:
            return self.read().where(F.lit(False))
        return self.read(since=moment, until=moment)

    def max_time(self) -> dt.datetime | None:
        """Newest time in the table (UTC), read from its last date partition only."""
        if not self.exists():
            return None
        df = self._stored()
        for last in sorted(self.dates(), reverse=True):
            newest = df.where(F.col(DATE) == F.lit(last)).agg(F.max(self._micros())).first()[0]
            if newest is not None:  # a date may be left without rows
                return from_micros(newest)
        return None

    def dates(self) -> list[dt.date]:
        """The dates of the table, from the names of its partitions; no file is opened."""
        if self.by_path:
            names = self._stored().inputFiles()
        else:
            names = [r[0] for r in self.spark.sql(f"SHOW PARTITIONS {self.location}").collect()]
        found = {m[1] for n in names if (m := re.search(DATE + r"=(\d{4}-\d\d-\d\d)", n))}
        return sorted(dt.date.fromisoformat(d) for d in found)

    def signatures(self) -> DataFrame:
        """``day`` and ``signature`` of the files of every date; names and sizes only, nothing is opened."""
        files = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(self.path())
        day = F.regexp_extract("path", DATE + r"=(\d{4}-\d\d-\d\d)/", 1)
        whole = F.xxhash64("path", "length", "modificationTime")
        found = files.select(F.nullif(day, F.lit("")).cast("date").alias("day"), whole.alias("h"))
        parts = F.concat_ws(":", F.count(F.lit(1)), F.bit_xor("h"), F.sum(F.col("h").cast("decimal(38,0)")))
        return found.groupBy("day").agg(parts.alias("signature"))

    def with_date(self, df: DataFrame) -> DataFrame:
        # UTC calendar day, whatever the session time zone
        return df.withColumn(DATE, F.date_add(F.lit(dt.date(1970, 1, 1)), self._epoch_day()))

    def _epoch_day(self) -> Column:
        return F.floor(self._micros() / F.lit(86_400_000_000)).cast("int")

    def _micros(self) -> Column:
        # text that is no time has no date and sorts nowhere
        return F.unix_micros(F.col(self.time).try_cast("timestamp"))

    def dates_in(self, df: DataFrame) -> list[dt.date | None]:
        """Dates touched by ``df``: at most one value per calendar day, None for rows without a time."""
        return [r[0] for r in self.with_date(df).select(DATE).distinct().collect()]

    def _gathered(self, df: DataFrame) -> DataFrame:
        # few files per date: small dates share a task, a large one is split over several
        return self.with_date(df).hint("rebalance", F.col(DATE)).sortWithinPartitions(
            DATE, *self.cluster_by, self.time
        )

    def earliest_in(self, df: DataFrame) -> dt.datetime | None:
        """Earliest time of ``df`` in UTC; None if it has none."""
        return from_micros(df.agg(F.min(self._micros())).first()[0])

    def append(self, df: DataFrame) -> None:
        writer = self._gathered(df).write.mode("append").partitionBy(DATE).format("parquet")
        writer.save(self.location) if self.by_path else writer.saveAsTable(self.location)

    def replace_dates(self, df: DataFrame) -> None:
        """Replace exactly the date partitions present in ``df``; others stay untouched.

        Reading the same partitions in ``df`` is safe: new files are staged and moved in
        after every read has finished.
        """
        dated = self._gathered(df)
        if self.by_path:
            (
                dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy(DATE).format("parquet").save(self.location)
            )
            return
        # insertInto takes the overwrite mode from the session only
        with setting(self.spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            dated.select(*self._stored().columns).write.mode("overwrite").insertInto(self.location)

    def compact(self, dates: list[dt.date]) -> None:
        """Rewrite the given dates with few files; frequent small appends need this."""
        self.replace_dates(self.read(dates=dates))

    def columns(self) -> DataFrame:
        """One row per column: name, type and nullability."""
        fields = self.read().schema.fields
        rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in fields]
        return self.spark.createDataFrame(rows, "column_name string, data_type string, nullable boolean")


def _utc(moment: dt.datetime) -> dt.datetime:
    return moment if moment.tzinfo is not None else moment.replace(tzinfo=dt.timezone.utc)


def to_micros(moment: dt.datetime) -> int:
    """Microseconds since 1970 of a UTC time."""
    delta = _utc(moment) - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds


def from_micros(value: int | None) -> dt.datetime | None:
    """UTC time (without tzinfo) of a microsecond count, independent of the driver's zone."""
    if value is None:
        return None
    return dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=value)

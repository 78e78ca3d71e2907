"""Change feed of a table by arrival: which of its files a consumer has not taken yet.

A watermark over poll times loses what arrives late. Files do not: whatever times its rows
hold, a file is new until a consumer has committed it. The consumer's log has one small file per
committed batch. It becomes visible in one rename, so a batch is taken or not; one that
was loaded but not committed is loaded again, which merges by key absorb.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import DATE, FeedTable

#: Most files that one batch takes; the driver holds their names. More files are more batches.
FILES_PER_BATCH = 100_000
#: Every so many batches the log is gathered into the file of that batch.
FOLD = 64

_LOG_SCHEMA = "path string, batch long"
_DATE_IN_PATH = re.compile(re.escape(DATE) + r"=([^/]+)/")


@dataclass(frozen=True)
class Batch:
    """Files to be taken together, as batch ``number`` of the log."""

    table: FeedTable
    number: int
    paths: tuple[str, ...]

    def read(self) -> DataFrame:
        """Exactly the rows of these files, whatever their times."""
        reader = self.table.spark.read.schema(self.table.schema(with_date=True)).option("basePath", self.table.path())
        return reader.parquet(*self.paths).drop(DATE)

    @property
    def dates(self) -> list[dt.date | None]:
        """The dates that the files belong to, from their names; None stands for rows without a time."""
        names = {m[1] for p in self.paths if (m := _DATE_IN_PATH.search(p))}
        return [dt.date.fromisoformat(n) if re.fullmatch(r"\d{4}-\d\d-\d\d", n) else None for n in sorted(names)]


@dataclass(frozen=True)
class Arrivals:
    """What one consumer still has to take of ``table``; ``log`` is the folder of its log.

    Compacting a table makes new files of known rows. They are taken once more, and a merge by
    key adds nothing from them. One consumer at a time uses a log.
    """

    table: FeedTable
    log: str
    spark: SparkSession = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "spark", self.table.spark)

    def files(self) -> DataFrame:
        """``path`` and ``modified`` of every file of the table; no file is opened."""
        listed = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(self.table.path())
        return listed.select("path", F.col("modificationTime").alias("modified"))

    def last(self) -> int:
        """Number of the last committed batch, 0 before the first; from the names in the log."""
        try:
            names = self.spark.read.schema(_LOG_SCHEMA).parquet(self.log).inputFiles()
        except AnalysisException as problem:
            if problem.getCondition() == "PATH_NOT_FOUND":
                return 0
            raise
        return max((int(m[1]) for n in names if (m := re.search(r"/batch=(\d+)/", n))), default=0)

    def taken(self, last: int | None = None) -> DataFrame:
        """``path`` of every file taken so far, some perhaps more than once."""
        last = self.last() if last is None else last
        if not last:
            return self.spark.createDataFrame([], "path string")
        log = self.spark.read.schema(_LOG_SCHEMA).parquet(self.log)
        return log.where(F.col("batch") >= last - last % FOLD).select("path")

    def pending(self) -> DataFrame:
        """``path`` and ``modified`` of the files not taken yet."""
        return self.files().join(self.taken(), "path", "left_anti")

    def next_batch(self, files_per_batch: int = FILES_PER_BATCH) -> Batch | None:
        """The oldest files not taken yet; None if there are none."""
        if not self.table.exists():
            return None
        last = self.last()
        rest = self.files().join(self.taken(last), "path", "left_anti")
        paths = tuple(r["path"] for r in rest.orderBy("modified", "path").limit(files_per_batch).collect())
        return Batch(self.table, last + 1, paths) if paths else None

    def commit(self, batch: Batch) -> None:
        """Mark the files of ``batch`` as taken. One file of the log: all of them or none."""
        rows = self.spark.createDataFrame([(p,) for p in batch.paths], "path string")
        if batch.number % FOLD == 0:
            # what has left the table meanwhile need not be remembered
            rows = rows.union(self.taken(batch.number - 1).join(self.files(), "path", "left_semi")).distinct()
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.log}/batch={batch.number}")

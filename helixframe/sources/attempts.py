"""Tables of a run that may break and go on: every attempt writes apart, and a run is what its committed attempts wrote.

An attempt's part of a table is a folder ``<table>/attempt=<id>`` below the
target. The last thing an attempt writes is its row in ``commits``, one file that
appears whole or not at all; readers take the folders of committed attempts
only, so a run that breaks anywhere leaves nothing that is read. A fresh run's
commit takes the place of all earlier ones.
"""

from __future__ import annotations

import datetime
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

COMMIT = "attempt string, fresh boolean, tables array<string>, settings map<string,string>"


class Attempts:
    """The attempts below one target folder."""

    def __init__(self, spark: SparkSession, target: str):
        self.spark, self.target = spark, target.rstrip("/")

    def commits(self) -> list:
        """Commits that count, in order: the last fresh one and those after it (a row for each run, not for its files)."""
        try:
            rows = self.spark.read.schema(COMMIT).json(f"{self.target}/commits").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        rows.sort(key=lambda r: r["attempt"])
        fresh = [k for k, r in enumerate(rows) if r["fresh"]]
        return rows[fresh[-1] :] if fresh else rows

    def begin(self) -> str:
        """The id of a new attempt; ids sort in order of time."""
        now = datetime.datetime.now(datetime.UTC).strftime("%Y%m%dT%H%M%S%f")
        return f"{now}-{uuid.uuid4().hex[:8]}"

    def path(self, attempt: str, table: str) -> str:
        return f"{self.target}/{table}/attempt={attempt}"

    def write(self, attempt: str, table: str, rows: DataFrame, by: str | None = None) -> DataFrame:
        """The attempt's part of a table, written and read again; a part that is written anew takes the place of what is left of it."""
        writer = rows.write.mode("overwrite")
        (writer.partitionBy(by) if by else writer).parquet(self.path(attempt, table))
        return self.spark.read.schema(rows.schema).parquet(self.path(attempt, table))

    def commit(self, attempt: str, tables: list[str], settings: dict, fresh: bool, seen: list[str]) -> None:
        """Make the attempt count, unless others than those it saw do by now."""
        if [r["attempt"] for r in self.commits()] != seen:
            raise ValueError(f"another run committed below {self.target} meanwhile")
        row = (attempt, fresh, tables, {k: str(v) for k, v in settings.items()})
        self.spark.createDataFrame([row], COMMIT).coalesce(1).write.mode("append").json(f"{self.target}/commits")

    def read(self, table: str, latest: str | None = None) -> DataFrame:
        """A table of all committed attempts; with ``latest`` only the rows of the last attempt that has a value of that column."""
        own = [r["attempt"] for r in self.commits() if table in r["tables"]]
        if not own:
            raise ValueError(f"no committed run below {self.target} has the table {table}")
        parts = [self.spark.read.parquet(self.path(a, table)).withColumn("_attempt", F.lit(a)) for a in own]
        out = parts[0]
        for more in parts[1:]:
            out = out.unionByName(more, allowMissingColumns=True)
        if latest and len(parts) > 1:
            last = F.max("_attempt").over(Window.partitionBy(latest))
            out = out.withColumn("_last", last).where("_attempt = _last").drop("_last")
        return out.drop("_attempt")

"""Tables of dated parts that are replaced a few at a time.

A batch writes the parts it replaces (months, days) to folders of its own, then publishes a
manifest: for each part, the batch that wrote it last and its number of rows. Readers open the
folders that the newest manifest names and nothing else, so no job overwrites what it reads, a
crash before the manifest changes nothing, and a repeated batch replaces its own folders.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder wherever the session's file systems have it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none where it does not exist."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in system.listStatus(target) if s.isDirectory()) if system.exists(target) else []


@dataclass(frozen=True)
class PartTable:
    """``part`` is the date column that names a row's part, ``ddl`` the other columns."""

    spark: SparkSession
    root: str
    part: str
    ddl: str

    def _manifests(self) -> DataFrame | None:
        try:
            return self.spark.read.schema("part date, written_by bigint, rows bigint, batch bigint").parquet(f"{self.root}/manifest")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def newest(self) -> int | None:
        """The last batch that published a manifest."""
        found = self._manifests()
        return found.agg(F.max("batch").alias("batch")).first().batch if found is not None else None

    def manifest(self) -> dict[date, tuple[int, int]]:
        """For each part, the batch that wrote it and its rows. One entry for each month or day of the table."""
        newest = self.newest()
        if newest is None:
            return {}
        listed = self._manifests().filter((F.col("batch") == newest) & F.col("part").isNotNull())
        return {r.part: (r.written_by, r.rows) for r in listed.collect()}

    def folders(self, parts: Iterable[date] | None = None) -> list[str]:
        """The folders of these parts (of all parts without them) that hold rows."""
        wanted = None if parts is None else set(parts)
        listed = sorted(self.manifest().items())
        return [f"{self.root}/data/batch={by}/{self.part}={part}" for part, (by, rows) in listed if rows and (wanted is None or part in wanted)]

    def read(self, parts: Iterable[date] | None = None) -> DataFrame:
        folders, schema = self.folders(parts), f"{self.ddl}, {self.part} date"
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(f"{schema}, batch bigint").option("basePath", f"{self.root}/data").parquet(*folders).drop("batch")

    def replace(self, rows: DataFrame, parts: Iterable[date], batch: int, arranged: bool = False) -> None:
        """Publishes the table with these parts as ``rows`` has them; a part without rows becomes empty, other parts stay.

        ``arranged`` rows lie together by part already and are written as they lie.
        """
        path, known = f"{self.root}/data/batch={batch}", self.manifest()
        names = T.StructType.fromDDL(self.ddl).names
        rows = rows.select(*names, self.part)
        # Spark cuts a large part into several files and puts small ones together.
        (rows if arranged else rows.hint("rebalance", self.part)).write.mode("overwrite").partitionBy(self.part).parquet(path)
        sizes = {r.part: r.n for r in self._sizes(path)}
        known |= {part: (batch, sizes.get(part, 0)) for part in parts}
        self._publish(known, batch)

    def drop(self, parts: Iterable[date], batch: int) -> None:
        """Publishes the table without these parts."""
        gone = set(parts)
        self._publish({part: entry for part, entry in self.manifest().items() if part not in gone}, batch)

    def _sizes(self, path: str) -> list:
        written = self.spark.read.schema(f"{self.ddl}, {self.part} date").parquet(path)
        return written.groupBy(F.col(self.part).alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()

    def _publish(self, entries: dict[date, tuple[int, int]], batch: int) -> None:
        lines = [(part, by, rows) for part, (by, rows) in sorted(entries.items())] + [(None, batch, 0)]
        listed = self.spark.createDataFrame(lines, "part date, written_by bigint, rows bigint")
        listed.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifest/batch={batch}")  # one file: it is there whole or not at all

    def vacuum(self) -> list[str]:
        """Deletes the folders that the newest manifest no longer names, and older manifests. For when no reader of those is left."""
        newest, kept = self.newest(), set(self.folders())
        gone = []
        for batch in child_folders(self.spark, f"{self.root}/data"):
            for part in child_folders(self.spark, f"{self.root}/data/{batch}"):
                folder = f"{self.root}/data/{batch}/{part}"
                if folder not in kept and int(batch.split("=")[1]) <= newest:
                    gone.append(folder)
        gone += [f"{self.root}/manifest/{m}" for m in child_folders(self.spark, f"{self.root}/manifest") if int(m.split("=")[1]) < newest]
        for folder in gone:
            remove_folder(self.spark, folder)
        return gone

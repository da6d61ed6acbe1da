"""Session settings, the caller's identity and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings every operator relies on (UTC, ANSI, AQE with skew handling)."""
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@dataclass(frozen=True)
class Principal:
    """Who asks: user name, current role and every role active in the session."""

    user: str
    role: str
    session_roles: frozenset[str] = field(default_factory=frozenset)

    def has_role(self, *roles: str) -> bool:
        active = {r.upper() for r in self.session_roles} | {self.role.upper()}
        return any(r.upper() in active for r in roles)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names in ``spark.checkpoint.dir``.

    A temporary folder is used only on a local master, where driver and executors are one process.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    path = tempfile.mkdtemp(prefix="tallyward-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one run's written tables, under the shared folder."""
    return f"{shared_folder(spark)}/tallyward/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors, and stops plans from growing."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)

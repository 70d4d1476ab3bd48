"""Run settings: environment, storage root, contract mode and reporting date."""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Follow the documented contract (default).
DOCUMENTED = "documented"
#: Follow the original code to the letter, quirks included.
REFERENCE = "reference"


@dataclass(frozen=True)
class Settings:
    """One environment of the lakehouse.

    ``as_of`` replaces the clock in every age, tenure and birth-year rule, so
    that a rebuild of old data gives the old answer. ``None`` means today.
    """

    root: str = ""
    env: str = "dev"
    mode: str = DOCUMENTED
    as_of: dt.date | None = None

    def __post_init__(self) -> None:
        if self.mode not in (DOCUMENTED, REFERENCE):
            raise ValueError(f"unknown mode {self.mode!r}")

    @property
    def documented(self) -> bool:
        return self.mode == DOCUMENTED

    @property
    def as_of_sql(self) -> str:
        return f"DATE'{self.as_of.isoformat()}'" if self.as_of else "current_date()"

    @property
    def as_of_column(self) -> Column:
        return F.expr(self.as_of_sql)

    def schema(self, layer: str) -> str:
        """Database of a layer: ``dev_silver``, or ``silver`` without an environment."""
        return f"{self.env}_{layer}" if self.env else layer

    def path(self, layer: str, table: str) -> str:
        if not self.root:
            raise ValueError("Settings.root is needed to read or write tables")
        return f"{self.root.rstrip('/')}/{self.schema(layer)}/{table}"


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables and checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Only a session without
    that setting, which is to say a local test, gets a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.partition("[")[0] == "local":  # local-cluster has executors of its own
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    own = tempfile.mkdtemp(prefix="ledgerstrata-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder below :func:`scratch_root`."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


#: Spark's own setting that drops the shuffle files of a query once it has ended.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _set_for(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for the block alone."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def dropping_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """Writes in the block drop their shuffle files once they are done, and not only when the driver next collects garbage."""
    return _set_for(spark, _DROP_SHUFFLES, "true")


def tasks_of(spark: SparkSession, size: int) -> AbstractContextManager[None]:
    """Rows that are dealt out anew in the block go to tasks of about ``size`` bytes."""
    return _set_for(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", str(size))


def cut_lineage(df: DataFrame, compression: str | None = None, folder: str | None = None) -> DataFrame:
    """The same rows as a table in the shared scratch folder.

    Later branches read its files, and of those only their columns, instead of
    computing the rows again; losing an executor loses nothing. The shuffle files
    behind the rows go as soon as the table is written, so that a job of many steps
    takes the disk of its widest step and not of all of them. ``compression``: a
    parquet codec, None for the session's own; ``folder``: where the table goes, None
    for a folder of its own.
    """
    spark = df.sparkSession
    path = folder or scratch_dir(spark, "rows")
    with dropping_shuffles(spark):
        df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[Callable[..., DataFrame]]:
    """:func:`cut_lineage` for the steps of a block; the tables it writes are removed when the block ends.

    What is read after the block must have been written by :func:`cut_lineage` itself, or by that of an outer block.
    """
    root = scratch_dir(spark, "passing")

    def cut(df: DataFrame, compression: str | None = None) -> DataFrame:
        return cut_lineage(df, compression, f"{root}/{uuid.uuid4().hex}")

    try:
        yield cut
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(root)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

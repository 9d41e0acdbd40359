"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import importlib
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Scratch folders named since each open ``scratch`` block began, innermost last.
_open_blocks: list[list[str]] = []


def ship_package() -> None:
    """Send this package's task functions by value, so that no worker needs the package installed.

    That includes the helper process of stateful streams, which files added to the session do not reach.
    """
    cloudpickle.register_pickle_by_value(importlib.import_module("pointgate"))


def configure(spark: SparkSession) -> SparkSession:
    """Set the SQL settings the results and the speed rely on (all can be set at run time); ship the package."""
    ship_package()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # Repeated JSON keys resolve to the last one.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    # With pruning, selecting fewer CSV columns silently un-flags ragged rows.
    spark.conf.set("spark.sql.csv.parser.columnPruning.enabled", "false")
    # HotSpot leaves methods over 8,000 bytes uncompiled; wide decoders run faster as several smaller methods.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets one new temporary folder per session.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="pointgate-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", configured)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; deleted at the end of the ``scratch`` block around it, if there is one."""
    path = f"{shared_dir(spark).rstrip('/')}/pointgate/{label}-{uuid.uuid4().hex}"
    if _open_blocks:
        _open_blocks[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that operators stage inside the block, and their checkpoints, when it ends.

    Results are lazy and read those tables: write them inside the block.
    """
    made: list[str] = []
    _open_blocks.append(made)
    try:
        yield
    finally:
        _open_blocks.remove(made)
        for path in made:
            remove_folder(spark, path)


def staged(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write a table to the shared folder and read it back: later jobs neither repeat it nor depend on executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    # no file format has columns without a type
    void = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NullType)}
    kept = df.drop(*void)
    kept.write.options(**options).parquet(path)
    back = spark.read.schema(kept.schema).parquet(path)
    return back.select(*[F.lit(None).alias(c) if c in void else F.col(f"`{c}`") for c in df.columns]) if void else back


def checkpointed(df: DataFrame) -> DataFrame:
    """``checkpoint()`` in the shared folder: partitions and their order stay.  Deleted as ``scratch_path``s are."""
    shared_dir(df.sparkSession)
    done = df.checkpoint()
    written = done._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
    if _open_blocks and written.isDefined():
        _open_blocks[-1].append(written.get())
    return done


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any file system Spark can reach."""
    files, target = _file_system(spark, path)
    return files.exists(target)


def remove_folder(spark: SparkSession, path: str) -> None:
    files, target = _file_system(spark, path)
    files.delete(target, True)


def folder_names(spark: SparkSession, path: str, holding: str) -> list[str]:
    """Names of the folders below ``path`` that hold a file of this name."""
    files, target = _file_system(spark, path)
    if not files.exists(target):
        return []
    inner = spark._jvm.org.apache.hadoop.fs.Path
    found = [s.getPath() for s in files.listStatus(target) if s.isDirectory()]
    return [p.getName() for p in found if files.exists(inner(p, holding))]

"""Spark sessions, the package on the executors, and the folder that all share."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, name: str = "skyscreen", **conf: str) -> SparkSession:
    """A session on this machine, for tests and the bench."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(name)
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, which may run elsewhere or without this folder in their path."""
    sc = spark.sparkContext
    if getattr(sc, "_skyscreen_shipped", False):
        return spark
    home = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="skyscreen-code-"), "skyscreen_code.zip")
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(home.rglob("*.py")):
            z.write(f, f.relative_to(home.parent))
    sc.addPyFile(target)
    sc._skyscreen_shipped = True
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    It is set here only where it is unset and one machine runs everything.
    """
    got = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext._jsc.sc().conf().get("spark.checkpoint.dir", "")
    if got:
        return got.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not getattr(spark, "_skyscreen_dir", None):
        spark._skyscreen_dir = tempfile.mkdtemp(prefix="skyscreen-")
        spark.sparkContext.setCheckpointDir(spark._skyscreen_dir)
    return spark._skyscreen_dir


#: Written tables that :func:`scratch` is to delete, the innermost block last.
_OPEN: list[Scratch] = []


class Scratch:
    """The tables that were written within a block, and must not outlive it."""

    def __init__(self):
        self.paths: list[str] = []

    def keep(self, df: DataFrame) -> DataFrame:
        """Leave a stored table to the block around this one, or to the caller if there is none."""
        self.paths.remove(df._stored_at)
        if _OPEN.index(self):
            _OPEN[_OPEN.index(self) - 1].paths.append(df._stored_at)
        return df


def stored(df: DataFrame, name: str = "t", files: int | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: lineage ends there, and a lost executor loses nothing.

    ``files``: write that many at most, from as many tasks.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    (df.coalesce(files) if files else df).write.parquet(path)
    if _OPEN:
        _OPEN[-1].paths.append(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._stored_at = path
    return back


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete the folders of written tables, wherever the shared folder is."""
    for path in paths:
        there = spark._jvm.org.apache.hadoop.fs.Path(path)
        there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """Delete the tables that :func:`stored` writes within this block when it ends, but for those that are kept. Blocks nest."""
    block = Scratch()
    _OPEN.append(block)
    try:
        yield block
    finally:
        _OPEN.remove(block)
        discard(spark, *block.paths)

"""Stored frames: a written table in the shared folder cuts the lineage of a plan.

The folder is ``spark.checkpoint.dir`` of the session, so that a stored frame
outlives the executors that wrote it. Only a local master may fall back to a
folder of its own machine.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_open: list[list[str]] = []  # of the blocks of made_here


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read and write."""
    folder = spark.conf.get(_SETTING, "") or spark.sparkContext.getConf().get(_SETTING, "")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{_SETTING} must name a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="modelweave-")
    spark.conf.set(_SETTING, folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other call gets."""
    return f"{shared_dir(spark)}/{label}-{uuid4().hex}"


@contextmanager
def made_here() -> Iterator[list[str]]:
    """The folders of the frames stored inside the block, for ``discard`` when they have been used."""
    folders: list[str] = []
    _open.append(folders)
    try:
        yield folders
    finally:
        del _open[next(i for i, own in enumerate(_open) if own is folders)]


def discard(spark: SparkSession, folders: list[str]) -> None:
    """Remove stored frames that nothing reads any more, and forget them."""
    for folder in folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    folders.clear()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Frames stored inside the block are removed at its end, but for those stored with ``keep``.

    For a function whose result is one small stored frame or a value: nothing
    else may read what it stored on the way.
    """
    with made_here() as folders:
        yield
    discard(spark, folders)


def store(df: DataFrame, label: str = "frame", keep: bool = False) -> DataFrame:
    """Write ``df`` once and read it back; runs one job. ``keep`` leaves it out of the innermost block of ``made_here``."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    for folders in _open[:-1] if keep else _open:
        folders.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Session settings and the shared folder for written tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import SparkSession

# Folders given out, in order.
_given: list[str] = []

SETTINGS = {
    # Bars carry calendar dates; a fixed zone keeps date casts independent of the machine.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app_name: str = "barline", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the library's settings; ``settings`` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache(maxsize=1)
def _local_root() -> str:
    """A temporary folder of this process, removed when it ends."""
    root = tempfile.mkdtemp(prefix="barline-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def _scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = _local_root()
    return f"{root.rstrip('/')}/barline-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for a written intermediate table.

    It lies under ``spark.checkpoint.dir``, the folder every executor of the cluster can
    reach. Only a local session without that setting falls back to a temporary folder.
    """
    path = f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    _given.append(path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Remove the tables written to ``scratch_path`` folders asked for inside, at the end; what reads them must be stored by then."""
    before = len(_given)
    try:
        yield
    finally:
        for path in _given[before:]:
            _delete(spark, path)
        del _given[before:]


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this application has written there; results that read it must be stored before."""
    _delete(spark, _scratch_root(spark))
    _given.clear()

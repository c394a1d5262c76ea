"""Materialise intermediate results where every executor can read them again."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}
_open: list[Scratch] = []


class Scratch:
    """Staged copies of one owner."""

    def __init__(self):
        self.copies: list[DataFrame] = []

    def keep(self, df: DataFrame) -> DataFrame:
        """Leave this copy to the owner outside."""
        self.copies = [c for c in self.copies if c is not df]
        if len(_open) > 1 and hasattr(df, "_staged_at"):
            _open[-2].copies.append(df)
        return df


@contextmanager
def scratch():
    """Owns what is staged inside: at the end the copies are deleted, but for those kept.

    To be held open until the result that reads them is written::

        with scratch():
            queries["op6_packing"](spark, folder).write.parquet(out)

    Without an owner copies stay until the shared folder is cleared, since a
    frame that is returned still reads them.
    """
    own = Scratch()
    _open.append(own)
    try:
        yield own
    finally:
        _open.remove(own)
        discard(*own.copies)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where it is unset, a temporary one of a local session only."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = "file://" + tempfile.mkdtemp(prefix="ledgerspark-")
    return _local[app]


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage at a columnar copy that outlives lost executors; the
    reader keeps the given schema, so an empty table stays typed.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/staged/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    if _open:
        _open[-1].copies.append(out)
    return out


def discard(*staged: DataFrame) -> None:
    """Delete staged copies that no frame still to be run reads; frames that are not such copies are left alone."""
    for df in staged:
        path = getattr(df, "_staged_at", None)
        if path is not None:
            spark = df.sparkSession
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

"""Cut points of long plans: a table written once in the folder that driver and executors share, so that what reads it several times does not
compute it again, and a lost executor loses nothing."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame

#: Folders that were written since each open `tidy` began, the innermost last.
_WRITTEN: list[list[tuple[DataFrame, str]]] = []


def settled(df: DataFrame, name: str = "rows") -> DataFrame:
    """The rows of df, written as Parquet below spark.checkpoint.dir (where it is unset, as in local tests, below a new folder)."""
    spark = df.sparkSession
    conf = spark.sparkContext.getConf()
    folder = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="genoweave-")
        spark.conf.set("spark.checkpoint.dir", folder)
    path = f"{folder.rstrip('/')}/genoweave/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    if _WRITTEN:
        _WRITTEN[-1].append((out, path))
    return out


def spread(df: DataFrame, *by: str) -> DataFrame:
    """The rows of df in as many partitions as the session's shuffles have (by the columns, if any), however few bytes they are: for work that takes long a row."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def dealt(df: DataFrame) -> DataFrame:
    """The rows of df dealt out to four tasks a core: for a file of few bytes whose rows grow to much more, and plans that cost a task more than its rows."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)


def _delete(df: DataFrame, path: str) -> None:
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def dropped(*tables: DataFrame) -> None:
    """Delete settled tables that no later plan reads."""
    for df in tables:
        for f in df.inputFiles()[:1]:
            if "/genoweave/" in f:
                _delete(df, f.rsplit("/", 1)[0])


def any_settled() -> bool:
    """Whether tables were settled since the innermost `tidy` began."""
    return bool(_WRITTEN and _WRITTEN[-1])


@contextmanager
def tidy() -> Iterator[list]:
    """Tables settled inside are deleted at its end. A frame that is to outlive it is settled and appended to what this gives:

        with tidy() as results:
            results.append(settled(frame))
    """
    results: list[DataFrame] = []
    _WRITTEN.append([])
    try:
        yield results
    finally:
        written = _WRITTEN.pop()
        for df, path in written:
            if not any(df is r for r in results):
                _delete(df, path)
            elif _WRITTEN:
                _WRITTEN[-1].append((df, path))

"""Tables a plan has to write before it can go on.

They go to the shared folder the cluster names in ``spark.checkpoint.dir``, so
that any executor can read them and a lost one costs no recomputation of what
is already written. A run's tables lie in a folder of its own: `clear` removes it once
results are no longer needed, and `discard` a table that nothing reads any more.
"""

import atexit
import re
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


_RUN = uuid.uuid4().hex


@lru_cache(maxsize=1)
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="civiclens-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody else writes to. Only a local master may lack the setting."""
    return f"{_run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _run_folder(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_folder()
    return f"{root.rstrip('/')}/civiclens/{_RUN}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` and read it back: short lineage, and a size the planner knows."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def _remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def discard(*tables: DataFrame) -> None:
    """Remove tables of `materialise` that no plan to come will read."""
    for table in tables:
        _remove(table.sparkSession, table.__dict__["scratch_path"])


def clear(spark: SparkSession) -> None:
    """Remove all that this run has written; lazy results that read it are no longer valid."""
    _remove(spark, _run_folder(spark))

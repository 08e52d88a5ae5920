"""Tables written on the way, in a folder that all machines share."""

from __future__ import annotations

import atexit
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.sources.parquet import write_and_read


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, or one inside the warehouse where that is unset.

    On several machines a local warehouse will not do: what one writes the others would not find.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    folder = f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    local_storage = spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration()).getScheme() == "file"
    if local_storage and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set spark.checkpoint.dir: {folder} is a folder of each machine, not one that all share")
    return folder


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table, to cut its lineage: a lost executor then costs a re-read.

    The table is removed when the driver's Python ends.
    """
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/ledgerloom-{name}-{uuid4().hex}"
    atexit.register(_remove, spark, folder)
    return write_and_read(df, folder, "zstd")


def removed(df: DataFrame) -> None:
    """Remove a table that ``written`` has made, once nothing will read it any more."""
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        _remove(df.sparkSession, folder)


def _remove(spark: SparkSession, folder: str) -> None:
    if spark.sparkContext._jsc is None:  # the session has ended before
        return
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

"""A folder that all executors share, for what a query writes on its way."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """Below ``spark.checkpoint.dir``; where that is unset and all tasks run here, a temporary folder."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    made = tempfile.mkdtemp(prefix=f"{name}-")
    atexit.register(shutil.rmtree, made, True)
    return f"file://{made}"


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written by the driver in any store that Spark knows."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()

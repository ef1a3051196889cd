"""Where intermediate tables go."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession, work_dir: str | None = None) -> str:
    """A new directory below ``work_dir``, or else below the shared folder named by ``spark.checkpoint.dir``.

    Driver and executors all have to see it, so there is no local folder to fall back on.
    """
    base = work_dir or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("intermediate tables need a folder that all executors share: give work_dir, or start the session with spark.checkpoint.dir")
    return f"{base.rstrip('/')}/sunledger/{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete staged data that has been published."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if it is not there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

"""Small files on the cluster's own file system that are replaced in one step.

Commit markers and pointers are JSON files of one line. A new one is written
under a hidden name beside the old one and renamed over it, which HDFS and local
file systems do atomically; on an object store the rename is a copy, and the
store's own last-writer rule holds.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def exists(spark: SparkSession, path: str) -> bool:
    target = _hadoop_path(spark, path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file, or of all files in a folder."""
    target = _hadoop_path(spark, path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


def replace_json(spark: SparkSession, path: str, value: dict) -> None:
    """The file holds ``value`` afterwards; readers see the old content or the new one."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder, _, name = path.rpartition("/")
    target, staged = _hadoop_path(spark, path), _hadoop_path(spark, f"{folder}/_{name}-{uuid.uuid4().hex}")
    out = target.getFileSystem(conf).create(staged, True)
    try:
        out.write(bytearray((json.dumps(value, sort_keys=True) + "\n").encode()))
    finally:
        out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(staged, target, how)


def read_json(spark: SparkSession, path: str) -> dict:
    """The content of one such file; FileNotFoundError if there is none."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    return json.loads(spark.read.text(path).first()[0])

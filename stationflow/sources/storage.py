"""Small files whose appearance is one step: how versions and pointers are switched.

Works on whatever file system Spark reaches. A file is written under a hidden
name first and renamed when complete, and a name is never taken twice, so readers
see all of it or nothing and of two writers of one name the later one fails.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _on(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, files = _on(spark, path)
    return files.exists(hadoop_path)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, in order, without hidden ones; none if there is no folder."""
    hadoop_path, files = _on(spark, folder)
    if not files.exists(hadoop_path):
        return []
    return sorted(n for s in files.listStatus(hadoop_path) if not (n := s.getPath().getName()).startswith((".", "_")))


def delete(spark: SparkSession, path: str) -> bool:
    hadoop_path, files = _on(spark, path)
    return files.delete(hadoop_path, True)


def age_seconds(spark: SparkSession, path: str) -> float:
    """Seconds since ``path`` was last written, by this machine's clock."""
    hadoop_path, files = _on(spark, path)
    now = spark._jvm.java.lang.System.currentTimeMillis()
    return (now - files.getFileStatus(hadoop_path).getModificationTime()) / 1000


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Make ``path`` appear with its whole content; refused if the name is taken."""
    target, files = _on(spark, path)
    hidden = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    out = files.create(hidden, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if files.exists(target) or not files.rename(hidden, target):
        files.delete(hidden, False)
        raise FileExistsError(f"{path} was published by another writer")


def read_text(spark: SparkSession, path: str) -> str:
    hadoop_path, files = _on(spark, path)
    stream = files.open(hadoop_path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder or file; the folder above the target is made first."""
    here, files = _on(spark, source)
    there, _ = _on(spark, target)
    files.mkdirs(there.getParent())
    if files.exists(there) or not files.rename(here, there):
        raise FileExistsError(f"{source} cannot be moved to {target}")

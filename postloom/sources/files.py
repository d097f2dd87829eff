"""Listing, creating and moving files on whatever file system the cluster uses."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    _, p, fs = _hadoop(spark, path)
    return fs.exists(p)


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Files matching a glob, sorted by file name."""
    _, p, fs = _hadoop(spark, pattern)
    found = fs.globStatus(p) or []
    paths = [(s.getPath().getName(), s.getPath().toString()) for s in found if s.isFile()]
    return [path for _, path in sorted(paths)]


def list_folders(spark: SparkSession, pattern: str) -> list[str]:
    """Folders matching a glob."""
    _, p, fs = _hadoop(spark, pattern)
    return [s.getPath().toString() for s in fs.globStatus(p) or [] if s.isDirectory()]


#: Seconds after which a claim without its file is that of a writer that died.
PATIENCE = 600


def create_file(spark: SparkSession, path: str, text: str, patience: float = PATIENCE) -> bool:
    """Create a small file; False where it exists. The content is complete before the name appears.

    A writer claims the name first. A claim older than ``patience`` seconds whose file does not exist is taken over.
    """
    jvm, p, fs = _hadoop(spark, path)
    fs.mkdirs(p.getParent())
    aside = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}")
    stream = fs.create(aside, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    # A claim that only one writer can create decides, since a rename may replace its target on some file systems.
    claim = jvm.org.apache.hadoop.fs.Path(p.getParent(), f"{p.getName()}.claim")

    def claimed() -> bool:
        try:
            fs.create(claim, False).close()
        except Py4JJavaError as exc:
            if "AlreadyExists" not in str(exc.java_exception):
                raise
            return False
        return True

    mine = claimed()
    if not mine and not fs.exists(p) and fs.exists(claim):
        age = jvm.java.lang.System.currentTimeMillis() - fs.getFileStatus(claim).getModificationTime()
        # Of several that wait, the one whose delete succeeds goes on, and the new claim decides again.
        mine = age > patience * 1000 and fs.delete(claim, False) and claimed()
    if not mine or fs.exists(p):
        fs.delete(aside, False)
        return False
    return bool(fs.rename(aside, p))


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file, making the folder it goes to."""
    jvm, p, fs = _hadoop(spark, target)
    fs.mkdirs(p.getParent())
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(source), p):
        raise OSError(f"cannot move {source} to {target}")


def replace_folder(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder in the place of another, or of none. The old one steps aside, returns if the new one cannot take its
    place, and goes once it has: between the two renames a reader finds nothing, but never a part."""
    jvm, p, fs = _hadoop(spark, target)
    fs.mkdirs(p.getParent())
    aside = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}-{uuid.uuid4().hex}")
    had = fs.exists(p)
    if had and not fs.rename(p, aside):
        raise OSError(f"cannot move {target} aside")
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(source), p):
        if had:
            fs.rename(aside, p)
        raise OSError(f"cannot move {source} to {target}")
    if had:
        fs.delete(aside, True)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it, if it is there."""
    _, p, fs = _hadoop(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    """Content of a small file."""
    jvm, p, fs = _hadoop(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()

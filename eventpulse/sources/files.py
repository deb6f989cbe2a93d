"""Files of any Hadoop file system, by way of the JVM: listing, small text files, rename and delete."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def glob(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """(path, bytes) of what matches, in order of path; an unmatched pattern is an empty list."""
    fs, p = _fs(spark, pattern)
    return sorted((s.getPath().toString(), s.getLen()) for s in (fs.globStatus(p) or []))


def copy(spark: SparkSession, source: str, to: str) -> None:
    """Copy a file, between file systems too."""
    fs, p = _fs(spark, source)
    target_fs, target = _fs(spark, to)
    target_fs.mkdirs(target.getParent())
    if not spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, p, target_fs, target, False, True, spark._jsc.hadoopConfiguration()):
        raise OSError(f"could not copy {source} to {to}")


def modified(spark: SparkSession, path: str) -> int:
    """When a file was written, in milliseconds."""
    fs, p = _fs(spark, path)
    return fs.getFileStatus(p).getModificationTime()


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write beside, then rename over: a reader sees the old text or the new."""
    fs, p = _fs(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}._new")
    out = fs.create(beside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    rename(spark, f"{path}._new", path)


def rename(spark: SparkSession, source: str, to: str) -> None:
    """Rename a file, replacing what is there."""
    fs, p = _fs(spark, source)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    fs.mkdirs(target.getParent())
    if fs.exists(target):
        fs.delete(target, False)
    if not fs.rename(p, target):
        raise OSError(f"could not rename {source} to {to}")


def delete(spark: SparkSession, path: str, recursive: bool = True) -> bool:
    fs, p = _fs(spark, path)
    return fs.delete(p, recursive)


def remove_if_empty(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p) and not fs.listStatus(p):
        fs.delete(p, False)


def shared_dir(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, which driver and executors share. Only a local session, whose executors are the driver, may go without it."""
    import tempfile
    import uuid

    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.gettempdir()
    return f"{base.rstrip('/')}/eventpulse-{uuid.uuid4().hex}"

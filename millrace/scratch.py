"""Shared work folders and small control files, through the session's own Hadoop file system."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``.

    A local session without the setting gets a fresh temporary folder; a cluster session must
    name a shared one, since a machine-local folder would be invisible to the executors.
    """
    context = spark.sparkContext
    root = spark.conf.get(_SETTING, None) or context.getCheckpointDir()
    if root:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(root)
        return root
    if not context.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="millrace-")
    context.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, never reused folder below the scratch root."""
    return f"{scratch_root(spark)}/millrace/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def make_dir(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.mkdirs(target)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; empty when it does not exist. For control folders only."""
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small control file: written beside it, then renamed into place in one step."""
    fs, beside = _file_system(spark, f"{path}.{uuid.uuid4().hex}.new")
    stream = fs.create(beside, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs
    target = fs.makeQualified(hadoop.Path(path))
    how = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    how[0] = hadoop.Options.Rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(target.toUri(), fs.getConf())
    context.rename(fs.makeQualified(beside), target, how)


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """Write a small file under a name that no other run uses."""
    fs, target = _file_system(spark, path)
    stream = fs.create(target, False)
    try:
        stream.write(bytearray(content))
    finally:
        stream.close()


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Rename a finished folder into place."""
    fs, target = _file_system(spark, path)
    fs.mkdirs(target.getParent())
    if not fs.rename(_file_system(spark, staged)[1], target):
        raise OSError(f"could not publish {staged} as {path}")

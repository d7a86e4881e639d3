"""Folder listing and small marker files, through the file system Spark itself uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    """The file system of `path` and the fully qualified path."""
    fs = _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(_path(spark, path)).toString()


def folder_names(fs, spark: SparkSession, path: str) -> list[str]:
    """Names directly below `path`; none when it does not exist."""
    folder = _path(spark, path)
    if not fs.exists(folder):
        return []
    return [status.getPath().getName() for status in fs.listStatus(folder)]


def delete(fs, spark: SparkSession, path: str) -> None:
    fs.delete(_path(spark, path), True)


def read_text(fs, spark: SparkSession, path: str) -> str:
    stream = fs.open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(fs, spark: SparkSession, path: str, text: str) -> None:
    out = fs.create(_path(spark, path), True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def make_folder(fs, spark: SparkSession, path: str) -> None:
    fs.mkdirs(_path(spark, path))


def exists(fs, spark: SparkSession, path: str) -> bool:
    return fs.exists(_path(spark, path))


def rename_once(spark: SparkSession, path: str, to: str) -> bool:
    """Rename a file or folder; false where the new name is taken."""
    jvm = spark._jvm
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        _path(spark, to).toUri(), spark._jsc.hadoopConfiguration()
    )
    from py4j.protocol import Py4JJavaError

    try:
        context.rename(_path(spark, path), _path(spark, to), options)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in str(error.java_exception.getClass().getName()):
            return False
        raise
    return True

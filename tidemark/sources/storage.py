"""Small questions to the file system, through the Hadoop client Spark already uses."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop_path(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _hadoop_path(spark, path)
    fs.delete(target, True)


def subdirectories(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories right below ``path``; empty when it does not exist."""
    fs, target = _hadoop_path(spark, path)
    if not fs.exists(target):
        return []
    return [s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()]


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files right below ``path``; empty when it does not exist."""
    fs, target = _hadoop_path(spark, path)
    if not fs.exists(target):
        return []
    return [s.getPath().getName() for s in fs.listStatus(target) if s.isFile()]


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Paths below ``path``, relative to it, of all files but hidden ones."""
    fs, target = _hadoop_path(spark, path)
    prefix = len(fs.makeQualified(target).toUri().getPath()) + 1
    found, names = fs.listFiles(target, True), []
    while found.hasNext():
        names.append(found.next().getPath().toUri().getPath()[prefix:])
    return sorted(n for n in names if not n.rsplit("/", 1)[-1].startswith(("_", ".")))


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _hadoop_path(spark, path)
    stream = fs.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, target = _hadoop_path(spark, path)
    stream = fs.create(target, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()


def move_new(spark: SparkSession, source: str, target: str) -> bool:
    """Give a file a name that nothing has yet; False when something has it."""
    context, jvm = spark.sparkContext, spark.sparkContext._jvm
    fs, old = _hadoop_path(spark, source)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.makeQualified(old).toUri(), context._jsc.hadoopConfiguration()
    )
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = context._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    try:
        files.rename(fs.makeQualified(old), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(target)), options)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True

"""Small files and directories on whatever file system a path names.

Paths go through the session's Hadoop file systems, so a history behaves alike on
HDFS, an object store and a local folder, and nothing looks at the driver's disk.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a directory; none if there is no such directory."""
    if not exists(spark, path):
        return []
    return sorted(s.getPath().getName() for s in _fs(spark, path).listStatus(_path(spark, path)))


def read_text(spark: SparkSession, path: str) -> str:
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str, temporary: str) -> bool:
    """Put a whole file in place, or leave the one that is there: false then.

    The text is written to ``temporary`` first and renamed without overwriting, so
    a reader sees all of it or nothing, and of two writers one wins."""
    jvm = spark._jvm
    fs = _fs(spark, path)
    out = fs.create(_path(spark, temporary), True)
    try:
        out.write(text.encode())
    finally:
        out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(_path(spark, temporary), _path(spark, path), options)
        return True
    except Exception as e:  # noqa: BLE001 - a Java exception: only "exists already" is an answer
        if "FileAlreadyExistsException" not in str(e):
            raise
        fs.delete(_path(spark, temporary), False)
        return False


def delete(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)

"""Questions about folders, asked of the file system Spark uses."""

from __future__ import annotations

from pyspark.sql import SparkSession

STREAM_LOG = "_spark_metadata"


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), folder


def is_stream_output(spark: SparkSession, path: str) -> bool:
    """Whether a stream has written the folder; readers then follow the stream's own list
    of files and do not see any others."""
    files, folder = _file_system(spark, path)
    return files.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, STREAM_LOG))


def refuse_stream_output(spark: SparkSession, path: str) -> None:
    if is_stream_output(spark, path):
        raise ValueError(f"{path} belongs to a stream; write to a folder of its own")


def delete_folder(spark: SparkSession, path: str) -> None:
    files, folder = _file_system(spark, path)
    files.delete(folder, True)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values of a table's first partition column in order, from the names of its folders;
    no file is listed or opened. A missing table has none."""
    files, folder = _file_system(spark, path)
    if not files.exists(folder):
        return []
    mark = f"{column}="
    names = [status.getPath().getName() for status in files.listStatus(folder) if status.isDirectory()]
    return sorted(name[len(mark):] for name in names if name.startswith(mark))


def finished_folders(spark: SparkSession, path: str, column: str) -> list[str]:
    """Those partition values in order whose folder a finished job wrote; its mark comes last."""
    files, folder = _file_system(spark, path)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return [value for value in partition_values(spark, path, column)
            if files.exists(at(at(folder, f"{column}={value}"), "_SUCCESS"))]

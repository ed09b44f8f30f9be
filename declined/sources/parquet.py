from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def _locate(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and its qualified form."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = location.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs, fs.makeQualified(location)


INSTANTS = "spark.sql.parquet.outputTimestampType"


def write_with_statistics(df: DataFrame, path: str) -> None:
    """Writes ``df`` as Parquet with instants as 64-bit integers.

    Spark's default for instants is INT96, which has no statistics and takes no pushed-down
    filter.  The session gets its own setting back after the write; a job that writes nothing else
    sets it for good (``conf/spark-cluster.conf``).
    """
    conf = df.sparkSession.conf
    before = conf.get(INSTANTS)
    conf.set(INSTANTS, "TIMESTAMP_MICROS")
    try:
        df.write.parquet(path)
    finally:
        conf.set(INSTANTS, before)


def replace_parquet(df: DataFrame, path: str) -> None:
    """Writes ``df`` to ``path`` as Parquet, replacing what is there only once it is complete.

    Spark's overwrite mode deletes the old directory before the job runs, so a failing
    job would lose it, and a plan that reads ``path`` could not write to it.  Here the
    job writes to a hidden sibling directory, on the same file system, that takes the
    target's place by a rename.  If a rename fails, by its result or by an exception, the old data
    are put back and the new ones deleted.  If that fails as well, or if the driver dies between the two
    renames, both stay: the old data in the ``.previous`` sibling, the new ones in the
    ``.staging`` one; the error names them.

    On an object store a rename of a directory copies every object.  There, write each run to
    a folder of its own instead (``new_parquet``).
    """
    spark = df.sparkSession
    fs, target = _locate(spark, path)
    hidden = f".{target.getName()}.{uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
    staging = hadoop_path(target.getParent(), f"{hidden}.staging")
    previous = hadoop_path(target.getParent(), f"{hidden}.previous")
    try:
        write_with_statistics(df, staging.toString())
        had_previous = fs.exists(target)
        if had_previous:
            _rename(fs, target, previous)
    except BaseException:
        fs.delete(staging, True)
        raise
    try:
        _rename(fs, staging, target)
    except BaseException as failure:
        if had_previous:
            try:
                _rename(fs, previous, target)
            except BaseException as second:
                raise OSError(
                    f"cannot move {staging} to {target}, nor the old data back:"
                    f" they are in {previous}, the new ones in {staging}"
                ) from second
        fs.delete(staging, True)
        raise failure
    fs.delete(previous, True)


def _rename(fs, source, target) -> None:
    """File systems report a failed rename by their result or by an exception; this raises."""
    if not fs.rename(source, target):
        raise OSError(f"cannot move {source} to {target}")


def new_parquet(df: DataFrame, folder: str) -> str:
    """Writes ``df`` to a new folder below ``folder`` and returns its path.

    Nothing is renamed or replaced, so this suits object stores; a reader takes the path from the
    writer's outcome.  A folder is complete once it holds ``_SUCCESS``.
    """
    path = f"{folder.rstrip('/')}/run-{uuid4().hex}"
    write_with_statistics(df, path)
    return path


def delete_folder(spark: SparkSession, path: str) -> None:
    """Deletes ``path`` and what is below it, on whatever file system it lies."""
    fs, location = _locate(spark, path)
    fs.delete(location, True)


def stage_parquet(df: DataFrame, path: str, sort_by: Sequence[str] = ()) -> DataFrame:
    """Copies a text input to a new Parquet folder below ``path`` and returns the copy.

    Compressed text is read by one task per file and parsed anew by every job; the copy
    is splittable, columnar and takes pushed-down predicates.  Since every column is
    written, every column of every row is checked by the reader's strict mode, which a
    query that reads few columns would skip.  No folder is renamed or replaced: a staged copy has no
    readers that know its place beforehand.

    ``sort_by`` sorts within each task, so that Parquet's statistics let a later range
    filter skip most of a file.  It needs no shuffle and no second pass over the text.
    """
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    return df.sparkSession.read.schema(df.schema).parquet(new_parquet(df, path))

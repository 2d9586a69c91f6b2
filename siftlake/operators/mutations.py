"""Conditional deletes and their preview."""

from __future__ import annotations

import uuid
from itertools import batched

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlake.functions.predicates import matches
from siftlake.operators.profile import row_count
from siftlake.schemas import literal, quoted, ref
from siftlake.workspace import (
    Scratch,
    exists,
    from_uri,
    move,
    new_path,
    partition_folders,
    read_text,
    remove,
    write_new,
)

# Emptied partitions that one statement takes out of the catalog.
PARTITIONS_AT_ONCE = 1000


def without(df: DataFrame, condition: str | None) -> DataFrame:
    """The rows a delete keeps: those for which the predicate is FALSE or NULL."""
    return df.filter(~matches(condition))


def delete_preview(df: DataFrame, condition: str | None = None) -> DataFrame:
    """``total_rows, rows_to_delete`` without touching the data.

    The predicate is a filter of its own, so Parquet statistics and partitions prune what it reads; counting all rows
    needs no column.
    """
    doomed = df if condition is None else df.filter(condition)
    return doomed.agg(F.count(F.lit(1)).alias("rows_to_delete")).select(
        row_count(df).scalar().alias("total_rows"), "rows_to_delete"
    )


def _summary(spark: SparkSession, before: int, after: int) -> DataFrame:
    return spark.createDataFrame(
        [(before, before - after, after)], "total_rows long, deleted_rows long, remaining_rows long"
    )


def delete_from_path(
    spark: SparkSession,
    path: str,
    condition: str | None = None,
    target: str | None = None,
    fmt: str = "parquet",
    partition_by: str | None = None,
) -> tuple[str, DataFrame]:
    """Delete from a dataset without a catalog entry; returns where it is now, and
    ``total_rows, deleted_rows, remaining_rows``.

    A Delta dataset is changed in place. Plain Parquet has no transaction log: the remaining rows are written once, beside
    ``path`` and with the same partition folders, and then take its place; the old files go when the switch is done. A
    driver lost on the way leaves a marker beside ``path``, by which the next call undoes or finishes what was begun
    (``recover_path``) before it looks at the data. One delete at a time may work on a path.
    With a ``target`` the remaining rows go there instead and ``path`` stays as it was.
    """
    if fmt != "delta":
        recover_path(spark, path)
    before = spark.read.format(fmt).load(path)
    rows_before = before.count()
    if fmt == "delta":
        where = "" if condition is None else f" WHERE {condition}"
        spark.sql(f"DELETE FROM delta.`{path}`{where}")
        return path, _summary(spark, rows_before, spark.read.format(fmt).load(path).count())
    partitions = [partition_by] if partition_by else partition_folders(spark, path)
    beside = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    written = target or f"{beside}-new"
    if target is None:
        # Without the marker nothing is to be moved: another delete that works on the path would be disturbed.
        if not write_new(spark, _marker(path), beside):
            raise OSError(f"another delete works on {path}")
    kept = without(before, condition)
    if partitions:
        kept = kept.hint("rebalance", *partitions)
    writer = kept.write.format(fmt).mode("errorifexists")
    (writer.partitionBy(*partitions) if partitions else writer).save(written)
    if target is None:
        move(spark, path, f"{beside}-old")
        move(spark, written, path)
        remove(spark, f"{beside}-old")
        remove(spark, _marker(path))
        target = path
        spark.catalog.refreshByPath(path)
    return target, _summary(spark, rows_before, spark.read.schema(before.schema).format(fmt).load(target).count())


def _marker(path: str) -> str:
    return f"{path.rstrip('/')}-delete"


def recover_path(spark: SparkSession, path: str) -> bool:
    """Bring a dataset that a lost delete has left back into place; whether there was one.

    Before the first rename the dataset lies where it was, so what was written beside it goes and the delete has not
    happened. After it the remaining rows are complete and take their place. No row that should stay is lost either way,
    and a recovery that is lost itself may be repeated.
    """
    if not exists(spark, _marker(path)):
        return False
    beside = read_text(spark, _marker(path))
    old, new = f"{beside}-old", f"{beside}-new"
    if exists(spark, path):
        if exists(spark, new) and exists(spark, old):
            raise OSError(f"{path} was written anew after a lost delete; its rows before the delete lie in {old}")
        remove(spark, new)
    else:
        move(spark, new if exists(spark, new) else old, path)
    remove(spark, old)
    remove(spark, _marker(path))
    spark.catalog.refreshByPath(path)
    return True


def delete_from_table(spark: SparkSession, table: str, condition: str | None = None) -> DataFrame:
    """Delete from a Parquet table of the catalog; returns the same counts.

    In a partitioned table only partitions that hold matching rows are touched: those that lose all rows are removed with
    their folders, those that lose some are rewritten at once, all others stay as they are. However many they are, that is
    a fixed number of jobs, and the list of them stays in a working table. Running it again after a failure finishes the
    job, since rows already gone match nothing. A table without partitions is rewritten as a whole.
    """
    df = spark.table(table)
    rows_before = df.count()
    partition = _partition_column(spark, table)
    if partition:
        _delete_by_partition(spark, table, df, partition, condition)
    else:
        _replace(spark, table, without(df, condition), partition)
    spark.catalog.refreshTable(table)
    return _summary(spark, rows_before, spark.table(table).count())


def _partition_column(spark: SparkSession, table: str) -> str | None:
    columns = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if len(columns) > 1:
        raise ValueError(f"{table} has partition columns {columns}; one at most is supported")
    return columns[0] if columns else None


def _delete_by_partition(
    spark: SparkSession, table: str, df: DataFrame, partition: str, condition: str | None
) -> None:
    if condition is None:
        spark.sql(f"INSERT OVERWRITE {table} {_no_rows(df, df.columns)}")
        return
    scratch = Scratch(spark, "delete")
    doomed = df.filter(condition)
    folder = F.regexp_replace(doomed.metadataColumn("_metadata")["file_path"], "/[^/]*$", "")
    doomed = doomed.select(ref(partition).alias("value"), folder.alias("folder"))
    gone = scratch.settle(doomed.groupBy("value").agg(F.count(F.lit(1)).alias("gone"), F.max("folder").alias("folder")))
    held = _rows_of(df, gone, partition).groupBy(ref(partition).alias("value")).agg(F.count(F.lit(1)).alias("held"))
    touched = gone.join(held.withColumnRenamed("value", "other"), F.col("value").eqNullSafe(F.col("other")))
    touched = scratch.settle(touched.drop("other"))
    rewritten = touched.where("gone < held")
    if not rewritten.isEmpty():
        _replace(spark, table, without(_rows_of(df, rewritten, partition), condition), partition)
    emptied = touched.where("gone = held").select(F.col("value").cast("string"), "folder").coalesce(1)
    for some in batched(emptied.toLocalIterator(), PARTITIONS_AT_ONCE):
        # The rows first: what is lost in between is an entry without rows, not rows without an entry.
        for row in some:
            remove(spark, from_uri(spark, row.folder))
        values = ["NULL" if row.value is None else literal(row.value) for row in some]
        specs = ", ".join(f"PARTITION ({quoted(partition)} = {value})" for value in values)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
    scratch.close()


def _rows_of(df: DataFrame, touched: DataFrame, partition: str) -> DataFrame:
    """The rows of some partitions. The join lets Spark find the partitions to read when it runs (dynamic pruning), as long
    as the list of them is short enough to be broadcast by the session's threshold; NULL, which no join finds, is asked for."""
    # To Spark a comparison is a sign that the list is selective, which pruning depends on.
    values = touched.where("gone > 0").select(F.col("value").alias("__value"))
    rows = df.join(values, ref(partition) == F.col("__value"), "left_semi")
    if touched.where("value IS NULL").isEmpty():
        return rows
    return rows.unionByName(df.where(ref(partition).isNull()))


def _no_rows(df: DataFrame, columns: list[str]) -> str:
    fields = ", ".join(f"cast(null AS {df.schema[c].dataType.simpleString()}) AS {quoted(c)}" for c in columns)
    return f"SELECT {fields} WHERE false"


def _replace(spark: SparkSession, table: str, rows: DataFrame, partition: str | None) -> None:
    """Overwrite the partitions that the rows belong to, or the whole table when it has none."""
    # The rows are written out before the table is touched: a query must not overwrite what it reads.
    staged = new_path(spark, "delete")
    rows.write.parquet(staged)
    # Only the partitions in the input are to be replaced. That is a session setting, so it gets a session of its own.
    session = spark.newSession()
    session.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    kept = session.read.schema(rows.schema).parquet(staged)
    if partition:
        kept = kept.hint("rebalance", partition)
    kept.write.insertInto(table, overwrite=True)
    remove(spark, staged)

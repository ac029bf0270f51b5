"""Stored tables: creating schemas, writing and reading.

An overwrite never touches the stored table while it runs: rows are written beside it and swapped in
by renaming, so a job may read the table it replaces, and a failed one leaves it as it was. A job that
dies between the two renames leaves the old rows under their backup name, from which the next read or
write brings them back. (Delta replaces tables by itself.) `replace_parts` does the same for single
folders of a table stored by member part.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanrisk.config import MEMBER_PART, TableLayout
from loanrisk.sources import files


def _writer(df: DataFrame, layout: TableLayout):
    writer = df.write.format(layout.fmt)
    if layout.fmt == "parquet" and layout.compression:
        writer = writer.option("compression", layout.compression)
    return writer


def create_schemas(spark: SparkSession, layout: TableLayout) -> None:
    """Create the three layer schemas. Path layouts need none."""
    if layout.path is None:
        for name in layout.schema_names():
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def write_table(
    df: DataFrame,
    layout: TableLayout,
    table: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    bucket_by: tuple[int, str] | None = None,
) -> None:
    """Write one table; `mode` is `overwrite` or `append`.

    `partition_by` adds a rebalance first, so each partition value gets evenly sized files and a
    value holding much of the table is split over several tasks. `bucket_by=(n, column)` (catalog
    layouts only) shuffles once to one task per bucket, so the table has n files per write and
    later joins on the column need no exchange.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    elif bucket_by:
        df = df.repartition(*bucket_by)
    writer = _writer(df, layout).mode(mode)
    if layout.fmt == "delta" and mode == "overwrite":
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        if layout.path is not None:
            raise ValueError("bucketed tables need a catalog layout")
        buckets, column = bucket_by
        writer = writer.bucketBy(buckets, column).sortBy(column)
    place = layout.locate(table)
    restore_table(df.sparkSession, layout, table)
    if mode == "overwrite" and layout.fmt != "delta":
        _replace(df.sparkSession, writer, layout, place)
    elif layout.path is None:
        writer.saveAsTable(place)
    else:
        writer.save(place)


def _backup(place: str, path_layout: bool) -> str:
    """Where the old rows are between the renames. A leading underscore hides a folder from scans."""
    if not path_layout:
        return f"{place}__old"
    parent, _, name = place.rpartition("/")
    return f"{parent}/_{name}.old"


def _replace(spark: SparkSession, writer, layout: TableLayout, place: str) -> None:
    unique = uuid.uuid4().hex
    by_path = layout.path is not None
    new = f"{place.rpartition('/')[0]}/_{place.rpartition('/')[2]}.{unique}" if by_path else f"{place}__{unique}"
    try:
        writer.save(new) if by_path else writer.saveAsTable(new)
        swap(spark, layout, new, place)
    except Exception:
        _drop(spark, new, by_path)
        raise


def _drop(spark: SparkSession, place: str, by_path: bool) -> None:
    if by_path:
        files.delete(spark, place)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {place}")


def _move(spark: SparkSession, place: str, to: str, by_path: bool) -> None:
    if by_path:
        files.move(spark, place, to)
    else:
        spark.sql(f"ALTER TABLE {place} RENAME TO {to}")


def _there(spark: SparkSession, place: str, by_path: bool) -> bool:
    return files.exists(spark, place) if by_path else spark.catalog.tableExists(place)


def swap(spark: SparkSession, layout: TableLayout, new: str, place: str) -> None:
    """Put the written rows at `new` in the place of a table."""
    by_path = layout.path is not None
    backup = _backup(place, by_path)
    if _there(spark, place, by_path):
        _drop(spark, backup, by_path)  # of an earlier swap that did not get to the end
        _move(spark, place, backup, by_path)
    _move(spark, new, place, by_path)
    _drop(spark, backup, by_path)


def restore_table(spark: SparkSession, layout: TableLayout, table: str) -> None:
    """Bring a table back that a swap has moved away and not replaced."""
    by_path, place = layout.path is not None, layout.locate(table)
    backup = _backup(place, by_path)
    if not _there(spark, place, by_path) and _there(spark, backup, by_path):
        _move(spark, backup, place, by_path)
    if by_path:
        for name in files.matching(spark, place, f"{_OLD_PART}*"):
            part = _part_folder(int(name.removeprefix(_OLD_PART)))
            if not files.exists(spark, f"{place}/{part}"):
                files.move(spark, f"{place}/{name}", f"{place}/{part}")


#: Names of old folders between the renames; an underscore and no equals sign hide them from scans.
_OLD_PART = "_old_part."


def _part_folder(part: int) -> str:
    return f"{MEMBER_PART}={part}"


def replace_parts(df: DataFrame, layout: TableLayout, table: str, parts: Sequence[int]) -> None:
    """Replace some folders of a Parquet table under a path that is stored by member part.

    `df` holds all rows the named parts shall have, with their part; it may read the table. Rows are
    written beside the table and swapped in folder by folder; all other folders stay as they are. A
    job that fails leaves the table as it was. One that dies between two renames leaves each folder
    with all its old or all its new rows (see `restore_table`).
    """
    spark, place = df.sparkSession, layout.locate(table)
    restore_table(spark, layout, table)
    new = f"{place.rpartition('/')[0]}/_{table}.{uuid.uuid4().hex}"
    try:
        _writer(df.hint("rebalance", MEMBER_PART), layout).partitionBy(MEMBER_PART).save(new)
        for part in parts:
            folder, backup = f"{place}/{_part_folder(part)}", f"{place}/{_OLD_PART}{part}"
            files.delete(spark, backup)  # of an earlier swap that did not get to the end
            if files.exists(spark, folder):
                files.move(spark, folder, backup)
            if files.exists(spark, f"{new}/{_part_folder(part)}"):
                files.move(spark, f"{new}/{_part_folder(part)}", folder)
            files.delete(spark, backup)
    finally:
        files.delete(spark, new)


def read_parts(spark: SparkSession, layout: TableLayout, table: str, parts: Sequence[int] | None) -> DataFrame:
    """The rows of some parts, or of all, with the part; the scan opens no file of another part."""
    restore_table(spark, layout, table)
    rows = spark.read.format(layout.fmt).load(layout.locate(table))
    return rows if parts is None else rows.where(F.col(MEMBER_PART).isin(list(parts)))


def file_names(spark: SparkSession, layout: TableLayout, table: str) -> list[str]:
    """The data files of a Parquet table under a path that has no folders."""
    return files.matching(spark, layout.locate(table), "*.parquet")


def read_files(spark: SparkSession, layout: TableLayout, table: str, names: Sequence[str]) -> DataFrame:
    """The rows of some data files of such a table."""
    whole = read_table(spark, layout, table)
    if not names:
        return whole.limit(0)
    place = layout.locate(table)
    return spark.read.schema(whole.schema).format(layout.fmt).load([f"{place}/{name}" for name in names])


def read_table(spark: SparkSession, layout: TableLayout, table: str) -> DataFrame:
    restore_table(spark, layout, table)
    if layout.path is None:
        return spark.table(layout.locate(table))
    return spark.read.format(layout.fmt).load(layout.locate(table)).drop(MEMBER_PART)


def table_exists(spark: SparkSession, layout: TableLayout, table: str) -> bool:
    """Whether the table has been written; any failure to find out is raised."""
    restore_table(spark, layout, table)
    return _there(spark, layout.locate(table), layout.path is not None)


def preview(df: DataFrame, *order_by: str, rows: int = 20) -> DataFrame:
    """The first rows of a frame; with `order_by`, the same rows every time."""
    return df.orderBy(*order_by).limit(rows) if order_by else df.limit(rows)

"""What the operators share: reading tables, cutting lineage, Arrow batches, exact labels of rows."""

from __future__ import annotations

import gc
import os
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanrisk.sources.shared_folder import new_shared_folder

LIBRARY_ROOT = str(Path(__file__).resolve().parents[2])


def let_workers_import(spark: SparkSession) -> None:
    """Put the checkout on the Python workers' path; a cluster with the package installed ignores it."""
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if LIBRARY_ROOT not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (LIBRARY_ROOT, known) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: later steps start from files that
    outlive any executor, and a non-deterministic step is run once."""
    spark = df.sparkSession
    path = new_shared_folder(spark, purpose)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._stored_at = path
    return back


def discard(df: DataFrame) -> None:
    """Delete a table that `stored` has written and that nothing reads any more."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._stored_at)
    path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Have Spark drop the shuffle files of finished jobs now. It does so when the driver collects
    garbage, which may be long after an operator of many steps has filled the disks."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def utf8_values(column: pa.Array) -> Iterator[bytes]:
    """The texts of an Arrow string column as UTF-8 bytes; null counts as empty."""
    for value in column.cast(pa.binary() if column.type == pa.string() else pa.large_binary()):
        yield value.as_py() or b""


def partitions_for(df: DataFrame) -> int:
    """The session's number of shuffle partitions, for explicit repartitioning."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def only(df: DataFrame, **columns: str) -> DataFrame:
    """Just the named input columns under fixed names, so other columns cannot clash."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


#: Ids are broadcast only when counted to be no more than this (24 MB as a hash table).
BROADCAST_IDS = 1_000_000


def _matching(rows: DataFrame, ids: DataFrame, id_col: str, how: str) -> DataFrame:
    """Semi or anti join on an id; the ids travel to the rows if a count shows they are few."""
    ids = stored(ids.select(F.col(ids.columns[0]).alias("_id")).distinct(), "ids")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return rows.join(ids, rows[id_col] == ids["_id"], how)


def rows_with_ids(rows: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows whose id is in the one column of `ids`; columns stay as they are."""
    return _matching(rows, ids, id_col, "left_semi")


def rows_without_ids(rows: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows whose id is null or not in the one column of `ids`; columns stay as they are."""
    return _matching(rows, ids, id_col, "left_anti")

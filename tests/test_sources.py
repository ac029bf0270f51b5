"""CSV binding, audit columns and stored tables."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from loanrisk.config import DIM_CUSTOMERS, FACT_LOANS, RAW_LOANS, TableLayout
from loanrisk.plans.bronze import ingest_csv
from loanrisk.sources.raw_files import add_audit_columns, read_raw_csv
from loanrisk.sources.raw_schema import RAW_COLUMNS, RAW_LOAN_SCHEMA, TEXT_COLUMNS
from loanrisk.sources.shared_folder import new_shared_folder
from loanrisk.sources.tables import create_schemas, file_names, preview, read_files, read_table, write_table

GOOD = {"id": "1", "loan_amnt": "1000", "grade": "A", "annual_inc": "75000", "emp_title": "Nurse"}


def line(**values):
    return ",".join(values.get(name, "") for name in RAW_COLUMNS)


def write_csv(folder, *lines, header=None):
    path = folder / "loans.csv"
    path.write_text("\n".join([header or ",".join(RAW_COLUMNS), *lines]) + "\n")
    return str(path)


def test_schema():
    assert len(RAW_COLUMNS) == len(set(RAW_COLUMNS)) == 118
    assert len(TEXT_COLUMNS) == 28 and TEXT_COLUMNS <= set(RAW_COLUMNS)
    assert all(f.nullable for f in RAW_LOAN_SCHEMA)
    assert (RAW_COLUMNS[0], RAW_COLUMNS[40], RAW_COLUMNS[117]) == ("id", "total_pymnt", "debt_settlement_flag")


def test_csv(spark, tmp_path):
    path = write_csv(
        tmp_path,
        line(**GOOD),
        "Total amount funded in policy code 1: 12345",
        "",
        line(**{**GOOD, "id": "2", "loan_amnt": "many"}),
        line(**{**GOOD, "id": "3", "title": '"one, two"', "emp_title": '"a ""b"" c"'}),
    )
    found = {r.id: r for r in read_raw_csv(spark, path).collect()}
    assert list(found) == ["1", "Total amount funded in policy code 1: 12345", "2", "3"]
    assert (found["1"].loan_amnt, found["1"].annual_inc, found["1"].member_id) == (1000.0, 75000.0, None)
    assert found["Total amount funded in policy code 1: 12345"].loan_amnt is None
    assert found["2"].loan_amnt is None and found["2"].annual_inc == 75000.0
    assert found["3"].title == "one, two"
    # the escape character is a backslash, so doubled quotes stay
    assert found["3"].emp_title == '"a ""b"" c"'


def test_csv_binds_by_position_unless_the_header_is_checked(spark, tmp_path):
    swapped = ["loan_amnt", "id", *[c for c in RAW_COLUMNS if c not in ("id", "loan_amnt")]]
    path = write_csv(tmp_path, line(**GOOD), header=",".join(swapped))
    assert read_raw_csv(spark, path).first().id == "1"
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_raw_csv(spark, path, strict_header=True).collect()


def test_csv_round_trip_to_bronze(spark, tmp_path):
    path = write_csv(
        tmp_path, line(**GOOD), "Total amount funded", line(**{**GOOD, "grade": ""}),
        line(**{**GOOD, "annual_inc": "x"}),
    )
    bronze = ingest_csv(spark, path, datetime(2024, 1, 1, 2, 0, 0))
    assert len(bronze.columns) == 121
    assert TableLayout(landing="/in/").raw_file() == "/in/accepted_loans.csv"
    (row,) = bronze.collect()
    assert row._source_file == path and row._batch_id == "20240101_020000"
    assert len(row.member_id) == 64


def test_directory_of_csv_files(spark, tmp_path):
    for i in range(3):
        folder = tmp_path / "landing"
        folder.mkdir(exist_ok=True)
        (folder / f"{i}.csv").write_text(",".join(RAW_COLUMNS) + "\n" + line(**{**GOOD, "id": str(i)}) + "\n")
    assert {r.id for r in read_raw_csv(spark, str(tmp_path / "landing")).collect()} == {"0", "1", "2"}


def test_audit_columns(spark):
    df = add_audit_columns(spark.range(2))
    assert [t for _, t in df.dtypes] == ["bigint", "timestamp", "string", "string"]
    rows = df.collect()
    assert {r._source_file for r in rows} == {"manual"}
    assert all(r._batch_id == f"{r._ingested_at:%Y%m%d_%H%M%S}" for r in rows)


def test_locations():
    assert TableLayout(path="/x/").locate(FACT_LOANS) == "/x/silver/fact_loans"
    assert TableLayout(catalog="lake").locate(RAW_LOANS) == "lake.bronze.raw_loan_data"
    assert TableLayout(gold="top").schema_names() == ["bronze", "silver", "top"]


def test_write_modes_and_partitions(spark, tmp_path):
    layout = TableLayout(path=str(tmp_path))
    df = spark.range(100).select("id", (F.col("id") % 3).alias("issue_year"))
    write_table(df, layout, FACT_LOANS, partition_by=["issue_year"])
    write_table(df, layout, FACT_LOANS, mode="append", partition_by=["issue_year"])
    assert read_table(spark, layout, FACT_LOANS).count() == 200
    write_table(df.limit(5), layout, FACT_LOANS)
    assert read_table(spark, layout, FACT_LOANS).count() == 5
    years = {p.name for p in (tmp_path / "silver" / FACT_LOANS).iterdir() if p.is_dir()}
    assert years == set()


def test_parquet_tables_have_the_codec_of_their_layout(spark, tmp_path):
    for codec, expected in (("zstd", "zstd"), ("gzip", "gz"), (None, "snappy")):
        layout = TableLayout(path=str(tmp_path / str(codec)), compression=codec)
        write_table(spark.range(9), layout, FACT_LOANS)
        write_table(spark.range(9), layout, FACT_LOANS, mode="append")
        names = [p.name for p in (tmp_path / str(codec)).glob("*/*/*.parquet")]
        assert names and all(f".{expected}." in name for name in names)
    assert TableLayout().compression == "zstd"


def test_files_of_a_table_are_read_by_name(spark, tmp_path):
    layout = TableLayout(path=str(tmp_path))
    write_table(spark.range(3), layout, FACT_LOANS)
    before = file_names(spark, layout, FACT_LOANS)
    write_table(spark.range(3, 9), layout, FACT_LOANS, mode="append")
    added = [name for name in file_names(spark, layout, FACT_LOANS) if name not in before]
    assert sorted(r.id for r in read_files(spark, layout, FACT_LOANS, added).collect()) == list(range(3, 9))
    assert read_files(spark, layout, FACT_LOANS, []).isEmpty()


def test_catalog_tables(spark):
    layout = TableLayout(bronze="t_bronze", silver="t_silver", gold="t_gold")
    create_schemas(spark, layout)
    create_schemas(spark, layout)
    write_table(spark.range(10), layout, DIM_CUSTOMERS)
    write_table(spark.range(7), layout, DIM_CUSTOMERS)
    assert read_table(spark, layout, DIM_CUSTOMERS).count() == 7
    assert spark.catalog.tableExists("t_silver.dim_customers")


def test_buckets_need_a_catalog(spark, tmp_path):
    with pytest.raises(ValueError):
        write_table(spark.range(3), TableLayout(path=str(tmp_path)), FACT_LOANS, bucket_by=(2, "id"))


def test_preview(spark):
    df = spark.range(100)
    assert preview(df).count() == 20
    assert [r.id for r in preview(df, "id", rows=3).collect()] == [0, 1, 2]


def test_shared_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = new_shared_folder(spark, "x"), new_shared_folder(spark, "x")
    assert one.startswith(f"{base}/x-") and one != two

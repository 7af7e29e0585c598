import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from tidemark.functions.scalar import readable_size
from tidemark.operators.reports import parts_report
from verify import plain


def test_parts_report_beyond_a_tebibyte_equals_its_sql(spark, tmp_path):
    # sums of 3 TiB, of ties between two hundredths (.125, .375, .625 GiB) and of what a double shows as a tie, and one byte less than units
    sums = [3 << 40, 9 << 27, 11 << 27, 21 << 27, 8497 << 7, 1029, 1023, 1024, (1 << 20) - 1, (1 << 30) - 1, 5 << 50]
    rows = [(n - 7 if half else 7, f"type {n}") for n in sums for half in (0, 1)]
    spark.createDataFrame(rows, "event_id long, event_type string").write.parquet(f"{tmp_path}/events.parquet")
    got = __spark_entry__.queries()["parts_report_by_type"](spark, str(tmp_path)).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    want = con.execute(__spark_entry__.oracle_sql()["parts_report_by_type"]).df()
    assert plain(got) == plain(want)
    assert "3072.00 GiB" in set(got["size"])


@pytest.mark.parametrize("n,text", [(1029, "1.00 KiB"), (1152, "1.12 KiB"), (1408, "1.38 KiB"), ((1 << 40) - 1, "1024.00 GiB"), (3 << 40, "3.00 TiB"), ((1 << 63) - 1, "8.00 EiB"), (0, "0.00 B"), (None, None)])
def test_sizes_are_rounded_exactly(spark, n, text):
    assert spark.range(1).select(readable_size(F.lit(n).cast("long")).alias("t")).first().t == text


def test_parts_report_names_larger_units_by_itself(spark):
    parts = spark.createDataFrame([("a", 1, 3 << 40)], "partition string, rows long, bytes long")
    assert [r["size"] for r in parts_report(parts).collect()] == ["3.00 TiB"]

"""Queries against their SQL on rows as larger tables have them."""

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from tidemark.functions import numbers
from tidemark.operators import ranking
from tidemark.queries import ORACLE_SQL, QUERIES


def both(spark, folder, name, table, rows):
    """The query's rows and those of its SQL, columns by name, on one table."""
    rows.to_parquet(folder / f"{table}.parquet", coerce_timestamps="us")
    con = duckdb.connect()
    con.execute(f"create view {table} as select * from '{folder / table}.parquet'")
    cur = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    cols = sorted(names)
    shown = lambda v: float(v) if type(v).__name__ == "Decimal" else v
    want = [tuple(shown(r[names.index(c)]) for c in cols) for r in cur.fetchall()]
    got = [tuple(shown(r[c]) for c in cols) for r in QUERIES[name](spark, str(folder)).select(*cols).collect()]
    return sorted(got, key=repr), sorted(want, key=repr)


def test_forward_pe_just_below_the_limit(spark, tmp_path):
    """The limit holds for the quotient, not for what is shown of it; the shown digit is rounded as the product with 10 is."""
    size, price = [31, 31, 31, 18, 32], [929.8, 929.9, 930.0, 916.65, 959.99]
    part = pd.DataFrame({"p_partkey": range(1, 6), "p_size": pd.array(size, "int32"), "p_retailprice": price})
    got, want = both(spark, tmp_path, "mth16_forward_pe", "part", part)
    assert got == want


def test_places_by_forward_pe(spark, tmp_path):
    """What is just below the limit passes; halves go to the even hundredth of the product with 100; equal ones by ticker, in no single task."""
    size, price = [46, 47, 48, 49, 51, 52, 46, 48], [919.9, 939.86, 915.36, 934.43, 956.76, 991.64, 907.35, 915.36]
    part = pd.DataFrame({"p_partkey": range(8, 0, -1), "p_size": pd.array(size, "int32"), "p_retailprice": price})
    got, want = both(spark, tmp_path, "srt02_by_forward_pe", "part", part)
    assert got == want and len(got) == 8
    rows = spark.createDataFrame([(None, "b"), (2.0, "c"), (1.0, "d"), (None, "a"), (2.0, "a")], "v double, k string")
    assert [tuple(r) for r in ranking.placed(rows, "v", ["k"]).orderBy("place").collect()] == [(None, "a", 1), (None, "b", 2), (1.0, "d", 3), (2.0, "a", 4), (2.0, "c", 5)]


def test_accession_numbers_beyond_six_digits(spark, tmp_path):
    """A number of seven digits is kept whole, and follows those of six on the same day."""
    keys = [1_000_000, 999_999, 1_000_001, 12_345_678, 7, 99_999]
    day = pd.Timestamp("1998-02-06")
    orders = pd.DataFrame({"o_orderkey": keys, "o_custkey": [900_000] * 4 + [3] * 2, "o_orderstatus": "F", "o_orderdate": [day, day, day, day, day, day + pd.Timedelta(days=1)]})
    got, want = both(spark, tmp_path, "srt03_newest_6k", "orders", orders)
    assert got == want and len(got) == 5


def test_amounts_of_a_billion_in_millions(spark, tmp_path):
    orders = pd.DataFrame({"o_orderkey": [0, 249, 250, 249_998, 250_000, 250_001, 250_002, 9_000_000, 8_999_999, 1_000_000_000_001]})
    got, want = both(spark, tmp_path, "str20_human_format", "orders", orders)
    assert got == want
    v = spark.createDataFrame([(2.5e9,), (-1e9,), (999.0,)], "v double")
    assert [tuple(r) for r in v.select(numbers.human(F.col("v")), numbers.human(F.col("v"), billions=False)).collect()] == [
        ("2.50B", "2500.00M"), ("-1.00B", "-1000.00M"), ("999.00", "999.00")
    ]

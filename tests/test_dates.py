"""Dates of several written forms; impossible ones are passed over."""

import datetime

import pytest
from pyspark.sql import functions as F

from tidings.operators.extractive import written_date
from tidings.operators.outcomes import size_stats

CASES = {
    "on 2024-02-29 it": (2024, 2, 29), "2023-02-29": None, "2023/3/9.": (2023, 3, 9), "2021.12.31": (2021, 12, 31),
    "May 5, 2020": (2020, 5, 5), "Sept. 3rd 2019": (2019, 9, 3), "JUNE 31, 2020; 1 July 2020": (2020, 7, 1),
    "the 21st of May": None, "21st May 2018": (2018, 5, 21), "3. Okt 2018": None, "Marching 3, 2018": None,
    "id 12-2024-01-01": None, "2024-01-01-7": None, "12024-01-01": None, "v2024-01-01": None, "0 May 2020": None,
    "2024-13-01 then 2024-12-01": (2024, 12, 1), "": None, None: None, "Aug 7, 1999 and 2001-01-01": (1999, 8, 7),
}


def test_written_dates(spark):
    df = spark.createDataFrame([(t,) for t in CASES], "t string")
    got = {r.t: r.d for r in df.select("t", written_date("t").alias("d")).collect()}
    assert got == {t: d and datetime.date(*d) for t, d in CASES.items()}


@pytest.mark.parametrize("n", [1, 2, 99, 1000])
def test_percentiles_are_values_that_occur(spark, n):
    df = spark.range(n).select(F.lit("s").alias("sender"), (F.col("id") * 3 + 1).alias("n_chars"), F.lit(1).alias("n_tokens"),
                               F.lit(1).alias("n_chunks"))
    r = size_stats(df.repartition(5)).first()
    want = sorted(3 * i + 1 for i in range(n))
    assert (r.p50_chars, r.p95_chars) == tuple(want[-(-n * q // 100) - 1] for q in (50, 95))

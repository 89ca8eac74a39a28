"""Marks, literals and stamps don't depend on the driver's time zone."""

import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import datetime as dt, json, tempfile
from pyspark.sql import functions as F
from snapledger.session import build_session
from snapledger.functions.columns import ntz
from snapledger.model import PURCHASE
from snapledger.operators import asof, bronze, silver
spark = build_session("local[2]", shuffle_partitions=2)
day = dt.datetime(2024, 1, 1)
def events(ids, stamp):
    raw = spark.range(*ids).select(ntz(day).alias("transaction_datetime"), F.lit("2024-01-01").alias("transaction_date"),
                                   F.col("id").alias("purchase_id"))
    return bronze.stamp_ingestion(bronze.typed_events(raw, PURCHASE), stamp)
first, second = events((0, 10), dt.datetime(2024, 1, 2)), events((10, 20), dt.datetime(2024, 1, 2, 1))
every = first.unionByName(second)
stored = silver.build_silver(first, PURCHASE, line_created_at=day)
mark = silver.high_water_mark(stored)
print("RESULT", json.dumps({
    "mark": str(mark),
    "increment": silver.incremental_slice(every, mark).count(),
    "known": asof.as_of_known_by(every, PURCHASE, "2024-01-31", dt.datetime(2024, 1, 2, 0, 30)).count(),
    "stamps": sorted({str(r[0]) for r in every.select(F.col("ingestion_date").cast("string")).collect()}),
    "created": sorted({str(r[0]) for r in stored.select(F.col("line_created_at").cast("string")).collect()})}))
"""


@pytest.mark.parametrize("zone", ["America/Sao_Paulo", "Asia/Tokyo"])
def test_results_are_those_of_utc(zone):
    env = os.environ | {"TZ": zone, "PYTHONPATH": ROOT}
    out = subprocess.run([sys.executable, "-c", SCRIPT], env=env, capture_output=True, text=True, timeout=300)
    line = next((x for x in out.stdout.splitlines() if x.startswith("RESULT")), out.stderr[-2000:])
    assert json.loads(line.removeprefix("RESULT")) == {
        "mark": "2024-01-02 00:00:00", "increment": 10, "known": 10,
        "stamps": ["2024-01-02 00:00:00", "2024-01-02 01:00:00"], "created": ["2024-01-01 00:00:00"]}

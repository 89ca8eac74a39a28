"""What keeps the larger runs small: single passes, rows not multiplied, partitions that follow the tables."""

import datetime as dt

from pyspark.sql import functions as F

from snapledger import session
from snapledger.model import PRODUCT_ITEM
from snapledger.operators import keyindex, silver
from test_plans import plan


def _items(spark):
    """Purchase 1 has one product with 300 event times, 50 others have three each."""
    start = dt.datetime(2024, 1, 1)
    hot = [(start + dt.timedelta(hours=h), 1, 7) for h in range(300)]
    rest = [(start + dt.timedelta(hours=h), p, None if p == 9 else p) for p in range(2, 52) for h in range(3)]
    rows = [(t, t.date(), p, i, 1, t + dt.timedelta(days=1)) for t, p, i in hot + rest]
    names = "transaction_datetime timestamp_ntz, transaction_date date, purchase_id long, product_id long, item_quantity int, bronze_ingestion_date timestamp_ntz"
    return spark.createDataFrame(rows, names)


def test_a_row_stays_one_row_while_the_index_is_made(spark):
    p = plan(keyindex.partition_index(spark.range(10).select("id", F.current_date().alias("part")), "id", "part"))
    assert "Generate" not in p and "bit_or" in p


def test_current_flag_of_hot_keys_in_one_pass_over_the_keys(spark):
    rows = _items(spark)
    spark.conf.set("snapledger.skew.keyRows", "100")
    try:
        marked = silver.mark_current(rows, PRODUCT_ITEM, key_source=rows)
        got = {(r["purchase_id"], r["transaction_datetime"]) for r in marked.where(silver.FLAG).collect()}
        assert marked.count() == rows.count()
    finally:
        spark.conf.unset("snapledger.skew.keyRows")
    # A null product is a null key: never current.
    want = {(1, dt.datetime(2024, 1, 13, 11))} | {(p, dt.datetime(2024, 1, 1, 2)) for p in range(2, 52) if p != 9}
    assert got == want
    final = spark.createDataFrame(rows.collect(), rows.schema)
    marked = silver.mark_current(final, PRODUCT_ITEM, key_source=final)
    marked.collect()
    assert "ReusedExchange" in marked._jdf.queryExecution().executedPlan().toString()


def test_enrichment_works_the_items_out_once(spark):
    items = silver.mark_current(silver.dedup_events(_items(spark), PRODUCT_ITEM), PRODUCT_ITEM, key_source=_items(spark))
    purchases = spark.range(60).select(F.col("id").alias("purchase_id"), F.col("id").alias("prod_item_id"), F.lit(True).alias(silver.FLAG))

    def marks(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("row_number")

    once = silver.enrich_from_current(items, purchases, key_source=_items(spark))
    assert marks(once) < marks(silver.enrich_from_current(items, purchases))
    assert {r["prod_item_id"] for r in once.where("purchase_id = 1").collect()} == {1}


def test_shuffle_partitions_follow_the_tables(spark, tmp_path, monkeypatch):
    old = spark.conf.get(session.INITIAL_PARTITIONS, None)
    (tmp_path / "orders.parquet").write_bytes(b"x" * 1000)
    (tmp_path / "lineitem.parquet").mkdir()
    (tmp_path / "lineitem.parquet" / "part-0").write_bytes(b"x" * 3001)
    try:
        monkeypatch.setattr(session, "INPUT_PER_PARTITION", 100)
        session.apply_sql_conf(spark, str(tmp_path))
        assert spark.conf.get(session.INITIAL_PARTITIONS) == "41"
        session.apply_sql_conf(spark, str(tmp_path / "none"))
        assert spark.conf.get(session.INITIAL_PARTITIONS) == spark.conf.get("spark.sql.shuffle.partitions")
    finally:
        if old is None:
            spark.conf.unset(session.INITIAL_PARTITIONS)
        else:
            spark.conf.set(session.INITIAL_PARTITIONS, old)

"""Staged publishing, and tables bucketed by order."""

import contextlib
import io
import os
import re

import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from retail_insights import operators as op
from retail_insights.plans import bronze
from retail_insights.sinks import CheckFailed, at_least, not_null, publish, publish_checked, unique_key, write_checked
from retail_insights.sources.fixture import Fixture


def _frame(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k long, v string")


def test_a_failed_check_leaves_the_old_table(spark, tmp_path):
    root, name = str(tmp_path), "staged_a.t"
    assert publish_checked(spark, _frame(spark, (1, "a"), (2, "b")), name, root, [unique_key("k"), not_null("v")]) == 2
    before = publish.location(spark, name)
    for bad, check in ((_frame(spark, (1, "a"), (1, "b")), unique_key("k")), (_frame(spark, (1, None)), not_null("k", "v")),
                       (_frame(spark), at_least(1))):
        with pytest.raises(CheckFailed):
            publish_checked(spark, bad, name, root, [check])
        assert rows(spark.table(name)) == [(1, "a"), (2, "b")]
    assert publish.location(spark, name) == before
    assert len(os.listdir(tmp_path / "_versions" / "t")) == 1  # what failed is gone
    assert [t.name for t in spark.catalog.listTables("staged_a")] == ["t"]


def test_versions_switch_and_old_readers_finish(spark, tmp_path):
    root, name = str(tmp_path), "staged_b.t"
    publish_checked(spark, _frame(spark, (1, "a")), name, root)
    reader = spark.read.parquet(publish.location(spark, name))
    publish_checked(spark, _frame(spark, (2, "b")), name, root)
    assert rows(spark.table(name)) == [(2, "b")] and rows(reader) == [(1, "a")]
    publish_checked(spark, _frame(spark, (3, "c")), name, root)
    assert len(os.listdir(tmp_path / "_versions" / "t")) == 2
    # Other columns, partitions, and back.
    wide = _frame(spark, (4, "d")).withColumn("w", F.lit(1.5))
    publish_checked(spark, wide, name, root)
    assert spark.table(name).columns == ["k", "v", "w"]
    for k in (5, 6):
        publish_checked(spark, _frame(spark, (k, "x"), (k, "y")), name, root, partition_by=["v"])
        assert rows(spark.table(name), "k", "v") == [(k, "x"), (k, "y")]
    publish_checked(spark, _frame(spark), name, root)
    assert spark.table(name).count() == 0


def test_a_job_lost_before_the_switch_changes_nothing(spark, tmp_path, monkeypatch):
    root, name = str(tmp_path), "staged_c.t"
    publish_checked(spark, _frame(spark, (1, "a")), name, root)
    with monkeypatch.context() as m:
        m.setattr(publish, "_layout", lambda *a: os._exit if False else (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            publish_checked(spark, _frame(spark, (2, "b")), name, root)
    assert rows(spark.table(name)) == [(1, "a")]
    assert publish_checked(spark, _frame(spark, (3, "c")), name, root) == 1
    assert rows(spark.table(name)) == [(3, "c")]


def test_folders_are_swapped_after_the_check(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    assert write_checked(spark, _frame(spark, (1, "a")), path, [unique_key("k")]) == 1
    with pytest.raises(CheckFailed):
        write_checked(spark, _frame(spark, (1, "a"), (1, "b")), path, [unique_key("k")])
    assert rows(spark.read.parquet(path)) == [(1, "a")]
    # Lost between the two renames: the next run puts the old folder back before it goes on.
    rename, calls = publish.rename_folder, []
    with monkeypatch.context() as m:
        m.setattr(publish, "rename_folder", lambda s, a, b: calls.append(a) or (
            rename(s, a, b) if len(calls) == 1 else (_ for _ in ()).throw(OSError("lost"))))
        with pytest.raises(OSError):
            write_checked(spark, _frame(spark, (2, "b")), path)
    assert not os.path.exists(path)
    with pytest.raises(CheckFailed):
        write_checked(spark, _frame(spark), path, [at_least(1)])
    assert rows(spark.read.parquet(path)) == [(1, "a")]
    assert write_checked(spark, _frame(spark, (3, "c")), path) == 1
    assert rows(spark.read.parquet(path)) == [(3, "c")] and sorted(os.listdir(tmp_path)) == ["t"]


def test_duplicate_products_leave_the_published_catalogue(spark, tmp_path):
    products = Fixture(spark, SF_SMALL).products()
    for database in (None, "staged_d"):
        target = str(tmp_path / str(database))
        assert bronze._land(spark, products, "products_raw", target, database) == 200
        with pytest.raises(ValueError, match="not unique"):
            bronze._land(spark, products.unionByName(products.limit(1)), "products_raw", target, database)
        held = spark.table("staged_d.products_raw") if database else spark.read.parquet(f"{target}/products_raw")
        assert rows(held) == rows(products)


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.fixture
def bucketed(spark, tmp_path):
    """Orders and lines as bronze ingestion buckets them; a third of all lines on one order."""
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    f = Fixture(spark, SF_SMALL)
    hot = F.when(F.xxhash64("order_id", "product_id") % 3 == 0, F.lit(7).cast("long")).otherwise(F.col("order_id"))
    lines = f.order_items().withColumn("order_id", hot)
    for name, df in (("orders_raw", f.orders()), ("order_items_raw", lines)):
        bronze._land(spark, df, name, str(tmp_path), "bucketed_db", buckets=8)
    old = {k: spark.conf.get(k, None) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    yield f, f.orders(), lines, spark.table("bucketed_db.orders_raw"), spark.table("bucketed_db.order_items_raw")
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_bucketed_orders_join_without_a_shuffle(spark, bucketed):
    f, orders, lines, b_orders, b_lines = bucketed
    joined = op.sales_fact(b_orders, b_lines)
    assert "Exchange" not in _plan(joined)
    assert "SortMergeJoin" in _plan(joined)
    # Per-order aggregates stay on the buckets; only sums by customer are shuffled.
    for make in (op.purchase_trend, op.customer_segments):
        keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", _plan(make(joined)))
        assert keys and not any("order_id" in k for k in keys)
        assert rows(make(joined)) == rows(make(op.sales_fact(orders, lines)))
    # With the product check the joined rows are shuffled by product alone.
    checked = op.sales_fact(b_orders, b_lines, f.products())
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", _plan(checked))
    assert len(keys) == 2 and all("product_id" in k for k in keys)
    assert rows(checked) == rows(op.sales_fact(orders, lines, f.products()))
    assert checked.where("order_id = 7").count() > lines.count() / 4


def test_buckets_stay_when_a_version_replaces_them(spark, bucketed, tmp_path):
    _, orders, _, _, b_lines = bucketed
    bronze._land(spark, orders.where("order_id % 2 = 0"), "orders_raw", str(tmp_path), "bucketed_db", buckets=8)
    again = spark.table("bucketed_db.orders_raw")
    assert again.count() == orders.where("order_id % 2 = 0").count()
    assert "Exchange" not in _plan(op.sales_fact(again, b_lines))

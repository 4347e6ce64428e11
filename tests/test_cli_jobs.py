"""The command-line jobs: conversion, incremental and balanced ingestion, quarantine, rollup."""

import json
import os
from decimal import Decimal

import pytest
from conftest import SF_SMALL, rows

from retail_insights import operators as op
from retail_insights.plans import increments, jobs, registry, rollup
from retail_insights.plans.increments import read_ingested
from retail_insights.schemas import ORDERS, declared_schema
from retail_insights.sources.fixture import Fixture

DERBY = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def _url(name):
    return f"jdbc:derby:memory:{name};create=true"


def test_convert_with_schema_options_and_transform(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.csv").write_text("id;amount\n1;2.50\n2;3.00\n3;9.00\n")
    base = ["convert_files", "--source", str(src), "--target", str(tmp_path / "out"), "--option", "sep=;"]
    got = jobs.run(spark, [*base, "--schema", "id long, amount decimal(10,2)", "--where", "amount > 2.6",
                           "--select", "id; amount * 2 AS twice"])
    assert got == {"rows": 2}
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == [(2, Decimal("6.00")), (3, Decimal("18.00"))]
    assert declared_schema("orders") == ORDERS
    (src / "b.csv").write_text("id;amount\nx;1\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        jobs.run(spark, [*base, "--schema", "id long, amount decimal(10,2)"])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2  # the failed run left it
    got = jobs.run(spark, [*base, "--schema", "id long, amount decimal(10,2)", "--quarantine", str(tmp_path / "bad"),
                           "--where", "amount > 2.6"])
    assert got == {"rows": 4, "good": 3, "bad": 1}
    assert rows(spark.read.parquet(str(tmp_path / "out")), "id") == [(2,), (3,)]
    assert [r._raw for r in spark.read.parquet(str(tmp_path / "bad")).collect()] == ["x;1"]
    with pytest.raises(SystemExit):
        jobs.run(spark, [*base, "--quarantine", "x"])


def test_convert_only_new_files(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    args = ["convert_files", "--source", str(src), "--target", str(tmp_path / "out"), "--checkpoint",
            str(tmp_path / "ck"), "--schema", "id long, v string", "--select", "id; upper(v) AS v"]
    for k in (1, 2, 2):
        (src / f"{k}.csv").write_text(f"id,v\n{k},a{k}\n")
        jobs.run(spark, args)
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == [(1, "A1"), (2, "A2")]


def _put(spark, url, table, df, mode="overwrite"):
    df.write.format("jdbc").option("url", url).option("dbtable", table).options(**DERBY).mode(mode).save()


def test_relational_jobs_in_balanced_parts_and_increments(spark, tmp_path):
    f, url = Fixture(spark, SF_SMALL), _url("cli_rel")
    _put(spark, url, "Orders", f.orders().where("order_id <= 500"))
    _put(spark, url, "Products", f.products().selectExpr(
        "product_id", "cast(name as varchar(60)) name", "cast(category as varchar(60)) category"))
    target = str(tmp_path / "raw")
    args = ["ingest_relational", "--target", target, "--only", "--jdbc-property", f"driver={DERBY['driver']}"]
    orders = [*args, "--jdbc-url", f"Orders={url}", "--incremental", "Orders=ORDER_ID"]
    first = f.orders().where("order_id <= 500").count()
    got = jobs.run(spark, [*orders, "--jdbc-url", f"Products={url}", "--jdbc-split", "Products=PRODUCT_ID,4"])
    assert got == {"orders_raw": first, "products_raw": 200}
    _put(spark, url, "Orders", f.orders().where("order_id > 500"), "append")
    with pytest.MonkeyPatch.context() as m:
        m.setattr(increments, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            jobs.run(spark, orders)
    assert jobs.run(spark, orders) == {"orders_raw": 1500 - first}
    assert jobs.run(spark, orders) == {"orders_raw": 0}
    held = read_ingested(spark, os.path.join(target, "orders_raw"))
    assert rows(held.select("order_id", "customer_id")) == rows(f.orders().select("order_id", "customer_id"))
    with pytest.raises(SystemExit):
        jobs.run(spark, [*orders, "--incremental", "Customers=CUSTOMER_ID"])


def test_buckets_from_the_command_line(spark, tmp_path):
    f, url = Fixture(spark, SF_SMALL), _url("cli_buckets")
    _put(spark, url, "Orders", f.orders())
    _put(spark, url, "Order_Items", f.order_items())
    got = jobs.run(spark, ["ingest_relational", "--target", str(tmp_path), "--publish-db", "cli_bronze", "--only",
                           "--buckets", "4", "--jdbc-url", f"Orders={url}", "--jdbc-url", f"Order_Items={url}",
                           "--jdbc-property", f"driver={DERBY['driver']}"])
    assert got == {"orders_raw": 1500, "order_items_raw": 6000}
    detail = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED cli_bronze.orders_raw").collect()}
    assert detail["Num Buckets"] == "4" and "order_id" in detail["Bucket Columns"]


def test_document_jobs(spark, tmp_path):
    src = tmp_path / "exports"
    src.mkdir()
    plain = {"CustomerID": 1, "TicketID": "t1", "Timestamp": "2024-01-02T03:04:05", "Issue": {"Status": "Open"}}
    (src / "1.json").write_text(json.dumps(plain) + "\n")
    args = ["ingest_documents", "--export", f"customer_support_raw={src}", "--only"]
    new = [*args, "--target", str(tmp_path / "inc"), "--checkpoint", str(tmp_path / "ck")]
    jobs.run(spark, new)
    (src / "2.json").write_text(json.dumps({**plain, "TicketID": "t2"}) + "\n")
    jobs.run(spark, new)
    jobs.run(spark, new)
    assert rows(spark.read.parquet(str(tmp_path / "inc" / "customer_support_raw")), "TicketID") == [("t1",), ("t2",)]
    (src / "3.json").write_text('{"CustomerID": "none"}\n')
    got = jobs.run(spark, [*args, "--target", str(tmp_path / "q"), "--quarantine", str(tmp_path / "bad")])
    assert got == {"customer_support_raw": {"rows": 3, "good": 2, "bad": 1}}
    with pytest.raises(SystemExit):
        jobs.run(spark, [*new, "--typed"])


def test_pricing_from_the_rollup_equals_pricing_from_lines(spark, tmp_path):
    f = Fixture(spark, SF_SMALL)
    bronze = {"customers_raw": f.customers(), "orders_raw": f.current_orders(), "order_items_raw": f.order_items(),
              "products_raw": f.products()}
    for name, df in bronze.items():
        df.write.parquet(str(tmp_path / "bronze" / name))
    f.history().write.parquet(str(tmp_path / "history"))
    sales = registry.all_sales(f)
    rollup.load_sales(spark, sales, "all", str(tmp_path / "fact"), str(tmp_path / "rollup"))
    args = ["pricing_trends", "--bronze-path", str(tmp_path / "bronze"), "--history-path", str(tmp_path / "history")]
    lines = jobs.run(spark, [*args, "--target", str(tmp_path / "a")])
    months = jobs.run(spark, [*args, "--target", str(tmp_path / "b"), "--rollup-path", str(tmp_path / "rollup")])
    assert lines == months and lines["peak_sales_months"] == 80
    for name in lines:
        a, b = (spark.read.parquet(str(tmp_path / x / name)) for x in "ab")
        assert a.dtypes == b.dtypes and rows(a) == rows(b)
    assert rows(spark.read.parquet(str(tmp_path / "a" / "peak_sales_months"))) == rows(op.peak_sales_months(sales))

import contextlib
import datetime as dt
import io
import json
import os
from decimal import Decimal

from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from retail_insights import operators as op
from retail_insights.plans import bronze, gold
from retail_insights.schemas import CUSTOMER_SUPPORT, ORDERS
from retail_insights.sinks import publish_table, write_files
from retail_insights.sources import read_csv, read_documents, read_jdbc
from retail_insights.sources.fixture import AS_OF, Fixture
from retail_insights.streaming import incremental_files

# In-process Derby database: no server, no port.
DERBY = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def _derby_url(name):
    return f"jdbc:derby:memory:{name};create=true"


def test_jdbc_round_trip_partitioned_read_and_pushdown(spark, tmp_path):
    url = _derby_url("ri_orders")
    src = Fixture(spark, SF_SMALL).orders()
    src.write.format("jdbc").option("url", url).option("dbtable", "ORDERS") \
        .options(**DERBY).mode("overwrite").save()
    one = read_jdbc(spark, url, "ORDERS", DERBY)
    assert one.rdd.getNumPartitions() == 1
    split = read_jdbc(spark, url, "ORDERS", DERBY, partition_column="ORDER_ID",
                      lower_bound=0, upper_bound=6000, num_partitions=3)
    assert split.rdd.getNumPartitions() == 3
    assert split.count() == src.count() == 1500
    pushed = split.filter(F.col("customer_id") == 1).select("order_id")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        pushed.explain()
    plan = buf.getvalue()
    assert "PushedFilters: [*IsNotNull(customer_id), *EqualTo(customer_id,1)]" in plan
    assert "ReadSchema: struct<order_id:bigint>" in plan
    # Bronze ingestion of the same table through the job entry point.
    counts = bronze.ingest_jdbc(
        spark, [bronze.JdbcTable(url, "ORDERS", "orders_raw", "ORDER_ID", 0, 6000, 2)],
        str(tmp_path), DERBY)
    assert counts == {"orders_raw": 1500}
    assert spark.read.parquet(str(tmp_path / "orders_raw")).count() == 1500


def test_document_export_keeps_nesting(spark, tmp_path):
    path = tmp_path / "support.json"
    docs = [
        {"CustomerID": 1, "TicketID": "t1", "Timestamp": "2024-01-02T03:04:05",
         "Issue": {"Status": "Open", "Extra": "x"}},
        {"CustomerID": 2, "TicketID": "t2", "Timestamp": "2024-01-03T00:00:00", "Issue": None},
    ]
    path.write_text("\n".join(json.dumps(d) for d in docs))
    df = read_documents(spark, str(path), CUSTOMER_SUPPORT)
    assert df.schema == CUSTOMER_SUPPORT
    assert rows(op.flatten_tickets(df), "TicketID", "Status") == [("t1", "Open"), ("t2", None)]
    counts = bronze.ingest_documents(
        spark, {"customer_support_raw": (str(path), CUSTOMER_SUPPORT)}, str(tmp_path / "b"))
    assert counts == {"customer_support_raw": 2}
    back = spark.read.parquet(str(tmp_path / "b" / "customer_support_raw"))
    assert back.schema["Issue"].dataType.fieldNames() == ["Status"]


def test_convert_files_with_transform(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.csv").write_text("id,amount\n1,2.50\n2,3.00\n")
    assert read_csv(spark, str(src)).dtypes == [("id", "string"), ("amount", "string")]
    n = bronze.convert_files(
        spark, str(src), str(tmp_path / "out"),
        transform=lambda df: df.select(F.col("id").cast("bigint"),
                                       F.col("amount").cast("decimal(10,2)")))
    assert n == 2
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == [(1, Decimal("2.50")),
                                                               (2, Decimal("3.00"))]


def test_write_files_counts_in_one_action_and_publish(spark, tmp_path):
    df = spark.range(10).withColumn("y", F.col("id") % 3)
    assert write_files(df, str(tmp_path / "w"), partition_by=["y"]) == 10
    assert {"_SUCCESS", "y=0", "y=1", "y=2"} <= set(os.listdir(tmp_path / "w"))
    n = publish_table(spark, df, "gold_test.numbers", path=str(tmp_path / "t"))
    assert n == 10
    assert spark.table("gold_test.numbers").count() == 10


def test_incremental_files_only_new_input(spark, tmp_path):
    src, out, ck = tmp_path / "src", tmp_path / "out", tmp_path / "ck"
    src.mkdir()
    schema = "id bigint, amount string"
    (src / "1.csv").write_text("id,amount\n1,a\n2,b\n")
    incremental_files(spark, str(src), str(out), str(ck), schema)
    assert rows(spark.read.parquet(str(out)), "id") == [(1,), (2,)]
    (src / "2.csv").write_text("id,amount\n3,c\n")
    incremental_files(spark, str(src), str(out), str(ck), schema)
    incremental_files(spark, str(src), str(out), str(ck), schema)
    assert rows(spark.read.parquet(str(out)), "id") == [(1,), (2,), (3,)]


def _bronze_from_fixture(spark):
    f = Fixture(spark, SF_SMALL)
    return {
        "customers_raw": f.customers(),
        "orders_raw": f.current_orders(),
        "order_items_raw": f.order_items(),
        "products_raw": f.products(),
        "login_history_raw": f.logins(),
        "enterprise_campaign_raw": f.campaigns(),
        "customer_support_raw": f.support(),
    }, f


def test_gold_jobs_end_to_end(spark, tmp_path):
    b, f = _bronze_from_fixture(spark)
    target = str(tmp_path / "gold")
    counts = {}
    counts.update(gold.purchase_behavior(spark, b, target, AS_OF, country_like="NATION_1%"))
    counts.update(gold.churn_prediction(spark, b, target, AS_OF))
    counts.update(gold.fraud_detection(spark, b, target, AS_OF))
    counts.update(gold.omni_channel_engagement(spark, b, target, AS_OF))
    counts.update(gold.pricing_trends(spark, b, f.history(), target, database="gold_r1"))
    assert counts["peak_sales_months"] == 80
    assert counts["top_customers"] == 353
    assert counts["retention_rate_pct"] == 7
    assert counts["month_over_month_growth_pct"] == 4950
    assert counts["customer_segments"] == 136
    assert counts["omni_channel_engagement"] == 65
    assert spark.table("gold_r1.customer_purchase_trend").count() == 1387
    # The copies that the pricing outputs shared are gone.
    root = spark.conf.get("spark.checkpoint.dir")
    assert not [n for n in os.listdir(root) if n.startswith(("sales_current-", "best_customers-"))]
    assert spark.table("gold_r1.customer_segments").count() == 136
    assert spark.read.parquet(os.path.join(target, "churn_risk")).count() == counts["churn_risk"]


def test_as_of_defaults_to_current_date(spark):
    orders = spark.createDataFrame(
        [(1, 1, dt.datetime.now() - dt.timedelta(days=1), Decimal("1"))], ORDERS)
    customers = spark.createDataFrame([(1, "a", "b", "e", "United X")],
                                      "customer_id bigint, first_name string, last_name string, "
                                      "email string, country string")
    assert op.top_customers(orders, customers).count() == 1


def test_job_entry_points_from_bronze_folders(spark, tmp_path):
    from retail_insights.plans import jobs

    b, f = _bronze_from_fixture(spark)
    root = tmp_path / "bronze"
    for name, df in b.items():
        df.write.parquet(str(root / name))
    f.history().write.parquet(str(tmp_path / "history"))
    out = str(tmp_path / "gold")
    # Bronze orders hold the orders from 2000 on, so churn differs from the
    # whole-table query; the job must equal the operator on the same input.
    expected = op.churn_risk(b["orders_raw"], AS_OF).count()
    assert jobs.run(spark, ["churn_prediction", "--bronze-path", str(root), "--target", out,
                            "--as-of", "2001-08-01"]) == {"churn_risk": expected}
    got = jobs.run(spark, ["purchase_behavior", "--bronze-path", str(root), "--target", out,
                           "--as-of", "2001-08-01", "--params", '{"country_like": "NATION_1%"}'])
    assert got == {"top_customers_by_country": 59}
    got = jobs.run(spark, ["pricing_trends", "--bronze-path", str(root), "--target", out,
                           "--history-path", str(tmp_path / "history")])
    assert got["peak_sales_months"] == 80 and got["customer_segments"] == 136
    # Relational ingestion through the same entry point, on in-process Derby.
    url = _derby_url("ri_jobs")
    f.products().write.format("jdbc").option("url", url).option("dbtable", "Products") \
        .options(**DERBY).mode("overwrite").save()
    got = jobs.run(spark, ["ingest_relational", "--target", str(tmp_path / "raw"),
                           "--jdbc-url", f"Products={url}",
                           "--jdbc-property", f"driver={DERBY['driver']}",
                           "--jdbc-partition", "Products=product_id,0,200,2", "--only"])
    assert got == {"products_raw": 200}


def test_incremental_document_exports_keep_nesting(spark, tmp_path):
    src, out, ck = tmp_path / "exports", tmp_path / "bronze", tmp_path / "ck"
    src.mkdir()
    doc = {"CustomerID": 1, "TicketID": "t1", "Timestamp": "2024-01-02T03:04:05",
           "Issue": {"Status": "Open"}}
    (src / "part-1.json").write_text(json.dumps(doc))
    incremental_files(spark, str(src), str(out), str(ck), CUSTOMER_SUPPORT, format="json",
                      transform=op.flatten_tickets)
    (src / "part-2.json").write_text(json.dumps({**doc, "TicketID": "t2", "Issue": None}))
    incremental_files(spark, str(src), str(out), str(ck), CUSTOMER_SUPPORT,
                      format="json", transform=op.flatten_tickets)
    back = spark.read.parquet(str(out))
    assert rows(back, "TicketID", "Status") == [("t1", "Open"), ("t2", None)]

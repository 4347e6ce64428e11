"""NULLs, wide keys, foreign types, duplicates and bad rows: each has a rule."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from retail_insights import operators as op
from retail_insights.plans import bronze, gold, jobs
from retail_insights.plans.presentation import ORDERINGS, presented
from retail_insights.schemas import CUSTOMER_SUPPORT, SALES
from retail_insights.sources import read_csv, read_documents, read_files, read_typed_documents
from retail_insights.sources.fixture import AS_OF, Fixture

BIG = 2**31 + 5
D = Decimal


def _sales(spark, data):
    return spark.createDataFrame(data, SALES)


def _line(order, customer, day, product=1, amount="10.00"):
    when = None if day is None else dt.datetime.fromisoformat(day)
    return (order, customer, when, product, 1, D(amount), D(amount), when and when.year, when and when.month)


def test_null_dates_have_a_null_month(spark):
    sales = _sales(spark, [_line(1, 1, "2024-03-05"), _line(2, 1, None, amount="4.00")])
    assert rows(op.peak_sales_months(sales)) == [("2024-03", D("10.00")), (None, D("4.00"))]
    products = spark.createDataFrame([(1, "p", "c")], "product_id bigint, name string, category string")
    months = rows(op.best_customer_products(sales, products), "year_month")
    assert months == [("2024-03",), (None,)]


def test_wide_keys_and_foreign_types_conform(spark):
    current = _sales(spark, [_line(BIG, BIG, "2024-01-02")])
    archive = spark.createDataFrame(
        [("7", str(BIG + 1), "2020-05-06 07:08:09", "3", "2", 2.5, 5.0, "2020", "5")],
        [f.name for f in SALES.fields])
    both = op.with_history(current, archive)
    assert both.schema == SALES
    assert rows(both, "order_id", "customer_id", "order_date", "sales_amount") == [
        (7, BIG + 1, dt.datetime(2020, 5, 6, 7, 8, 9), D("5.00")), (BIG, BIG, dt.datetime(2024, 1, 2), D("10.00"))]
    # The current side is cast as well: text there cannot turn the archive to text.
    loose = current.withColumn("order_date", F.col("order_date").cast("string")).withColumn(
        "sales_amount", F.col("sales_amount").cast("double"))
    assert op.with_history(loose, archive).schema == SALES


def test_archive_and_current_orders_hold_every_order(spark):
    f = Fixture(spark, SF_SMALL)
    assert f.current_orders().count() + f.archived_orders().count() == f.orders().count()


def test_activity_without_a_customer_is_one_row(spark):
    day = dt.datetime(2024, 1, 1)
    inter = spark.createDataFrame([(None, "Email", "Opened", day)],
                                  "CustomerID bigint, Channel string, Action string, Timestamp timestamp")
    orders = spark.createDataFrame([(1, None, day, D("3.00"))],
                                   "order_id bigint, customer_id bigint, order_date timestamp, total_amount decimal(12,2)")
    tickets = spark.createDataFrame([(None, "t", day, "Open")],
                                    "CustomerID bigint, TicketID string, Timestamp timestamp, Status string")
    out = op.omni_channel(inter, orders, tickets, dt.date(2024, 1, 2))
    assert rows(out, "customer_id", "emails_opened", "purchases", "open_ticket") == [(None, 1, 1, 1)]


def test_duplicate_products_stop_bronze(spark, tmp_path):
    good = spark.createDataFrame([(1, "a", "c"), (2, "b", "c")], "product_id bigint, name string, category string")
    assert bronze._land(spark, good, "products_raw", str(tmp_path), None) == 2
    with pytest.raises(ValueError, match="not unique"):
        bronze._land(spark, good.union(good), "products_raw", str(tmp_path), None)


def test_bad_rows_stop_a_read_with_a_schema(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,n\n1,2\nx,y\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        read_csv(spark, str(tmp_path / "a.csv"), "id bigint, n int").collect()
    assert read_files(spark, str(tmp_path / "a.csv"), options={"header": "true", "mode": "PERMISSIVE"},
                      schema="id bigint, n int").count() == 2
    (tmp_path / "d.json").write_text('{"CustomerID": 1}\nnot json\n')
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        read_documents(spark, str(tmp_path / "d.json"), CUSTOMER_SUPPORT).collect()


def test_typed_documents_unwrap_by_field(spark, tmp_path):
    docs = [
        {"Item": {"CustomerID": {"N": str(BIG)}, "TicketID": {"S": "t1"}, "Timestamp": {"S": "2024-01-02T03:04:05"},
                  "Issue": {"M": {"Status": {"S": "Open"}}}}},
        {"Item": {"CustomerID": {"N": "2"}, "TicketID": {"S": "t2"}, "Issue": {"NULL": True}}},
    ]
    path = tmp_path / "e.json"
    path.write_text("\n".join(map(json.dumps, docs)))
    df = read_typed_documents(spark, str(path), CUSTOMER_SUPPORT)
    assert df.schema == CUSTOMER_SUPPORT
    assert rows(op.flatten_tickets(df), "CustomerID", "TicketID", "Status") == [(2, "t2", None), (BIG, "t1", "Open")]
    path.write_text(json.dumps({"Item": {"CustomerID": {"S": "x"}, "TicketID": {"S": "t"}}}))
    with pytest.raises(Exception, match="no value of type N"):
        read_typed_documents(spark, str(path), CUSTOMER_SUPPORT).collect()
    path.write_text(json.dumps({"CustomerID": 1}))
    with pytest.raises(Exception, match="no field Item"):
        read_typed_documents(spark, str(path), CUSTOMER_SUPPORT).collect()


def test_unknown_and_missing_tables_stop_ingestion(spark, tmp_path):
    base = ["ingest_relational", "--target", str(tmp_path)]
    with pytest.raises(SystemExit, match="unknown"):
        jobs.run(spark, [*base, "--jdbc-url", "Ordres=jdbc:x", "--only"])
    with pytest.raises(SystemExit, match="missing"):
        jobs.run(spark, [*base, "--jdbc-url", "Orders=jdbc:x"])
    with pytest.raises(SystemExit, match="unknown"):
        jobs.run(spark, ["ingest_documents", "--target", str(tmp_path), "--export", "support=x", "--only"])


def test_ingested_and_published_bronze_feeds_every_gold_job(spark, tmp_path):
    from test_io_and_jobs import DERBY, _derby_url

    f = Fixture(spark, SF_SMALL)
    url = _derby_url("ri_bronze")
    sources = {"Customers": f.customers(), "Products": f.products(), "Orders": f.current_orders(),
               "Order_Items": f.order_items(), "LoginHistory": f.logins()}
    for name, df in sources.items():
        text = {c: F.col(c).cast("timestamp") for c, kind in df.dtypes if kind == "timestamp_ntz"}
        df.withColumns(text).write.format("jdbc").option("url", url).option("dbtable", name).options(**DERBY).mode(
            "overwrite").save()
    args = ["--publish-db", "bronze_all", "--target", str(tmp_path / "bronze")]
    urls = [x for name in sources for x in ("--jdbc-url", f"{name}={url}")]
    got = jobs.run(spark, ["ingest_relational", *args, *urls, "--jdbc-property", f"driver={DERBY['driver']}"])
    assert got["orders_raw"] == sources["Orders"].count()
    exports = {"customer_support_raw": f.support(), "enterprise_campaign_raw": f.campaigns()}
    for name, df in exports.items():
        df.write.json(str(tmp_path / name))
    jobs.run(spark, ["ingest_documents", *args,
                     *[x for n in exports for x in ("--export", f"{n}={tmp_path / n}")]])
    f.history().write.parquet(str(tmp_path / "history"))
    gold_args = ["--bronze-db", "bronze_all", "--target", str(tmp_path / "gold"), "--ordered"]
    dated = [*gold_args, "--as-of", AS_OF.isoformat()]
    assert jobs.run(spark, ["purchase_behavior", *dated, "--params", '{"country_like": "NATION_1%"}'])
    assert jobs.run(spark, ["churn_prediction", *dated])["churn_risk"] == op.churn_risk(
        f.current_orders(), AS_OF).count()
    assert jobs.run(spark, ["fraud_detection", *dated])
    assert jobs.run(spark, ["omni_channel_engagement", *dated])["omni_channel_engagement"] == 65
    got = jobs.run(spark, ["pricing_trends", *gold_args, "--history-path", str(tmp_path / "history")])
    assert got["peak_sales_months"] == 80 and got["customer_segments"] == 136


@pytest.mark.parametrize("output", sorted(ORDERINGS))
def test_presented_orders(spark, output):
    keys = ORDERINGS[output]
    data = [(i % 3 if i else None, i // 3 if i != 4 else None, i) for i in range(9)]
    names = [c for c, _ in keys]
    df = spark.createDataFrame(data, "a int, b int, c int").toDF(*(names + ["x", "y", "z"])[:3])
    got = [tuple(r[n] for n in names) for r in presented(df.repartition(3), output).collect()]
    # Ascending keys put NULLs first, descending ones last.
    want = sorted(got, key=lambda t: tuple(
        ((v is not None), v or 0) if up else ((v is None), -(v or 0)) for v, (_, up) in zip(t, keys)))
    assert got == want


def test_gold_ordered_output(spark, tmp_path):
    f = Fixture(spark, SF_SMALL)
    gold.churn_prediction(spark, {"orders_raw": f.orders()}, str(tmp_path), AS_OF, ordered=True)
    days = [r[0] for r in spark.read.parquet(str(tmp_path / "churn_risk")).select("days_since_last_purchase").collect()]
    assert days == sorted(days, reverse=True)

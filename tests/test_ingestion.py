"""Balanced parallel reads, incremental ingestion and quarantine."""

import datetime as dt
import json
from collections import Counter
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from retail_insights.plans import increments
from retail_insights.plans.increments import committed, ingest_increment, latest, read_ingested
from retail_insights.schemas import CUSTOMER_SUPPORT
from retail_insights.sources import land, marked, marked_typed, plan_splits, read_balanced, read_typed_documents
from retail_insights.sources.splits import literal, part_sizes

# In-process Derby database: no server, no port, seen by this process alone.
DERBY = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def _url(name):
    return f"jdbc:derby:memory:{name};create=true"


def _put(spark, name, table, data, schema, mode="overwrite"):
    df = spark.createDataFrame(data, schema)
    df.coalesce(1).write.format("jdbc").option("url", _url(name)).option("dbtable", table).options(**DERBY).mode(mode).save()
    return _url(name)


def _is_balanced(sizes, n, most=1.6):
    return max(sizes) <= most * sum(sizes) / n and len(sizes) <= 2 * n


# -- balanced reads ----------------------------------------------------------

def test_skewed_numbers_are_read_in_equal_parts(spark):
    keys = [2 ** (k % 40) + k for k in range(900)] + [None] * 20  # most keys are small, some are huge
    url = _put(spark, "splits_a", "T", [(k, i) for i, k in enumerate(keys)], "ID long, N int")
    df = read_balanced(spark, url, "T", ["ID"], 6, DERBY)
    assert Counter(r.N for r in df.collect()) == Counter(range(920))
    assert _is_balanced(part_sizes(df), 6)


def test_text_and_time_keys(spark):
    day = dt.datetime(2024, 1, 1)
    data = [(f"k'{i % 97:02d}" + "x" * (i % 7), day + dt.timedelta(seconds=i * i), i) for i in range(600)]
    url = _put(spark, "splits_b", "T", data, "CODE string, CHANGED timestamp, N int")
    for column in ("CODE", "CHANGED"):
        # Derby orders neither CLOBs nor reads them by key: strings need a bounded type.
        table = "(SELECT CAST(CODE AS VARCHAR(40)) AS CODE, CHANGED, N FROM T) q"
        df = read_balanced(spark, url, table, [column], 5, DERBY)
        assert sorted(r.N for r in df.collect()) == list(range(600))
        assert _is_balanced(part_sizes(df), 5)


def test_a_hot_key_is_divided_by_a_second_column(spark):
    data = [(7 if i % 3 else i, i) for i in range(900)]  # two thirds on one key
    url = _put(spark, "splits_c", "T", data, "ID long, N int")
    alone = part_sizes(read_balanced(spark, url, "T", ["ID"], 6, DERBY))
    assert max(alone) >= 600
    df = read_balanced(spark, url, "T", ["ID", "N"], 6, DERBY)
    assert sorted(r.N for r in df.collect()) == list(range(900))
    assert _is_balanced(part_sizes(df), 6, 1.8)


def test_small_and_empty_tables(spark):
    url = _put(spark, "splits_d", "T", [(1, 1), (None, 2)], "ID long, N int")
    assert sorted(r.N for r in read_balanced(spark, url, "T", ["ID"], 4, DERBY).collect()) == [1, 2]
    assert plan_splits(spark, url, "T", ["ID"], 1, DERBY) == ["1 = 1"]
    url = _put(spark, "splits_e", "T", [], "ID long, N int")
    assert read_balanced(spark, url, "T", ["ID"], 4, DERBY, fetch_size=10).count() == 0
    assert literal(Decimal("1.50")) == "1.50" and literal(dt.date(2024, 1, 2)) == "{d '2024-01-02'}"
    with pytest.raises(TypeError):
        literal(1.5)


# -- increments --------------------------------------------------------------

SCHEMA = "ID long, V string"


def _ids(spark, target):
    return sorted(r.ID for r in read_ingested(spark, target).collect())


def test_increments_arrive_once_after_lost_runs(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "t")
    url = _put(spark, "inc_a", "T", [(1, "a"), (2, "b")], SCHEMA)
    run = lambda **k: ingest_increment(spark, url, "T", "ID", target, DERBY, **k)
    with pytest.raises(FileNotFoundError):
        read_ingested(spark, target)
    assert run().rows == 2 and _ids(spark, target) == [1, 2]
    assert run() == committed(spark, target)  # nothing new
    _put(spark, "inc_a", "T", [(3, "c"), (4, "d")], SCHEMA, "append")
    with monkeypatch.context() as m:  # lost after the batch was written, before its commit
        m.setattr(increments, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            run()
    assert _ids(spark, target) == [1, 2]
    _put(spark, "inc_a", "T", [(5, "e")], SCHEMA, "append")  # the source has moved on meanwhile
    assert run(parts=3).batch == 2
    assert _ids(spark, target) == [1, 2, 3, 4, 5]
    with monkeypatch.context() as m:  # lost while the mark was written
        m.setattr(increments, "rename_folder", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        _put(spark, "inc_a", "T", [(6, "f")], SCHEMA, "append")
        with pytest.raises(OSError):
            run()
    assert _ids(spark, target) == [1, 2, 3, 4, 5]
    run()
    run()
    assert _ids(spark, target) == [1, 2, 3, 4, 5, 6]
    assert committed(spark, target).rows == 6


def test_two_runs_cannot_commit_one_number(spark, tmp_path):
    target = str(tmp_path / "t")
    url = _put(spark, "inc_b", "T", [(1, "a")], SCHEMA)
    mark = ingest_increment(spark, url, "T", "ID", target, DERBY)
    with pytest.raises(OSError):
        increments._commit(spark, target, mark)


def test_changed_rows_by_time_and_rows_without_a_key(spark, tmp_path):
    target, t0 = str(tmp_path / "t"), dt.datetime(2024, 5, 1, 12)
    at = lambda s: t0 + dt.timedelta(seconds=s)
    schema = "ID long, CHANGED timestamp, V string"
    url = _put(spark, "inc_c", "T", [(1, at(0), "a"), (2, at(50), "b"), (3, at(100), "c")], schema)
    run = lambda: ingest_increment(spark, url, "T", "CHANGED", target, DERBY, settle=60,
                                   shape=lambda df: df.withColumn("V", F.upper("V")))
    run()
    assert _ids(spark, target) == [1]  # what is younger than a minute may not be whole yet
    _put(spark, "inc_c", "T", [(1, at(160), "a2"), (4, at(70), "late"), (5, at(400), "e")], schema, "append")
    run()
    state = latest(read_ingested(spark, target), "ID", "CHANGED")
    assert rows(state, "ID", "V") == [(1, "A2"), (2, "B"), (3, "C"), (4, "LATE")]
    _put(spark, "inc_c", "T", [(9, None, "x")], schema, "append")
    with pytest.raises(ValueError):
        run()


# -- quarantine --------------------------------------------------------------

def test_bad_csv_rows_go_to_the_side(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.csv").write_text("id,amount\n1,2.50\nx,3.00\n3,\n")
    (src / "b.csv").write_text("id,amount\n4,oops\n5,1.00,extra\n6,7.25\n")
    df = marked(spark, str(src), spark.createDataFrame([], "id long, amount decimal(10,2)").schema)
    done = land(df, str(tmp_path / "good"), str(tmp_path / "bad"))
    assert (done.rows, done.good, done.bad) == (6, 3, 3)
    assert rows(spark.read.parquet(str(tmp_path / "good"))) == [(1, Decimal("2.50")), (3, None), (6, Decimal("7.25"))]
    side = spark.read.parquet(str(tmp_path / "bad"))
    assert sorted((r._raw, r._file[-5:]) for r in side.collect()) == [
        ("4,oops", "b.csv"), ("5,1.00,extra", "b.csv"), ("x,3.00", "a.csv")]
    assert {r._reason for r in side.collect()} == {"the row does not fit the declared columns"}


def test_bad_json_rows_and_clean_files(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text('{"id": 1, "v": "a"}\n{"id": "no"}\nnot json\n{"id": 2}\n')
    schema = spark.createDataFrame([], "id long, v string").schema
    done = land(marked(spark, str(src), schema, "json"), str(tmp_path / "good"), str(tmp_path / "bad"))
    assert (done.rows, done.good, done.bad) == (4, 2, 2)
    assert sorted(r._raw for r in spark.read.parquet(str(tmp_path / "bad")).collect()) == ['not json', '{"id": "no"}']
    (src / "a.json").write_text('{"id": 1, "v": "a"}\n')
    done = land(marked(spark, str(src), schema, "json"), str(tmp_path / "good"), str(tmp_path / "bad"))
    assert (done.rows, done.bad) == (1, 0) and spark.read.parquet(str(tmp_path / "bad")).count() == 0


def test_bad_typed_documents_say_where(spark, tmp_path):
    src = tmp_path / "in.json"
    good = {"CustomerID": {"N": "7"}, "TicketID": {"S": "t"}, "Timestamp": {"S": "2024-01-02T03:04:05"},
            "Issue": {"M": {"Status": {"S": "Open"}}}}
    bad = [{**good, "CustomerID": {"S": "7"}}, {**good, "CustomerID": {"N": "seven"}},
           {**good, "Issue": {"M": {"Status": {"N": "1"}}}}, {**good, "Timestamp": {"S": "yesterday"}}]
    lines = [{"Item": good}, *[{"Item": b} for b in bad], {"Other": 1}, {"Item": {**good, "Issue": {"NULL": True}}}]
    src.write_text("\n".join(map(json.dumps, lines)) + "\nbroken\n")
    done = land(marked_typed(spark, str(src), CUSTOMER_SUPPORT), str(tmp_path / "good"), str(tmp_path / "bad"))
    assert (done.rows, done.good, done.bad) == (8, 2, 6)
    reasons = sorted(r._reason for r in spark.read.parquet(str(tmp_path / "bad")).collect())
    assert reasons == ["CustomerID: no bigint: seven", "CustomerID: no value of type N",
                       "Issue.Status: no value of type S", "Timestamp: no timestamp: yesterday",
                       "a document has no field Item", "the line is no such document"]
    only_good = tmp_path / "clean.json"
    only_good.write_text("\n".join(json.dumps(x) for x in (lines[0], lines[-1])))
    assert rows(spark.read.parquet(str(tmp_path / "good")).drop("Issue")) == rows(
        read_typed_documents(spark, str(only_good), CUSTOMER_SUPPORT).drop("Issue"))

"""Ranked search and its sharing plan against brute force and DuckDB."""

import math
import re
from collections import Counter
from random import Random

import duckdb
import numpy as np
from conftest import SF_SMALL, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from retail_insights.llm import ranked_search as rs
from retail_insights.llm.oracle import ORACLE_SQL
from retail_insights.llm.shared_sums import sharing_plan

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def naive_terms(text):
    return [t.translate(SMALL) for t in TERM.findall(text or "")]


def naive_ranks(docs, items, top):
    texts = [(i, naive_terms(t)) for i, t in docs]
    total, words = sum(1 for _, t in texts if t), sum(len(t) for _, t in texts)
    df = Counter(t for _, ts in texts for t in set(ts))
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for i, ts in texts:
            tf, score = Counter(ts), 0
            m = 50 + 50 * len(ts) * total // max(words, 1)
            for t in set(naive_terms(text)):
                w = math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1)))
                score += w * (10**9 * tf[t] // (1000 * tf[t] + 20 * m))
            if score > 0:
                scored.append((-score, i is not None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sets(st.integers(0, 11), min_size=1), min_size=1, max_size=8), st.integers(0, 2**31))
def test_plan_sums_every_term_of_every_item_once(items, seed):
    plan = sharing_plan(items, 12)
    sums = np.zeros(plan.nodes, np.int64)
    sums[:12] = np.random.default_rng(seed).integers(-10**9, 10**9, 12)
    for first, a, b in plan.levels:
        assert max(*a, *b) < first
        sums[first:first + len(a)] = sums[a] + sums[b]
    assert sums[plan.roots].tolist() == [int(sums[list(i)].sum()) for i in items]
    assert plan.nodes - 12 <= sum(len(i) - 1 for i in items)


def test_shared_sets_are_summed_once():
    items = [{*range(20), 20 + k} for k in range(10)]
    plan = sharing_plan(items, 30)
    assert plan.nodes - 30 == 19 + 10 and plan.shared == 19
    assert plan.roots == sharing_plan(items, 30).roots
    same = sharing_plan([{1, 2, 3}] * 5, 4)
    assert len(set(same.roots)) == 1 and same.nodes == 6


def test_terms():
    text = "Foo_Bar é漢x\x00y9Z\x7fÉÀ ß-\u0080"
    assert [t.decode() for t in rs.terms_of(text.encode())] == naive_terms(text)
    assert rs.terms_of(None) == []


def test_scorer_keeps_the_best_in_any_order(monkeypatch):
    monkeypatch.setattr(rs, "HELD", 8)
    import pyarrow as pa

    rng = np.random.default_rng(1)
    plan = sharing_plan([{0, 1}, {1, 2}, {0, 1, 2}], 3)
    scorer = rs.Scorer(plan, [3, 5, 7], 100, 500, 4)
    seen = []
    for k in range(60):
        counts = rng.integers(0, 2, (3, 5))
        sizes = counts.sum(axis=0) + 1
        ids = [None if rng.random() < .1 else int(x) for x in rng.integers(-50, 50, 5)]
        s = scorer.scores(sizes, counts)
        seen += [(j, -s[j, d], ids[d] is not None, ids[d] or 0) for j in range(3) for d in range(5) if s[j, d] > 0]
        scorer.add(pa.array(ids, pa.int64()), sizes, counts)
    item, score, known, doc = scorer.cut()
    got = list(zip(item.tolist(), (-score).tolist(), known.tolist(), doc.tolist()))
    assert got == [x for j in range(3) for x in sorted(y for y in seen if y[0] == j)[:4]]


DOCS = [(1, "Apple pie"), (2, "apple PIE"), (2, "apple PIE"), (3, None), (4, ""), (5, "... !"), (None, "apple pie"),
        (6, "é É " * 20000), (7, "pear"), (8, "pie pie pie apple cake"), (9, "x " * 300 + "apple")]
ITEMS = [(1, "apple pie"), (1, "apple pie"), (2, "APPLE é"), (3, None), (4, "--"), (None, "pear cake"), (5, "absent"),
         (6, "apple pie")]


def test_edge_rows(spark):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in DOCS], "doc_id long, text string, TEXT long, score string")
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, Text long")
    for top, block in ((50, rs.BLOCK_BYTES), (3, 12), (1, 1)):
        got = rs.ranked_search(docs.repartition(3), items, top=top, block_bytes=block)
        assert sorted(map(tuple, got.collect()), key=str) == naive_ranks(DOCS, ITEMS, top)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert rs.ranked_search(docs.limit(0), items).count() == 0
    assert rs.ranked_search(docs, items.limit(0)).count() == 0


def test_copies_and_ties_keep_the_least_ids(spark):
    rng = Random(2)
    docs = [(rng.randrange(10**6), "copy of one text") for _ in range(3000)] + [(7, "another one text")]
    items = [(1, "one text"), (2, "copy of")]
    got = rs.ranked_search(spark.createDataFrame(docs, "doc_id long, text string").repartition(8),
                           spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == naive_ranks(docs, items, 50)


def test_query_equals_brute_force_and_duckdb(spark):
    read = lambda t, key: [(r[key], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/{t}.parquet").collect()]
    got = rs.op12_ranked_search(spark, SF_SMALL)
    assert sorted(map(tuple, got.collect()), key=str) == naive_ranks(
        read("documents", "doc_id"), read("benchmark", "item_id"), 50)
    with duckdb.connect() as db:
        for t in ("documents", "benchmark"):
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
        oracle = db.execute(ORACLE_SQL["op12_ranked_search"])
        names = [c[0] for c in oracle.description]
        told = [dict(zip(names, r)) for r in oracle.fetchall()]
    assert rows(got) == sorted((tuple(r[c] for c in got.columns) for r in told),
                               key=lambda t: tuple((v is None, v) for v in t))

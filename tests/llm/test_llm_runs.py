"""Periodic runs against brute force."""

import hashlib
import zlib

import numpy as np
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from retail_insights.llm import periodic_runs as pr


def naive_runs(words):
    """Every maximal stretch on every lag, kept if the lag is its smallest period."""
    n, out = len(words), []
    for q in range(1, n):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            stretch = words[i:j + q]
            least = next(d for d in range(1, q + 1) if stretch[d:] == stretch[:-d])
            if length >= max(6, 4 * q) and least == q:
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def naive_rest(words, runs):
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in drop)


def _numbers(texts):
    flat = [w for t in texts for w in t]
    ids = {w: i for i, w in enumerate(dict.fromkeys(flat))}
    return np.array([ids[w] for w in flat], np.int64)


periodic = st.builds(lambda unit, times, cut, pre, post: pre + (unit * times)[:len(unit) * times - cut] + post,
                     st.lists(st.sampled_from(b"ab"), min_size=1, max_size=9).map(list), st.integers(3, 7),
                     st.integers(0, 4), st.lists(st.sampled_from(b"abc"), max_size=6).map(list),
                     st.lists(st.sampled_from(b"abc"), max_size=6).map(list))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(b"ab"), max_size=60).map(list) | periodic, min_size=1, max_size=4))
def test_runs_equal_all_lags(texts):
    assert pr.runs_of(_numbers(texts), [len(t) for t in texts]) == [naive_runs(t) for t in texts]


def test_long_periods_and_one_word_documents():
    rng = np.random.default_rng(3)
    texts = [[7] * 5000, [], [1]]
    for q in (4, 5, 6, 14, 15, 16, 44, 45, 46, 135, 136, 400):
        unit = rng.integers(0, 10**6, q).tolist()
        for length in (4 * q - 1, 4 * q, 5 * q + q // 2):
            texts.append([-1, -2] + (unit * 6)[:length] + [-3])
    got = pr.runs_of(_numbers(texts), [len(t) for t in texts])
    assert got[:3] == [[(0, 5000, 1)], [], []]
    for k, q in enumerate((4, 5, 6, 14, 15, 16, 44, 45, 46, 135, 136, 400)):
        assert got[3 + 3 * k:6 + 3 * k] == [[], [(2, 4 * q, q)], [(2, 5 * q + q // 2, q)]]


def test_hashes_that_share_their_upper_bits_are_sorted_whole():
    hashes = np.array([(5 << 24) | 3, (5 << 24) | 1, (5 << 24) | 3, (9 << 24), (5 << 24) | 1], np.uint64)
    a, b = pr._neighbours(hashes, np.arange(5))
    assert sorted(zip(a.tolist(), b.tolist())) == [(0, 2), (1, 4)]


EDGE = [(1, None), (2, ""), (3, " \t\r\n\x0b\x0c"), (None, "x x x x x x x"), (4, "a b " * 9), (4, "a b " * 9),
        (5, "é é " * 8), (6, "long " * 30000), (7, "p q r s p q r s p q r s p q r"), (8, "A a A a A a A")]


def _expected(docs, planted):
    out = []
    for i, t in docs:
        words = (t or "").encode().split()
        if planted and i is not None:
            h = zlib.crc32(str(i).encode())
            if h % 10 == 0 and words:
                n, g = len(words), h // 10
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                words = [words[j] if j < a else words[a + (j - a) % p] for j in range(n)]
        runs = [(0, len(words), 1)] if len(words) == 30000 else naive_runs(words)
        out.append((i, len(words), runs, naive_rest(words, runs)))
    return sorted(out, key=str)


def test_operator_on_edge_rows(spark):
    docs = spark.createDataFrame([(i, t, 9, "x") for i, t in EDGE], "doc_id long, text string, TEXT long, runs string")
    for unit in (pr.UNIT, 5):
        got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], bytes(r.collapsed))
                      for r in pr.periodic_runs(docs, unit=unit).collect()), key=str)
        assert got == _expected(EDGE, False)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pr.periodic_runs(empty).count() == 0


def test_query_equals_brute_force(spark, tmp_path):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet")
            .where(F.length("text") < 3000).collect()]
    docs = rows + EDGE[:5] + EDGE[6:7] + [(10**12 + i, "w v u w t " * (i + 1)) for i in range(40)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    want, planted = [], 0
    for i, n, runs, rest in _expected(docs, True):
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        lines = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
        planted += bool(runs)
        want.append((i, len(runs), *told, hashlib.sha256(lines.encode()).hexdigest(),
                     hashlib.sha256(rest).hexdigest()))
    got = pr.op13_periodic_runs(spark, str(tmp_path)).drop("n_words")
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                           "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert planted > 20

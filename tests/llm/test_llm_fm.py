"""The FM-index and the removal of earlier documents' words against brute force."""

import hashlib
from collections import Counter
from random import Random

import numpy as np
import pytest
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from retail_insights.llm import fm_index, substring_fm

sequences = st.lists(st.lists(st.integers(0, 3), max_size=25), min_size=1, max_size=5)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=200))
def test_wavelet_tree_ranks(symbols):
    tree = fm_index.WaveletTree(np.array(symbols), 10)
    for c in set(symbols):
        at = np.arange(len(symbols) + 1)
        want = np.concatenate(([0], np.cumsum(np.array(symbols) == c)))
        assert tree.rank(np.full(len(at), c), at).tolist() == want.tolist()


def test_codes_are_prefix_free_and_short():
    rng = np.random.default_rng(4)
    counts = (10_000 / np.arange(1, 400) ** 1.3).astype(np.int64)
    counts[rng.integers(0, 399, 40)] = 0
    depth = fm_index.code_lengths(counts)
    code = fm_index.canonical_codes(depth)
    words = [format(c, f"0{d}b") for c, d in zip(code.tolist(), depth.tolist()) if d]
    assert len(set(words)) == np.count_nonzero(counts)
    assert not any(b.startswith(a) for a, b in zip(sorted(words), sorted(words)[1:]))
    share = counts[counts > 0] / counts.sum()
    entropy = -(share * np.log2(share)).sum()
    assert entropy <= (counts * depth).sum() / counts.sum() < entropy + 1


def _occurs(texts, part):
    return [k for k, t in enumerate(texts) if any(t[i:i + len(part)] == part for i in range(len(t) - len(part) + 1))]


@settings(max_examples=200, deadline=None)
@given(sequences, st.lists(st.lists(st.integers(-1, 5), max_size=25), max_size=4), st.integers(1, 30))
def test_matching_statistics(texts, foreign, cap):
    index = fm_index.FMIndex([np.array(t, np.int64) for t in texts], 5, cap)
    values = np.array([(7 * k) % 11 for k in range(len(texts))])
    least = index.least_of_class(values)
    patterns = [*foreign, *texts]
    length, suffix = index.matching_statistics([np.array(p, np.int64) for p in patterns])
    at = 0
    for p in patterns:
        for i in range(len(p)):
            want = max(n for n in range(min(cap, len(p) - i) + 1) if not n or _occurs(texts, p[i:i + n]))
            assert length[at] == want
            if want == cap:
                held = _occurs(texts, p[i:i + cap])
                assert least[index.class_of[suffix[at]]] == min(values[k] for k in held)
            at += 1


def naive(docs, length):
    """(id, words, removed, kept) of rows ``(id, text)``."""
    least = {}
    for i, t in docs:
        w = (t or "").encode().split()
        for k in range(len(w) - length + 1 if i is not None else 0):
            part = tuple(w[k:k + length])
            least[part] = min(i, least.get(part, i))
    out = []
    for i, t in docs:
        w = (t or "").encode().split()
        gone = {j for k in range(len(w) - length + 1 if i is not None else 0)
                if least[tuple(w[k:k + length])] < i for j in range(k, k + length)}
        out.append((i, len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone)))
    return Counter(out)


def told(df):
    return Counter((r.doc_id, r.n_words, r.n_removed, bytes(r.kept)) for r in df.collect())


def _mixed_docs(rng, n, passages, vocabulary=400):
    words = [f"w{k}é" for k in range(vocabulary)]
    shared = [rng.choices(words, k=rng.randrange(10, 160)) for _ in range(passages)]
    docs = []
    for i in rng.sample(range(10 * n), n):
        text = rng.choices(words, k=rng.randrange(0, 90))
        for _ in range(rng.randrange(3)):
            at, part = rng.randrange(len(text) + 1), rng.choice(shared)
            a = rng.randrange(len(part))
            text[at:at] = part[a:] if rng.random() < .3 else part
        docs.append((i, rng.choice([" ", "\n", "\t\r "]).join(text)))
    return docs


@pytest.mark.parametrize("seed", range(2))
def test_earlier_words_equal_brute_force(spark, seed, monkeypatch):
    if seed:  # crowded anchors and full shards at once
        monkeypatch.setattr(substring_fm, "CROWD", 3)
    rng = Random(seed)
    docs = _mixed_docs(rng, 150, 12)
    long = " ".join(f"v{k % 700}" for k in range(6000))
    docs += [(None, docs[3][1]), (None, None), (5, None), (6, ""), (7, "one two"), (8, long), (9, long), (9, long),
             (9, "start " + long), (docs[0][0], docs[0][1]), (docs[0][0], docs[1][1])]
    rng.shuffle(docs)
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, TEXT long, size string")
    got = substring_fm.without_earlier_words(df.repartition(4), unit=700 if seed else substring_fm.UNIT,
                                             shard=500 if seed else substring_fm.SHARD)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept"]
    assert told(got) == naive(docs, substring_fm.LENGTH)


def test_a_passage_in_more_documents_than_a_shard_takes(spark):
    """More than CROWD different segments stand at one anchor."""
    rng = Random(9)
    passage = [f"p{k}" for k in range(56)]
    docs = []
    for i in range(substring_fm.CROWD + 300):
        around = [f"u{rng.randrange(10**6)}" for _ in range(40)]
        docs.append((i, " ".join(around[:20] + passage + around[20:])))
    got = substring_fm.without_earlier_words(spark.createDataFrame(docs, "doc_id long, text string").repartition(4))
    assert told(got) == naive(docs, substring_fm.LENGTH)


def test_empty_table(spark):
    assert substring_fm.without_earlier_words(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_equals_brute_force(spark, tmp_path):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    docs += [(10**6 + i, t) for i, t in docs[::7]] + [(-1, docs[20][1])]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = substring_fm.op11_substring_dedup(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    want = Counter((i, n, gone, hashlib.sha256(kept).hexdigest()) for i, n, gone, kept in naive(docs, 50).elements())
    assert Counter(map(tuple, got.collect())) == want
    assert sum(r[2] > 0 for r in want) > 10

"""Benchmark passages, SimHash groups, URL rules and suffix arrays against brute force."""

import hashlib
from collections import Counter
from random import Random

import numpy as np
import pytest
import xxhash
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from retail_insights.llm import components, decontaminate, simhash_covering, suffix_array, suffix_dedup, url_rules
from retail_insights.llm.common import only


def _docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]


# -- benchmark passages ----------------------------------------------------

def _nearest(window, code):
    row = [0] * (len(code) + 1)
    for i, x in enumerate(window, 1):
        new = [i]
        for j, y in enumerate(code, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_passages_equal_full_alignment(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    index = decontaminate.PassageIndex(items)
    hosts, rng, found = [t.encode() for _, t in _docs(spark)], Random(5), 0
    for _ in range(40):
        item, text = rng.choice(items)
        chars = list(text)
        for _ in range(rng.randrange(14)):
            at = rng.randrange(len(chars))
            chars[at:at + 1] = rng.choice([[], ["q"], [chars[at], "z"]])
        host = rng.choice(hosts)[:700].decode("utf-8", "ignore")
        raw = (host[:300] + " " + "".join(chars) + " " + host[300:]).encode()
        code = decontaminate.symbols(raw)[0].tolist()
        want = any(owner == item and _nearest(w.tolist(), code) <= index.e[k]
                   for k, (owner, w) in enumerate(zip(index.item, index.windows)))
        assert (item in {hit[1] for hit in index.search([raw])}) == want
        found += want
    assert 0 < found < 40


def test_passages_in_documents(spark, monkeypatch):
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    item = bench.orderBy("item_id").first()
    planted = item.text.upper().replace(" ", "\n")
    docs = [(1, "é before it. " + planted + " after"), (1, "é before it. " + planted + " after"), (2, None), (3, ""),
            (4, "plain words"), (None, planted)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = decontaminate.benchmark_passages(df, bench).collect()
    assert sorted((r.doc_id or 0, r.item_id) for r in got) == [(0, item.item_id), (1, item.item_id), (1, item.item_id)]
    for r in got:
        if r.doc_id == 1:
            covered = docs[0][1][r.start:r.end]
            assert [c for c in covered.lower() if c.isalnum()] == [c for c in item.text.lower() if c.isalnum()]
    # Blocks of the benchmark find the same, and the filter drops the same rows.
    assert sorted(map(str, decontaminate.benchmark_passages(df, bench, block_bytes=2000).collect())) == sorted(map(str, got))
    assert sorted(r.doc_id for r in decontaminate.without_passages(df, bench).collect()) == [2, 3, 4]
    nothing = bench.limit(0)
    assert decontaminate.benchmark_passages(df, nothing).count() == 0
    assert decontaminate.without_passages(df, nothing).count() == 6


def test_edited_items_at_the_edges_of_neighbouring_texts():
    rng = Random(9)
    word = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    items = [(k, word(150)) for k in range(4)]
    index, texts = decontaminate.PassageIndex(items), []
    for cut in (0, 1, 2, 5, 8, 9):
        item = rng.choice(items)[1]
        texts += [word(80), item[cut:] + word(30), word(60), word(30) + item[:len(item) - cut], word(40), item[cut:],
                  item[:70] + "z" + item[72:], "", word(3), item[:75], item[75:]]
    raw = [t.encode() for t in texts]
    want = {(k, index.item[w]) for k, t in enumerate(raw) for w, window in enumerate(index.windows)
            if _nearest(window.tolist(), decontaminate.symbols(t)[0].tolist()) <= index.e[w]}
    got = index.search(raw)
    assert {hit[:2] for hit in got} == want and len(want) >= 24
    # The same as each text alone, places and edits included.
    assert got == [(k, *hit[1:]) for k, t in enumerate(raw) for hit in index.search([t])]
    assert all(0 <= b < f <= len(raw[k]) for k, _, b, f, _, _ in got)


def test_copied_stretches_of_items_of_any_size():
    rng = Random(11)
    word = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    least = decontaminate.STRETCH + decontaminate.STRIDE - 1
    items = [(n, word(n)) for n in (5, 11, 12, 49, 50, 59, 60, 130, 190, 200, 201, 400)]
    index = decontaminate.PassageIndex(items)
    for n, item in items:
        size = min(n, least)
        for a in {0, n - size, *(rng.randrange(n - size + 1) for _ in range(40))}:
            raw = f"{word(40)} {item[a:a + size]} {word(40)}".encode()
            assert [hit[1] for hit in index.search([b"x", raw])] == [n]
    # A truncated item, and whole items with as many edits as allowed, evenly spread.
    assert [hit[1] for hit in index.search([items[8][1][:161].encode()])] == [190]
    for n, item in items[:-2]:
        edits = n * decontaminate.EDIT_PCT // 100 if n >= 49 else 0
        chars = list(item)
        for k in range(edits):
            chars[(2 * k + 1) * n // (2 * edits)] = "z"
        assert [hit[1] for hit in index.search(["".join(chars).encode()])] == [n]
    # Short items: whole words only, each place once.
    index = decontaminate.PassageIndex([(1, "Cat"), (2, "to be"), (None, "?"), (3, "\u00e9")])
    hits = index.search([b"cat, concatenate cats", b"Or not TO-BE. cat", b"tobe or to bed", b"", "\u00e9".encode(), b"cat"])
    assert [hit[:5] for hit in hits] == [(0, 1, 0, 3, 0), (1, 1, 14, 17, 0), (1, 2, 7, 12, 0), (2, 2, 0, 4, 0),
                                         (4, 3, 0, 2, 0), (5, 1, 0, 3, 0)]


def test_repeated_items_are_indexed_once(spark):
    rng = Random(12)
    one, two = ("".join(rng.choice("abcdefghij") for _ in range(100)) for _ in range(2))
    items = [(i % 20, one) for i in range(30)] + [(None, two), (7, two), (8, None), (9, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    blocks = list(decontaminate.item_blocks(bench, "text", 150))
    assert sorted(text for block in blocks for _, text in block) == sorted(["", one, two]) and len(blocks) == 2
    docs = spark.createDataFrame([(1, one), (2, two + " " + one), (3, "no item")], "doc_id long, text string")
    for size in (150, 1 << 20):
        got = decontaminate.benchmark_passages(docs, bench, block_bytes=size).collect()
        assert Counter((r.doc_id, r.item_id) for r in got) == Counter(
            (d, i) for d, has in ((1, [one]), (2, [one, two])) for i, t in items if t in has)


# -- SimHash ---------------------------------------------------------------

def _fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _groups(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover_every_pair_of_differences(radius):
    masks = simhash_covering.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    rng = Random(1)
    pairs = [(i, j) for i in range(64) for j in range(i)] if radius == 2 else [
        rng.sample(range(64), radius) for _ in range(500)]
    for bits in pairs:
        assert any(all(not m >> b & 1 for b in bits) for m in masks)
        deeper = simhash_covering.divided(masks, radius)
        assert any(all(not m >> b & 1 for b in bits) for m in deeper)


def test_simhash_groups_equal_all_pairs(spark):
    docs = _docs(spark) + [(1000, None), (1001, " \n"), (1002, "two words"), (1003, "two  Words")]
    out = simhash_covering.simhash_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    prints = {i: _fingerprint(t) for i, t in docs}
    assert {r.doc_id: r.fp % 2**64 for r in out} == prints
    near = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    assert {r.doc_id: r.component_id for r in out} == _groups(prints, near)


def test_crowded_buckets_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash_covering, "BUCKET", 4)
    rng = Random(2)
    seeds = [rng.getrandbits(64) for _ in range(4)]
    prints = {s for s in seeds}
    for s in seeds:
        for _ in range(60):
            prints.add(s ^ (1 << rng.randrange(12)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(12)))
    signed = {simhash_covering._signed(p): p for p in prints}
    edges = simhash_covering.links(spark.createDataFrame([(s,) for s in signed], "fp long")).collect()
    got = _groups(signed, [(r.u, r.v) for r in edges])
    want = _groups(signed, [(a, b) for a in signed for b in signed
                            if a < b and (signed[a] ^ signed[b]).bit_count() <= 2])
    assert got == want
    assert all((signed[r.u] ^ signed[r.v]).bit_count() <= 2 for r in edges)


def test_components_equal_union_find(spark):
    rng = Random(7)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)]
    out = components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    assert {r.node: r.root for r in out} == _groups(nodes, [e for e in edges if e[0] != e[1]])
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_one_document_of_each_group(spark):
    text = "the quick brown fox jumps over the lazy dog and more"
    docs = [(None, text, "a"), (None, text, "a"), (5, text, "b"), (5, text, "c"), (5, "quite other words stand here", "d"),
            (None, "zz yy xx ww", "e"), (None, "zz yy xx ww", "f"), (9, None, "g"), (8, "", "h")]
    kept = simhash_covering.one_of_each_group(spark.createDataFrame(docs, "doc_id long, text string, source string"))
    assert kept.columns == ["doc_id", "text", "source"]
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [
        ("5", "quite other words stand here"), ("5", text), ("8", ""), ("None", "zz yy xx ww")]


# -- URL rules -------------------------------------------------------------

def test_url_edges(spark):
    urls = [None, "", "nourl", "HTTP://WWW.Example.COM/en/a?b#c", "x://a.NET", "https://é.net/es/ü#/es/", "a://b://c/d",
            "http://spam-farm.example.org/a", "http://example.com/en/x", "http://notexample.com/en/x", "://",
            "http://h.org/casino", "http://h.org/casinos", "http://education.org/casino/", "http://a.net/es/", "http://a.net/es/"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    out = [tuple(r)[1:5] for r in url_rules.url_verdicts(df).orderBy("page_id").collect()]
    assert out == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("www.example.com", "/en/a", "www.example.com/en/", "allow"), ("a.net", "", None, "allow"),
        ("é.net", "/es/ü", "net/es/", "block"), ("b:", "//c/d", None, "allow"),
        ("spam-farm.example.org", "/a", None, "block"), ("example.com", "/en/x", "example.com/en/", "block"),
        ("notexample.com", "/en/x", "com/", "allow"), ("", "", None, "allow"), ("h.org", "/casino", None, "block"),
        ("h.org", "/casinos", None, "allow"), ("education.org", "/casino/", None, "allow"),
        ("a.net", "/es/", "net/es/", "block"), ("a.net", "/es/", "net/es/", "block")]
    assert url_rules.url_verdicts(df.limit(0)).count() == 0


def test_url_plan_is_native(spark, capsys):
    url_rules.url_verdicts(spark.createDataFrame([(1, "http://a.b/")], "page_id long, url string")).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


# -- suffix arrays ---------------------------------------------------------

@settings(max_examples=300, deadline=None)
@given(st.lists(st.binary(max_size=25) | st.text("ab", max_size=40).map(str.encode), min_size=1, max_size=5))
def test_suffix_array_and_common_prefixes(strings):
    t, _, _ = suffix_array.joined(strings)
    symbols = t.tolist()
    order = suffix_array.suffix_array(t, len(strings))
    assert order.tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:])
    plcp, _ = suffix_array.permuted_lcp(t, order)
    for a, b in zip(order.tolist(), order.tolist()[1:]):
        k = 0
        while max(a, b) + k < len(symbols) and symbols[a + k] == symbols[b + k]:
            k += 1
        assert plcp[b] == k


def _without_repeats(docs, length):
    texts = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(t[k:k + length] for _, t in texts for k in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        covered = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - length + 1):
            if seen[t[k:k + length]] > 1:
                covered[k:k + length] = True
        runs = int((np.diff(np.concatenate(([False], covered)).astype(int)) == 1).sum())
        rest = bytes(c for c, x in zip(t, covered) if not x)
        out.append((i, len(t), int(covered.sum()), runs, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("crowd, tile", [(1024, 8 << 20), (4, 8 << 20), (1024, 700)])
def test_repeats_equal_brute_force(spark, monkeypatch, crowd, tile):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    monkeypatch.setattr(suffix_dedup, "TILE", tile)
    rng = Random(2)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(300))
    docs = []
    for i in range(40):
        a, b = rng.randrange(120), rng.randrange(90, 300)
        docs.append((i, "".join(rng.choice("xyz ") for _ in range(rng.randrange(300))) + passage[a:b]
                     + "".join(rng.choice("uvw é") for _ in range(rng.randrange(300)))))
    docs += [(100, "a" * 900), (101, "ab" * 300), (102, None), (103, ""), (104, docs[0][1]), (104, docs[0][1]),
             (None, docs[1][1]), (None, docs[1][1]), (105, "é" * 200)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = suffix_dedup.without_repeats(df, length=100, gram=16).drop("kept").collect()
    assert sorted(map(tuple, got), key=str) == _without_repeats(docs, 100)


def test_texts_with_one_short_hash_stay_apart(spark):
    passage = "".join(Random(4).choice("abcdefgh ") for _ in range(150))
    own = F.concat(F.lit("own words "), F.col("id"), F.lit(" stand here, "))
    texts = spark.range(400_000).select((F.col("id") % 2).alias("late"), F.when(
        F.col("id") % 2 == 0, F.concat(F.lit(passage), own)).otherwise(F.concat(own, own, F.lit(passage))).alias("text"))
    pair = texts.groupBy(F.hash("text")).agg(F.min(F.when(F.col("late") == 0, F.col("text"))).alias("a"),
                                             F.min(F.when(F.col("late") == 1, F.col("text"))).alias("b"))
    a, b = pair.where("a is not null and b is not null").select("a", "b").first()
    docs = [(i, t) for i in (None, 7) for t in (a, b)]
    got = suffix_dedup.without_repeats(spark.createDataFrame(docs, "doc_id long, text string"), length=100, gram=16)
    assert sorted(map(tuple, got.drop("kept").collect()), key=str) == _without_repeats(docs, 100)
    alone = suffix_dedup.without_repeats(spark.createDataFrame(docs[:2], "doc_id long, text string"), length=100, gram=16)
    assert sorted(map(tuple, alone.drop("kept").collect()), key=str) == _without_repeats(docs[:2], 100)


def test_repeats_on_documents_and_empty_table(spark):
    docs = _docs(spark)
    got = suffix_dedup.op6_suffix_dedup(spark, SF_SMALL).collect()
    assert sorted(map(tuple, got), key=str) == _without_repeats(docs, 400)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.without_repeats(empty).count() == 0


def test_clashing_column_names(spark):
    df = spark.createDataFrame([(1, "x", "y", 2)], ["doc_id", "text", "TEXT", "Doc_ID"])
    assert only(df, "doc_id", "text").collect() == [(1, "x")]
    with pytest.raises(ValueError):
        only(df, "lang")

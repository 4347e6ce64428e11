"""Periodic runs of words in each document, by seeds and diagonals.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q``
apart are equal), at least ``MIN_REPEATS * q`` and ``MIN_WORDS`` words long,
which no neighbouring word extends.

A run agrees with itself shifted by ``q`` in at least 3q words (five where q is
one), so every run with a lag in (k/3, k] holds a k-gram that occurs again
``q`` words on.  Seeds of k = 5, 15, 45, ... words cover all lags.  A k-gram is
at least as long as the lags looked for, so inside a run its next occurrence is
exactly one period on: only neighbouring occurrences are paired, and a gram
that fills a document gives no more pairs than words.  Each pair lies on the
diagonal of its lag and is extended both ways; a table with the furthest place
covered on each lag suppresses the pairs that a known stretch already holds.

Words are compared by exact numbers.  Grams meet by 64-bit hashes, so a seed
could only be lost where two grams of one document share all 64 bits.

Defined results: words are the maximal matches of ``[^\\x20\\x09-\\x0D]+``; a
null, empty or wordless text has none, no runs and an empty rest; every input
row gives one output row, so repeated rows and null ids stay; other columns
(clashing names included) are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_insights.llm.common import only, table, text_batches

MIN_WORDS, MIN_REPEATS = 6, 4
#: Words of the shortest seeds, and how much longer those of the next lags are.
SEED, GROWTH = 5, 3
#: Words that a task examines at once (a longer document is examined alone).
UNIT = 1 << 18
POSITION_BITS = 24
BASE = 0x9E3779B97F4A7C15
RUNS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"


def _mixed(x):
    """64 well-spread bits of each number."""
    import numpy as np

    x = (x + np.uint64(1)) * np.uint64(BASE)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Grams:
    """Hashes of the grams of any length of one array of word numbers."""

    def __init__(self, words):
        import numpy as np

        n = len(words)
        up, down = (np.full(n, b, np.uint64) for b in (BASE, pow(BASE, -1, 1 << 64)))
        up[:1] = down[:1] = 1
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_mixed(words.astype(np.uint64)) * np.multiply.accumulate(up), out=self.sums[1:])
        self.scale = np.multiply.accumulate(down)

    def at(self, places, k: int):
        return _mixed((self.sums[places + k] - self.sums[places]) * self.scale[places])


def _neighbours(hashes, places):
    """(place, next place) of neighbouring equal hashes; ``places`` ascend."""
    import numpy as np

    if places[-1] >> POSITION_BITS == 0:
        low = np.uint64((1 << POSITION_BITS) - 1)
        mixed = np.sort((hashes & ~low) | np.arange(len(places), dtype=np.uint64))
        order = (mixed & low).astype(np.int64)
        same = hashes[order[1:]] == hashes[order[:-1]]
        alike = (mixed[1:] ^ mixed[:-1]) <= low
        if not (alike & ~same).any():
            return places[order[:-1][same]], places[order[1:][same]]
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    return places[order[:-1][same]], places[order[1:][same]]


def _agreeing(a, b) -> int:
    """How many leading entries of two arrays are equal."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        differ = a[at:at + step] != b[at:at + step]
        if differ.any():
            return at + int(differ.argmax())
        at, step = at + step, step * 2
    return n


def runs_of(words, sizes) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each document, by start and
    period.  ``words`` holds the word numbers of the documents side by side."""
    import numpy as np

    sizes = np.asarray(sizes, np.int64)
    ends = np.cumsum(sizes)
    found: list[list[tuple[int, int, int]]] = [[] for _ in sizes]
    if not len(words):
        return found
    grams = Grams(words)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    covered: dict[int, int] = {}
    k, above = SEED, 0  # lags above ``above`` and up to ``k``
    while True:
        least = max(MIN_WORDS, MIN_REPEATS * (above + 1))
        places = np.flatnonzero((sizes >= least)[owner] & (np.arange(len(words)) + k <= ends[owner]))
        if not len(places):
            return [sorted(x, key=lambda r: (r[0], r[2])) for x in found]
        p, q = _neighbours(grams.at(places, k), places)
        lag = q - p
        fits = (lag > above) & (lag <= k) & (owner[p] == owner[q])
        # Seeds one after another on a diagonal lie in one stretch: the first stands for them.
        key = np.sort(lag[fits] * len(words) + p[fits])
        firsts = key[np.append(True, np.diff(key) != 1)] if len(key) else key
        for key in firsts.tolist():
            lag, p = divmod(key, len(words))
            if p < covered.get(lag, 0):
                continue
            doc = int(owner[p])
            lo, hi = int(ends[doc] - sizes[doc]), int(ends[doc])
            right = p + _agreeing(words[p:hi - lag], words[p + lag:hi])
            left = p - _agreeing(words[lo:p][::-1], words[lo + lag:p + lag][::-1])
            covered[lag] = right
            length = right + lag - left
            if length >= max(MIN_WORDS, MIN_REPEATS * lag):
                found[doc].append((left - lo, length, lag))
        above, k = k, k * GROWTH


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run repeats, joined by one space."""
    kept, at = [], 0
    for start, stop in sorted((s + q, s + n) for s, n, q in runs):
        kept += words[at:max(at, start)]
        at = max(at, stop)
    return b" ".join(kept + words[at:])


def _finder(unit: int):
    def solve(ids, texts):
        import numpy as np
        import pyarrow as pa

        number: dict[bytes, int] = {}
        known = [number.setdefault(w, len(number)) for t in texts for w in t]
        runs = runs_of(np.array(known, np.int64), [len(t) for t in texts])
        named = [[dict(zip(("start", "length", "period"), r)) for r in x] for x in runs]
        kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array(named, kind),
             pa.array([_collapsed(t, r) for t, r in zip(texts, runs)], pa.binary())],
            names=["doc_id", "n_words", "runs", "collapsed"])

    def find(batches):
        for batch in batches:
            ids, texts, size = [], [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = (text.as_py() or b"").split()  # splits bytes at the six white-space bytes
                if texts and size + len(words) > unit:
                    yield solve(ids, texts)
                    ids, texts, size = [], [], 0
                ids.append(doc)
                texts.append(words)
                size += len(words)
            if ids:
                yield solve(ids, texts)

    return find


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: int = UNIT) -> DataFrame:
    """Per input row: doc_id, n_words, runs (start, length and period in words,
    by start and period) and collapsed (UTF-8: the words left when each run
    keeps its first period only, joined by one space).  One narrow pass."""
    text_batches(docs.sparkSession)
    d = only(docs, id_col, text_col).select(F.col(id_col).cast("long").alias("doc_id"),
                                            F.col(text_col).cast("binary").alias("text"))
    return d.mapInArrow(_finder(unit), RUNS)


def planted_words(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of the query's contract: every tenth document by checksum of
    its id turns periodic from some word on."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def _planter(batches):
    import pyarrow as pa

    for batch in batches:
        ids, out = batch.column(0).to_pylist(), []
        for doc, text in zip(ids, batch.column(1)):
            raw = text.as_py() or b""
            chosen = doc is not None and not zlib.crc32(str(doc).encode()) % 10
            out.append(b" ".join(planted_words(doc, raw.split())) if chosen else raw)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["doc_id", "text"])


def op13_periodic_runs(spark, sf_dir):
    """Runs of all documents, after the contract's change of every tenth one."""
    text_batches(spark)
    docs = only(table(spark, sf_dir, "documents"), "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    found = periodic_runs(docs.mapInArrow(_planter, "doc_id long, text binary"))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"], r["period"])))
    line = lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    return found.withColumn("best", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"), (-F.col("best.n")).alias("length"), F.col("best.period").alias("period"),
        F.expr("(-1000 * best.n) div best.period").cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")

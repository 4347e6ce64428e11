"""Benchmark passages in documents, by the q-gram lemma on diagonal bands.

Texts are compared by their letters and digits alone (ASCII letters in lower
case, other characters as UTF-8 bytes), so layout and punctuation do not
matter.  Items of every size are searched for copied stretches, by windows of
``STRETCH`` symbols, one each ``STRIDE`` symbols and one at the end (a shorter
item is one window).  So a document that repeats any ``STRETCH + STRIDE - 1``
symbols of an item with at most ``STRETCH_EDIT_PCT`` percent of a window's
symbols edited is found, wherever the stretch starts.  With more edits
(``EDIT_PCT`` percent) items are searched whole, long ones by half overlapping
windows of ``WINDOW`` symbols.

A region that matches a window of ``m`` symbols with at most ``e``
edits shares at least ``m + 1 - q - q*e`` q-grams with it, and all of them lie
on diagonals within a band of ``e + 1``.  So shared q-grams are counted in
overlapping bands, bands that meet the bound are kept, and each is verified
by a banded alignment.

Documents are read once per block of benchmark items; a block's index is
shipped with the tasks, and its size is bounded by ``block_bytes``, as each
distinct text is indexed once; the ids of its rows are joined to the hits.
Nothing is shuffled but the hits and the item ids.

An item with fewer than ``q`` symbols is compared exactly, and only from the
start of a word to the end of one.

Defined results: null or empty texts and items without symbols match nothing;
repeated documents and repeated items are
matched one by one; other columns (clashing names included) are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_insights.llm.common import only, positional, table

Q = 12
#: Edits allowed per hundred symbols of an item or long window.
EDIT_PCT = 6
#: Items with more symbols are searched by windows of this many, half overlapping.
WHOLE, WINDOW = 200, 160
#: Symbols of a window for stretches, from one's start to the next, edits per hundred.
STRETCH, STRIDE, STRETCH_EDIT_PCT = 50, 10, 4
BLOCK_BYTES = 8 << 20
#: Bytes of documents that a task handles at once (a longer document alone).
UNIT = 1 << 20
HITS = "doc_id long, item string, start long, end long, edits int, n_windows int"


def symbols(data: bytes):
    """(symbol codes, byte offset of each): letters, digits and non-ASCII bytes."""
    import numpy as np

    raw = np.frombuffer(data, np.uint8)
    lut = np.zeros(256, np.uint8)
    for c in b"0123456789abcdefghijklmnopqrstuvwxyz":
        lut[c] = c
    lut[65:91] = np.arange(97, 123)
    lut[128:] = np.arange(128, 256)
    code = lut[raw]
    at = np.flatnonzero(code)
    return code[at], at


def gram_hashes(code, q: int = Q):
    """64-bit hash of the q-gram at each position, by doubling."""
    import numpy as np

    base = 0x9E3779B97F4A7C15
    powers = {1: code.astype(np.uint64) + np.uint64(1)}
    size = 1
    while size * 2 <= q:
        h = powers[size]
        step = np.uint64(pow(base, size, 1 << 64))
        powers[size * 2] = h[:max(0, len(h) - size)] * step + h[size:]
        size *= 2
    h, done = powers[size], size
    while done < q:
        size = max(s for s in powers if s <= q - done)
        n = max(0, len(code) - done - size + 1)
        h = h[:n] * np.uint64(pow(base, size, 1 << 64)) + powers[size][done:done + n]
        done += size
    h = h ^ (h >> np.uint64(29))
    return h * np.uint64(0xBF58476D1CE4E5B9)


class PassageIndex:
    """q-grams of the windows of a block of benchmark items."""

    def __init__(self, items: list[tuple[int, str]], q: int = Q, edit_pct: int = EDIT_PCT):
        import numpy as np

        self.q = q
        #: An entry stands for a q-gram at ``place`` of an item and the windows
        #: from ``lo`` on, ``many`` of them, that hold it.
        self.item, self.exact, codes, size = [], {}, [np.zeros(0, np.uint8)], 0
        at, begin, m, pct, grams, lo, many, place = ([np.zeros(0, np.int64)] for _ in range(8))
        for item_id, text in items:
            code, _ = symbols((text or "").encode("utf-8", "surrogatepass"))
            n = len(code)
            if n < q:
                if n:
                    self.exact.setdefault(n, {}).setdefault(code.tobytes(), []).append(item_id)
                continue
            h, pos = gram_hashes(code, q), np.arange(n - q + 1)
            rules = [(n, n, edit_pct) if n <= WHOLE else (WINDOW, WINDOW // 2, edit_pct)]
            if n > STRETCH:
                rules.append((STRETCH, STRIDE, STRETCH_EDIT_PCT))
            for length, stride, allowed in rules:
                starts = np.array([*range(0, n - length, stride), n - length])
                first = np.searchsorted(starts, pos + q - length)
                grams.append(h)
                lo.append(first + len(self.item))
                many.append(np.searchsorted(starts, pos, "right") - first)
                place.append(pos)
                begin.append(starts)
                at.append(starts + size)
                m.append(np.full(len(starts), length))
                pct.append(np.full(len(starts), allowed))
                self.item += [item_id] * len(starts)
            codes.append(code)
            size += n
        self.code = np.concatenate(codes)
        self.at, self.begin, self.m, pct = (np.concatenate(x) for x in (at, begin, m, pct))
        # The budget, lowered where the lemma would leave nothing to count.
        self.e = np.minimum(self.m * pct // 100, np.maximum(0, (self.m - q) // q))
        self.need = np.maximum(1, self.m + 1 - q - q * self.e)
        h = np.concatenate([x.view(np.uint64) for x in grams])
        order = np.argsort(h, kind="stable")
        self.gram, self.first, self.count = np.unique(h[order], return_index=True, return_counts=True)
        self.lo, self.many, self.place = (np.concatenate(x)[order].astype(np.int32) for x in (lo, many, place))
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.gram >> np.uint64(44)).astype(np.int64)] = True

    @property
    def windows(self):
        return [self.code[a:a + m] for a, m in zip(self.at.tolist(), self.m.tolist())]

    def bands(self, code):
        """Candidates ``(window, first diagonal)`` in a stretch of text."""
        import numpy as np

        none = np.zeros(0, np.int64)
        if len(code) < self.q or not len(self.gram):
            return none, none
        h = gram_hashes(code, self.q)
        pos = np.flatnonzero(self.seen[(h >> np.uint64(44)).astype(np.int64)])
        k = np.searchsorted(self.gram, h[pos])
        k[k == len(self.gram)] = 0
        real = self.gram[k] == h[pos]
        pos, k = pos[real], k[real]
        if not len(pos):
            return none, none
        spread = lambda start, n: np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())
        n = self.count[k]
        entry = spread(self.first[k], n)
        many = self.many[entry]
        window = spread(self.lo[entry], many)
        shift = int(self.m.max())
        diagonal = np.repeat(np.repeat(pos, n) - self.place[entry], many) + self.begin[window] + shift
        width = self.e[window] + 1
        span = (len(code) + 2 * shift) + 2
        keys, found = np.unique(window * span + diagonal // width, return_counts=True)
        total = found.copy()
        follows = np.flatnonzero(np.diff(keys) == 1)
        total[follows] += found[follows + 1]
        keys = keys[total >= self.need[keys // span]]
        window, band = keys // span, keys % span
        return window, band * (self.e[window] + 1) - shift

    def verify(self, code, window, diagonal):
        """Banded alignment of each candidate: (edits, start, end) in symbols;
        edits above the budget mean no match.  No alignment uses a separator of
        texts, so a match lies in one text."""
        import numpy as np

        e = self.e[window]
        m = self.m[window]
        left = diagonal - e
        width = int((4 * e + 2).max())
        column = np.arange(width)
        limit = 4 * e + 2
        big = np.int64(1) << 40
        # A cell holds (cost << 20 | column where the match starts).
        row = np.where(column < limit[:, None], column, big)
        # What lies beyond a window is not compared.
        padded = self.code[np.minimum(self.at[window, None] + np.arange(int(m.max())), len(self.code) - 1)]
        one, wall = np.int64(1) << 20, np.int64(1) << 30
        for i in range(1, int(m.max()) + 1):
            live = np.flatnonzero(m >= i)
            p = left[live, None] + i + column - 1
            symbol = np.where((p >= 0) & (p < len(code)), code[np.clip(p, 0, len(code) - 1)], 0)
            step = np.where(symbol == 0, wall, one)
            old = row[live]
            new = old + np.where(symbol == padded[live, i - 1, None], 0, step)
            new[:, :-1] = np.minimum(new[:, :-1], old[:, 1:] + one)
            new[column >= limit[live, None]] = big
            ramp = np.cumsum(step, axis=1)
            row[live] = np.minimum.accumulate(new - ramp, axis=1) + ramp
        row[column >= limit[:, None]] = big
        best = row.argmin(axis=1)
        cell = row[np.arange(len(row)), best]
        return cell >> 20, left + (cell & (one - 1)), left + m + best

    def exact_matches(self, code, fresh):
        """(item, start, end) of the items below ``q`` symbols; ``fresh`` tells
        which symbols start a word, separators among them."""
        import numpy as np

        for n, items in self.exact.items():
            at = np.flatnonzero(fresh[:max(0, len(code) - n)] & fresh[n:])
            known = np.concatenate([gram_hashes(np.frombuffer(x, np.uint8), n) for x in items])
            for a in at[np.isin(gram_hashes(code, n)[at], known)].tolist():
                for item in items.get(code[a:a + n].tobytes(), ()):
                    yield item, a, a + n

    def search(self, texts: list[bytes]) -> list[tuple[int, int, int, int, int, int]]:
        """(text number, item, first byte, end byte, least edits, windows) of all matches."""
        import numpy as np

        out: dict[tuple[int, int], list[int]] = {}
        k = 0
        while k < len(texts):
            stop, size = k, 0
            while stop < len(texts) and (stop == k or size + len(texts[stop]) <= UNIT):
                size += len(texts[stop])
                stop += 1
            parts = [symbols(t) for t in texts[k:stop]]
            # Texts stand in one stretch, parted by a symbol that no window has.
            code = np.concatenate([x for c, _ in parts for x in (c, np.zeros(1, np.uint8))])
            starts = np.concatenate(([0], np.cumsum([len(c) + 1 for c, _ in parts])))

            def add(item, window, begin, end, edits):
                doc = int(np.searchsorted(starts, begin, "right")) - 1
                at = parts[doc][1]
                b, f = int(at[begin - starts[doc]]), int(at[end - starts[doc] - 1]) + 1
                hit = out.setdefault((k + doc, item), [b, f, edits, set()])
                hit[0], hit[1], hit[2] = min(hit[0], b), max(hit[1], f), min(hit[2], edits)
                hit[3].add(window)

            window, diagonal = self.bands(code)
            # Windows of like size together, as the longest sets the cost of all.
            order = np.argsort(self.m[window], kind="stable")
            window, diagonal = window[order], diagonal[order]
            for a in range(0, len(window), 4096):
                w = window[a:a + 4096]
                edits, begin, end = self.verify(code, w, diagonal[a:a + 4096])
                for i in np.flatnonzero(edits <= self.e[w]).tolist():
                    add(self.item[w[i]], int(w[i]), int(begin[i]), int(end[i]), int(edits[i]))
            if self.exact:
                fresh = np.concatenate([x for _, at in parts for x in (np.diff(at, prepend=-2) > 1, [True])])
                for item, begin, end in self.exact_matches(code, fresh):
                    add(item, -1, begin, end, 0)
            k = stop
        return [(*key, b, f, edits, len(ws)) for key, (b, f, edits, ws) in sorted(out.items(), key=lambda x: x[0])]


def item_blocks(benchmark: DataFrame, text_col: str, block_bytes: int) -> list[list[tuple]]:
    """The distinct texts of the benchmark under their SHA-256, in blocks of
    about ``block_bytes`` (a text is never cut), read from Spark one block at a time."""
    b = only(benchmark, text_col).select(F.col(text_col).alias("text")).where("text is not null").distinct()
    total = b.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes)
    block = F.pmod(F.xxhash64("text"), F.lit(max(1, n)))
    for k in range(n):
        yield [(r["key"], r["text"]) for r in
               b.where(block == k).select(F.sha2("text", 256).alias("key"), "text").orderBy("key").collect()]


def _encoded(column) -> list[bytes]:
    return [(x.as_py() or "").encode("utf-8", "surrogatepass") for x in column]


def _finder(items):
    def find(batches):
        import pyarrow as pa

        index = PassageIndex(items)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = _encoded(batch.column(1))
            rows = [(ids[k], item, len(texts[k][:b].decode("utf-8", "ignore")),
                     len(texts[k][:f].decode("utf-8", "ignore")), edits, n)
                    for k, item, b, f, edits, n in index.search(texts)]
            kinds = [pa.int64(), pa.string()] + [pa.int64()] * 2 + [pa.int32()] * 2
            cols = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                             names=["doc_id", "item", "start", "end", "edits", "n_windows"])

    return find


def benchmark_passages(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text: str = "text",
                       block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document and benchmark item found in it: the span that its
    matches cover (code points), the fewest edits of a match, and how many
    windows of the item matched."""
    d = only(docs, id_col, text_col).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = docs.sparkSession.createDataFrame([], HITS)
    for items in item_blocks(benchmark, item_text, block_bytes):
        found = found.unionByName(d.mapInArrow(_finder(items), HITS))
    rows = only(benchmark, item_col, item_text).where(F.col(item_text).isNotNull()).select(
        F.sha2(F.col(item_text), 256).alias("item"), F.col(item_col).cast("long").alias("item_id"))
    return found.join(rows, "item").select("doc_id", "item_id", "start", "end", "edits", "n_windows")


def _dropper(items, text_at: int):
    def drop(batches):
        import pyarrow as pa

        index = PassageIndex(items)
        for batch in batches:
            bad = {hit[0] for hit in index.search(_encoded(batch.column(text_at)))}
            yield batch.filter(pa.array([k not in bad for k in range(batch.num_rows)], pa.bool_()))

    return drop


def without_passages(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                     item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents in which no benchmark item is found, all columns kept."""
    kept = positional(docs)
    for items in item_blocks(benchmark, item_text, block_bytes):
        kept = kept.mapInArrow(_dropper(items, docs.columns.index(text_col)), kept.schema)
    return kept.toDF(*docs.columns)


def op3_benchmark_passages(spark, sf_dir):
    return benchmark_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

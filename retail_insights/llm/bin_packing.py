"""Packing of tokenized documents into sequences of a fixed capacity.

A document longer than the capacity is cut from its end into full pieces, so
only its first piece may be shorter.  Pieces are counted by length; at most
``capacity`` different lengths exist, so the histogram is small whatever the
corpus.  The plan is made on the histogram, in whole runs of equal bins:

1. large-item matching: pieces above a third of the capacity, largest first,
   take the largest other large piece that still fits (two to a bin at most);
2. smaller pieces, largest first, go to the bin with the least sufficient gap;
   only if none has one is a new bin opened.

Every piece then finds its sequence and offset from its rank among the pieces
of its length.  Ranks come from counts per task of the stored piece table, so
no length, however common, is gathered anywhere.

Defined results: a null text is an empty document and packs as its end id
alone; repeated rows are packed one by one; other columns (clashing names
included) are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import zlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retail_insights.llm.common import materialize, only, table, text_batches
from retail_insights.llm.tokens import END_ID, TOKENIZER, process_encoder

CAPACITY = 1024
PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long, task int, local_rank long")


def plan_bins(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Runs of equal bins: ``(number of bins, [(length, how many in a bin)])``."""
    left = {s: n for s, n in histogram.items() if n}
    by_gap: dict[int, list[list]] = {}  # gap -> runs [bins, items]

    def put(bins: int, items: list, gap: int) -> None:
        if bins:
            by_gap.setdefault(gap, []).append([bins, items])

    large = sorted(s for s in left if 3 * s > capacity)
    while large:
        s = large[-1]
        k = bisect.bisect_right(large, capacity - s)
        if k == len(large) and left[s] == 1:
            k -= 1  # the last of its length can't pair with itself
        p = large[k - 1] if k else None
        if p is None:
            put(left[s], [(s, 1)], capacity - s)
            left[s] = 0
        elif p == s:
            put(left[s] // 2, [(s, 2)], capacity - 2 * s)
            left[s] %= 2
        else:
            n = min(left[s], left[p])
            put(n, [(s, 1), (p, 1)], capacity - s - p)
            left[s] -= n
            left[p] -= n
        large = [x for x in large if left[x]]
    gaps = sorted(by_gap)
    for s in sorted((s for s in left if left[s]), reverse=True):
        n = left[s]
        while n:
            k = bisect.bisect_left(gaps, s)
            if k == len(gaps):
                each = capacity // s
                runs, gap = [], capacity
                new = [[-(-n // each), []]]
            else:
                gap = gaps[k]
                new, runs, each = by_gap[gap], [], gap // s
            bins, items = new.pop()
            if not new and k < len(gaps):
                del by_gap[gap]
                gaps.pop(k)
            full = min(bins, n // each)
            odd = n - full * each if full < bins else 0
            runs.append((full, items + [(s, each)], gap - each * s))
            if odd:
                runs.append((1, items + [(s, odd)], gap - odd * s))
            if items:
                runs.append((bins - full - (odd > 0), items, gap))
            n -= full * each + odd
            for bins, items, rest in runs:
                if bins:
                    if rest not in by_gap:
                        bisect.insort(gaps, rest)
                    put(bins, items, rest)
    return [(bins, items) for gap in sorted(by_gap) for bins, items in by_gap[gap]]


def placements(plan: list) -> dict[int, list[tuple[int, int, int, int]]]:
    """length -> runs ``(first rank, in each bin, first sequence, offset)`` by rank."""
    out: dict[int, list] = {}
    rank: dict[int, int] = {}
    sequence = 0
    for bins, items in plan:
        offset = 0
        for s, each in items:
            out.setdefault(s, []).append((rank.get(s, 0), each, sequence, offset))
            rank[s] = rank.get(s, 0) + bins * each
            offset += s * each
        sequence += bins
    return out


def _cutter(capacity: int, tokenizer: str, end_id: int):
    def cut(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        encoder, seen = None, np.zeros(capacity + 1, np.int64)
        for batch in batches:
            encoder = encoder or process_encoder(tokenizer)
            end = np.array([end_id], encoder.dtype).tobytes()
            cols = [[] for _ in range(6)]
            for doc, found in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1).to_pylist())):
                ids = np.frombuffer(found + end, encoder.dtype).astype("<u4")
                at, piece = 0, 0
                while at < len(ids):
                    n = (len(ids) - 1) % capacity + 1 if not at else capacity
                    for c, v in zip(cols, (doc, piece, at, n, zlib.crc32(ids[at:at + n].tobytes()), int(seen[n]))):
                        c.append(v)
                    seen[n] += 1
                    at, piece = at + n, piece + 1
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(cols, kinds)]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array([task] * len(cols[0]), pa.int32()), pa.array(cols[5], pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "local_rank"])

    return cut


def _placer(where: dict):
    def place(batches):
        import numpy as np
        import pyarrow as pa

        runs = {s: np.array(r, np.int64) for s, r in where.items()}
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for s in np.unique(length):
                at = np.flatnonzero(length == s)
                run = runs[int(s)]
                hit = run[np.searchsorted(run[:, 0], rank[at], "right") - 1]
                bin_no, slot = np.divmod(rank[at] - hit[:, 0], hit[:, 1])
                sequence[at], offset[at] = hit[:, 2] + bin_no, hit[:, 3] + slot * s
            keep = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return place


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
                   tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    text_batches(docs.sparkSession)
    d = only(docs, id_col, text_col).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = materialize(d.mapInArrow(_cutter(capacity, tokenizer, end_id), PIECES), "pieces")
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    # At most ``capacity`` rows, whatever the corpus.
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    where = placements(plan_bins(histogram, capacity))
    before = Window.partitionBy("length").orderBy("task")
    bases = counts.select("length", "task", (F.sum("n").over(before) - F.col("n")).alias("base"))
    ranked = pieces.join(bases, ["length", "task"]).withColumn("rank", F.col("base") + F.col("local_rank"))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        _placer(where), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op9_best_fit_packing(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"))

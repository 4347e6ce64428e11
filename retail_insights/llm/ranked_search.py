"""Ranked lexical search of many items at once, with shared partial scores.

Every item ranks all documents by the integer score

    sum over its terms of  w * ((10^9 * tf) div (1000 * tf + 20 * m))

with w = floor(1000 ln((2N + 2) / (2 df + 1))) and m = 50 + (50 n N) div L.

Items come in blocks of bounded size.  For a block, one narrow pass counts N, L
and the df of its terms; the second scores.  The term sets that items share are
mined into a sharing plan (see ``shared_sums``).  A task takes a few documents
at a time, computes each term's contributions once, sums every shared set once
into an accumulator over those documents, and combines the accumulators along
the plan into the scores of all items.  Of each item only the best of a task
leave it; they are merged in two steps, so no item's candidates meet in one task.

Defined results: terms are the maximal matches of letters A-Z, a-z (A-Z
lower-cased), digits and all characters beyond ASCII; null, empty and termless
texts hold none, find nothing and are found by nothing; every document row
counts, and equal scores are ordered by id, null ids first; rows that repeat an
item's id and text are one item; other columns (clashing names included) are
ignored; empty tables give no rows.
"""

from __future__ import annotations

import math
from itertools import chain, repeat

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retail_insights.llm.common import only, table, text_batches
from retail_insights.llm.shared_sums import SharingPlan, sharing_plan

TOP = 50
#: Bytes of item texts in a block: bounds what the driver collects and tasks get.
BLOCK_BYTES = 1 << 20
#: Accumulator cells (nodes times documents) that a task fills at once.
CELLS = 1 << 19
#: Candidates that a task holds before it cuts them to the best of each item.
HELD = 1 << 17
#: Groups of tasks whose best are merged first.
MERGERS = 256

# Bytes of terms: A-Z become small, letters, digits and bytes beyond ASCII stay, all else parts terms.
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
                   for c in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(TERM_BYTES).split()


def _small_batches(batches, vocabulary: dict[bytes, int], docs: int):
    """(ids, terms in each text, counts[term, document]) of ``docs`` texts at a
    time; only terms of the vocabulary are counted singly."""
    import numpy as np

    other = len(vocabulary)
    for batch in batches:
        for at in range(0, batch.num_rows, docs):
            part = batch.slice(at, docs)
            texts = [terms_of(t.as_py()) for t in part.column(1)]
            sizes = np.array([len(t) for t in texts], np.int64)
            known = np.fromiter(map(vocabulary.get, chain.from_iterable(texts), repeat(other)), np.int64, sizes.sum())
            cell = known * len(texts) + np.repeat(np.arange(len(texts)), sizes)
            counts = np.bincount(cell, minlength=(other + 1) * len(texts)).reshape(other + 1, len(texts))
            yield part.column(0), sizes, counts[:other]


def _counter(vocabulary: dict[bytes, int]):
    """Per task: (term, number of documents that hold it); -1 and -2 stand for
    the documents with a term and for all terms."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        held, docs, terms = np.zeros(len(vocabulary), np.int64), 0, 0
        for _, sizes, counts in _small_batches(batches, vocabulary, max(1, CELLS // (len(vocabulary) + 1))):
            held += np.count_nonzero(counts, axis=1)
            docs += int(np.count_nonzero(sizes))
            terms += int(sizes.sum())
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, -2, *some.tolist()], pa.int64()), pa.array([docs, terms, *held[some].tolist()], pa.int64())],
            names=["term", "n"])

    return run


class Scorer:
    """Scores and the best documents of every item of a block."""

    def __init__(self, plan: SharingPlan, weights: list[int], n_docs: int, n_terms: int, top: int):
        import numpy as np

        self.levels = [(first, np.array(a), np.array(b)) for first, a, b in plan.levels]
        self.roots, self.weights = np.array(plan.roots), np.array(weights, np.int64)
        self.nodes, self.n_docs, self.n_terms, self.top = plan.nodes, n_docs, n_terms, top
        self.bar = np.ones(len(self.roots), np.int64)  # the least score that can still be among the best
        self.best, self.held = [], 0

    def scores(self, sizes, counts):
        """Scores [item, document]."""
        import numpy as np

        m = np.array([50 + 50 * int(n) * self.n_docs // max(1, self.n_terms) for n in sizes], np.int64)
        sums = np.empty((self.nodes, len(sizes)), np.int64)
        sums[:len(counts)] = 0
        term, doc = np.nonzero(counts)
        tf = counts[term, doc]
        sums[term, doc] = self.weights[term] * (10**9 * tf // (1000 * tf + 20 * m[doc]))
        for first, a, b in self.levels:
            np.add(sums[a], sums[b], out=sums[first:first + len(a)])
        return sums[self.roots]

    def add(self, ids, sizes, counts) -> None:
        import numpy as np

        scores = self.scores(sizes, counts)
        item, doc = np.nonzero(scores >= self.bar[:, None])
        known = np.array(ids.is_valid())[doc]
        self.best.append((item, scores[item, doc], known, np.array(ids.fill_null(0))[doc]))
        self.held += len(item)
        if self.held > HELD:
            self.cut()

    def cut(self):
        """Keep the best of each item: (item, score, id is known, id)."""
        import numpy as np

        item, score, known, doc = (np.concatenate(c) for c in zip(*self.best))
        order = np.lexsort((doc, known, -score, item))
        item = item[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        order, rank, item = order[rank < self.top], rank[rank < self.top], item[rank < self.top]
        full = rank == self.top - 1
        self.bar[item[full]] = score[order][full]
        self.best = [(item, score[order], known[order], doc[order])]
        self.held = len(item)
        return self.best[0]


def _scorer(vocabulary: dict[bytes, int], keys: list[str], *parameters):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        scorer, seen = Scorer(*parameters), False
        for ids, sizes, counts in _small_batches(batches, vocabulary, max(1, CELLS // (scorer.nodes + 1))):
            scorer.add(ids, sizes, counts)
            seen = True
        if seen:
            item, score, known, doc = scorer.cut()
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[i] for i in item.tolist()], pa.string()), pa.array(doc, pa.int64(), mask=~known),
                 pa.array(score, pa.int64()), pa.array(np.full(len(item), TaskContext.get().partitionId()), pa.int32())],
                names=["item", "doc_id", "score", "task"])

    return run


def query_blocks(items: DataFrame, block_bytes: int):
    """Blocks of (key, text) of the distinct texts, each collected when its turn comes."""
    texts = items.where("text is not null").select("text").distinct()
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes)
    for k in range(n):
        block = texts.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k).select(F.sha2("text", 256).alias("key"), "text")
        yield sorted((r["key"], r["text"]) for r in block.collect())


def _best(found: DataFrame, top: int, *groups) -> DataFrame:
    order = Window.partitionBy(*groups).orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of each item
    with a score above 0."""
    spark = docs.sparkSession
    text_batches(spark)
    d = only(docs, id_col, text_col).select(F.col(id_col).cast("long").alias("doc_id"),
                                            F.col(text_col).cast("binary").alias("text"))
    rows = only(items, item_col, item_text).select(F.col(item_col).cast("long").alias("item_id"),
                                                   F.col(item_text).alias("text")).distinct()
    found = spark.createDataFrame([], "item string, doc_id long, score long, task int")
    for block in query_blocks(rows, block_bytes):
        asked = {key: set(terms_of(text.encode("utf-8", "surrogatepass"))) for key, text in block}
        keys = [key for key, terms in asked.items() if terms]
        vocabulary = {t: i for i, t in enumerate(sorted(set().union(*asked.values())))}
        # At most one row per term of the block, and two.
        counts = {r["term"]: r["n"] for r in d.mapInArrow(_counter(vocabulary), "term long, n long")
                  .groupBy("term").agg(F.sum("n").alias("n")).collect()}
        n_docs, n_terms = counts.get(-1, 0), counts.get(-2, 0)
        if not keys or not n_docs:
            continue
        weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * counts.get(t, 0) + 1)))
                   for t in range(len(vocabulary))]
        plan = sharing_plan([{vocabulary[t] for t in asked[key]} for key in keys], len(vocabulary))
        found = found.unionByName(d.mapInArrow(_scorer(vocabulary, keys, plan, weights, n_docs, n_terms, top),
                                               "item string, doc_id long, score long, task int"))
    merged = _best(found, top, "item", F.pmod("task", F.lit(MERGERS))).drop("rank")
    ranked = _best(merged, top, "item")
    named = rows.where("text is not null").select(F.sha2("text", 256).alias("item"), "item_id")
    return ranked.join(named, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def op12_ranked_search(spark, sf_dir):
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

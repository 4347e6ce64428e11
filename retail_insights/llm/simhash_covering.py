"""SimHash near-duplicate groups by covering locality-sensitive hashing.

Every document gets a 64-bit fingerprint of its word shingles.  Radius ``r``
needs ``2**(r+1) - 1`` tables: bit ``i`` carries a nonzero vector ``m(i)`` of
``r + 1`` bits, and table ``v`` hashes the bits whose ``m(i)`` has an odd
product with ``v``.  Any ``r`` differing bits leave some ``v`` orthogonal to
all their vectors, so the two fingerprints agree in that table: no pair within
the radius is missed.

Only distinct fingerprints are hashed; documents with equal ones meet through
a map-side combined minimum.  A bucket with more than ``BUCKET`` fingerprints
is divided again: its free bits are cut into ``r + 1`` blocks, one of which
any pair within the radius agrees on.  Each division frees fewer bits, so the
last level's buckets are bounded by their free bits alone.  A bucket yields a
spanning forest of its links, never its pairs.

Defined results: a null or wordless text has fingerprint zero and is linked
like any other; null ids take part but never name a component; repeated rows
are returned as often as they occur; other columns (clashing names included)
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retail_insights.llm.common import materialize, only, place, positional, table
from retail_insights.llm.components import connected_components

SHINGLE, MAX_DISTANCE = 3, 2
#: Fingerprints of one bucket that a task compares at once.
BUCKET = 256
ALL_BITS = (1 << 64) - 1


def covering_masks(radius: int) -> list[int]:
    """One mask of hashed bits per table."""
    top = (1 << (radius + 1)) - 1
    vectors = [i % top + 1 for i in range(64)]
    return [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2) for v in range(1, top + 1)]


def divided(masks: list[int], radius: int) -> list[int]:
    """Masks of the next level: mask ``k`` becomes ``k * (radius + 1) + block``."""
    out = []
    for mask in masks:
        free = [i for i in range(64) if not mask >> i & 1]
        for block in range(radius + 1):
            out.append(mask | sum(1 << i for i in free[block::radius + 1]))
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _fingerprints(shingle: int):
    def run(batches):
        from itertools import repeat

        import numpy as np
        import pyarrow as pa
        from xxhash import xxh64_intdigest

        def fingerprint(text):
            words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # both in ASCII terms
            n = max(1, len(words) - shingle + 1) if words else 0
            ones = np.zeros(64, np.int64)
            for k in range(0, n, 1 << 16):
                part = words[k:k + (1 << 16) + shingle - 1]
                grams = map(b" ".join, zip(*[part[j:] for j in range(shingle)])) if len(words) >= shingle else [
                    b" ".join(words)]
                h = np.fromiter(map(xxh64_intdigest, grams, repeat(42)), np.uint64)
                ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
                    axis=0, dtype=np.int64)
            return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])

        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array([fingerprint(t.as_py()) for t in batch.column(2)], pa.int64())],
                names=["doc_id", "text_hash", "fp"])

    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(doc_id, text_hash, fp)``: the fingerprint as a signed 64-bit number."""
    d = only(docs, id_col, text_col).select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    return d.mapInArrow(_fingerprints(shingle), "doc_id long, text_hash long, fp long")


def _bucket_links(max_distance: int):
    """Spanning forests of the links within each bucket."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            us, vs = [], []
            for found in batch.column(0):
                a = found.values.to_numpy()
                bits = a.view(np.uint64)  # signed numbers would be counted by their absolute value
                near = np.bitwise_count(bits[:, None] ^ bits[None, :]) <= max_distance
                waiting = np.ones(len(a), bool)
                while waiting.any():
                    stack = [int(waiting.argmax())]
                    waiting[stack[0]] = False
                    while stack:
                        i = stack.pop()
                        for j in np.flatnonzero(near[i] & waiting).tolist():
                            waiting[j] = False
                            us.append(int(a[i]))
                            vs.append(int(a[j]))
                            stack.append(j)
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    return run


def _mask_of(masks: list[int], path: Column) -> Column:
    return F.get(F.array(*[F.lit(_signed(m)) for m in masks]), path)


def links(prints: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Edges between distinct fingerprints ``fp`` within the distance: enough
    of them to connect all that are linked."""
    masks = covering_masks(max_distance)
    rows = prints.select("fp", F.explode(F.sequence(F.lit(0), F.lit(len(masks) - 1))).alias("path"))
    edges = None
    while True:
        rows = materialize(rows.withColumn("key", F.col("fp").bitwiseAND(_mask_of(masks, F.col("path")))), "buckets")
        bounded = max(64 - m.bit_count() for m in masks) <= BUCKET.bit_length() - 1
        crowded = None
        if not bounded:
            crowded = materialize(
                rows.groupBy("path", "key").agg(F.count("*").alias("n")).where(F.col("n") > BUCKET), "crowded")
            if crowded.isEmpty():
                crowded = None
        calm = rows if crowded is None else rows.join(crowded, ["path", "key"], "left_anti")
        lists = calm.groupBy("path", "key").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
        found = lists.select("fps").mapInArrow(_bucket_links(max_distance), "u long, v long")
        edges = found if edges is None else edges.unionByName(found)
        if crowded is None:
            return edges
        masks = divided(masks, max_distance)
        rows = rows.join(crowded, ["path", "key"], "left_semi").select(
            "fp", F.explode(F.sequence(F.lit(0), F.lit(max_distance))).alias("block"), "path").select(
            "fp", (F.col("path") * (max_distance + 1) + F.col("block")).alias("path"))


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_hash, fp, root, component_id)`` per input row; the
    component is named by the least document id that links reach, ``root`` is
    its least fingerprint."""
    prints = materialize(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    reps = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "representatives")
    roots = connected_components(links(reps, max_distance))
    rooted = reps.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    return prints.join(rooted.join(named, "root").select("fp", "root", "component_id"), "fp").select(
        "doc_id", "text_hash", "fp", "root", "component_id")


def one_of_each_group(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without near-duplicates, all columns kept: of each group
    the row with the least id stays (rows without an id come last; equal ids go
    by text hash; rows equal in both are one document)."""
    groups = simhash_components(docs, shingle, max_distance, id_col, text_col)
    winners = groups.groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("w")).select(
        F.coalesce("w.doc_id", "w.text_hash").alias("_key"), F.col("w.text_hash").alias("_hash"),
        F.col("w.no_id").alias("_no_id"))
    plain, doc, text = positional(docs), place(docs, id_col), place(docs, text_col)
    keyed = plain.withColumn("text_hash", F.xxhash64(text)).withColumn(
        "_key", F.coalesce(F.col(doc).cast("long"), F.col("text_hash")))
    kept = keyed.join(winners, "_key").where(
        (F.col("_hash") == F.col("text_hash")) & (F.col("_no_id") == F.col(doc).isNull()))
    # The join left equal rows side by side; one of them stays.
    first = Window.partitionBy("_key", "_hash", "_no_id").orderBy(F.xxhash64(*plain.columns))
    return kept.withColumn("_row", F.row_number().over(first)).where("_row = 1").select(plain.columns).toDF(*docs.columns)


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def op4_simhash_components(spark, sf_dir):
    return simhash_components(table(spark, sf_dir, "documents")).select(
        "doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")

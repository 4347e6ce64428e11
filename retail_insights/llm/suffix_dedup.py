"""Removal of byte strings that occur again anywhere, by sharded suffix arrays.

Every byte covered by a string of ``length`` bytes that also starts at another
place (in the same or another document) is removed.  To bring equal strings
together, each window of ``length`` bytes goes to the shard of its anchor, the
least hash among its ``GRAM``-byte grams; equal windows have equal anchors.
Neighbouring windows with one anchor travel as one segment.  Anchors met once
are dropped, and equal segments travel once with their number, so a hot passage
costs no more than a rare one; where all segments of an anchor are equal, that
number settles them.  Each shard of different segments builds a suffix array by
induced sorting and permuted common prefixes (see ``suffix_array``); those
decide which windows occur again.

An anchor with many different segments is divided: its segments are cut into
pieces of at most ``g`` windows, which meet under the hash of the bytes that
all windows of a piece share.  ``g`` falls to one, where all segments of a
group are equal, so no group is ever too large for a task.

Defined results: a null text counts as empty; texts shorter than ``length``
keep all bytes; repeated rows are repeated text; rows with equal id and text
get the same result, and texts under one id (or none) are told apart by their
64-bit hash and length; other columns (clashing names included) are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_insights.llm.common import materialize, only, release, table
from retail_insights.llm.suffix_array import repeated_starts

LENGTH = 400
GRAM = 32
#: Different segments of one anchor that share a shard.
CROWD = 1024
#: Windows in a piece of a divided group, level by level.
PIECES = [96, 24, 1]
#: Bytes that a task hashes, and symbols that it sorts, at once.
UNIT, SHARD = 2 << 20, 1 << 20
#: Longer texts are hashed in tiles that overlap by a window.
TILE = 8 << 20


def window_anchors(raw, length: int, gram: int):
    """(anchor position, its hash) of every window of ``length`` bytes."""
    import numpy as np

    base = 0x9E3779B97F4A7C15
    h, size = raw.astype(np.uint64) + np.uint64(1), 1
    while size < gram:  # gram is a power of two
        h = h[:-size] * np.uint64(pow(base, size, 1 << 64)) + h[size:]
        size *= 2
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    # 40 bits of hash, then the position: the minimum is the leftmost least gram.
    low = np.uint64(24)
    packed = (h >> low << low) | np.arange(len(h), dtype=np.uint64)
    w = length - gram + 1
    n = len(h) - w + 1
    blocks = -(-len(packed) // w)
    padded = np.full(blocks * w, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:len(packed)] = packed
    grid = padded.reshape(blocks, w)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    at = (np.minimum(behind[:n], ahead[w - 1:w - 1 + n]) & np.uint64((1 << 24) - 1)).astype(np.int64)
    return at, h[at]


def segments_of(texts: list[bytes], length: int, gram: int):
    """(text number, start, windows, anchor hash, anchor's place in the segment)
    of the segments of texts that are hashed side by side."""
    import numpy as np

    raw = np.frombuffer(b"".join(texts), np.uint8)
    none = np.zeros(0, np.int64)
    if len(raw) < length:
        return none, none, none, none.astype(np.uint64), none
    at, value = window_anchors(raw, length, gram)
    begin = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    # Windows that reach over the end of their text are not windows.
    owner = np.searchsorted(begin, np.arange(len(at)), "right") - 1
    valid = np.arange(len(at)) + length <= begin[owner + 1]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (at[1:] != at[:-1]) | ~valid[:-1] | (owner[1:] != owner[:-1])
    start = np.flatnonzero(fresh & valid)
    stop = np.flatnonzero(valid & np.append(fresh[1:] | ~valid[1:], True)) + 1
    return owner[start], start - begin[owner[start]], stop - start, value[start], at[start] - start


def _tiles(texts: list[bytes], length: int):
    """(text number, offset, bytes): texts, long ones in overlapping tiles."""
    for k, t in enumerate(texts):
        for a in range(0, max(1, len(t) - length + 1), TILE):
            yield k, a, t[a:a + TILE + length - 1] if len(t) > TILE else t


def _segmenter(length: int, gram: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh3_64_intdigest

        for batch in batches:
            ids, hashes, sizes = (batch.column(k).to_pylist() for k in range(3))
            texts = batch.column(3).to_pylist()
            group, size = [], 0
            tiles = [x for x in _tiles(texts, length) if len(x[2]) >= length]
            for i, tile in enumerate(tiles):
                group.append(tile)
                size += len(tile[2])
                if size < UNIT and i < len(tiles) - 1:
                    continue
                owner, start, run_, anchor, place = segments_of([t for _, _, t in group], length, gram)
                content = np.fromiter(
                    (xxh3_64_intdigest(group[o][2][s:s + r + length - 1])
                     for o, s, r in zip(owner.tolist(), start.tolist(), run_.tolist())), np.uint64, len(owner))
                shift = np.array([a for _, a, _ in group], np.int64)
                texts_of = [group[o][0] for o in owner.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[k] for k in texts_of], pa.int64()), pa.array([hashes[k] for k in texts_of], pa.int64()),
                     pa.array([sizes[k] for k in texts_of], pa.int32()), pa.array(start + shift[owner]), pa.array(run_.astype(np.int32)),
                     pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64)), pa.array(place.astype(np.int32))],
                    names=["doc_id", "dh", "size", "start", "run", "anchor", "content", "place"])
                group, size = [], 0

    return run


def _binary_batch(rows: list[tuple], names: list[str]):
    """A batch of 64-bit columns and, last, the text."""
    import pyarrow as pa

    kinds = [pa.int64()] * (len(names) - 1) + [pa.binary()]
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)


def _fetcher(length: int):
    """Texts of the chosen segments of each document."""
    names = ["anchor", "content", "n", "kinds", "place", "text"]

    def run(batches):
        for batch in batches:
            rows, size = [], 0
            for text, wanted in zip(batch.column(0), batch.column(1)):
                raw = text.as_py()
                for s in wanted.as_py():
                    piece = raw[s["start"]:s["start"] + s["run"] + length - 1]
                    rows.append((s["anchor"], s["content"], s["n"], s["kinds"], s["place"], piece))
                    size += len(piece)
                    if size > UNIT:
                        yield _binary_batch(rows, names)
                        rows, size = [], 0
            yield _binary_batch(rows, names)

    return run


def _sorter(length: int):
    """Rows (key, piece, n, text), equal keys together -> ranges of repeated windows."""

    def solve(rows):
        import pyarrow as pa

        found = repeated_starts([(text, n) for _, _, n, text in rows], length)
        out = [(k, p, a, b) for (k, p, _, _), ranges in zip(rows, found) for a, b in ranges]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in list(zip(*out)) or [()] * 4],
                                          names=["key", "piece", "from", "to"])

    def run(batches):
        rows, size, last = [], 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != last and size > SHARD:
                    yield solve(rows)
                    rows, size = [], 0
                last = row[0]
                rows.append(row)
                size += len(row[3])
        if rows:
            yield solve(rows)

    return run


def _cutter(length: int, g: int):
    """Rows (anchor, content, off, n, place, text) -> pieces of at most ``g``
    windows, and as key the hash of the bytes common to all windows that such a
    piece can have.  Cuts are counted from the anchor (``place``), which lies
    alike in equal windows."""
    names = ["anchor", "content", "off", "n", "place", "key", "piece", "text"]

    def run(batches):
        from xxhash import xxh3_64_intdigest

        signed = lambda x: x - (1 << 64) if x >> 63 else x
        for batch in batches:
            rows, size = [], 0
            for anchor, content, off, n, place, text in zip(*(c.to_pylist() for c in batch.columns)):
                windows, a = len(text) - length + 1, 0
                while a < windows:
                    first = (a - place) // g * g + place
                    b = min(windows, first + g)
                    piece = text[a:b + length - 1]
                    key = xxh3_64_intdigest(text[first + g - 1:first + length])
                    rows.append((anchor, content, off + a, n, place - a, signed(key),
                                 signed(xxh3_64_intdigest(piece)), piece))
                    size += len(piece)
                    a = b
                if size > UNIT:
                    yield _binary_batch(rows, names)
                    rows, size = [], 0
            yield _binary_batch(rows, names)

    return run


def _sorted_ranges(groups: DataFrame, length: int) -> DataFrame:
    """(key, piece, n, text) -> (key, piece, from, to), keys whole in a task.
    Sorting costs far more than its bytes show, so the number of partitions is
    fixed and not left to their size."""
    n = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = groups.select("key", "piece", "n", "text").repartition(n, "key").sortWithinPartitions("key")
    return rows.mapInArrow(_sorter(length), "key long, piece long, from long, to long")


def repeated_ranges(segments: DataFrame, length: int) -> DataFrame:
    """(anchor, content, n, kinds, place, text) -> (anchor, content, from, to):
    the windows of each segment that occur again."""
    calm = segments.where(F.col("kinds") <= CROWD)
    out = _sorted_ranges(calm.select(F.col("anchor").alias("key"), F.col("content").alias("piece"), "n", "text"),
                         length).toDF("anchor", "content", "from", "to")
    rows = segments.where(F.col("kinds") > CROWD).select(
        "anchor", "content", F.lit(0).cast("long").alias("off"), "n", "place", "text")
    if rows.isEmpty():
        return out
    for g in PIECES:
        cut = materialize(rows.mapInArrow(_cutter(length, g), "anchor long, content long, off long, n long, place long, "
                                                             "key long, piece long, text binary"), "pieces")
        groups = cut.groupBy("key", "piece").agg(F.sum("n").alias("n"), F.first("text").alias("text"))
        crowded = materialize(
            cut.select("key", "piece").distinct().groupBy("key").agg(F.count("*").alias("kinds"))
            .where(F.col("kinds") > CROWD).select("key"), "crowded")
        ranges = _sorted_ranges(groups.join(crowded, "key", "left_anti"), length)
        out = out.unionByName(cut.select("anchor", "content", "off", "key", "piece").join(ranges, ["key", "piece"]).select(
            "anchor", "content", (F.col("off") + F.col("from")).alias("from"), (F.col("off") + F.col("to")).alias("to")))
        if crowded.isEmpty():
            break
        rows = cut.join(crowded, "key", "left_semi").select("anchor", "content", "off", "n", "place", "text")
    return out


def _remover(length: int):
    def run(batches):
        from hashlib import sha256

        import pyarrow as pa

        for batch in batches:
            rows = []
            for doc, text, ranges in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                raw, spans = text.as_py(), ranges.as_py() or []
                kept, removed, n, at = [], 0, 0, 0
                end = -1
                for a, b in sorted((s["a"], s["b"]) for s in spans):
                    if a > end:
                        if end >= 0:
                            kept.append(raw[at:start])
                            removed, n, at = removed + end - start, n + 1, end
                        start, end = a, b
                    else:
                        end = max(end, b)
                if end >= 0:
                    kept.append(raw[at:start])
                    removed, n, at = removed + end - start, n + 1, end
                kept.append(raw[at:])
                rest = b"".join(kept)
                rows.append((doc, len(raw), removed, n, sha256(rest).hexdigest(), rest))
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 6, kinds)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (bytes)."""
    spark = docs.sparkSession
    d = only(docs, id_col, text_col).select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    d = d.select("doc_id", F.xxhash64("text").alias("dh"), F.octet_length("text").alias("size"), F.col("text").cast("binary").alias("text"))
    segments = materialize(d.mapInArrow(
        _segmenter(length, gram),
        "doc_id long, dh long, size int, start long, run int, anchor long, content long, place int"), "segments")
    anchors = materialize(segments.groupBy("anchor").agg(F.count("*").alias("total")).where("total > 1").select("anchor"),
                          "anchors")
    # Equal segments once, with their number and one of their places.  As one value, anchor and content are
    # dealt anew after the join; with the anchors read from a table, nothing ties the join to its
    # partitioning, and a hot anchor is split.
    again = materialize(
        segments.join(anchors, "anchor").withColumn("both", F.struct("anchor", "content")).groupBy("both").agg(
            F.count("*").alias("n"), F.min(F.struct("doc_id", "dh", "size", "start", "run", "place")).alias("first"))
        .select("both.*", "n", "first.*"), "repeated")
    release(spark)
    kinds = materialize(again.groupBy("anchor").agg(F.count("*").alias("kinds")), "kinds")
    counted = again.join(kinds, "anchor")
    alike = counted.where("kinds = 1").select(
        "anchor", "content", F.lit(0).cast("long").alias("from"), F.col("run").cast("long").alias("to"))
    wanted = counted.where("kinds > 1").groupBy("doc_id", "dh", "size").agg(
        F.collect_list(F.struct("start", "run", "anchor", "content", "n", "kinds", "place")).alias("wanted"))
    same_doc = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["dh"] == b["dh"]) & (a["size"] == b["size"])
    # Rows that repeat id and text would give the same segments again.
    texts = d.join(wanted, same_doc(d, wanted)).select("text", "wanted", d["doc_id"], d["dh"], d["size"])
    found = materialize(
        texts.select("text", "wanted").mapInArrow(
            _fetcher(length), "anchor long, content long, n long, kinds long, place long, text binary"), "texts")
    release(spark)
    ranges = materialize(repeated_ranges(found, length).distinct().unionByName(alike), "ranges")
    release(spark)
    spans = segments.join(ranges, ["anchor", "content"]).select(
        "doc_id", "dh", "size", F.struct((F.col("start") + F.col("from")).alias("a"),
                                         (F.col("start") + F.col("to") - 1 + length).alias("b")).alias("span"))
    spans = materialize(spans.groupBy("doc_id", "dh", "size").agg(F.collect_set("span").alias("spans")), "spans")
    release(spark)
    joined = d.join(spans, same_doc(d, spans), "left").select(d["doc_id"], "text", "spans")
    return joined.mapInArrow(_remover(length), "doc_id long, n_bytes long, n_removed long, n_spans long, "
                                               "kept_sha256 string, kept binary")


def op6_suffix_dedup(spark, sf_dir):
    return without_repeats(table(spark, sf_dir, "documents")).drop("kept")

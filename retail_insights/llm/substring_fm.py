"""Removal of word sequences that an earlier document holds, by sharded FM-indexes.

A window is ``length`` consecutive words of one document.  Every word covered
by a window that also starts in a document with a smaller id is removed.

Windows meet by their anchor, the least hash among their ``GRAM``-word grams:
equal windows have equal anchors.  Neighbouring windows with one anchor travel
as one segment.  Only anchors of at least two documents go on, and equal
segments travel once.  A shard holds all segments of its anchors in a
compressed FM-index (see ``fm_index``).  The segments are then streamed through
it: backward search over the wavelet tree gives their matching statistics, and
every place with ``length`` matching words is reported with the least id among
all documents that hold the same words.

An anchor with many different segments is divided: they are cut into pieces of
at most ``g`` windows, which meet under the hash of the words that all windows
of a piece share.  ``g`` falls to one, where all pieces of a group are equal,
so no group is too large for a task.

Defined results: words are the maximal matches of ``[^\\x20\\x09-\\x0D]+``; a
null, empty or short text keeps all words; a row without an id neither loses
words nor makes others lose them; rows under one id are one document, none of
which makes another lose words, and texts under one id are told apart by their
64-bit hash and length; other columns (clashing names included) are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_insights.llm.common import materialize, only, release, table, text_batches
from retail_insights.llm.fm_index import FMIndex
from retail_insights.llm.periodic_runs import Grams
from retail_insights.llm.suffix_dedup import window_anchors

LENGTH = 50
GRAM = 8
#: Different segments of one anchor that share a shard.
CROWD = 1024
#: Windows in a piece of a divided group, level by level.
PIECES = [12, 1]
#: Words that a task hashes, and words of an index.
UNIT, SHARD = 1 << 18, 1 << 18
#: Words whose hashes a task remembers.
REMEMBERED = 1 << 18
SEGMENTS = "doc_id long, dh long, size int, start long, run int, anchor long, content long, place int"


class _Hashes(dict):
    """64-bit hash of each word, computed once."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest

        h = self[word] = xxh3_64_intdigest(word)
        return h


def segments_of(words, sizes, length: int, gram: int):
    """(document number, start, windows, anchor hash, content hash, anchor's
    place in the segment) of documents whose word hashes stand side by side."""
    import numpy as np

    at, value = window_anchors(words, length, gram)
    stop = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(sizes)), sizes)[:len(at)]
    # Windows that reach over the end of their document are not windows.
    valid = np.arange(len(at)) + length <= stop[owner]
    fresh = np.append(True, (at[1:] != at[:-1]) | ~valid[:-1] | (owner[1:] != owner[:-1]))
    first = np.flatnonzero(fresh & valid)
    last = np.flatnonzero(valid & np.append(fresh[1:] | ~valid[1:], True))
    run = last + 1 - first
    content = Grams(words).at(first, run + length - 1)
    begin = stop - sizes
    return owner[first], first - begin[owner[first]], run, value[first], content, at[first] - first


def _segmenter(length: int, gram: int, unit: int):
    def solve(rows):
        import numpy as np
        import pyarrow as pa

        keys, shifts, parts = zip(*rows)
        sizes = np.array([len(p) for p in parts], np.int64)
        owner, start, run, anchor, content, place = segments_of(np.concatenate(parts), sizes, length, gram)
        ids, hashes, bytes_ = (np.array(c)[owner] for c in zip(*keys))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(hashes, pa.int64()), pa.array(bytes_, pa.int32()),
             pa.array(start + np.array(shifts, np.int64)[owner]), pa.array(run, pa.int32()),
             pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64)), pa.array(place, pa.int32())],
            names=["doc_id", "dh", "size", "start", "run", "anchor", "content", "place"])

    def run(batches):
        import numpy as np

        known = _Hashes()
        for batch in batches:
            if len(known) > REMEMBERED:
                known.clear()
            rows, size = [], 0
            keys = zip(*(batch.column(k).to_pylist() for k in range(3)))
            for key, text in zip(keys, batch.column(3)):
                words = text.as_py().split()  # splits bytes at the six white-space bytes
                hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
                # Long documents in tiles that overlap by a window less one word.
                for a in range(0, len(words) - length + 1, unit):
                    rows.append((key, a, hashes[a:a + unit + length - 1]))
                    size += len(rows[-1][2])
                    if size >= unit:
                        yield solve(rows)
                        rows, size = [], 0
            if rows:
                yield solve(rows)

    return run


def _rows_batch(rows: list[tuple], names: list[str]):
    """A batch of 64-bit columns and, last, the text."""
    import pyarrow as pa

    kinds = [pa.int64()] * (len(names) - 1) + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * len(names), kinds)],
                                      names=names)


def _fetcher(length: int, unit: int):
    """Words of the chosen segments of each document."""
    names = ["anchor", "content", "place", "doc", "last", "text"]

    def run(batches):
        for batch in batches:
            rows, size = [], 0
            for doc, text, wanted in zip(*(batch.column(k) for k in range(3))):
                words, doc = text.as_py().split(), doc.as_py()
                for s in wanted.as_py():
                    part = words[s["start"]:s["start"] + s["run"] + length - 1]
                    rows.append((s["anchor"], s["content"], s["place"], doc, s["last"], b" ".join(part)))
                    size += len(part)
                    if size > unit:
                        yield _rows_batch(rows, names)
                        rows, size = [], 0
            yield _rows_batch(rows, names)

    return run


def shared_windows(texts: list[bytes], docs: list[int], length: int) -> list[list[tuple[int, int, int]]]:
    """For each text the ranges of windows ``(from, to, least id)``: the least
    id among all texts of the shard that hold the same ``length`` words."""
    import numpy as np

    number: dict[bytes, int] = {}
    words = [np.array([number.setdefault(w, len(number)) for w in t.split()], np.int64) for t in texts]
    index = FMIndex(words, len(number), length)
    least = index.least_of_class(np.array(docs, np.int64))
    matched, suffix = index.matching_statistics(words)
    found = np.where(matched == length, least[index.class_of[suffix]], np.iinfo(np.int64).max)
    out, at = [], 0
    for w in words:
        own = found[at:at + len(w) - length + 1]
        edge = np.append(np.flatnonzero(np.append(True, own[1:] != own[:-1])), len(own)).tolist()
        out.append([(a, b, int(own[a])) for a, b in zip(edge, edge[1:])])
        at += len(w)
    return out


def _searcher(length: int, shard: int):
    """Rows (key, piece, doc, last, text), equal keys together -> ranges whose
    words an earlier document than ``last`` holds."""

    def solve(rows):
        import pyarrow as pa

        ranges = shared_windows([r[4] for r in rows], [r[2] for r in rows], length)
        out = [(k, p, a, b, least) for (k, p, _, last, _), own in zip(rows, ranges) for a, b, least in own if least < last]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in list(zip(*out)) or [()] * 5],
                                          names=["key", "piece", "from", "to", "least"])

    def run(batches):
        rows, size, at = [], 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != at and size > shard:
                    yield solve(rows)
                    rows, size = [], 0
                at = row[0]
                rows.append(row)
                size += row[4].count(b" ") + 1
        if rows:
            yield solve(rows)

    return run


def _cutter(length: int, g: int, unit: int):
    """Segments -> pieces of at most ``g`` windows, and as key the hash of the
    words common to all windows that such a piece can have.  Cuts are counted
    from the anchor (``place``), which lies alike in equal windows."""
    names = ["anchor", "content", "off", "place", "doc", "last", "key", "piece", "text"]

    def run(batches):
        from xxhash import xxh3_64_intdigest

        signed = lambda x: x - (1 << 64) if x >> 63 else x
        for batch in batches:
            rows, size = [], 0
            for anchor, content, off, place, doc, last, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = text.split()
                windows, a = len(words) - length + 1, 0
                while a < windows:
                    first = (a - place) // g * g + place
                    b = min(windows, first + g)
                    piece = b" ".join(words[a:b + length - 1])
                    key = xxh3_64_intdigest(b" ".join(words[first + g - 1:first + length]))
                    rows.append((anchor, content, off + a, place - a, doc, last, signed(key),
                                 signed(xxh3_64_intdigest(piece)), piece))
                    size += b - a + length
                    a = b
                if size > unit:
                    yield _rows_batch(rows, names)
                    rows, size = [], 0
            yield _rows_batch(rows, names)

    return run


def _searched(groups: DataFrame, length: int, shard: int) -> DataFrame:
    """(key, piece, doc, last, text) -> (key, piece, from, to, least), keys
    whole in a task.  Searching costs far more than its bytes show, so the
    number of partitions is fixed and not left to their size."""
    n = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = groups.select("key", "piece", "doc", "last", "text").repartition(n, "key").sortWithinPartitions("key")
    return rows.mapInArrow(_searcher(length, shard), "key long, piece long, from long, to long, least long")


def earlier_ranges(segments: DataFrame, length: int, unit: int = UNIT, shard: int = SHARD) -> DataFrame:
    """(anchor, content, place, doc, last, text) -> (anchor, content, from, to,
    least): ranges of windows and the least id of a document that holds them."""
    by_anchor = segments.groupBy("anchor").agg(F.count("*").alias("kinds"))
    crowded = materialize(by_anchor.where(F.col("kinds") > CROWD).select("anchor"), "crowded")
    calm = segments.join(crowded, "anchor", "left_anti").withColumnsRenamed({"anchor": "key", "content": "piece"})
    out = _searched(calm, length, shard).withColumnsRenamed({"key": "anchor", "piece": "content"})
    if crowded.isEmpty():
        return out
    rows = segments.join(crowded, "anchor", "left_semi").select(
        "anchor", "content", F.lit(0).cast("long").alias("off"), "place", "doc", "last", "text")
    for g in PIECES:
        cut = materialize(rows.mapInArrow(
            _cutter(length, g, unit), "anchor long, content long, off long, place long, doc long, last long, "
                                      "key long, piece long, text binary"), "pieces")
        groups = cut.groupBy("key", "piece").agg(F.min("doc").alias("doc"), F.max("last").alias("last"),
                                                 F.first("text").alias("text"))
        crowded = materialize(
            cut.select("key", "piece").distinct().groupBy("key").agg(F.count("*").alias("kinds"))
            .where(F.col("kinds") > CROWD).select("key"), "crowded")
        ranges = _searched(groups.join(crowded, "key", "left_anti"), length, shard)
        out = out.unionByName(
            cut.select("anchor", "content", "off", "key", "piece").join(ranges, ["key", "piece"]).select(
                "anchor", "content", (F.col("off") + F.col("from")).alias("from"),
                (F.col("off") + F.col("to")).alias("to"), "least"))
        if crowded.isEmpty():
            break
        rows = cut.join(crowded, "key", "left_semi").select("anchor", "content", "off", "place", "doc", "last", "text")
    return out


def _remover(batches):
    import pyarrow as pa

    for batch in batches:
        rows = []
        for doc, text, spans in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            words = (text.as_py() or b"").split()
            kept, at = [], 0
            for a, b in sorted((s["a"], s["b"]) for s in spans.as_py() or []):
                kept += words[at:max(at, a)]
                at = max(at, b)
            kept += words[at:]
            rows.append((doc, len(words), len(words) - len(kept), b" ".join(kept)))
        yield _rows_batch(rows, ["doc_id", "n_words", "n_removed", "kept"])


def without_earlier_words(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id",
                          text_col: str = "text", unit: int = UNIT, shard: int = SHARD) -> DataFrame:
    """Per input row: doc_id, n_words, n_removed, kept (UTF-8: the words that
    stay, joined by one space)."""
    spark = docs.sparkSession
    text_batches(spark)
    d = only(docs, id_col, text_col).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    d = d.select("doc_id", F.xxhash64("text").alias("dh"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"),
                 F.col("text").cast("binary").alias("text"))
    # A window has a byte a word at least, and what parts them.
    has_window = F.col("doc_id").isNotNull() & (F.col("size") >= 2 * length - 1)
    long = d.where(has_window)
    segments = materialize(long.mapInArrow(_segmenter(length, gram, unit), SEGMENTS), "segments")
    shared = materialize(
        segments.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi")
        .select("anchor"), "anchors")
    # Equal segments once: the place in the least document, and the last document that holds them.
    # As one value, anchor and content are dealt anew after the join; with the anchors read from a table,
    # nothing ties the join to its partitioning, and a hot anchor is split.
    again = materialize(
        segments.join(shared, "anchor").withColumn("both", F.struct("anchor", "content"))
        .groupBy("both").agg(F.min(F.struct("doc_id", "dh", "size", "start", "run", "place")).alias("at"),
                             F.max("doc_id").alias("last")).select("both.*", "last", "at.*"), "shared")
    release(spark)
    same = ["doc_id", "dh", "size"]
    wanted = again.groupBy(*same).agg(F.collect_list(F.struct("start", "run", "anchor", "content", "place", "last")).alias("wanted"))
    # Of rows that repeat id and text (each has one first segment), one gives its words.
    copies = materialize(segments.where("start = 0").groupBy(*same).agg(F.count("*").alias("n")).where("n > 1")
                         .select(*same), "copies")
    source = long
    if not copies.isEmpty():
        source = long.join(copies, same, "left_anti").unionByName(
            long.join(copies, same, "left_semi").dropDuplicates(same).select(long.columns))
    texts = source.join(wanted, same).select("doc_id", "text", "wanted")
    found = materialize(texts.mapInArrow(_fetcher(length, unit), "anchor long, content long, place long, doc long, "
                                                                 "last long, text binary"), "texts")
    release(spark)
    ranges = materialize(earlier_ranges(found, length, unit, shard), "ranges")
    release(spark)
    spans = segments.join(ranges, ["anchor", "content"]).where("doc_id > least").select(
        *same, F.struct((F.col("start") + F.col("from")).alias("a"),
                        (F.col("start") + F.col("to") - 1 + length).alias("b")).alias("span"))
    spans = materialize(spans.groupBy(*same).agg(F.collect_set("span").alias("spans")), "spans")
    release(spark)
    untouched = d.where(~F.coalesce(has_window, F.lit(False))).select("doc_id", "text", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"))
    rows = long.join(spans, same, "left").select("doc_id", "text", "spans").unionByName(untouched)
    return rows.mapInArrow(_remover, "doc_id long, n_words long, n_removed long, kept binary")


def op11_substring_dedup(spark, sf_dir):
    return without_earlier_words(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))

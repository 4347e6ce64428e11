"""Token ids written as length-delimited binary records, with an offset index.

Documents are range-partitioned and sorted by id; each task encodes its range
and writes one record file.  A record is

    u64 length | u32 masked crc of the length | body | u32 masked crc of the body

with body = ``i64 id, u8 id is null, u8 bytes per token id, token ids``; all
integers are little-endian, the checksum is CRC-32, masked by a rotation and
an added constant so that checksums of data holding checksums stay sound.  The
index, a Parquet table beside the files, has one row per record (file, byte
offset, length, first token of the document within the file), so any subset
can be read in any order.

A task writes under a name of its own and renames the finished file, so a
repeated or speculative task leaves the same file once.

Defined results: a null text is an empty document (its ids are the end id
alone); null ids sort first; rows that repeat an id are ordered by text; other
columns (clashing names included) are ignored; an empty table gives no files.
"""

from __future__ import annotations

import struct
import uuid
import zlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retail_insights.llm.common import only, scratch_path, table, text_batches
from retail_insights.llm.tokens import END_ID, TOKENIZER, process_encoder

# Fixed value: the constant added to a rotated checksum.
MASK_DELTA = 0xA282EAD8
HEAD, BODY = "<QI", "<qBB"
HEAD_BYTES, BODY_BYTES = struct.calcsize(HEAD), struct.calcsize(BODY)
READ_BLOCK = 8 << 20
INDEX_SCHEMA = ("part int, file string, row long, id long, offset long, n_bytes long, "
                "token_start long, n_tokens long")


def masked_crc(data: bytes) -> int:
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(body: bytes) -> bytes:
    size = struct.pack("<Q", len(body))
    return b"".join((size, struct.pack("<I", masked_crc(size)), body, struct.pack("<I", masked_crc(body))))


def unframe(data: bytes, at: int = 0) -> bytes:
    """The body of the record at ``at``; a damaged record raises."""
    n, crc = struct.unpack_from(HEAD, data, at)
    if masked_crc(data[at:at + 8]) != crc:
        raise ValueError(f"record at {at}: damaged length")
    body = bytes(data[at + HEAD_BYTES:at + HEAD_BYTES + n])
    (crc,) = struct.unpack_from("<I", data, at + HEAD_BYTES + n)
    if len(body) != n or masked_crc(body) != crc:
        raise ValueError(f"record at {at}: damaged body")
    return body


def _writer(folder: str, tokenizer: str, end_id: int):
    def write(batches):
        import numpy as np
        import pyarrow as pa
        from pyarrow import fs
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder, out, place, offset, row, start = None, None, None, 0, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                encoder = process_encoder(tokenizer)
                store, base = fs.FileSystem.from_uri(folder)
                store.create_dir(base, recursive=True)
                final = f"{base}/part-{part:06d}.records"
                place = f"{base}/_{part:06d}-{uuid.uuid4().hex}"
                out = store.open_output_stream(place)
            end = np.array([end_id], encoder.dtype).tobytes()
            width = encoder.dtype.itemsize
            ids = batch.column(0).to_pylist()
            cols = [[] for _ in range(5)]
            for doc, found in zip(ids, encoder.encode(batch.column(1).to_pylist())):
                found += end
                record = frame(struct.pack(BODY, doc or 0, doc is None, width) + found)
                out.write(record)
                n = len(found) // width
                for c, v in zip(cols, (row, offset, len(record), start, n)):
                    c.append(v)
                row, offset, start = row + 1, offset + len(record), start + n
            r, o, b, s, n = (pa.array(c, pa.int64()) for c in cols)
            k = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * k, pa.int32()), pa.array([f"part-{part:06d}.records"] * k),
                 r, pa.array(ids, pa.int64()), o, b, s, n],
                names=["part", "file", "row", "id", "offset", "n_bytes", "token_start", "n_tokens"])
        if out is not None:
            out.close()
            store.move(place, final)

    return write


def write_records(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
                  tokenizer: str = TOKENIZER, end_id: int = END_ID) -> None:
    """Write ``folder/records/part-*.records`` and the index ``folder/index``."""
    text_batches(docs.sparkSession)
    d = only(docs, id_col, text_col).select(F.col(id_col).cast("long").alias("id"),
                                            F.col(text_col).alias("text"))
    ordered = d.repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"), "text")
    ordered.mapInArrow(_writer(f"{folder}/records", tokenizer, end_id), INDEX_SCHEMA).write.parquet(f"{folder}/index")


def _reader(folder: str):
    def read(batches):
        import numpy as np
        import pyarrow as pa
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            rows = batch.to_pydict()
            out = {"id": [], "n_tokens": [], "ids_crc32": [], "start": []}
            order = sorted(range(batch.num_rows), key=lambda i: (rows["file"][i], rows["offset"][i]))
            k = 0
            while k < len(order):
                # One block: neighbouring records of a file, up to READ_BLOCK bytes (or one record).
                file, first = rows["file"][order[k]], rows["offset"][order[k]]
                end, j = first, k
                while j < len(order) and rows["file"][order[j]] == file and (
                        j == k or rows["offset"][order[j]] + rows["n_bytes"][order[j]] - first <= READ_BLOCK):
                    end = rows["offset"][order[j]] + rows["n_bytes"][order[j]]
                    j += 1
                with store.open_input_file(f"{base}/{file}") as f:
                    data = f.read_at(end - first, first)
                for i in order[k:j]:
                    body = unframe(data, rows["offset"][i] - first)
                    doc, null, width = struct.unpack_from(BODY, body)
                    ids = np.frombuffer(body, f"<u{width}", offset=BODY_BYTES)
                    out["id"].append(None if null else doc)
                    out["n_tokens"].append(len(ids))
                    out["ids_crc32"].append(zlib.crc32(ids.astype("<u4").tobytes()))
                    out["start"].append(rows["base"][i] + rows["token_start"][i])
                k = j
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([(c, pa.int64()) for c in out]))

    return read


def read_records(spark, folder: str) -> DataFrame:
    """(id, n_tokens, ids_crc32, start) of every record, read from the files by
    the index; ``start`` counts the ids of all documents before."""
    index = spark.read.parquet(f"{folder}/index")
    # One row per file from here, so the running total is over the file list alone.
    files = index.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    bases = files.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("base"))
    rows = index.join(bases, "part").select("file", "offset", "n_bytes", "token_start", "base")
    return rows.mapInArrow(_reader(f"{folder}/records"), "id long, n_tokens long, ids_crc32 long, start long")


def op7_token_records(spark, sf_dir):
    folder = scratch_path(spark, "token-records")
    write_records(table(spark, sf_dir, "documents"), folder)
    return read_records(spark, folder).select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")

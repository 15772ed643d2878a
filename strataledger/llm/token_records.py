"""Token ids in length-delimited binary records, with an offset index beside each file.

A record: the payload's length (uint64), the length's masked checksum (uint32), the payload, the payload's masked
checksum (uint32), all little-endian. The mask rotates a CRC-32 by 15 bits and adds a constant, so that checksums of data that
holds checksums stay apart. The payload: 1 byte (1 if the document has an id), the id (int64), then the ids as unsigned
integers of the header's width. A file begins with the magic and the width; its index holds the records' offsets and the end (uint64 each).
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_folder, spread, staged
from .tokens import encoder, opened, parts, qualified

#: Fixed values of the format.
MAGIC, MASK = b"SLREC1", 0xA282EAD8
HEAD = struct.Struct("<QI")


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<I", masked(size)), payload, struct.pack("<I", masked(payload))))


def unframe(data: memoryview, at: int) -> tuple[memoryview, int]:
    """The payload at an offset and the offset of the next record; ValueError if a checksum fails."""
    if len(data) < at + HEAD.size:
        raise ValueError(f"record at {at} is cut off")
    size, crc = HEAD.unpack_from(data, at)
    if masked(bytes(data[at : at + 8])) != crc:
        raise ValueError(f"length at {at} is damaged")
    begin = at + HEAD.size
    payload = data[begin : begin + size]
    if len(payload) < size or len(data) < begin + size + 4 or struct.unpack_from("<I", data, begin + size)[0] != masked(payload):
        raise ValueError(f"record at {at} is damaged")
    return payload, begin + size + 4


def write(docs: DataFrame, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text", folder: str | None = None,
          by_words: bool | None = None) -> DataFrame:
    """Writes every text's ids and the end id in ascending id order; returns the files (file, data, index, n_records, n_tokens).

    Rows are dealt by ranges of id and text, so that file i comes before file i + 1 and a repeated id is spread by its texts; null ids
    come first, null texts are empty, equal rows are all written. Every attempt of a task writes files of its own name, and the
    list of files, committed by Spark, names those that count: a lost executor or a second attempt leaves no wrong file in it.
    An empty table gives no records. Columns beyond the two named are not read.
    """
    spark = docs.sparkSession
    target = qualified(spark, folder or shared_folder(spark))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    tie = F.xxhash64("text")
    rows = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, "text")
    rows = rows.select(F.col("doc_id").cast("string"), "text")  # pandas would make null ids' column floats
    tail = [end_id]

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(tokenizer, by_words)
        number, name = TaskContext.get().partitionId(), uuid.uuid4().hex
        data, index = (f"{target}/{number:06d}-{name}.{kind}" for kind in ("rec", "idx"))
        n_records = n_tokens = 0
        at, offsets = len(MAGIC) + 1, []
        end = np.array(tail, enc.dtype).tobytes()
        with opened(data, "w") as out:
            out.write(MAGIC + bytes([enc.width]))
            for pdf in batches:
                for part in parts(pdf):
                    for i, own in zip(part["doc_id"], enc.encode(part["text"].fillna("").tolist()), strict=True):
                        record = frame(struct.pack("<?q", i is not None, int(i or 0)) + own + end)
                        out.write(record)
                        offsets.append(at)
                        at += len(record)
                        n_records += 1
                        n_tokens += len(own) // enc.width + 1
        with opened(index, "w") as out:
            out.write(np.array([*offsets, at], "<u8").tobytes())
        yield pd.DataFrame([(number, data, index, n_records, n_tokens)], columns=["file", "data", "index", "n_records", "n_tokens"])

    return staged(rows.mapInPandas(put, "file int, data string, index string, n_records long, n_tokens long"))


def read(files: DataFrame, window: int = 32 << 20) -> DataFrame:
    """Reads files of ``write`` back and checks them: (doc_id, start, n_tokens, ids_crc32, file, record).

    ``start`` counts the ids of all records before, over the files in order; there is one row per file in that running sum. A task
    reads a file in pieces of about ``window`` bytes, cut at the index's offsets. A damaged record is an error that names its place.
    """
    order = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    based = files.withColumn("base", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)))
    based = spread(based.select("file", "data", "index", "base"), files.count())

    def get(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for number, data, index, base in pdf.itertuples(index=False):
                head = opened(data, "r", 0, len(MAGIC) + 1)
                if head[:-1] != MAGIC:
                    raise ValueError(f"{data} is not a record file")
                dtype = np.dtype(f"<u{head[-1]}")
                offsets = np.frombuffer(opened(index, "r"), "<u8").astype(np.int64)
                first, start = 0, int(base)
                while first < len(offsets) - 1:
                    last = int(max(first + 1, np.searchsorted(offsets, offsets[first] + window, "right") - 1))
                    begin = int(offsets[first])
                    piece, out = memoryview(opened(data, "r", begin, int(offsets[last]) - begin)), []
                    for k in range(first, last):
                        payload, _ = unframe(piece, int(offsets[k]) - begin)
                        has, i = struct.unpack_from("<?q", payload)
                        ids = np.frombuffer(payload, dtype, offset=9)
                        out.append((str(i) if has else None, start, len(ids), zlib.crc32(ids.astype("<u4")), number, k))
                        start += len(ids)
                    first = last
                    yield pd.DataFrame(out, columns=["doc_id", "start", "n_tokens", "ids_crc32", "file", "record"])

    got = based.mapInPandas(get, "doc_id string, start long, n_tokens long, ids_crc32 long, file int, record long")
    return got.withColumn("doc_id", F.col("doc_id").cast("long"))


def pick(data: str, index: str, record: int) -> tuple[int | None, np.ndarray]:
    """One record by its number, through the index alone: what a shuffled reader does."""
    a, b = np.frombuffer(opened(index, "r", 8 * record, 16), "<u8").astype(int)
    payload, _ = unframe(memoryview(opened(data, "r", int(a), int(b - a))), 0)
    has, i = struct.unpack_from("<?q", payload)
    width = opened(data, "r", len(MAGIC), 1)[0]
    return (i if has else None), np.frombuffer(payload, f"<u{width}", offset=9)

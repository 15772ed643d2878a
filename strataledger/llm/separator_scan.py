"""Token counts of documents in flat, unindexed token files, by a scan for the separator.

Files are cut into byte blocks. A first scan finds in every block, vectorised, how many separators it has and where the last one is; a
prefix scan over a file's blocks tells each block how many documents ended before it and where the last separator was; a
second scan then gives every document's length, those that cross blocks included.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_folder, spread, staged
from .tokens import encoder, opened, parts, qualified

BLOCK = 8 << 20


def write_flat(docs: DataFrame, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text", folder: str | None = None,
               by_words: bool | None = None) -> tuple[DataFrame, DataFrame]:
    """Writes texts as flat token files, an end id after each; returns the files (data, width, n_bytes) and the documents' order (data, at, doc_id).

    A task writes one file, in the order in which it reads its rows. Strings of special tokens in a text are ordinary text, so the end id ends
    documents only. Null texts are empty documents. Attempts write files of their own; the lists, committed by Spark, name those that count.
    """
    spark = docs.sparkSession
    target = qualified(spark, folder or shared_folder(spark))
    kind = dict(docs.dtypes)[doc_id]
    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(tokenizer, by_words, True)
        name, at, size = f"{target}/{uuid.uuid4().hex}.tok", 0, 0
        end = np.array([end_id], enc.dtype).tobytes()
        with opened(name, "w") as out:
            for pdf in batches:
                for part in parts(pdf):
                    data = end.join([*enc.encode(part["text"].fillna("").tolist()), b""])
                    out.write(data)
                    size += len(data)
                    yield pd.DataFrame({"data": name, "at": np.arange(at, at + len(part)), "doc_id": part["doc_id"].to_numpy(), "width": 0, "n_bytes": 0})
                    at += len(part)
        yield pd.DataFrame({"data": [name], "at": [-1], "doc_id": [None], "width": enc.width, "n_bytes": size})

    lines = staged(rows.mapInPandas(put, "data string, at long, doc_id string, width int, n_bytes long"))
    lines = lines.withColumn("doc_id", F.col("doc_id").cast(kind))
    return lines.where("at < 0").select("data", "width", "n_bytes"), lines.where("at >= 0").select("data", "at", "doc_id")


def count_tokens(files: DataFrame, end_id: int, block: int = BLOCK) -> DataFrame:
    """(data, at, n_tokens, ended) of every document in flat files (data, width, n_bytes).

    ``at`` is the document's place in its file, from 0; ``n_tokens`` leaves out the separator. Two separators in a row enclose an empty
    document; tokens after a file's last separator are one more document that is not ``ended``. Empty files have no documents. ``block``
    bytes, a multiple of the width, bound a task's memory whatever a file's or a document's size.
    """
    block -= block % 4
    cut = files.where("n_bytes > 0").select("data", "width", "n_bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_bytes") - 1, F.lit(block).cast("long"))).alias("begin"))
    tasks = -(-(files.agg(F.sum("n_bytes")).first()[0] or 0) // BLOCK)
    cut = spread(cut.withColumn("size", F.least(F.lit(block), F.col("n_bytes") - F.col("begin"))), tasks)

    def places(data: str, width: int, begin: int, size: int) -> np.ndarray:
        """Places of the block's separators, in tokens from the file's start."""
        ids = np.frombuffer(opened(data, "r", begin, size), f"<u{width}")
        return np.flatnonzero(ids == end_id) + begin // width

    def ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                p = places(r.data, r.width, r.begin, r.size)
                out.append((*r, len(p), int(p[-1]) if len(p) else -1))
            yield pd.DataFrame(out, columns=[*pdf.columns, "n_ends", "last_end"])

    shape = "data string, width int, n_bytes long, begin long, size long"
    found = staged(cut.mapInPandas(ends, f"{shape}, n_ends long, last_end long"))
    before = Window.partitionBy("data").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    stitched = spread(found.select(
        "data", "width", "n_bytes", "begin", "size",
        F.coalesce(F.sum("n_ends").over(before), F.lit(0)).alias("first"),
        F.coalesce(F.max("last_end").over(before), F.lit(-1)).alias("from_end"),
    ), tasks)

    def lengths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                p = places(r.data, r.width, r.begin, r.size)
                n = np.diff(p, prepend=r.from_end) - 1
                at, ended = np.arange(r.first, r.first + len(p)), np.ones(len(p), bool)
                rest = r.n_bytes // r.width - 1 - (p[-1] if len(p) else r.from_end)
                if r.begin + r.size == r.n_bytes and rest > 0:
                    n, at, ended = np.append(n, rest), np.append(at, r.first + len(p)), np.append(ended, False)
                yield pd.DataFrame({"data": r.data, "at": at, "n_tokens": n, "ended": ended})

    return stitched.mapInPandas(lengths, "data string, at long, n_tokens long, ended boolean")


def document_tokens(docs: DataFrame, tokenizer: str, end_id: int, block: int = BLOCK, **columns) -> DataFrame:
    """(doc_id, n_tokens) of every row, counted in flat files: repeated rows stay, null and empty texts have 0, null ids stay null."""
    files, order = write_flat(docs, tokenizer, end_id, **columns)
    # one row for each document on either side: merged, as the plan takes the lengths for as few as the blocks they come from
    return order.join(count_tokens(files, end_id, block).hint("merge"), ["data", "at"]).select("doc_id", "n_tokens")

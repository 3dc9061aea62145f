"""Token counts of documents from flat token streams.

A stream is what a tokeniser leaves on disk: ids of all documents one after the other, each
document closed by the end-of-document id, cut into blocks of equal size, with no index.
:func:`count_tokens` finds the closing ids with one vectorised comparison for a block. A document may begin
in one block and end many blocks later, so each block reports how many documents it closes and
how many ids it leaves open; a prefix sum over these small rows gives every block the ordinal of its
first document and the ids carried into it.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weir.llm.common import map_batches, sealed, small_batches

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# How this vocabulary cuts texts before merging, and its free id.
CUT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END = 50256

# Ids in a block; two bytes each.
BLOCK = 1 << 18

STREAM = "stream_id BIGINT, block_no BIGINT, block BINARY, first_ordinal BIGINT, doc_ids ARRAY<BIGINT>"


@lru_cache(maxsize=2)
def encoding(path: str = RANKS) -> tiktoken.Encoding:
    with open(path, "rb") as lines:  # the vocabulary is on every machine
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=CUT, mergeable_ranks=ranks, special_tokens={})


def write_streams(docs: DataFrame, path: str = RANKS, end: int = END, block: int = BLOCK) -> DataFrame:
    """Tokenise ``(doc_id, text)`` into flat streams, one for each task, written to the shared folder.

    ``(stream_id, block_no, block, first_ordinal, doc_ids)``: little-endian 16-bit ids; the last block of
    a stream may be shorter. ``doc_ids`` is the manifest, kept apart from the ids: the documents of a stream in
    order, in pieces, each with the ordinal of its first. NULL texts count as empty.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, number, ordinal, open_ids = TaskContext.get().partitionId(), 0, 0, bytearray()
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64())]

        def row(*values) -> pa.RecordBatch:
            arrays = [pa.array([v], kind) for v, kind in zip(values, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["stream_id", "block_no", "block", "first_ordinal", "doc_ids"])

        closing = np.array([end], "<u2").tobytes()
        for batch in batches:
            coder = encoding(path)
            for text in batch.column(1).to_pylist():
                if text:
                    open_ids += np.array(coder.encode_ordinary(text), "<u2").tobytes()
                open_ids += closing
                while len(open_ids) >= 2 * block:
                    yield row(stream, number, bytes(open_ids[: 2 * block]), None, None)
                    del open_ids[: 2 * block]
                    number += 1
            if batch.num_rows:
                yield row(stream, None, None, ordinal, batch.column(0).to_pylist())
                ordinal += batch.num_rows
        if open_ids:
            yield row(stream, number, bytes(open_ids), None, None)

    return sealed(docs.select("doc_id", "text").mapInArrow(run, STREAM), "token-streams")


def scan_blocks(blocks: DataFrame, end: int = END) -> DataFrame:
    """``(stream_id, block_no, closed, head, sizes, tail)`` of ``(stream_id, block_no, block)``.

    ``closed`` documents end in the block; ``head`` ids stand before the first end, ``tail`` after the
    last; ``sizes`` are those of the documents that lie inside. Without an end all ids are ``tail``.
    """

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for data in batch.column(2).to_pylist():
            ids = np.frombuffer(data, "<u2")
            ends = np.flatnonzero(ids == end)
            if len(ends):
                rows.append((len(ends), int(ends[0]), np.diff(ends) - 1, len(ids) - 1 - int(ends[-1])))
            else:
                rows.append((0, 0, np.empty(0, np.int64), len(ids)))
        closed, head, sizes, tail = zip(*rows, strict=True)
        number = pa.int64()
        columns = [pa.array(closed, number), pa.array(head, number), pa.array(sizes, pa.list_(number)), pa.array(tail, number)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *columns], ["stream_id", "block_no", "closed", "head", "sizes", "tail"]
        )

    schema = "stream_id BIGINT, block_no BIGINT, closed BIGINT, head BIGINT, sizes ARRAY<BIGINT>, tail BIGINT"
    return map_batches(blocks.select("stream_id", "block_no", "block"), scan, schema)


def count_tokens(blocks: DataFrame, end: int = END) -> DataFrame:
    """``(stream_id, ordinal, n_tokens)`` of every document of flat streams; ends are not counted.

    The blocks of a stream, some ten numbers each, are put in order for two prefix sums: documents closed
    before a block, and ids left open since the last end. Ids behind the last end of a stream belong to no document.
    """
    scanned = scan_blocks(blocks, end)
    summary = scanned.select("stream_id", "block_no", "closed", "head", "tail")
    before = Window.partitionBy("stream_id").orderBy("block_no").rowsBetween(Window.unboundedPreceding, -1)
    # All ids left open so far, and what that sum was when a document last ended.
    opened = F.sum("tail").over(before)
    at_end = F.max(F.when(F.col("closed") > 0, F.col("upto"))).over(before)
    carried = (
        summary.withColumn("first", F.coalesce(F.sum("closed").over(before), F.lit(0)))
        .withColumn("open", F.coalesce(opened, F.lit(0)))
        .withColumn("upto", F.col("open"))
        .withColumn("carry", F.col("open") - F.coalesce(at_end, F.lit(0)))
        .select("stream_id", "block_no", "first", "carry")
    )
    whole = F.concat(F.array(F.col("head") + F.col("carry")), F.col("sizes"))
    return (
        scanned.where("closed > 0")
        .join(carried, ["stream_id", "block_no"])
        .select("stream_id", "first", F.posexplode(whole).alias("i", "n_tokens"))
        .select("stream_id", (F.col("first") + F.col("i")).alias("ordinal"), "n_tokens")
    )


def document_tokens(docs: DataFrame, path: str = RANKS, end: int = END, block: int = BLOCK) -> DataFrame:
    """``(doc_id, n_tokens)``, one row for every row of ``docs``: written as streams, then scanned.

    Empty and NULL texts have 0 tokens; NULL and repeated ids are carried along; other columns are not read.
    """
    streams = write_streams(docs, path, end, block)
    manifest = streams.where("doc_ids IS NOT NULL").select(
        "stream_id", "first_ordinal", F.posexplode("doc_ids").alias("i", "doc_id")
    ).select("stream_id", (F.col("first_ordinal") + F.col("i")).alias("ordinal"), "doc_id")
    counts = count_tokens(streams.where("block IS NOT NULL"), end)
    return manifest.join(counts, ["stream_id", "ordinal"], "left").select("doc_id", "n_tokens")

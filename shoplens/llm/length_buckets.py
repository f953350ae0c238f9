"""Packing by power-of-two decomposition: no sequence holds more than one document."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.common import settle, small_side, text_bytes
from shoplens.llm.tokens import closed, vocabulary_path, word_tokens

#: Tokens of the longest sequence; a power of two.
CAPACITY = 2048
#: Id put after the last token of each document.
END = 1
#: Pieces whose sequences are numbered together, about.
BLOCK_PIECES = 1 << 14

_PIECES = pa.list_(
    pa.struct(
        [
            ("start", pa.int64()),
            ("length", pa.int64()),
            ("ids_crc32", pa.int64()),
            ("doc_tokens", pa.int64()),
            ("ids", pa.list_(pa.int32())),
        ]
    )
)
_PIECES_DDL = (
    "array<struct<start:bigint,length:bigint,ids_crc32:bigint,doc_tokens:bigint,ids:array<int>>>"
)


def decompose(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``total`` tokens.

    As many of ``capacity`` as fit, then one for each binary digit of the rest, longest first.
    """
    cut = []
    at = 0
    while at < total:
        left = total - at
        length = capacity if left >= capacity else 1 << (left.bit_length() - 1)
        cut.append((at, length))
        at += length
    return cut


def _pieces(path: str, capacity: int, end: int, with_ids: bool):
    def pieces_of(ids: np.ndarray, totals: np.ndarray) -> pa.Array:
        raw = memoryview(ids.astype("<u4").tobytes())
        starts, lengths, crcs, whole, ends, at = [], [], [], [], [0], 0
        for total in totals.tolist():
            for start, length in decompose(total, capacity):
                starts.append(start)
                lengths.append(length)
                crcs.append(zlib.crc32(raw[4 * at : 4 * (at + length)]))
                whole.append(total)
                at += length
            ends.append(len(starts))
        if with_ids:  # pieces follow each other as the ids do
            cuts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            tokens = pa.ListArray.from_arrays(pa.array(cuts), pa.array(ids.astype(np.int32)))
        else:
            tokens = pa.nulls(len(starts), pa.list_(pa.int32()))
        columns = [pa.array(c, pa.int64()) for c in (starts, lengths, crcs, whole)]
        return pa.ListArray.from_arrays(
            pa.array(ends, pa.int32()),
            pa.StructArray.from_arrays([*columns, tokens], fields=list(_PIECES.value_type)),
        )

    def pieces(texts: pa.Array) -> pa.Array:
        tokens = word_tokens(path)
        found = [pieces_of(*closed(*c, end)) for c in tokens.encode_columns(texts)]
        return pa.concat_arrays([pa.array([], _PIECES), *(f.cast(_PIECES) for f in found)])

    return F.arrow_udf(pieces, _PIECES_DDL).asNondeterministic()


def cut_documents(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    vocabulary: str | None = None,
    capacity: int = CAPACITY,
    end: int = END,
    with_ids: bool = True,
) -> DataFrame:
    """The pieces of all documents: id, start, length, ids_crc32, doc_tokens, ids.

    A document is the ids of its text, then ``end``. It is cut into pieces of ``capacity`` and
    one of each power of two that its rest needs, so a null or empty text gives one piece of
    one token. Each row counts as a document of its own, also if rows repeat or the id is null.
    ``with_ids=False`` leaves the ids null. Other columns of ``docs`` are not read.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    cut = _pieces(vocabulary or vocabulary_path(), capacity, end, with_ids)
    return (
        docs.select(F.col(id).alias("doc_id"), cut(text_bytes(text)).alias("pieces"))
        .select("doc_id", F.inline("pieces"))
    )


def pack(pieces: DataFrame) -> DataFrame:
    """Pieces with ``bucket``, ``sequence_id`` and ``offset``.

    Each piece is a sequence: all of a bucket are equally long, so a batch of them needs no
    padding, and attention never crosses documents. Sequences are numbered from 0 without gaps,
    the shortest bucket first. A bucket is numbered in blocks by a hash of the place of a piece, so
    that rows that repeat or have no id are dealt like all others; their number follows the
    number of pieces, and there is a count for each bucket and block. An empty table gives an
    empty one.
    """
    own = settle(
        pieces.withColumn("bucket", F.log2("length").cast("int")).withColumn(
            "place", F.monotonically_increasing_id()
        )
    )
    blocks = max(1, -(-own.count() // BLOCK_PIECES))
    own = own.withColumn("block", F.pmod(F.xxhash64("place"), F.lit(blocks)))
    before = Window.orderBy("bucket", "block").rowsBetween(Window.unboundedPreceding, -1)
    begins = (
        own.groupBy("bucket", "block")
        .agg(F.count("*").alias("n"))
        .select("bucket", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    )
    rank = F.row_number().over(
        Window.partitionBy("bucket", "block").orderBy("doc_id", "start", "ids_crc32")
    )
    return (
        own.join(small_side(settle(begins)), ["bucket", "block"])
        .withColumn("sequence_id", F.col("begin") + rank - 1)
        .withColumn("offset", F.lit(0).cast("long"))
        .drop("block", "begin", "place")
    )

"""Token ids packed by best fit decreasing, with a segment tree over free capacities."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import text_bytes
from shoplens.llm.tokens import closed, vocabulary_path, word_tokens

#: Tokens of a row of a matrix, the id that ends a document, and the id that fills a row.
CAPACITY = 2048
END = 1
PAD = 0
#: Documents whose pieces are packed together, about.
BLOCK_DOCUMENTS = 2048


class FreeCapacities:
    """Open rows by free capacity: the fullest one that still has room, in logarithmic time.

    A complete binary tree over capacities; a node counts the rows below it.
    """

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def _add(self, free: int, change: int) -> None:
        node = self.leaves + free
        while node:
            self.count[node] += change
            node >>= 1

    def put(self, row: int, free: int) -> None:
        self.rows[free].append(row)
        self._add(free, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (row, free) with the least free capacity of at least ``need``."""
        count, node = self.count, self.leaves + need
        if not count[node]:
            # up to the first subtree to the right that holds a row, then down to its left
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if count[2 * node] else 2 * node + 1
        free = node - self.leaves
        self._add(free, -1)
        return self.rows[free].pop(), free


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[int]:
    """The row of each piece; the longest pieces come first, equal ones in the given order."""
    tree = FreeCapacities(capacity)
    row_of = [0] * len(lengths)
    rows = 0
    for piece in sorted(range(len(lengths)), key=lambda p: -lengths[p]):
        found = tree.take(lengths[piece])
        if found is None:
            row, free = rows, capacity
            rows += 1
        else:
            row, free = found
        row_of[piece] = row
        if free > lengths[piece]:
            tree.put(row, free - lengths[piece])
    return row_of


_ROWS = pa.schema(
    [
        ("block", pa.int64()),
        ("row", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("starts", pa.list_(pa.int64())),
        ("cu_seqlens", pa.list_(pa.int32())),
        ("ids", pa.binary()),
        ("positions", pa.binary()),
        ("ids_crc32", pa.int64()),
    ]
)
_ROWS_DDL = (
    "block bigint, row bigint, doc_ids array<bigint>, starts array<bigint>,"
    " cu_seqlens array<int>, ids binary, positions binary, ids_crc32 bigint"
)


def _token_ids(path: str, end: int):
    def token_ids(texts: pa.Array) -> pa.Array:
        tokens = word_tokens(path)
        narrow = max(tokens.tokenizer.get_vocab_size(), end + 1) <= 1 << 16
        kind = np.dtype("<u2" if narrow else "<u4")
        found = [pa.array([], pa.binary())]
        for coded in tokens.encode_columns(texts):
            ids, sizes = closed(*coded, end)
            edges = np.concatenate([[0], np.cumsum(sizes)]) * kind.itemsize
            data = [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(ids.astype(kind))]
            found.append(pa.Array.from_buffers(pa.binary(), len(sizes), data))
        return pa.concat_arrays(found)

    return F.arrow_udf(token_ids, "binary").asNondeterministic()


def _pack_block(path: str, capacity: int, end: int, pad: int):
    def pack_block(key: tuple, table: pa.Table) -> pa.Table:
        narrow = max(word_tokens(path).tokenizer.get_vocab_size(), end + 1) <= 1 << 16
        kind = "<u2" if narrow else "<u4"
        docs = sorted(
            zip(table["doc_id"].to_pylist(), table["ids"].to_pylist(), strict=True),
            key=lambda d: (d[0] is not None, d[0] or 0, d[1]),
        )
        pieces = []  # document, start, ids
        for doc, raw in docs:
            ids = np.frombuffer(raw, kind)
            pieces += [(doc, at, ids[at : at + capacity]) for at in range(0, len(ids), capacity)]
        rows: dict[int, list[tuple]] = {}
        lengths = [len(ids) for _, _, ids in pieces]
        for row, piece in zip(best_fit_decreasing(lengths, capacity), pieces, strict=True):
            rows.setdefault(row, []).append(piece)
        out = []
        for row, held in rows.items():
            ends = np.cumsum([0, *(len(ids) for _, _, ids in held)])
            matrix = np.full(capacity, pad, "<u4")
            matrix[: ends[-1]] = np.concatenate([ids for _, _, ids in held])
            positions = np.empty(capacity, "<u4")
            for a, b in zip(ends, [*ends[1:], capacity], strict=True):
                positions[a:b] = np.arange(b - a)
            out.append(
                {
                    "block": key[0].as_py(),
                    "row": row,
                    "doc_ids": [doc for doc, _, _ in held],
                    "starts": [start for _, start, _ in held],
                    "cu_seqlens": ends.tolist(),
                    "ids": matrix.tobytes(),
                    "positions": positions.tobytes(),
                    "ids_crc32": zlib.crc32(matrix[: ends[-1]].tobytes()),
                }
            )
        return pa.Table.from_pylist(out, _ROWS)

    return pack_block


def pack(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    vocabulary: str | None = None,
    capacity: int = CAPACITY,
    end: int = END,
    pad: int = PAD,
) -> DataFrame:
    """Rows of packed matrices: block, row, doc_ids, starts, cu_seqlens, ids, positions, ids_crc32.

    A document is the ids of its text, then ``end``; one longer than ``capacity`` is cut into
    pieces of that length and a rest, and ``starts`` tells where in the document a piece begins.
    ``ids`` and ``positions`` are ``capacity`` little-endian unsigned 32-bit numbers: the ids,
    filled with ``pad``, and their places, which begin anew at 0 at each of ``cu_seqlens``, the
    ends of the pieces from 0 on. The crc is of the ids without filling.

    Documents are dealt by a hash of their place into blocks, matrices of their own; best fit goes
    over the pieces of a block, longest first. The number of blocks follows the number of rows,
    so a block stays as large as it is when the table grows, also if one row repeats. A null or empty text is one
    ``end``; rows that repeat, or have no id, each count; an empty table gives no rows. Other
    columns are not read. Texts are encoded once, and the ids move once.
    """
    path = vocabulary or vocabulary_path()
    blocks = max(1, -(-docs.count() // BLOCK_DOCUMENTS))
    block = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks))
    encoded = docs.select(
        F.col(id).cast("long").alias("doc_id"),
        block.alias("block"),
        _token_ids(path, end)(text_bytes(text)).alias("ids"),
    )
    return encoded.groupBy("block").applyInArrow(
        _pack_block(path, capacity, end, pad), _ROWS_DDL
    )


def write_matrices(packed: DataFrame, folder: str) -> None:
    """Write packed rows as a Parquet table, with the rows of a block in order in one file."""
    packed.repartition("block").sortWithinPartitions("block", "row").write.parquet(folder)


def unpack(packed: DataFrame) -> DataFrame:
    """doc_id, start, ids: the pieces of packed rows, for a round trip."""

    def cut(rows: pa.Array, ends: pa.Array) -> pa.Array:
        out = []
        for raw, edge in zip(rows.to_pylist(), ends.to_pylist(), strict=True):
            ids = np.frombuffer(raw, "<u4")
            out.append([ids[a:b].tolist() for a, b in zip(edge, edge[1:], strict=False)])
        return pa.array(out, pa.list_(pa.list_(pa.int64())))

    cuts = F.arrow_udf(cut, "array<array<bigint>>")(F.col("ids"), F.col("cu_seqlens"))
    zipped = F.arrays_zip("doc_ids", "starts", cuts.alias("pieces"))
    return packed.select(F.inline(zipped)).toDF("doc_id", "start", "ids")

"""Vectors as short codes: a codebook for each part of a vector, made by Lloyd rounds.

Members stay where they are. A block is some members of one entry of one codebook; blocks are
dealt to owners by part, entry and salt. Owners add up their resident members; after an update
they assign them anew, and only members whose entry changed move, to the owners of the new one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import settle, small_side

#: Parts of a vector, entries of a codebook (256 at most), and rounds of updates.
PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Components are floor(SCALE * x), smaller than LARGEST: squares of distances then fit 64 bits.
SCALE = 256
LARGEST = 1 << 26
#: Rows of a task whose members make up blocks, and rows for each salt.
HOME_ROWS = 1 << 15
SALT_ROWS = 1 << 18
#: The part number of the blocks that hold ids and labels.
INFO = -1

Codebook = list[np.ndarray]


def whole_vectors(vectors: DataFrame, id: str, vector: str, label: str) -> DataFrame:
    """vec_id, label, v: rows with a usable vector, their components as whole numbers."""
    x = F.col(vector).cast("array<double>")
    # numbers that are not finite fail this, too: NaN is the largest of all
    usable = F.forall(x, lambda c: c.isNotNull() & (F.abs(c) < LARGEST / SCALE))
    return (
        vectors.filter(F.col(vector).isNotNull() & (F.size(vector) > 0))
        .filter(F.size(vector) % PARTS == 0)
        .filter(usable)
        .select(
            F.col(id).cast("bigint").alias("vec_id"),
            F.col(label).alias("label"),
            F.transform(x, lambda c: F.floor(c * SCALE)).alias("v"),
        )
    )


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row, the first of several, and the squared distance."""
    between = (x * x).sum(axis=1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(axis=1)
    best = between.argmin(axis=1)
    return best, between[np.arange(len(x)), best]


def _block_schema(label: pa.DataType) -> pa.Schema:
    return pa.schema(
        [
            ("home", pa.int64()),
            ("part", pa.int32()),
            ("entry", pa.int32()),
            ("salt", pa.int32()),
            ("moved", pa.bool_()),
            ("slots", pa.binary()),
            ("members", pa.binary()),
            ("vec_ids", pa.list_(pa.int64())),
            ("labels", pa.list_(label)),
        ]
    )


_BLOCKS = (
    "home bigint, part int, entry int, salt int, moved boolean, slots binary, members binary,"
    " vec_ids array<bigint>, labels array<{label}>"
)


def _split(home, part, salt, slots, x, entry, stayed=None) -> list[dict]:
    """Members of one part as a block for each entry."""
    order = np.argsort(entry, kind="stable")
    ends = np.flatnonzero(np.diff(entry[order], append=-1)) + 1
    slots, x, blocks, begin = slots[order], x[order], [], 0
    for end in ends.tolist():
        number = int(entry[order[begin]])
        blocks.append(
            {
                "home": home,
                "part": part,
                "entry": number,
                "salt": salt,
                "moved": number != stayed,
                "slots": slots[begin:end].astype("<i4").tobytes(),
                "members": x[begin:end].astype("<i4").tobytes(),
            }
        )
        begin = end
    return blocks


def _first_blocks(codebook: Codebook, salts: int, rows_each: int) -> Callable:
    width = codebook[0].shape[1]

    def first_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, waiting, held = TaskContext.get().partitionId(), 0, [], 0

        def emit() -> pa.RecordBatch:
            table = pa.Table.from_batches(waiting).combine_chunks()
            n = len(table)
            flat = table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
            parts = flat.astype(np.int64).reshape(n, PARTS, width)
            home, salt = (task << 32) + made, (task * 31 + made) % salts
            rows = [
                {
                    "home": home,
                    "part": INFO,
                    "entry": 0,
                    "salt": salt,
                    "moved": False,
                    "vec_ids": table["vec_id"].to_pylist(),
                    "labels": table["label"].to_pylist(),
                }
            ]
            for p in range(PARTS):
                x = np.ascontiguousarray(parts[:, p])
                rows += _split(home, p, salt, np.arange(n), x, nearest(x, codebook[p])[0])
            return pa.RecordBatch.from_pylist(rows, _block_schema(table["label"].type))

        for batch in batches:
            while len(batch):
                taken = batch.slice(0, rows_each - held)
                waiting.append(taken)
                held += len(taken)
                batch = batch.slice(len(taken))
                if held == rows_each:
                    yield emit()
                    made, waiting, held = made + 1, [], 0
        if held:
            yield emit()

    return first_blocks


def _members(block: dict, width: int) -> np.ndarray:
    return np.frombuffer(block["members"], "<i4").astype(np.int64).reshape(-1, width)


def _sums(width: int) -> Callable:
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for block in batch.to_pylist():
                x = _members(block, width)
                key = block["part"], block["entry"]
                own = np.append(x.sum(axis=0), len(x))
                total[key] = total[key] + own if key in total else own
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array([k[0] for k in total], pa.int32()),
                "entry": pa.array([k[1] for k in total], pa.int32()),
                "sums": pa.array([v.tolist() for v in total.values()], pa.list_(pa.int64())),
            }
        )

    return sums


def _updated(resident: DataFrame, codebook: Codebook) -> Codebook:
    """Each entry as the floor of the mean of its members; those without members stay.

    What comes to the driver is a row for each entry, ``PARTS * ENTRIES`` at most.
    """
    width = codebook[0].shape[1]
    added = (
        resident.filter(F.col("part") != INFO)
        .select("part", "entry", "members")
        .mapInArrow(_sums(width), "part int, entry int, sums array<bigint>")
        .groupBy("part", "entry")
        .agg(*[F.sum(F.col("sums")[k].cast("decimal(38,0)")) for k in range(width + 1)])
    )
    new = [entries.copy() for entries in codebook]
    for part, entry, *sums, count in added.collect():
        new[part][entry] = [int(s) // int(count) for s in sums]
    return new


def _reassigned(codebook: Codebook, label: pa.DataType) -> Callable:
    width = codebook[0].shape[1]

    def reassigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for block in batch.to_pylist():
                if block["part"] == INFO:
                    rows.append(block)
                    continue
                x = _members(block, width)
                entry, _ = nearest(x, codebook[block["part"]])
                slots = np.frombuffer(block["slots"], "<i4")
                rows += _split(
                    block["home"], block["part"], block["salt"], slots, x, entry, block["entry"]
                )
            yield pa.RecordBatch.from_pylist(rows, _block_schema(label))

    return reassigned


_CODED = pa.schema(
    [
        ("home", pa.int64()),
        ("part", pa.int32()),
        ("slots", pa.binary()),
        ("entries", pa.binary()),
        ("errors", pa.binary()),
    ]
)


def _coded(codebook: Codebook) -> Callable:
    width = codebook[0].shape[1]

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for block in batch.to_pylist():
                entry, error = nearest(_members(block, width), codebook[block["part"]])
                rows.append(
                    {
                        "home": block["home"],
                        "part": block["part"],
                        "slots": block["slots"],
                        "entries": entry.astype(np.uint8).tobytes(),
                        "errors": error.astype("<i8").tobytes(),
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, _CODED)

    return coded


def _assembled(key: tuple, info: pa.Table, blocks: pa.Table) -> pa.Table:
    """Rows of a home, from the blocks of their parts."""
    row = info.to_pylist()[0]
    n = len(row["vec_ids"])
    codes, error = np.zeros((n, PARTS), np.uint8), np.zeros(n, np.int64)
    for block in blocks.to_pylist():
        slots = np.frombuffer(block["slots"], "<i4")
        codes[slots, block["part"]] = np.frombuffer(block["entries"], np.uint8)
        error[slots] += np.frombuffer(block["errors"], "<i8")
    text = codes.tobytes().hex()
    return pa.table(
        {
            "vec_id": pa.array(row["vec_ids"], pa.int64()),
            "label": pa.array(row["labels"], info["labels"].type.value_type),
            "code": [text[2 * PARTS * i : 2 * PARTS * (i + 1)] for i in range(n)],
            "error": pa.array(error),
        }
    )


def codebooks_text(codebook: Codebook) -> str:
    """All components by part, entry and position."""
    return ",".join(str(c) for entries in codebook for entry in entries for c in entry.tolist())


def compress(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    rounds: int = ROUNDS,
    home_rows: int = HOME_ROWS,
    salt_rows: int = SALT_ROWS,
) -> tuple[DataFrame, Codebook]:
    """Codes of all vectors (vec_id, label, code, error) and the codebooks of their parts.

    Rows are left out whose vector is null, empty, holds nulls or numbers that are not finite, has a
    length that is no multiple of ``PARTS`` or is not that of the vector with the smallest id,
    or a component of ``LARGEST / SCALE`` or more, as squared distances must fit 64 bits.
    The codebooks begin as the ``ENTRIES`` smallest ids (equal ids by their components, rows
    without an id last); fewer rows make fewer entries. Rows that repeat each count; an empty
    table gives no rows and no codebook. Other columns are not read.

    An entry that draws a third of all rows has as many owners as salts, which grow with the
    table. The driver and each task hold the codebooks and sums of ``PARTS * ENTRIES`` entries.
    """
    kept = whole_vectors(vectors, id, vector, label)
    kind = dict(kept.dtypes)["label"]
    order = [F.col("vec_id").isNull(), F.col("vec_id"), F.col("v")]
    low = F.min(F.struct(*order[:2], F.size("v").alias("length")))
    count, first = kept.agg(F.count("*"), low).first()
    if not count:
        return kept.selectExpr(
            "vec_id", "label", "cast(null as string) code", "cast(null as bigint) error"
        ), []
    length = first["length"]
    kept = kept.filter(F.size("v") == length)
    seeds = np.array([r["v"] for r in kept.orderBy(*order).limit(ENTRIES).collect()], np.int64)
    codebook = [np.ascontiguousarray(c) for c in np.split(seeds, PARTS, axis=1)]
    salts = max(1, -(-count // salt_rows))
    blocks = _BLOCKS.format(label=kind)
    owner = ("part", "entry", "salt")
    resident = settle(
        kept.mapInArrow(_first_blocks(codebook, salts, home_rows), blocks).repartition(*owner)
    )
    arrow_label = _arrow_type(vectors, label)
    for last in range(rounds - 1, -1, -1):
        codebook = _updated(resident, codebook)
        if last:
            again = settle(resident.mapInArrow(_reassigned(codebook, arrow_label), blocks))
            moving = settle(again.filter("moved").repartition(*owner))
            resident = again.filter("not moved").union(moving)
    members = resident.filter(F.col("part") != INFO).select("home", "part", "slots", "members")
    coded = members.mapInArrow(
        _coded(codebook),
        "coded_home bigint, part int, slots binary, entries binary, errors binary",
    )
    info = resident.filter(F.col("part") == INFO).select("home", "vec_ids", "labels")
    rows = (
        info.groupBy("home")
        .cogroup(coded.groupBy("coded_home"))
        .applyInArrow(_assembled, f"vec_id bigint, label {kind}, code string, error bigint")
    )
    return rows, codebook


def _arrow_type(vectors: DataFrame, label: str) -> pa.DataType:
    return vectors.select(label).limit(0).toArrow().schema.field(0).type


def code_table(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256: a row for each vector kept.

    ``label_error`` adds ``error`` up over rows with the same label, those without one together.
    See ``compress`` for rows that are left out.
    """
    rows, codebook = compress(vectors)
    rows = settle(rows)
    totals = settle(
        rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    )
    digest = hashlib.sha256(codebooks_text(codebook).encode()).hexdigest()
    return rows.join(small_side(totals), F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )


def _sql_round(number: int, last: bool) -> str:
    """An assignment to the codebook ``c<number>`` and, if it is not the last, an update."""
    assign = f"""
a{number} AS MATERIALIZED (
  SELECT row, p, min({ENTRIES} * d + e) AS best FROM (
    SELECT row, p, e, CAST(list_sum(list_transform(list_zip(x, c),
      lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
    FROM parts JOIN c{number} USING (p)) GROUP BY row, p
)"""
    if last:
        return assign
    return f"""{assign},
s{number} AS (
  SELECT p, e, k, sum(x) AS s, count(*) AS n FROM (
    SELECT p, best % {ENTRIES} AS e, unnest(x) AS x, generate_subscripts(x, 1) AS k
    FROM a{number} JOIN parts USING (row, p)) GROUP BY p, e, k
),
m{number} AS (
  SELECT p, e, list(CAST((s - ((s % n) + n) % n) / n AS BIGINT) ORDER BY k) AS c
  FROM s{number} GROUP BY p, e
),
c{number + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(m.c, o.c) AS c FROM c{number} o LEFT JOIN m{number} m USING (p, e)
)"""


#: The same with all distances in one join, for engines without Spark.
SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS row FROM (
    SELECT vec_id, label,
      list_transform(embedding, lambda x: CAST(floor({SCALE} * x::DOUBLE) AS BIGINT)) AS v
    FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false))))
),
parts AS MATERIALIZED (
  SELECT row, p, v[len(v) // {PARTS} * p + 1 : len(v) // {PARTS} * (p + 1)] AS x
  FROM kept, range({PARTS}) AS t(p)
),
c0 AS MATERIALIZED (SELECT p, row AS e, x AS c FROM parts WHERE row < {ENTRIES}),
{",".join(_sql_round(r, r == ROUNDS) for r in range(ROUNDS + 1))},
coded AS MATERIALIZED (
  SELECT row, string_agg(lpad(lower(hex(best % {ENTRIES})), 2, '0'), '' ORDER BY p) AS code,
    CAST(sum(best // {ENTRIES}) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY row
),
books AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256
  FROM c{ROUNDS}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  codebooks_sha256
FROM kept JOIN coded USING (row) CROSS JOIN books
"""

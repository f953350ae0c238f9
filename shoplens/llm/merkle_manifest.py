"""Merkle manifest of a table: a tree of three-way hashes per source, proofs for every row.

Proofs are made as octopus multiproofs: a task that holds a part of the leaves works out the
smallest set of nodes that it lacks, gets each of them once, derives the inner nodes that its
leaves share and only then spells out the proof of each leaf.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.common import settle, small_side

#: Children of a node.
FAN = 3
#: Levels that one task builds at a time: a block has FAN ** LEVELS = 6,561 nodes at most.
LEVELS = 8
#: Leaves whose proofs are made together.
PART_LEAVES = 1 << 15
#: The tree over the roots of all sources; those of the sources are numbered from 0.
TOP = -1

LENT = ("part", "tree", "level", "idx", "hash")

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


class Manifest(NamedTuple):
    """``leaves``: doc_id, leaf, bent, part, tree, idx, n. ``nodes``: tree, level, idx, hash."""

    leaves: DataFrame
    nodes: DataFrame
    root: str | None


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def _leaf(values: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(_field, values)), 256))


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def width(n: int, level: int) -> int:
    """Nodes at a level of a tree with ``n`` leaves."""
    return -(-n // FAN**level)


def height(n: int) -> int:
    """The level of the root of a tree with ``n`` leaves."""
    level = 0
    while width(n, level) > 1:
        level += 1
    return level


def _children(parents: np.ndarray, below: int) -> np.ndarray:
    """Numbers of all children of some nodes, of ``below`` at their level."""
    all_ = (parents[:, None] * FAN + np.arange(FAN)).ravel()
    return all_[all_ < below]


def missing(known: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(level, numbers) of the fewest nodes that lead from some leaves of a tree to its root."""
    known = np.unique(known)
    for level in range(height(n)):
        parents = np.unique(known // FAN)
        yield level, np.setdiff1d(_children(parents, width(n, level)), known)
        known = parents


def _numbered(
    rows: DataFrame, keys: list[Column | str], name: str, part_leaves: int
) -> DataFrame:
    """Settled rows with their place in the order of ``keys``, from 0 on; no task has all."""
    parts = max(1, -(-rows.count() // part_leaves))
    place = F.monotonically_increasing_id()
    # rows that are equal in all keys are told apart by where they lie, so that they can be dealt
    apart = rows.withColumn("tie", place)
    spread = (
        apart.repartitionByRange(parts, *keys, "tie")
        .sortWithinPartitions(*keys, "tie")
        .drop("tie")
        .withColumn("slot", place)
    )
    dealt = settle(
        spread.select(
            "*",
            F.shiftright("slot", 33).alias("task"),
            F.col("slot").bitwiseAND((1 << 33) - 1).alias("rank"),
        ).drop("slot")
    )
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    begins = (
        dealt.groupBy("task")
        .agg(F.count("*").alias("held"))
        .select("task", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("begin"))
    )
    return (
        dealt.join(small_side(settle(begins)), "task")
        .withColumn(name, F.col("begin") + F.col("rank"))
        .drop("task", "rank", "begin")
    )


_NODES_DDL = "tree bigint, n bigint, level int, idx bigint, hash binary"
_NODES = pa.schema(
    [
        ("tree", pa.int64()),
        ("n", pa.int64()),
        ("level", pa.int32()),
        ("idx", pa.int64()),
        ("hash", pa.binary()),
    ]
)


def _block_builder(built: int):
    def build_block(key: tuple, block: pa.Table) -> pa.Table:
        """All nodes above those of a block, up to ``built`` levels."""
        block = block.sort_by("idx")
        tree, n, level = (block[c][0].as_py() for c in ("tree", "n", "level"))
        at = block["idx"][0].as_py()
        now = [h.hex() for h in block["hash"].to_pylist()]
        top = min(level + built, height(n))
        levels, places, hashes = [], [], []
        while level < top:
            now = [digest(now[i : i + FAN]) for i in range(0, len(now), FAN)]
            at, level = at // FAN, level + 1
            levels += [level] * len(now)
            places += range(at, at + len(now))
            hashes += map(bytes.fromhex, now)
        return pa.Table.from_arrays(
            [
                pa.array([tree] * len(levels), pa.int64()),
                pa.array([n] * len(levels), pa.int64()),
                pa.array(levels, pa.int32()),
                pa.array(places, pa.int64()),
                pa.array(hashes, pa.binary()),
            ],
            schema=_NODES,
        )

    return build_block


def _grown(leaves: DataFrame, largest: int, built: int) -> DataFrame:
    """All nodes of trees, from their leaves (columns of ``_NODES_DDL``) on."""
    every, now = leaves, leaves
    for low in range(0, height(largest), built):
        # trees that end at this level have nothing above
        open_ = now.filter(F.col("n") > FAN**low)
        up = settle(
            open_.groupBy("tree", F.floor(F.col("idx") / FAN**built).alias("block"))
            .applyInArrow(_block_builder(built), _NODES_DDL)
        )
        every = every.unionByName(up)
        now = up.filter(F.col("level") == low + built)
    return every


def build(docs: DataFrame, part_leaves: int = PART_LEAVES, levels: int = LEVELS) -> Manifest:
    """The leaves, all nodes and the root of the manifest of a table of documents.

    A leaf is the hash of ``FIELDS``. Leaves of a source are in the order of doc_id, those
    without an id first; rows with the same id are ordered by their hash, and rows that are equal
    each have a leaf. Rows without a source are a source of their own, the first. ``bent`` is
    the hash of the row after tampering, null if that changes nothing: rows whose id has an
    even crc-32 lose the line breaks of their text. An empty table has no root. Columns other
    than ``FIELDS`` are not read.
    """
    column = {name: F.col(name) for name in FIELDS}
    bare = column | {"text": F.replace("text", F.lit("\n"), F.lit(""))}
    bends = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.contains(
        F.col("text"), F.lit("\n")
    )
    hashed = settle(
        docs.select(
            "doc_id",
            "source",
            _leaf([column[f] for f in FIELDS]).alias("leaf"),
            F.when(bends, _leaf([bare[f] for f in FIELDS])).alias("bent"),
        )
    )
    order = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf")]
    ranked = settle(_numbered(hashed, order, "at", part_leaves))
    sources = settle(
        ranked.groupBy("source").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    )
    trees = settle(
        _numbered(sources, ["first"], "tree", part_leaves).withColumnRenamed("source", "of")
    )
    leaves = settle(
        ranked.join(small_side(trees), F.col("source").eqNullSafe(F.col("of"))).select(
            "doc_id",
            "leaf",
            "bent",
            F.floor(F.col("at") / part_leaves).alias("part"),
            "tree",
            (F.col("at") - F.col("first")).alias("idx"),
            "n",
        )
    )
    many, largest = trees.agg(F.count("*"), F.max("n")).first()
    if not many:
        return Manifest(leaves, leaves.selectExpr("tree", "n", "0 level", "idx", "leaf hash"), None)
    low = leaves.selectExpr("tree", "n", "0 as level", "idx", "leaf as hash")
    nodes = _grown(low, largest, levels)
    tops = trees.select("tree", _height_of(F.col("n"), largest).alias("level")).join(
        nodes.filter("idx = 0"), ["tree", "level"]
    )
    subroots = settle(
        tops.select(
            F.lit(TOP).cast("bigint").alias("tree"),
            F.lit(many).cast("bigint").alias("n"),
            F.lit(0).alias("level"),
            F.col("tree").alias("idx"),
            "hash",
        )
    )
    crown = _grown(subroots, many, levels)
    root = crown.filter(F.col("level") == height(many)).first()["hash"].hex()
    nodes = nodes.unionByName(crown).select("tree", "level", "idx", "hash")
    return Manifest(leaves.withColumn("trees", F.lit(many).cast("bigint")), nodes, root)


def _height_of(n: Column, largest: int) -> Column:
    """``height`` as a column, for trees of at most ``largest`` leaves."""
    level = F.lit(0)
    for k in range(height(largest)):
        level = level + F.when(n > FAN**k, 1).otherwise(0)
    return level


def _lacking(key: tuple, runs: pa.Table) -> pa.Table:
    """The coordinates that a part lacks: (part, tree, level, idx), each once."""
    levels, trees, places = [], [], []

    def lack(tree: int, known: np.ndarray, n: int) -> None:
        for level, idx in missing(known, n):
            trees.extend([tree] * len(idx))
            levels.extend([level] * len(idx))
            places.extend(idx.tolist())

    for run in runs.to_pylist():
        lack(run["tree"], np.arange(run["low"], run["high"] + 1), run["n"])
    lack(TOP, runs["tree"].to_numpy(), runs["trees"][0].as_py())
    return pa.table(
        {
            "part": pa.array([key[0].as_py()] * len(trees), pa.int64()),
            "tree": pa.array(trees, pa.int64()),
            "level": pa.array(levels, pa.int32()),
            "idx": pa.array(places, pa.int64()),
        }
    )


def multiproofs(made: Manifest) -> DataFrame:
    """part, tree, level, idx, hash: what each part of the leaves needs beside them, once."""
    runs = made.leaves.groupBy("part", "tree", "n", "trees").agg(
        F.min("idx").alias("low"), F.max("idx").alias("high")
    )
    wanted = settle(
        runs.groupBy("part").applyInArrow(
            _lacking, "part bigint, tree bigint, level int, idx bigint"
        )
    )
    return made.nodes.join(small_side(wanted), ["tree", "level", "idx"]).select(*LENT)


class _Siblings:
    """Left and right siblings of all nodes above some leaves of one tree."""

    def __init__(self, known: dict[int, str], n: int, lent: dict[tuple[int, int], str]):
        self.levels: list[dict[int, tuple[str, str]]] = []
        for level in range(height(n)):
            most, beside, above = width(n, level), {}, {}
            for parent in sorted({i // FAN for i in known}):
                kids = range(parent * FAN, min(parent * FAN + FAN, most))
                hashes = [known.get(i) or lent[level, i] for i in kids]
                above[parent] = digest(hashes)
                for k, i in enumerate(kids):
                    if i in known:
                        beside[i] = "".join(hashes[:k]), "".join(hashes[k + 1 :])
            self.levels.append(beside)
            known = above
        self.root = known[0]

    def of(self, leaf: int) -> list[tuple[str, str]]:
        found = []
        for beside in self.levels:
            found.append(beside[leaf])
            leaf //= FAN
        return found


def fold(leaf: str, proof: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings lead to."""
    for left, right in proof:
        leaf = digest([left, leaf, right])
    return leaf


_PROVED = (
    "doc_id {id}, leaf string, subroot string, root string, proof_sha256 string,"
    " folded_root string, verified boolean"
)


def _prover(root: str):
    def prove_part(key: tuple, leaves: pa.Table, lent: pa.Table) -> pa.Table:
        leaves = leaves.sort_by([("tree", "ascending"), ("idx", "ascending")])
        lent_to: dict[int, dict[tuple[int, int], str]] = {}
        for node in lent.to_pylist():
            place = node["lent_level"], node["lent_idx"]
            lent_to.setdefault(node["lent_tree"], {})[place] = node["lent_hash"].hex()
        trees = leaves["tree"].to_pylist()
        places = leaves["idx"].to_pylist()
        own = [h.hex() for h in leaves["leaf"].to_pylist()]
        sizes = dict(zip(trees, leaves["n"].to_pylist(), strict=True))
        known: dict[int, dict[int, str]] = {}
        for tree, idx, leaf in zip(trees, places, own, strict=True):
            known.setdefault(tree, {})[idx] = leaf
        within = {t: _Siblings(known[t], n, lent_to.get(t, {})) for t, n in sizes.items()}
        subroots = {t: within[t].root for t in sizes}
        crown = _Siblings(subroots, leaves["trees"][0].as_py(), lent_to.get(TOP, {}))
        above = {t: crown.of(t) for t in sizes}
        proofs, folded = [], []
        for tree, idx, leaf, bent in zip(
            trees, places, own, leaves["bent"].to_pylist(), strict=True
        ):
            proof = within[tree].of(idx) + above[tree]
            proofs.append(digest([side for pair in proof for side in pair]))
            folded.append(fold(bent.hex() if bent else leaf, proof))
        return pa.table(
            {
                "doc_id": leaves["doc_id"],
                "leaf": own,
                "subroot": [subroots[t] for t in trees],
                "root": [root] * len(own),
                "proof_sha256": proofs,
                "folded_root": folded,
                "verified": pa.array([f == root for f in folded], pa.bool_()),
            }
        )

    return prove_part


def prove(docs: DataFrame, part_leaves: int = PART_LEAVES, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: a row for each of ``docs``.

    ``proof_sha256`` is of the siblings from the leaf up to the root; ``folded_root`` is what the
    leaf, tampered with where ``build`` says so, and the siblings of the untouched table lead to.
    Nulls, repeated rows and the empty table are as in ``build``.

    What moves are hashes, never texts: the leaves three times, and for each part of
    ``part_leaves`` leaves some hundred nodes at most beside one for each source that it ends in.
    """
    made = build(docs, part_leaves, levels)
    kind = dict(made.leaves.dtypes)["doc_id"]
    if made.root is None:
        hashes = ("leaf", "subroot", "root", "proof_sha256", "folded_root")
        none = [F.lit(None).cast("string").alias(c) for c in hashes]
        return made.leaves.select("doc_id", *none, F.lit(None).cast("boolean").alias("verified"))
    lent = multiproofs(made).toDF(*(f"lent_{c}" for c in LENT)).groupBy("lent_part")
    return (
        made.leaves.groupBy("part")
        .cogroup(lent)
        .applyInArrow(_prover(made.root), _PROVED.format(id=kind))
    )


#: The same by lists of all nodes of a level, for engines without Spark.
SQL = r"""
WITH RECURSIVE fields AS (
  SELECT doc_id, source, text, concat(
      CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END,
      CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END,
      CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END,
      CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END
    ) AS head,
    list_reduce(list_prepend(4294967295::UBIGINT,
        list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)::UBIGINT[]),
        lambda x, k: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))) AS crc
  FROM documents
),
leaves AS MATERIALIZED (
  SELECT doc_id, source, leaf,
    CASE WHEN (xor(crc, 4294967295::UBIGINT) & 1) = 0 AND text IS NOT NULL
      THEN sha256(head || strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''))
      ELSE leaf END AS bent,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx
  FROM (SELECT *, sha256(head || CASE WHEN text IS NULL THEN '-'
    ELSE strlen(text) || ':' || text END) AS leaf FROM fields)
),
levels AS (
  SELECT source, 0 AS level, list(leaf ORDER BY idx) AS nodes FROM leaves GROUP BY source
  UNION ALL
  SELECT source, level + 1, list_transform(range(0, len(nodes), 3),
    lambda i: sha256(array_to_string(nodes[i + 1 : i + 3], ''))) FROM levels WHERE len(nodes) > 1
),
subroots AS MATERIALIZED (
  SELECT source, nodes[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree
  FROM levels WHERE len(nodes) = 1
),
crown AS (
  SELECT 0 AS level, list(subroot ORDER BY tree) AS nodes FROM subroots
  UNION ALL
  SELECT level + 1, list_transform(range(0, len(nodes), 3),
    lambda i: sha256(array_to_string(nodes[i + 1 : i + 3], ''))) FROM crown WHERE len(nodes) > 1
),
steps AS MATERIALIZED (
  SELECT 0 AS tier, source, level, nodes FROM levels WHERE len(nodes) > 1
  UNION ALL
  SELECT 1, s.source, c.level, c.nodes FROM crown c, subroots s WHERE len(c.nodes) > 1
),
climb AS MATERIALIZED (
  SELECT l.source, l.idx, t.tier, t.level,
    CAST(floor(CASE t.tier WHEN 0 THEN l.idx ELSE s.tree END / power(3, t.level)) AS BIGINT) AS place,
    t.nodes
  FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source
  JOIN steps t ON l.source IS NOT DISTINCT FROM t.source
),
sides AS MATERIALIZED (
  SELECT source, idx, row_number() OVER (PARTITION BY source, idx ORDER BY tier, level) AS step,
    array_to_string(nodes[place - place % 3 + 1 : place], '') AS lefts,
    array_to_string(nodes[place + 2 : place - place % 3 + 3], '') AS rights
  FROM climb
),
fold AS (
  SELECT source, idx, 1 AS step, bent AS hash FROM leaves
  UNION ALL
  SELECT f.source, f.idx, f.step + 1, sha256(s.lefts || f.hash || s.rights)
  FROM fold f JOIN sides s
    ON f.source IS NOT DISTINCT FROM s.source AND f.idx = s.idx AND f.step = s.step
),
ends AS (SELECT source, idx, arg_max(hash, step) AS folded_root FROM fold GROUP BY 1, 2),
proofs AS (
  SELECT source, idx, sha256(string_agg(lefts || rights, '' ORDER BY step)) AS proof_sha256
  FROM sides GROUP BY 1, 2
),
top AS (SELECT nodes[1] AS root FROM crown WHERE len(nodes) = 1)
SELECT l.doc_id, l.leaf, s.subroot, top.root,
  coalesce(p.proof_sha256, sha256('')) AS proof_sha256, e.folded_root,
  e.folded_root = top.root AS verified
FROM leaves l
JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source
JOIN ends e ON l.source IS NOT DISTINCT FROM e.source AND l.idx = e.idx
LEFT JOIN proofs p ON l.source IS NOT DISTINCT FROM p.source AND l.idx = p.idx
CROSS JOIN top
"""

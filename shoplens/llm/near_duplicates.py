"""Near duplicates: SuperMinHash signatures, banding, verification on full sets, union-find.

SuperMinHash gives each element a random permutation of the places of the signature and, at the
place that its permutation names j-th, the value j plus a random fraction. A signature holds the
smallest value at each place. All elements of a document take their j-th step together here, and
no step follows once all places hold less than its value: the early stopping of the method.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import settle, small_side, text_bytes
from shoplens.llm.components import components

#: Words of a shingle where no other number is given, and the least percentage of shared shingles
#: that links documents.
SHINGLE = 4
PERCENT = 80
#: Bands and rows: at a similarity of 0.8 a pair meets in no band once in 20 million times.
BANDS = 32
ROWS = 4
PLACES = BANDS * ROWS
#: Shingles whose signatures are made together, and words whose hashes a worker remembers.
AT_ONCE = 1 << 15
MEMO_WORDS = 100_000
#: Rows of a bucket whose pairs one task forms; those of larger buckets are dealt over cells.
CELL = 512

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
_FACTORS = np.array(
    [
        0xD6E8FEB86659FD93,
        0xA0761D6478BD642F,
        0xE7037ED1A0B428DB,
        0x8EBC6AF09C88C6E3,
        0x589965CC75374CC3,
    ],
    _U,
)
_STEPS = np.arange(1, PLACES + 1, dtype=_U) * _STEP
_EMPTY = _U(0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < MEMO_WORDS:
            self[word] = value
        return value


_words = _WordHashes()


def shingles(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the different shingles of a text."""
    words = text.lower().split()
    if not words:
        return np.empty(0, _U)
    hashes = np.fromiter(map(_words.__getitem__, words), _U, len(words))
    size = min(shingle, len(words))
    n = len(words) - size + 1
    total = np.full(n, _U(size), _U)
    for k in range(size):
        total = mix(total + hashes[k : k + n] * _FACTORS[k % len(_FACTORS)])
    return np.unique(total)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of ``PLACES`` values for each nonempty set: step * 2^32 + fraction."""
    sizes = np.array([len(s) for s in sets])
    values = np.full((len(sets), PLACES), _EMPTY, _U)
    flat = values.reshape(-1)
    doc = np.repeat(np.arange(len(sets)), sizes)
    element = np.concatenate(sets) if sets else np.empty(0, _U)
    order = None  # for each element left, its permutation
    for step in range(PLACES):
        draw = mix(element + _STEPS[step])
        other = step + (((draw & _U(0xFFFFFFFF)) * _U(PLACES - step)) >> _U(32)).astype(np.int64)
        if order is None:
            place = other
        else:
            rows = np.arange(len(element))
            place = order[rows, other].astype(np.int64)
            order[rows, other] = order[:, step]
            order[:, step] = place
        np.minimum.at(flat, doc * PLACES + place, (_U(step) << _U(32)) + (draw >> _U(32)))
        open_ = values.max(axis=1) >= _U(step + 1) << _U(32)
        left = open_[doc]
        if not left.any():
            break
        if order is None:
            order = np.tile(np.arange(PLACES, dtype=np.uint8), (int(left.sum()), 1))
            first = place[left]
            rows = np.arange(len(order))
            order[rows, first] = 0
            order[:, 0] = first
        elif not left.all():
            order = order[left]
        element, doc = element[left], doc[left]
    return values


def bands(values: np.ndarray) -> np.ndarray:
    """The bucket of each signature in each band."""
    parts = values.reshape(len(values), BANDS, ROWS)
    total = np.broadcast_to(_STEPS[:BANDS], parts.shape[:2])
    for k in range(ROWS):
        total = mix(total + parts[:, :, k] * _FACTORS[k % 4])
    return total.view(np.int64)


def set_key(found: np.ndarray) -> tuple[int, int]:
    key = xxhash.xxh3_128_digest(found.tobytes())
    return int.from_bytes(key[:8], "little", signed=True), int.from_bytes(
        key[8:], "little", signed=True
    )


_LONGS = pa.list_(pa.int64())


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def _sign(texts: pa.Array, shingle: int) -> pa.Array:
    sizes, keys, buckets = [], [], []
    waiting: list[np.ndarray] = []

    def sign_waiting() -> None:
        full = [s for s in waiting if len(s)]
        rows = iter(bands(signatures(full)) if full else ())
        buckets.extend(next(rows) if len(s) else np.empty(0, np.int64) for s in waiting)
        waiting.clear()

    gathered = 0
    for text in texts:
        found = shingles(text.as_py(), shingle)
        sizes.append(len(found))
        keys.append(set_key(found))
        waiting.append(found)
        gathered += len(found)
        if gathered >= AT_ONCE:
            sign_waiting()
            gathered = 0
    sign_waiting()
    return pa.StructArray.from_arrays(
        [
            pa.array(sizes, pa.int64()),
            pa.array([k[0] for k in keys], pa.int64()),
            pa.array([k[1] for k in keys], pa.int64()),
            _lists(buckets),
        ],
        names=["n_shingles", "k1", "k2", "bands"],
    )


def _sets(texts: pa.Array, shingle: int) -> pa.Array:
    found = [shingles(text.as_py(), shingle) for text in texts]
    keys = [set_key(s) for s in found]
    return pa.StructArray.from_arrays(
        [
            pa.array([k[0] for k in keys], pa.int64()),
            pa.array([k[1] for k in keys], pa.int64()),
            _lists(found),
        ],
        names=["k1", "k2", "items"],
    )


def sign(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, ``keep``, n_shingles, (k1, k2) that tell sets apart, bands (none without a word)."""

    def of_texts(texts: pa.Array) -> pa.Array:
        return _sign(texts, shingle)

    signed = F.arrow_udf(
        of_texts, "struct<n_shingles:bigint,k1:bigint,k2:bigint,bands:array<bigint>>"
    ).asNondeterministic()
    return docs.select(
        F.col(id).alias("doc_id"), *keep, signed(text_bytes(text)).alias("s")
    ).select("doc_id", *keep, "s.*")


def _sets_of(
    nodes: DataFrame, classes: DataFrame, docs: DataFrame, id: str, text: str, shingle: int
) -> DataFrame:
    """node, items: the full sets of some nodes."""

    def of_texts(texts: pa.Array) -> pa.Array:
        return _sets(texts, shingle)

    wanted = settle(
        classes.join(nodes, "node").select("node", F.col("k1").alias("c1"), F.col("k2").alias("c2"))
    )
    make = F.arrow_udf(of_texts, "struct<k1:bigint,k2:bigint,items:array<bigint>>")
    return settle(
        docs.select(F.col(id).alias("node"), text_bytes(text).alias("text"))
        .join(small_side(wanted), "node")
        .withColumn("s", make.asNondeterministic()("text"))
        .filter("s.k1 = c1 and s.k2 = c2")
        .select("node", "s.items")
    )


def _laid_side_by_side(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b and their sets x, y."""
    one = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
    two = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    return pairs.join(one, "a").join(two, "b")


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, the sizes of their sets, how many elements they share, whether that links them."""
    shared = F.size(F.array_intersect("x", "y"))
    both = F.col("size_a") + F.col("size_b") - F.col("shared")
    return (
        _laid_side_by_side(pairs, sets)
        .select(
            "a",
            "b",
            F.size("x").alias("size_a"),
            F.size("y").alias("size_b"),
            shared.alias("shared"),
        )
        .distinct()
        .withColumn("linked", 100 * F.col("shared") >= PERCENT * both)
    )


def _with_component(members: DataFrame, labels: DataFrame) -> DataFrame:
    return members.join(labels, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )


def _lonely(stars: DataFrame, sets: DataFrame) -> DataFrame:
    """a, node, lonely: elements of a node that neither ``a`` nor another node of its stars has."""
    extra = _laid_side_by_side(
        stars.select("a", F.col("node").alias("b")).distinct(), sets
    ).select("a", "b", F.explode(F.array_except("y", "x")).alias("item"))
    return (
        extra.groupBy("a", "item")
        .agg(F.min("b").alias("node"), F.max("b").alias("last"))
        .filter("node = last")
        .groupBy("a", "node")
        .agg(F.count("*").alias("lonely"))
    )


def _crowded(rows: DataFrame) -> DataFrame:
    """bucket, cells: into how many parts the rows of a bucket of more than ``CELL`` are dealt."""
    return (
        rows.groupBy("bucket")
        .agg(F.ceil(F.count("*") / CELL).cast("int").alias("cells"))
        .filter("cells > 1")
    )


def _in_cells(rows: DataFrame, crowded: DataFrame, own: str, other: str) -> DataFrame:
    """``rows`` with the cells of their bucket's square: its own line, each column, or turned.

    A bucket that is not crowded has one cell. Each pair of rows meets in one cell, which holds
    about ``CELL`` rows of either side, so no task gets all pairs of a crowded bucket.
    """
    node = "node" if "node" in rows.columns else "node_2"
    return (
        rows.join(crowded, "bucket", "left")
        .withColumn("cells", F.coalesce("cells", F.lit(1)))
        .withColumn(own, F.pmod(F.xxhash64(node), F.col("cells")).cast("int"))
        .withColumn(other, F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
        .drop("cells")
    )


def linked(
    signed: DataFrame, docs: DataFrame, id: str, text: str, shingle: int = SHINGLE
) -> tuple[DataFrame, DataFrame]:
    """Classes of equal sets (k1, k2, node) and the components of their nodes.

    A node is the smallest id of a class, so copies are one node from here on. Each bucket of a
    band is a star: its head, the node that meets most others, is compared with all others.
    What then lies in different components of a bucket is compared, too, unless its distances
    from the head rule a link out: sets x and y that differ from the head in d(x) and d(y)
    elements differ from each other in at least d(x) + d(y) - 2 min(t(x), t(y)), where t leaves
    out the elements that no other set of the star has. So no link between nodes that meet in a
    band is lost, and a group of copies does not become all its pairs. The rows of a crowded
    bucket are dealt over the cells of a square, so its pairs are the work of many tasks.
    """
    classes = settle(
        signed.filter("n_shingles > 0 and doc_id is not null")
        .groupBy("k1", "k2")
        .agg(F.min("doc_id").alias("node"), F.any_value("bands").alias("bands"))
    )
    members = classes.select("node", F.explode("bands").alias("bucket"))
    several = members.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    met = settle(members.join(several, "bucket"))
    meets = met.groupBy("node").agg(F.sum("n").alias("meets"))
    heads = (
        met.join(meets, "node")
        .groupBy("bucket")
        .agg(F.max(F.struct("meets", (-F.col("node")).alias("node"))).alias("head"))
        .select("bucket", (-F.col("head.node")).alias("a"))
    )
    stars = settle(met.join(heads, "bucket").filter("a != node").select("bucket", "a", "node"))
    sets = _sets_of(met.select("node").distinct(), classes, docs, id, text, shingle)
    tried = settle(
        _compared(stars.select("a", F.col("node").alias("b")).distinct(), sets)
    )
    links = tried.filter("linked").select("a", "b")
    labels = components(links)

    of_head = labels.select(F.col("node").alias("a"), F.col("component").alias("of_a"))
    placed = (
        _with_component(stars, labels)
        .join(of_head, "a", "left")
        .withColumn("of_a", F.coalesce("of_a", "a"))
    )
    mixed = placed.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    )
    open_ = settle(
        placed.join(mixed.filter("low < high").select("bucket"), "bucket", "left_semi")
    )
    if open_.isEmpty():
        return classes, labels
    distance = F.col("size_a") + F.col("size_b") - 2 * F.col("shared")
    measured = tried.select(
        "a", F.col("b").alias("node"), F.col("size_b").alias("size"), distance.alias("d")
    )
    # sets of sizes n and m are linked if they differ in (n + m) * near elements at most, and
    # then the smaller has PERCENT of the larger
    near = (100 - PERCENT) / (100 + PERCENT) + 1e-9
    rated = settle(
        open_.join(measured, ["a", "node"])
        .join(_lonely(open_, sets), ["a", "node"], "left")
        .withColumn("lonely", F.coalesce("lonely", F.lit(0)))
        .withColumn("t", F.col("d") - F.col("lonely"))
        .filter(F.col("lonely") <= near * (1 + 100 / PERCENT) * F.col("size"))
    )
    # a bound that rules a pair out in one bucket rules it out in all, so the first one decides
    of_node = rated.groupBy("node").agg(F.collect_set("bucket").alias("buckets"))
    rated = settle(rated.join(of_node, "node"))
    one = rated.filter("component != of_a")
    told_apart = ("node", "component", "d", "t", "size", "buckets")
    two = rated.select("bucket", *[F.col(c).alias(f"{c}_2") for c in told_apart])
    possible = (
        (F.col("component") != F.col("component_2"))
        & ((F.col("component_2") == F.col("of_a")) | (F.col("node") < F.col("node_2")))
        & (
            F.col("d") + F.col("d_2") - 2 * F.least("t", "t_2")
            <= near * (F.col("size") + F.col("size_2"))
        )
        & (F.array_min(F.array_intersect("buckets", "buckets_2")) == F.col("bucket"))
    )
    crowded = small_side(settle(_crowded(rated)))
    pairs = (
        _in_cells(one, crowded, "line", "column")
        .join(_in_cells(two, crowded, "column", "line"), ["bucket", "line", "column"])
        .filter(possible)
        .select(F.least("node", "node_2").alias("a"), F.greatest("node", "node_2").alias("b"))
        .distinct()
    )
    more = settle(_compared(pairs, sets).filter("linked").select("a", "b"))
    return classes, labels if more.isEmpty() else components(links.union(more))


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: a row for each different id of ``docs``.

    Documents are linked if their sets of shingles of ``shingle`` words share ``PERCENT`` of their
    union, and a component is named by its smallest id, whose document is the one kept. Documents without a
    word are linked with nothing. If an id has several rows, it has all their links. Rows
    without an id stay as they are, unlinked and kept, with a null component. An empty table
    gives an empty one; other columns are not read.
    """
    signed = settle(sign(docs, id, text, shingle))
    classes, labels = linked(signed, docs, id, text, shingle)
    nodes = _with_component(classes.select("k1", "k2", "node"), labels).drop("node")
    rows = signed.select("doc_id", "n_shingles", "k1", "k2").join(nodes, ["k1", "k2"], "left")
    named = (
        rows.filter("doc_id is not null")
        .groupBy("doc_id")
        .agg(
            F.max("n_shingles").alias("n_shingles"),
            F.least(F.min("component"), F.col("doc_id")).alias("component_id"),
        )
    )
    none = rows.filter("doc_id is null").select(
        "doc_id", "n_shingles", F.lit(None).cast("bigint").alias("component_id")
    )
    kept: Column = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return named.union(none).withColumn("kept", kept)


def keep_one(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one row of each component.

    Rows are told apart by a hash of their id and text, so rows that share an id, or have none,
    are judged by their own texts. Of a component the row with the smallest id stays (those
    without an id last, of equal ids the smallest hash), of rows that repeat in both any one. Rows
    without a word all stay. Texts move between machines only if the rows that go, or those
    that repeat, are too many to broadcast.
    """
    row = F.xxhash64(F.col(id), F.col(text))
    keyed = docs.select(row.alias("row"), F.col(id).alias("id"), F.col(text).alias("text"))
    ids = settle(sign(keyed, "row", "text", shingle, keep=("id",)))
    classes, labels = linked(ids.drop("id"), keyed.select("row", "text"), "row", "text", shingle)
    component = _with_component(classes.select("k1", "k2", "node"), labels).drop("node")
    rows = settle(ids.filter("n_shingles > 0").join(component, ["k1", "k2"]))
    first = rows.groupBy("component").agg(
        F.min(F.struct(F.col("id").isNull().alias("last"), "id", "doc_id")).alias("first"),
        F.count("*").alias("n"),
    )
    one = first.filter("n > 1").select("component", F.col("first.doc_id").alias("stays"))
    gone = settle(
        rows.join(one, "component")
        .filter("doc_id != stays")
        .select(F.col("doc_id").alias("row"))
        .distinct()
    )
    again = settle(
        rows.groupBy(F.col("doc_id").alias("row")).count().filter("count > 1").select("row")
    )
    whole = docs.select(F.struct("*").alias("doc"), row.alias("row"))
    stay = whole.join(small_side(gone), "row", "left_anti")
    if again.isEmpty():
        return stay.select("doc.*")
    many = small_side(again)
    once = stay.join(many, "row", "left_semi").groupBy("row").agg(F.first("doc").alias("doc"))
    single = stay.join(many, "row", "left_anti")
    return single.select("doc.*").unionByName(once.select("doc.*"))


#: The same over all pairs that share a shingle, for engines without Spark.
SQL = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {SHINGLE}
    THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - {SHINGLE - 2}),
      lambda i: array_to_string(w[i : i + {SHINGLE - 1}], ' '))) END AS s
  FROM words
),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets),
links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM items a JOIN items b USING (item) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2
  HAVING 100 * count(*) >= {PERCENT} * (any_value(a.n + b.n) - count(*))
),
reach AS (
  SELECT doc_id, doc_id AS other FROM sets
  UNION
  SELECT reach.doc_id, b FROM reach JOIN links ON other = a
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, min(other) AS component_id,
  doc_id = min(other) AS kept
FROM sets JOIN reach USING (doc_id) GROUP BY doc_id, s
"""

"""Exact similarity join of documents by a token-group matrix.

Similar documents are put into groups. A group is stored by the union of its tokens, so one look
bounds how much a query can share with any member; only groups whose bound allows a link are
opened, and the query is then counted against all members at once.

Which groups a query must look at follows from short prefixes: in an order of all tokens that
puts frequent ones last, linked sets share ``HITS`` of the first tokens of both. Components that
grow large between the two passes become owners of their own groups, which their members skip.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from shoplens.llm.common import settle, small_side, text_bytes
from shoplens.llm.components import components
from shoplens.llm.near_duplicates import set_key, shingles

#: Words of a shingle and the least percentage of shared shingles that links documents.
SHINGLE = 4
PERCENT = 85
#: Tokens of both prefixes that linked sets share, if they have as many.
HITS = 16
#: Members of a group, and queries that one task holds against it.
GROUP_ROWS = 256
QUERIES = 1024
#: Tokens counted together, the least count that is passed on, the least sum that makes a token
#: frequent, and how many frequent tokens are put last (16 bytes each are sent to all tasks).
COUNTED = 1 << 22
SEEN = 8
OFTEN = 16
FREQUENT = 1 << 18

_U = np.uint64


def least_shared(n: int, percent: int) -> int:
    """The fewest tokens that a set of ``n`` shares with a set that it is linked with."""
    return -(-percent * n // 100)


def _least_shared(n: Column, percent: int) -> Column:
    return F.ceil(n * percent / 100)


def _counter(shingle: int) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[tuple[int, int], np.ndarray] = {}
        held = 0

        def emit() -> pa.RecordBatch:
            all_ = np.concatenate([*sets.values(), np.empty(0, _U)])
            tokens, seen = np.unique(all_, return_counts=True)
            often = seen >= SEEN
            return pa.RecordBatch.from_arrays(
                [pa.array(tokens[often].view(np.int64)), pa.array(seen[often])], ["token", "seen"]
            )

        for batch in batches:
            for text in batch.column(0):
                found = shingles(text.as_py(), shingle)
                # copies count once
                held += len(found) if sets.setdefault(set_key(found), found) is found else 0
                if held >= COUNTED:
                    yield emit()
                    sets, held = {}, 0
        yield emit()

    return count


def frequent_tokens(docs: DataFrame, text: str, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent tokens of all documents, sorted, and the rank of each by frequency.

    Each task counts its documents and passes on what it saw ``SEEN`` times among some million
    tokens, so what it leaves out is rare. The counts set an order only; any order is right.
    """
    counted = (
        docs.select(text_bytes(text).alias("text"))
        .mapInArrow(_counter(shingle), "token bigint, seen bigint")
        .groupBy("token")
        .agg(F.sum("seen").alias("seen"))
        .filter(F.col("seen") >= OFTEN)
        .orderBy(F.desc("seen"), "token")
        .limit(FREQUENT)
        .toArrow()
    )
    tokens = counted["token"].to_numpy().view(_U)
    rank = np.arange(len(tokens))[::-1]  # the most frequent one is the last
    order = np.argsort(tokens)
    return tokens[order], rank[order]


def prefix(found: np.ndarray, tokens: np.ndarray, ranks: np.ndarray, percent: int) -> np.ndarray:
    """The first tokens of a sorted set, of which linked sets share ``HITS`` or all they share."""
    length = min(len(found), len(found) - least_shared(len(found), percent) + HITS)
    if not len(tokens):
        return found[:length]
    at = np.minimum(np.searchsorted(tokens, found), len(tokens) - 1)
    often = tokens[at] == found
    rare = found[~often]
    if len(rare) >= length:
        return rare[:length]
    common, rank = found[often], ranks[at[often]]
    return np.concatenate([rare, common[np.argsort(rank)][: length - len(rare)]])


def _signer(shingle: int, percent: int, tokens: np.ndarray, ranks: np.ndarray):
    def sign(texts: pa.Array) -> pa.Array:
        sizes, keys, ends, first = [], [], [0], [np.empty(0, _U)]
        for text in texts:
            found = shingles(text.as_py(), shingle)
            sizes.append(len(found))
            keys.append(set_key(found))
            first.append(prefix(found, tokens, ranks, percent))
            ends.append(ends[-1] + len(first[-1]))
        flat = pa.array(np.concatenate(first).view(np.int64))
        return pa.StructArray.from_arrays(
            [
                pa.array(sizes, pa.int64()),
                pa.array([k[0] for k in keys], pa.int64()),
                pa.array([k[1] for k in keys], pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat),
            ],
            names=["n_shingles", "k1", "k2", "prefix"],
        )

    return F.arrow_udf(
        sign, "struct<n_shingles:bigint,k1:bigint,k2:bigint,prefix:array<bigint>>"
    ).asNondeterministic()


def _set_maker(shingle: int):
    def make(texts: pa.Array) -> pa.Array:
        found = [shingles(text.as_py(), shingle) for text in texts]
        keys = [set_key(s) for s in found]
        return pa.StructArray.from_arrays(
            [
                pa.array([k[0] for k in keys], pa.int64()),
                pa.array([k[1] for k in keys], pa.int64()),
                pa.array([s.tobytes() for s in found], pa.binary()),
            ],
            names=["k1", "k2", "items"],
        )

    return F.arrow_udf(make, "struct<k1:bigint,k2:bigint,items:binary>").asNondeterministic()


class TokenGroup:
    """The union of the tokens of some sets, and for each token the members that have it."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets])
        self.union, place = np.unique(np.concatenate(sets), return_inverse=True)
        member = np.repeat(np.arange(len(sets)), self.sizes)
        self.members = member[np.argsort(place, kind="stable")]
        self.begins = np.concatenate([[0], np.cumsum(np.bincount(place))])

    def places(self, query: np.ndarray) -> np.ndarray:
        """Where the union has tokens of the query; no member shares more of them."""
        at = np.minimum(np.searchsorted(self.union, query), len(self.union) - 1)
        return at[self.union[at] == query]

    def qualifies(self, size: int, places: np.ndarray, percent: int) -> bool:
        """Whether a query of some size may be linked with a member, by what the union has."""
        bound = len(places)
        return 100 * bound >= percent * size and (100 + percent) * bound >= percent * (
            size + int(self.sizes.min())
        )

    def shared(self, places: np.ndarray) -> np.ndarray:
        """How many of these tokens each member has."""
        begin, count = self.begins[places], self.begins[places + 1] - self.begins[places]
        skip = np.repeat(begin - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
        return np.bincount(self.members[skip + np.arange(len(skip))], minlength=len(self.sizes))

    def linked(self, query: np.ndarray, percent: int) -> np.ndarray:
        """Numbers of the members that a query is linked with; opened only if the bound allows."""
        places = self.places(query)
        if not self.qualifies(len(query), places, percent):
            return np.empty(0, np.int64)
        shared = self.shared(places)
        return np.flatnonzero(100 * shared >= percent * (len(query) + self.sizes - shared))


class _Forest:
    """Links that join two trees; others say nothing new."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}
        self.links: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        parent = self.parent
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent.setdefault(parent[x], parent[x])
        return x

    def link(self, a: int, b: int) -> None:
        one, two = self.root(a), self.root(b)
        if one != two:
            self.parent[max(one, two)] = min(one, two)
            self.links.append((a, b))


def _opener(percent: int, within: bool) -> Callable:
    def open_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by group and part of its queries, its members first."""
        now, names, sets = None, [], []
        group, forest = None, _Forest()

        def emit() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in forest.links], pa.int64()) for i in (0, 1)], ["a", "b"]
            )

        def close() -> None:
            """The links among the members, which the first part of the queries counts."""
            if within and now is not None and now[1] == 0 and len(sets) > 1:
                own = group or TokenGroup(sets)
                for k in range(1, len(sets)):
                    for other in own.linked(sets[k], percent).tolist():
                        if other < k:
                            forest.link(names[k], names[other])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in range(4)]
            for block, salt, query, node, items in zip(*columns, batch.column(4), strict=True):
                if (block, salt) != now:
                    close()
                    if forest.links:
                        yield emit()
                    now, names, sets, group, forest = (block, salt), [], [], None, _Forest()
                found = np.frombuffer(items.as_buffer(), _U)
                if not query:
                    names.append(node)
                    sets.append(found)
                    continue
                group = group or TokenGroup(sets)
                for other in group.linked(found, percent).tolist():
                    forest.link(node, names[other])
        close()
        yield emit()

    return open_groups


def _opened(
    members: DataFrame,
    queries: DataFrame,
    sets: Callable[[DataFrame], DataFrame],
    percent: int,
    within: bool,
) -> DataFrame:
    """Links of the queries (node, block) with the members (node, block) of their groups.

    A group's queries are dealt to tasks of about ``QUERIES``; each gets all members.
    """
    asked = queries.groupBy("block").agg(F.ceil(F.count("*") / QUERIES).alias("salts"))
    asked = settle(asked)
    salts = F.coalesce("salts", F.lit(1))
    held = members.join(asked, "block", "left" if within else "inner").select(
        "node",
        "block",
        F.explode(F.sequence(F.lit(0), (salts - 1).cast("int"))).alias("salt"),
        F.lit(False).alias("query"),
    )
    asking = queries.join(asked, "block").select(
        "node",
        "block",
        F.pmod(F.xxhash64("node"), "salts").cast("int").alias("salt"),
        F.lit(True).alias("query"),
    )
    targets = held.union(asking).groupBy("node").agg(
        F.collect_list(F.struct("block", "salt", "query")).alias("targets")
    )
    return (
        sets(targets)
        .select("node", "items", F.inline("targets"))
        .select("block", "salt", "query", "node", "items")
        .repartition("block", "salt")
        .sortWithinPartitions("block", "salt", "query")
        .mapInArrow(_opener(percent, within), "a bigint, b bigint")
    )


def _with_owner(placed: DataFrame, labels: DataFrame) -> DataFrame:
    """node, block, owner: members of large components are dealt anew into groups of their own."""
    named = placed.join(labels, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    large = settle(
        named.groupBy("component")
        .agg(F.count("*").alias("held"))
        .filter(F.col("held") > GROUP_ROWS)
    )
    part = F.pmod(F.xxhash64("node"), F.ceil(F.col("held") / GROUP_ROWS))
    return named.join(small_side(large), "component", "left").select(
        "node",
        F.when(F.col("held").isNotNull(), F.col("component")).alias("owner"),
        F.when(F.col("held").isNotNull(), F.xxhash64("component", part, F.lit("owner")))
        .otherwise(F.col("block"))
        .alias("block"),
    )


def _to_open(shared: DataFrame, owned: DataFrame, need: DataFrame) -> DataFrame:
    """node, block: the groups of others that share enough of a node's prefix, each pair once."""
    rows = shared.join(owned, "node")
    several = rows.groupBy("token").agg(
        F.min("block").alias("low"), F.max("block").alias("high")
    ).filter("low < high").select("token")
    rows = settle(
        rows.join(several, "token").select(
            "token", "node", "block", F.coalesce("owner", F.lit(-1)).alias("owner")
        )
    )
    matrix = settle(rows.select("token", "owner", "block").distinct())
    owners = matrix.select("token", F.col("owner").alias("of")).distinct()
    # first the owners of a token, so that a large component does not meet its own groups
    asking = rows.join(owners, "token").filter("of != owner or of = -1").select(
        "token", F.col("of").alias("owner"), "node", F.col("block").alias("own")
    )
    hits = (
        asking.join(matrix, ["token", "owner"])
        .filter("block > own")
        .groupBy("node", "block")
        .agg(F.count("*").alias("hits"))
    )
    return hits.join(need, "node").filter("hits >= need").select("node", "block")


def similar(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
) -> tuple[DataFrame, DataFrame]:
    """All documents (doc_id, n_shingles, node) and the component of each node that has links.

    Copies are one node, named by their smallest id. Every pair of nodes that is linked ends in one
    component; no pair is left out, whatever the size of a group.
    """
    tokens, ranks = frequent_tokens(docs, text, shingle)
    sign = _signer(shingle, percent, tokens, ranks)
    signed = settle(
        docs.select(F.col(id).alias("doc_id"), sign(text_bytes(text)).alias("s")).select(
            "doc_id", "s.*"
        )
    )
    full = signed.filter("n_shingles > 0 and doc_id is not null").groupBy("k1", "k2")
    classes = settle(
        full.agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"))
    )
    rows = full.agg(
        F.min("doc_id").alias("node"), F.any_value("prefix").alias("prefix")
    ).select("node", F.explode("prefix").alias("token"))
    met = F.count("*").over(Window.partitionBy("token"))
    shared = settle(rows.withColumn("met", met).filter("met > 1"))
    need = settle(
        classes.groupBy("node").agg(
            F.least(F.lit(HITS), _least_shared(F.min("n"), percent)).alias("need")
        )
    )
    # a node's group is that of its most frequent shared token
    placed = settle(
        shared.groupBy("node")
        .agg(F.count("*").alias("hits"), F.max(F.struct("met", "token")).alias("most"))
        .join(need, "node")
        .filter("hits >= need")
        .select("node", F.col("most.token").alias("group"))
    )
    sizes = placed.groupBy("group").agg(F.ceil(F.count("*") / GROUP_ROWS).alias("parts"))
    part = F.pmod(F.xxhash64("node"), "parts")
    placed = settle(
        placed.join(small_side(settle(sizes)), "group").select(
            "node",
            F.xxhash64("group", part).alias("block"),
            F.xxhash64("group", F.lit(0).cast("bigint")).alias("first"),
        )
    )
    make = _set_maker(shingle)

    def sets(targets: DataFrame) -> DataFrame:
        wanted = settle(
            targets.join(classes, "node").select(
                "node", F.col("k1").alias("c1"), F.col("k2").alias("c2"), "targets"
            )
        )
        return (
            docs.select(F.col(id).alias("node"), text_bytes(text).alias("text"))
            .join(small_side(wanted), "node")
            .withColumn("s", make("text"))
            .filter("s.k1 = c1 and s.k2 = c2")
            .select("node", "s.items", "targets")
        )

    # within groups, and all parts of a group against its first one
    links = settle(
        _opened(
            placed.select("node", "block"),
            placed.filter("block != first").select("node", F.col("first").alias("block")),
            sets,
            percent,
            within=True,
        )
    )
    labels = components(links)
    owned = settle(_with_owner(placed, labels))
    asking = settle(_to_open(shared.select("token", "node"), owned, need))
    if not asking.isEmpty():
        more = _opened(owned.select("node", "block"), asking, sets, percent, within=False)
        labels = components(links.union(settle(more)))
    return (
        signed.select("doc_id", "n_shingles", "k1", "k2").join(
            classes.select("k1", "k2", "node"), ["k1", "k2"], "left"
        ),
        labels,
    )


def similarity_classes(
    docs: DataFrame, id: str = "doc_id", text: str = "text", percent: int = PERCENT
) -> DataFrame:
    """doc_id, n_shingles, component_id: a row for each different id of ``docs``.

    Documents are linked if their sets of shingles share ``percent`` of their union; a component is
    named by its smallest id. A text of fewer words than a shingle is one shingle. Documents
    without a word or with a null text are linked with nothing. An id with several rows has
    the links of all of them and the largest of their sets' sizes. Rows without an id each stay, unlinked,
    with a null component. An empty table gives an empty one; other columns are not read.
    """
    rows, labels = similar(docs, id, text, SHINGLE, percent)
    rows = rows.join(labels, "node", "left")
    named = (
        rows.filter("doc_id is not null")
        .groupBy("doc_id")
        .agg(
            F.max("n_shingles").alias("n_shingles"),
            F.least(F.min("component"), F.min("node"), F.col("doc_id")).alias("component_id"),
        )
    )
    none = rows.filter("doc_id is null").select(
        "doc_id", "n_shingles", F.lit(None).cast("bigint").alias("component_id")
    )
    return named.union(none)


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
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, min(other) AS component_id
FROM sets JOIN reach USING (doc_id) GROUP BY doc_id, s
"""

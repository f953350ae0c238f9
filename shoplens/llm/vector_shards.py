"""Shards by vector bin packing: bytes, words and rows are balanced together.

Groups of equal texts are the items. A group that exceeds the share of a shard is cut into parts;
the small ones, of which there may be billions, are gathered by hash into lots. What the driver
places is therefore bounded by the number of shards, not by the number of documents.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.common import settle, small_side

#: Lots of small groups for each shard; a group larger than that part of a shard is its own lot.
LOTS = 256
#: A group that exceeds the share of a shard, in any measure, is cut into parts of about this part
#: of a shard; all others stay whole.
WHOLE = 8
#: Rows whose slots are counted together, about.
SLOT_ROWS = 1 << 16
#: Bytes that a document takes besides its text.
ROW_BYTES = 8
#: How much a residue counts: bytes, words, rows.
WEIGHTS = (4.0, 1.0, 1.0)


def place(items: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each item (a row of nonnegative measures).

    Items go in order of their largest share, each where the weighted dot product of its shares
    with the residual capacities is highest, of those with room for its first measure (if none has,
    where most of that is left); ties go to the lower shard. Capacity is the even share of each
    measure, and a shard that is full in a measure has a negative residue there.
    """
    total = items.sum(axis=0, dtype=float)
    share = items / np.where(total > 0, total, 1) * shards
    residue = np.where(total > 0, 1.0, 0.0) * np.ones((shards, items.shape[1]))
    weights = np.array(WEIGHTS[: items.shape[1]])
    where = np.zeros(len(items), np.int64)
    for i in np.lexsort([np.arange(len(items)), -share.max(axis=1)]):
        room = residue[:, 0] >= share[i, 0] - 1e-12
        fit = np.where(room, residue @ (share[i] * weights), -np.inf)
        best = int(np.argmax(fit if room.any() else residue[:, 0]))
        where[i] = best
        residue[best] -= share[i]
    return where


def describe(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, n_words, text_key of each row; a null text counts as empty."""
    whole = F.coalesce(F.col(text), F.lit(""))
    # each blank before a word, as a text does not begin with one any more
    words = F.regexp_count(F.concat(F.lit(" "), whole), F.lit("[ \\t-\\r][^ \\t-\\r]"))
    return docs.select(
        F.col(id).alias("doc_id"),
        (F.octet_length(whole).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"),
        words.cast("long").alias("n_words"),
        F.xxhash64(whole).alias("text_key"),
    )


def assign(
    docs: DataFrame, shards: int = 24, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: a row for each row of ``docs``.

    The law is ``bytes``: the sizes of the shards are as near to equal as the groups allow, words
    and rows follow. Equal texts share a shard unless they exceed the share of one; then they
    are cut by a hash of their places. Slots count from 0 without gaps, by lot; repeated rows
    each take one, and rows without an id are no exception. An empty table gives an empty one.
    The driver gets at most ``shards * LOTS`` lots and four times as many large groups, some
    numbers each; no task counts the slots of more than a block of rows.
    """
    rows = settle(describe(docs, id, text)).withColumn("place", F.monotonically_increasing_id())
    total = rows.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("size", "n_words")], F.count("*"))
    even = [max(1.0, value / shards) for value in total.first()]
    # a measure has room for ``shards * LOTS`` groups that exceed the size of a lot in it
    groups = rows.groupBy("text_key").agg(
        F.sum("size").alias("b"), F.sum("n_words").alias("w"), F.count("*").alias("r")
    )
    share = F.greatest(*[F.col(c) / F.lit(m) for c, m in zip("bwr", even, strict=True)])
    parts = F.when(share > 1, F.least(F.ceil(share * WHOLE), "r")).otherwise(1)
    large = groups.filter((share * LOTS > 1) & (F.col("r") > 1)).select(
        "text_key", parts.cast("long").alias("parts")
    )
    own = F.col("parts").isNotNull()
    lots = (
        rows.join(F.broadcast(large), "text_key", "left")
        .withColumn("part", F.when(own, F.pmod(F.xxhash64("place"), "parts")).otherwise(-1))
        .withColumn(
            "lot",
            F.when(own, F.col("text_key")).otherwise(F.pmod("text_key", F.lit(shards * LOTS))),
        )
        .drop("parts", "text_key")
    )
    sums = (
        lots.groupBy("lot", "part")
        .agg(F.sum("size").alias("b"), F.sum("n_words").alias("w"), F.count("*").alias("r"))
        .orderBy("lot", "part")
        .collect()
    )
    shard = place(np.array([[s.b, s.w, s.r] for s in sums], float).reshape(-1, 3), shards)
    filled = [0] * shards
    placed = []
    for s, at in zip(sums, shard.tolist(), strict=True):
        placed.append((s.lot, s.part, at, filled[at], -(-s.r // SLOT_ROWS)))
        filled[at] += s.r
    places = rows.sparkSession.createDataFrame(
        placed, "lot bigint, part bigint, shard int, begin bigint, blocks bigint"
    )
    dealt = lots.join(F.broadcast(places), ["lot", "part"]).withColumn(
        "block", F.pmod(F.xxhash64("place", F.lit("slot")), "blocks")
    )
    before = Window.partitionBy("lot", "part").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = settle(
        dealt.groupBy("lot", "part", "block")
        .agg(F.count("*").alias("n"))
        .select("lot", "part", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("off"))
    )
    rank = F.row_number().over(Window.partitionBy("lot", "part", "block").orderBy("place"))
    return (
        dealt.withColumn("rank", rank)
        .join(small_side(offsets), ["lot", "part", "block"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("begin") + F.col("off") + F.col("rank") - 1).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )

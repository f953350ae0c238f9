"""Repeated passages: every byte that lies in a string of 200 bytes found elsewhere, too.

Each window of 200 bytes is represented by the least of its hashed 64-byte grams, its anchor, so
equal windows have equal anchors. The consecutive windows of an anchor's occurrence make up a
segment. Anchors that occur once are done; where all segments of an anchor are equal, all their
windows are repeated. Only the different segments of the other anchors are compared, by the
Burrows-Wheeler transform of many of them: backward extension of its intervals, breadth first,
yields the lengths of common prefixes in increasing order and stops at 200. Where an anchor has
too many of them for one task, they are first cut by the place of the anchor in their windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import settle, small_side, text_bytes

#: Bytes of a repeated string.
LENGTH = 200
#: Bytes of a gram; the others of a window are how far its anchor may move.
GRAM = 64
REACH = LENGTH - GRAM + 1
#: Windows whose anchors are sought together.
AT_ONCE = 1 << 16
#: Bytes of segments that are transformed together.
BLOCK = 1 << 17
#: Different segments of an anchor beyond which they are halved before they are transformed.
HOT = 4096
#: Pieces of such segments whose repeated windows may be broadcast (1 kB each at most).
MAX_RUNS = 50_000
#: Repeated anchors that may be broadcast (about 35 bytes each, so 70 MB).
MAX_BROADCAST = 2_000_000

_U = np.uint64
_PLACE = _U((1 << 17) - 1)
_Q = 0x9E3779B97F4A7C15 | 1
_SPREAD = np.arange(1, 257, dtype=_U) * _U(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTES = _mix(_SPREAD)
_POWERS = np.cumprod(np.full(AT_ONCE + LENGTH + 1, _Q, _U))
_INVERSE = np.cumprod(np.full(AT_ONCE + LENGTH + 1, pow(_Q, -1, 1 << 64), _U))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values, by running minima of blocks."""
    n = len(values)
    padded = np.full(-(-n // width) * width, ~_U(0), _U)
    padded[:n] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def _grams(part: bytes) -> np.ndarray:
    """The hash of each gram of at most ``AT_ONCE + LENGTH - 1`` bytes."""
    codes = np.frombuffer(part, np.uint8)
    sums = np.zeros(len(codes) + 1, _U)
    np.cumsum(_BYTES[codes] * _POWERS[: len(codes)], out=sums[1:])
    return _mix((sums[GRAM:] - sums[:-GRAM]) * _INVERSE[: len(codes) - GRAM + 1])


def anchors(text: bytes) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor, segment's hash, first window, windows) of a text, a tuple for each part of it."""
    found = []
    for at in range(0, len(text) - LENGTH + 1, AT_ONCE):
        part = text[at : at + AT_ONCE + LENGTH - 1]
        grams = _grams(part)
        # of equal grams the leftmost is the anchor: the place stands in the lowest bits
        places = np.arange(len(grams), dtype=_U)
        least = _least((grams & ~_PLACE) | places, REACH)
        where = (least & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
        windows = np.diff(np.append(first, len(where)))
        segment = np.fromiter(
            (
                xxhash.xxh3_64_intdigest(part[a : a + n + LENGTH - 1])
                for a, n in zip(first.tolist(), windows.tolist(), strict=True)
            ),
            _U,
            len(first),
        )
        anchor = grams[where[first]]
        found.append((anchor.view(np.int64), segment.view(np.int64), first + at, windows))
    return found


_PARTS = ("anchor", "segment", "first", "windows")
_ANCHORS_DDL = "array<struct<anchor:bigint,segment:bigint,first:bigint,windows:bigint>>"


def _anchors_of(texts: pa.Array) -> pa.Array:
    ends, parts = [0], []
    for text in texts:
        found = anchors(text.as_py())
        parts += found
        ends.append(ends[-1] + sum(len(p[0]) for p in found))
    columns = [
        pa.array(np.concatenate([p[i] for p in parts]) if parts else [], pa.int64())
        for i in range(4)
    ]
    structs = pa.StructArray.from_arrays(columns, names=list(_PARTS))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs)


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by at least ``depth`` symbols (below 512); 0 follows the last one."""
    n = len(symbols)
    size = 7
    padded = np.zeros(n + size, np.int64)
    padded[:n] = symbols
    key = np.zeros(n, np.int64)
    for k in range(size):
        key = key << 9 | padded[k : k + n]
    while True:
        order = np.argsort(key)
        ranked = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.append(1, ranked[1:] != ranked[:-1]))
        if size >= depth or rank[order[-1]] == n:
            return order
        key = rank * (n + 1)
        if size < n:
            key[: n - size] += rank[size:]
        size *= 2


def common_prefixes(symbols: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """For each place in ``order`` but the first, whether ``depth`` symbols equal those before it.

    A border lies between neighbours in ``order`` that differ within as many symbols as were
    counted. Extended backward by a symbol, a border of one level becomes a border of the next
    level: between the last suffix before it and the first one after it that follow this
    symbol. Each pair of successive suffixes after the same symbol is thus met once, at the
    first level that has a border between them. Most pairs are neighbours and wait for one
    border only; the others are looked through at each level.
    """
    n = len(symbols)
    before = symbols[order - 1]
    rank = np.argsort(before, kind="stable")  # by symbol: where suffixes are after extension
    sorted_before = before[rank]
    starts = np.flatnonzero(np.append(True, sorted_before[1:] != sorted_before[:-1]))
    border = np.zeros(n + 1, bool)
    border[starts] = True
    pair = np.ones(n, bool)
    pair[starts] = False
    target = np.flatnonzero(pair)
    left, right = rank[target - 1], rank[target]
    close = right - left == 1
    waiting = np.full(n + 1, -1, np.int64)
    waiting[right[close]] = target[close]
    left, right, target = left[~close], right[~close], target[~close]
    fresh = starts
    for _ in range(1, depth):
        if not len(fresh):
            break
        reached = waiting[fresh]
        reached = reached[reached >= 0]
        if len(target):
            if len(target) * 16 < n:
                hit = np.searchsorted(fresh, right, "right") > np.searchsorted(
                    fresh, left, "right"
                )
            else:
                count = np.cumsum(border, dtype=np.int32)
                hit = count[right] > count[left]
            if hit.any():
                reached = np.concatenate([reached, target[hit]])
                left, right, target = left[~hit], right[~hit], target[~hit]
        border[reached] = True
        fresh = np.sort(reached)
    return ~border[1:n]


def repeated_windows(segments: list[bytes], weights: list[int], length: int = LENGTH):
    """For each segment, a mask of its windows that occur twice or more among all.

    ``weights`` count the copies of a segment; all windows of one that has copies are repeated.
    """
    sizes = np.array([len(s) for s in segments])
    # a separator, 0, ends each segment; it occurs in no window, so none runs across it
    symbols = np.zeros(int(sizes.sum()) + len(segments), np.int64)
    starts = np.cumsum(np.append(0, sizes[:-1] + 1))
    for start, segment in zip(starts.tolist(), segments, strict=True):
        symbols[start : start + len(segment)] = np.frombuffer(segment, np.uint8)
        symbols[start : start + len(segment)] += 1
    order = suffix_order(symbols, length)
    same = np.flatnonzero(common_prefixes(symbols, order, length))
    twice = np.zeros(len(symbols), bool)
    twice[order[same]] = True
    twice[order[same + 1]] = True
    masks = []
    for start, size, weight in zip(starts.tolist(), sizes.tolist(), weights, strict=True):
        mask = twice[start : start + max(0, size - length + 1)]
        masks.append(mask | (weight > 1))
    return masks


_RANGES = pa.schema(
    [
        ("anchor", pa.int64()),
        ("segment", pa.int64()),
        ("skip", pa.int64()),
        ("found", pa.int64()),
    ]
)
_RANGES_DDL = "anchor bigint, segment bigint, skip bigint, found bigint"


def _runs(mask: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    return [(int(a), int(b - a)) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def _transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted by anchor: all segments of as many anchors as fill a block, block by block."""
    held: list[tuple] = []
    size = 0

    def done() -> pa.RecordBatch:
        masks = repeated_windows([h[3] for h in held], [h[2] for h in held])
        rows = [
            (h[0], h[1], skip, found)
            for h, mask in zip(held, masks, strict=True)
            for skip, found in _runs(mask)
        ]
        columns = list(zip(*rows, strict=True)) or [[] for _ in _RANGES]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], schema=_RANGES
        )

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if size >= BLOCK and row[0] != held[-1][0]:
                yield done()
                held.clear()
                size = 0
            held.append(row)
            size += len(row[3])
    if held:
        yield done()


def halves(content: bytes, low: int, high: int) -> Iterator[tuple[int, int, int, int]]:
    """(low, high, first window, last window) of the two halves of a segment's windows.

    ``low`` and ``high`` bound how many bytes of a window lie before its anchor. So all windows
    within the bounds hold the ``low`` bytes before the anchor and ``REACH - 1 - high`` after it.
    """
    middle = (low + high + 1) // 2
    at = anchor_place(content)
    windows = len(content) - LENGTH + 1
    for least, most in ((middle, high), (low, middle - 1)):
        first, last = max(0, at - most), min(windows - 1, at - least)
        if first <= last:
            yield least, most, first, last


def anchor_place(content: bytes) -> int:
    """Where in a segment the anchor of its first window, and so of all its windows, begins."""
    grams = _grams(content[:LENGTH]) & ~_PLACE
    return int(np.argmin(grams))


_PARTS_OF_DDL = (
    "array<struct<key:bigint,part:bigint,skip:bigint,low:bigint,high:bigint,piece:binary>>"
)
_PARTS_OF = pa.list_(
    pa.struct(
        [
            ("key", pa.int64()),
            ("part", pa.int64()),
            ("skip", pa.int64()),
            ("low", pa.int64()),
            ("high", pa.int64()),
            ("piece", pa.binary()),
        ]
    )
)


def _signed(data: bytes, seed: int = 0) -> int:
    return int.from_bytes(xxhash.xxh3_64_digest(data, seed), "little", signed=True)


def _halved(contents: pa.Array, lows: pa.Array, highs: pa.Array) -> pa.Array:
    """The halves of each segment, keyed by the bytes that all their windows must share."""
    rows = []
    for content, low, high in zip(
        contents.to_pylist(), lows.to_pylist(), highs.to_pylist(), strict=True
    ):
        at = anchor_place(content)
        parts = []
        for least, most, first, last in halves(content, low, high):
            piece = content[first : last + LENGTH]
            shared = content[at - least : at + LENGTH - most]
            key = _signed(shared, least * REACH + most)
            parts.append(
                {
                    "key": key,
                    "part": _signed(piece),
                    "skip": first,
                    "low": least,
                    "high": most,
                    "piece": piece,
                }
            )
        rows.append(parts)
    return pa.array(rows, _PARTS_OF)


def _ranges(segments: DataFrame) -> DataFrame:
    """anchor, segment, runs: repeated windows of segments that differ, as (skip, found).

    ``segments``: anchor, segment, weight, content, low, high, one row for each different one.
    Equal windows have their anchor at the same place. So the segments of an anchor that has
    more than ``HOT`` are halved by that place, and each half goes to those that also share the
    bytes next to the anchor which all windows of the half hold. Equal halves become one, and
    what then is still crowded is halved again; windows that stand alone are keyed by all their
    bytes, so eight rounds are the most.
    """
    crowded = settle(
        segments.groupBy("anchor").count().filter(F.col("count") > HOT).select("anchor")
    )
    some = not crowded.isEmpty()
    few = small_side(crowded)
    found = (
        (segments.join(few, "anchor", "left_anti") if some else segments)
        .select("anchor", "segment", "weight", "content")
        .repartition("anchor")
        .sortWithinPartitions("anchor", "segment")
        .mapInArrow(_transform, _RANGES_DDL)
    )
    if some:
        halve = F.arrow_udf(_halved, _PARTS_OF_DDL).asNondeterministic()
        parts = settle(
            segments.join(few, "anchor", "left_semi").select(
                "anchor", "segment", "weight", F.inline(halve("content", "low", "high"))
            )
        )
        pieces = settle(
            parts.groupBy(F.col("key").alias("anchor"), F.col("part").alias("segment"))
            .agg(
                F.sum("weight").alias("weight"),
                F.any_value("piece").alias("content"),
                F.min("low").alias("low"),
                F.min("high").alias("high"),
            )
        )
        of_pieces = settle(_ranges(pieces).toDF("key", "part", "runs"))
        back = (
            parts.select("anchor", "segment", "key", "part", F.col("skip").alias("first"))
            .join(small_side(of_pieces, MAX_RUNS), ["key", "part"])
            .select("anchor", "segment", "first", F.inline("runs"))
            .select("anchor", "segment", (F.col("first") + F.col("skip")).alias("skip"), "found")
        )
        found = found.union(back)
    return found.groupBy("anchor", "segment").agg(
        F.collect_list(F.struct("skip", "found")).alias("runs")
    )


def _contents(texts: pa.Array, places: pa.Array) -> pa.Array:
    out = []
    for text, wanted in zip(texts.to_pylist(), places.to_pylist(), strict=True):
        out.append([text[p["first"] : p["first"] + p["windows"] + LENGTH - 1] for p in wanted])
    return pa.array(out, pa.list_(pa.binary()))


def _cut(with_kept: bool):
    def cut(texts: pa.Array, places: pa.Array) -> pa.Array:
        rows = []
        for text, spans in zip(texts.to_pylist(), places.to_pylist(), strict=True):
            merged: list[list[int]] = []
            for span in sorted((s["a"], s["b"]) for s in spans or ()):
                if merged and span[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], span[1])
                else:
                    merged.append(list(span))
            edges = [0, *(edge for span in merged for edge in span), len(text)]
            kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            rows.append(
                {
                    "n_bytes": len(text),
                    "n_removed": len(text) - len(kept),
                    "n_spans": len(merged),
                    "kept_sha256": hashlib.sha256(kept).hexdigest(),
                    "kept": kept if with_kept else None,
                }
            )
        return pa.array(rows, _RESULT)

    return F.arrow_udf(cut, _RESULT_DDL).asNondeterministic()


_RESULT = pa.struct(
    [
        ("n_bytes", pa.int64()),
        ("n_removed", pa.int64()),
        ("n_spans", pa.int64()),
        ("kept_sha256", pa.string()),
        ("kept", pa.binary()),
    ]
)
_RESULT_DDL = (
    "struct<n_bytes:bigint,n_removed:bigint,n_spans:bigint,kept_sha256:string,kept:binary>"
)
_KEY = ["k1", "k2"]


def _keyed(docs: DataFrame, id: str, text: str) -> DataFrame:
    """doc_id, bytes and a key that only rows with the same id and text share."""
    identity: list[Column] = [F.col(id).alias("doc_id"), text_bytes(text).alias("bytes")]
    return docs.select(*identity).select(
        "*",
        F.xxhash64("doc_id", "bytes").alias("k1"),
        F.xxhash64("bytes", "doc_id").alias("k2"),
    )


def repeated_spans(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """k1, k2, spans: for each row that has any, the spans (a, b) of repeated bytes of its text.

    They may overlap. Anchors are counted where they arise before they are moved. Texts are
    moved only if the rows that hold repeated anchors are too many to broadcast their keys.
    """
    rows = _keyed(docs, id, text)
    seek = F.arrow_udf(_anchors_of, _ANCHORS_DDL).asNondeterministic()
    occurring = rows.filter(F.octet_length("bytes") >= LENGTH).select(
        *_KEY, F.inline(seek("bytes"))
    )
    several = settle(
        occurring.groupBy("anchor")
        .agg(
            F.count("*").alias("n"),
            F.min("segment").alias("low"),
            F.max("segment").alias("high"),
        )
        .filter("n > 1")
        .select("anchor", (F.col("low") != F.col("high")).alias("differ"))
    )
    met = settle(occurring.join(small_side(several, MAX_BROADCAST), "anchor"))
    differing = met.filter("differ")
    places = differing.groupBy(*_KEY).agg(
        F.collect_set(F.struct("anchor", "segment", "first", "windows")).alias("places")
    )
    read = F.arrow_udf(_contents, "array<binary>").asNondeterministic()
    holders = small_side(settle(differing.select(*_KEY).distinct()))
    holding = rows.join(holders, _KEY, "left_semi").join(places, _KEY)
    segments = settle(
        holding.select("places", read("bytes", "places").alias("contents"))
        .select(F.inline(F.arrays_zip("places", "contents")))
        .groupBy("places.anchor", "places.segment")
        .agg(F.count("*").alias("weight"), F.any_value("contents").alias("content"))
    )
    bounds = {"low": F.lit(0).cast("long"), "high": F.lit(REACH - 1).cast("long")}
    ranges = settle(_ranges(segments.withColumns(bounds)))
    span = "struct({a} AS a, {a} + {n} + {more} AS b)"
    whole = met.filter("not differ").select(
        *_KEY, F.expr(f"array({span.format(a='first', n='windows', more=LENGTH - 1)})").alias("s")
    )
    run = span.format(a="first + r.skip", n="r.found", more=LENGTH - 1)
    partly = differing.join(ranges, ["anchor", "segment"]).select(
        *_KEY, F.expr(f"transform(runs, r -> {run})").alias("s")
    )
    # a set, as rows that repeat bring the same spans
    return (
        whole.union(partly)
        .groupBy(*_KEY)
        .agg(F.flatten(F.collect_set("s")).alias("spans"))
    )


def remove_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", with_kept: bool = True
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept: a row for each row of ``docs``.

    A byte goes if a string of ``LENGTH`` bytes that covers it also starts elsewhere, in the
    same text or another; strings are judged on the input. Rows that repeat are documents of
    their own, so what they share goes from all; rows without an id are no exception. A null
    text is empty, a short one stays. An empty table gives an empty one. Other columns are not
    read. ``kept`` is the remaining text as bytes; without ``with_kept`` it is left out.
    """
    by_row = settle(repeated_spans(docs, id, text))
    touched = small_side(settle(by_row.select(*_KEY)))
    rows = _keyed(docs, id, text)
    hit = rows.join(touched, _KEY, "left_semi").join(by_row, _KEY)
    clean = rows.join(touched, _KEY, "left_anti").withColumn(
        "spans", F.lit(None).cast("array<struct<a:bigint,b:bigint>>")
    )
    columns = ["doc_id", "bytes", "spans"]
    found = (
        hit.select(columns)
        .union(clean.select(columns))
        .select("doc_id", _cut(with_kept)("bytes", "spans").alias("r"))
        .select("doc_id", "r.*")
    )
    return found if with_kept else found.drop("kept")


#: The same by counting all strings of ``LENGTH`` bytes, for engines without Spark.
SQL = f"""
WITH hexed AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
slices AS (  -- as a place in a long string takes long to find
  SELECT doc_id, n, c * 512 AS base, substr(h, 1024 * c + 1, {2 * (512 + LENGTH)}) AS s
  FROM (SELECT doc_id, h, length(h) // 2 AS n, unnest(range((length(h) + 1023) // 1024)) AS c
    FROM hexed)
),
bytes AS (
  SELECT doc_id, base + i AS p, substr(s, 2 * i + 1, 2) AS byte,
    CASE WHEN base + i + {LENGTH} <= n THEN md5_number(substr(s, 2 * i + 1, {2 * LENGTH})) END
      AS string
  FROM (SELECT *, unnest(range(least(512, n - base))) AS i FROM slices)
),
often AS (
  SELECT string FROM bytes WHERE string IS NOT NULL GROUP BY string HAVING count(*) > 1
),
marked AS (
  SELECT doc_id, p, byte, max(CASE WHEN often.string IS NULL THEN 0 ELSE 1 END) OVER (
    PARTITION BY doc_id ORDER BY p ROWS BETWEEN {LENGTH - 1} PRECEDING AND CURRENT ROW) AS gone
  FROM bytes LEFT JOIN often USING (string)
),
edged AS (
  SELECT *, gone - lag(gone, 1, 0) OVER (PARTITION BY doc_id ORDER BY p) AS edge FROM marked
),
cut AS (
  SELECT doc_id, sum(gone) AS n_removed, count(*) FILTER (WHERE edge = 1) AS n_spans,
    string_agg(byte, '' ORDER BY p) FILTER (WHERE gone = 0) AS kept
  FROM edged GROUP BY doc_id
)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes,
  CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM hexed LEFT JOIN cut USING (doc_id)
"""

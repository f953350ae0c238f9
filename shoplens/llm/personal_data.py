"""Personal data: generators propose spans, boosted trees score them, thresholds select.

What the base patterns find and check is always redacted. Besides, wider patterns propose spans
of the same families; gradient-boosted trees score them by their format and their surroundings.
The trees learn from the corpus itself. Examples are the proposals that meet a checked base span
and rewritten spans: each base span is written as the base patterns do not find it (without the
plus, with other separators, with "(at)") and put back between its neighbours. Counterexamples
are rewritten spans that a check fails, and all proposals that meet no base span; as those may be
right, what is learnt errs to the careful side. Scores of labelled spans that were not learnt from
are calibrated by isotonic regression, and a threshold is the lowest score whose calibrated share
of right ones is high enough. Proposals may overlap; of those above their thresholds the best by
score are added.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.common import settle, text_bytes

#: Base kinds and kinds of added spans, in the order in which spans are listed.
BASE = ("email", "ip", "card", "phone")
ADDED = ("email_like", "ip_like", "card_like", "phone_like")

#: Proposals of each family that the trees learn from; all others set its threshold.
SAMPLE = 10_000
#: Examples and counterexamples without which nothing is learnt and no span is added.
MIN_EXAMPLES = 20
#: Calibrated share of labelled right spans at a threshold. Proposals that meet no base span count
#: as wrong there even if they are what is looked for, so the true share is higher: where spans
#: like the examples occur, they take the place of counterexamples; where decoys do, there are no
#: examples.
PRECISION = 0.5
#: Digits of the scores that are told apart, so that there are few of them.
SCORE_DIGITS = 3
TREES = 10
DEPTH = 3
#: Bytes before a proposal in which words count.
CONTEXT = 32
#: Fewest and most digits of proposed figures, by kind.
DIGITS = {"card_like": (12, 20), "phone_like": (7, 16)}
#: Proposals that a worker gathers before they become Arrow data.
AT_ONCE = 10_000

# The base patterns and what must hold for a match.
LOCAL = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(rb"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(rb"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")

# What proposes spans: runs of figures with separators, four or more numbers, written-out addresses.
RUN = re.compile(rb"[0-9][0-9\x20().-]*")
GROUP = re.compile(rb"[0-9]+")
NUMBERS = re.compile(rb"[0-9]{1,3}(?:[.:,][0-9]{1,3}){3}")
ADDRESS = re.compile(
    rb"[A-Za-z0-9._%+-]{1,64}\x20?(?:@|\(at\)|\[at\])\x20?"
    rb"[A-Za-z0-9-]{1,64}(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]{2,64}){1,5}"
)
AT = re.compile(rb"@|\(at\)|\[at\]")
HINTS = (
    re.compile(rb"(?i)mail|contact|write|reach"),
    re.compile(rb"(?i)\bip\b|host|server|address"),
    re.compile(rb"(?i)card|visa|credit|account"),
    re.compile(rb"(?i)phone|call|tel|fax|mobile"),
)
NOT_FIGURES = bytes(set(range(256)) - set(b"0123456789"))

Span = tuple[str, int, int]


def luhn(digits: bytes) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = digit - 48
        if place % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def at_most_255(figures: bytes) -> bool:
    """Also of thousands of figures, which ``int`` refuses."""
    return len(figures.lstrip(b"0")) <= 3 and int(figures[-3:]) <= 255


def emails(text: bytes) -> list[Span]:
    found, free = [], 0
    at = text.find(b"@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            free = match.end()
            found.append(("email", start, free))
        at = text.find(b"@", max(at + 1, free))
    return found


def base_spans(text: bytes) -> list[Span]:
    """Base spans in bytes, by kind and then start: leftmost, not overlapping within a kind."""
    found = emails(text)
    for match in IP.finditer(text):
        if all(map(at_most_255, match[0].split(b"."))):
            found.append(("ip", *match.span()))
    for match in CARD.finditer(text):
        digits = match[0].translate(None, NOT_FIGURES)
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *match.span()))
    for match in PHONE.finditer(text):
        if 9 <= len(match[0].translate(None, NOT_FIGURES)) <= 15:
            found.append(("phone", *match.span()))
    return found


def stands_alone(text: bytes, match: re.Match) -> bool:
    """Whether no letter or figure touches a match, as it does inside keys and hashes."""
    start, end = match.span()
    return not (text[start - 1 : start].isalnum() or text[end : end + 1].isalnum())


def figures(text: bytes) -> Iterator[tuple[int, int, int]]:
    """(start, end, digits) of all groups in a row, within any run, of 7 to 20 digits together.

    A run may be of any length; as digits are bounded, a group begins 20 of them at most. Those
    that a letter touches, as inside keys and hashes, are left out. A bracket and a plus before
    the first group are part of it.
    """
    least = min(low for low, _ in DIGITS.values())
    most = max(high for _, high in DIGITS.values())
    for run in RUN.finditer(text):
        groups = [match.span() for match in GROUP.finditer(text, *run.span())]
        for i, (first, _) in enumerate(groups):
            start = first - (text[first - 1 : first] == b"(")
            start -= text[start - 1 : start] == b"+"
            if text[start - 1 : start].isalnum():
                if i == 0:
                    continue
                start = first
            digits = 0
            for j in range(i, len(groups)):
                begin, end = groups[j]
                digits += end - begin
                if digits > most:
                    break
                if digits >= least and not text[end : end + 1].isalnum():
                    yield start, end, digits


def proposals(text: bytes) -> list[Span]:
    """Spans that could be personal data; they may overlap."""
    found = []
    if AT.search(text):
        found += [("email_like", *m.span()) for m in ADDRESS.finditer(text)]
    found += [("ip_like", *m.span()) for m in NUMBERS.finditer(text) if stands_alone(text, m)]
    for start, end, digits in figures(text):
        for kind, (low, high) in DIGITS.items():
            if low <= digits <= high:
                found.append((kind, start, end))
    return found


def features(text: bytes, span: Span) -> list[float]:
    """Format and surroundings of a span as numbers."""
    kind, start, end = span
    part = text[start:end]
    digits = part.translate(None, NOT_FIGURES)
    groups = [len(g) for g in re.findall(rb"[0-9]+", part)] or [0]
    numbers = [int(g[-6:]) for g in re.findall(rb"[0-9]+", part)] or [0]
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + 1]
    family = ADDED.index(kind)
    return [
        float(x)
        for x in (
            family,
            len(part),
            len(digits),
            sum(part.count(c) for c in (b" ", b"(", b")")),
            part.count(b"-"),
            part.count(b"."),
            part.count(b"@"),
            part.startswith(b"+"),
            len(groups),
            max(groups),
            min(groups),
            max(numbers),
            luhn(digits),
            bool(HINTS[family].search(before)),
            before[-1:].isspace(),
            after in b".,;:!?",
        )
    ]


class _Known:
    """The base spans of a kind in a text, which do not overlap, for quick search."""

    def __init__(self, text: bytes, spans: list[Span]):
        self.starts = [start for _, start, _ in spans]
        self.stops = [stop for _, _, stop in spans]
        self.figures = {(_first_figure(text, a), b) for _, a, b in spans}

    def meet(self, span: Span) -> bool:
        place = bisect_right(self.stops, span[1])
        return place < len(self.starts) and self.starts[place] < span[2]

    def cover(self, span: Span) -> bool:
        place = bisect_left(self.stops, span[2])
        return place < len(self.starts) and self.starts[place] <= span[1]


def _first_figure(text: bytes, start: int) -> int:
    while text[start : start + 1] in (b"+", b"("):
        start += 1
    return start


def judged(text: bytes, base: list[Span]) -> Iterator[tuple[Span, bool, bool]]:
    """Proposals, whether each is right, and whether it meets a base span of any kind.

    Parts of a checked card or phone are left out: that is redacted as a whole, so they are
    neither added nor examples or counterexamples.
    """
    known = {kind: _Known(text, [b for b in base if b[0] == kind]) for kind in BASE}
    for span in proposals(text):
        own = known[span[0].removesuffix("_like")]
        right = own.meet(span)
        if span[0] in DIGITS:
            right = (_first_figure(text, span[1]), span[2]) in own.figures
            if not right and own.cover(span):
                continue
        yield span, right, any(k.meet(span) for k in known.values())


def _regrouped(digits: bytes, between: bytes) -> bytes:
    return between.join(digits[i : i + 4] for i in range(0, len(digits), 4))


def _other_digit(digits: bytes) -> bytes:
    """Figures that fail the check of those given."""
    return digits[:-1] + bytes([48 + (digits[-1] - 48 + 5) % 10])


def rewritten(kind: str, part: bytes, choice: int) -> Iterator[tuple[bytes, int]]:
    """Forms of a base span that no base pattern finds, and whether each still is one."""
    digits = part.translate(None, NOT_FIGURES)
    if kind == "email":
        local, domain = part.split(b"@", 1)
        for at in (b" (at) ", b"(at)", b" [at] ", b"[at]", b" @ "):
            yield local + at + domain, 1
            yield local + at + domain.replace(b".", b" (dot) "), 1
    elif kind == "ip":
        parts = part.split(b".")
        wrong = [*parts[: choice % 4], str(300 + choice % 700).encode(), *parts[choice % 4 + 1 :]]
        for between in (b":", b","):
            yield between.join(parts), 1
            yield between.join(wrong), 0
    elif kind == "card":
        for between in (b".", b"  ", b" - "):
            yield _regrouped(digits, between), 1
            yield _regrouped(_other_digit(digits), between), 0
    else:
        bare = part.lstrip(b"+")
        yield bare, 1
        yield re.sub(rb"[^0-9]+", b".", bare), 1


def taught(text: bytes, base: list[Span]) -> list[dict]:
    """Rewritten base spans between their neighbours: kind, right, features."""
    found = []
    for kind, start, end in base:
        before, after = text[max(0, start - 2 * CONTEXT) : start], text[end : end + CONTEXT]
        for part, right in rewritten(kind, text[start:end], start + end):
            piece = before + part + after
            span = (f"{kind}_like", len(before), len(before) + len(part))
            if any(a < span[2] and b > span[1] for _, a, b in base_spans(piece)):
                continue
            if span in proposals(piece):
                values = np.array(features(piece, span))
                found.append({"kind": span[0], "right": right, "features": values})
    return found


def _edges(text: bytes, spans: list[Span]) -> dict[int, int]:
    """Place in code points of each edge of the spans."""
    places, at, count = {}, 0, 0
    plain = text.isascii()
    for edge in sorted({edge for span in spans for edge in span[1:]}):
        count = edge if plain else count + len(text[at:edge].decode("utf-8", "replace"))
        at = edge
        places[edge] = count
    return places


_FOUND = pa.struct(
    [(f"n_{kind}", pa.int64()) for kind in BASE]
    + [
        ("base_sha256", pa.string()),
        ("base", pa.string()),
        (
            "proposed",
            pa.list_(
                pa.struct(
                    [
                        ("kind", pa.string()),
                        ("start", pa.int64()),
                        ("stop", pa.int64()),
                        ("right", pa.int32()),
                        ("known", pa.bool_()),
                        ("features", pa.list_(pa.float64())),
                    ]
                )
            ),
        ),
        (
            "taught",
            pa.list_(
                pa.struct(
                    [
                        ("kind", pa.string()),
                        ("right", pa.int32()),
                        ("features", pa.list_(pa.float64())),
                    ]
                )
            ),
        ),
    ]
)
_FOUND_DDL = (
    "struct<"
    + ",".join(f"n_{kind}:bigint" for kind in BASE)
    + ",base_sha256:string,base:string,proposed:array<struct<kind:string,start:bigint,"
    "stop:bigint,right:int,known:boolean,features:array<double>>>,"
    "taught:array<struct<kind:string,right:int,features:array<double>>>>"
)


def look(text: bytes) -> dict:
    """Counts and digest of the base spans of a text, and its proposals."""
    base = base_spans(text)
    offered = list(judged(text, base))
    place = _edges(text, base + [span for span, *_ in offered])
    listed = ",".join(f"{kind}:{place[a]}:{place[b]}" for kind, a, b in base)
    kinds = [span[0] for span in base]
    return {f"n_{kind}": kinds.count(kind) for kind in BASE} | {
        "base_sha256": hashlib.sha256(listed.encode()).hexdigest(),
        "base": listed,
        "proposed": [
            {
                "kind": span[0],
                "start": place[span[1]],
                "stop": place[span[2]],
                "right": int(right),
                "known": known,
                "features": np.array(features(text, span)),
            }
            for span, right, known in offered
        ],
        "taught": taught(text, base),
    }


def _look_all(texts: pa.Array) -> pa.Array:
    done, rows, gathered = [pa.array([], _FOUND)], [], 0
    for text in texts:
        rows.append(look(text.as_py()))
        gathered += len(rows[-1]["proposed"]) + len(rows[-1]["taught"])
        if gathered >= AT_ONCE:
            done.append(pa.array(rows, _FOUND))
            rows, gathered = [], 0
    return pa.concat_arrays([*done, pa.array(rows, _FOUND)])


def _widest(level: list[dict]) -> list[dict]:
    """Spans that do not overlap and cover the most; of equally good choices the evenest."""
    level = sorted(level, key=lambda r: (r["stop"], r["start"], r["kind"]))
    stops = [r["stop"] for r in level]
    best, before = [(0, 0)], []
    for i, rival in enumerate(level):
        before.append(bisect_right(stops, rival["start"], 0, i))
        width = rival["stop"] - rival["start"]
        covered, uneven = best[before[i]]
        best.append(max(best[i], (covered + width, uneven - width * width)))
    taken, i = [], len(level)
    while i:
        if best[i] == best[i - 1]:
            i -= 1
        else:
            taken.append(level[i - 1])
            i = before[i - 1]
    return taken


def best_apart(rivals: list[dict]) -> list[dict]:
    """Spans that do not overlap: the best by score, of equal scores those that cover the most."""
    taken, starts, stops = [], [], []
    for _, level in groupby(sorted(rivals, key=lambda r: -r["score"]), lambda r: r["score"]):
        free = []
        for rival in level:
            place = bisect_right(stops, rival["start"])
            if place == len(starts) or starts[place] >= rival["stop"]:
                free.append(rival)
        taken += _widest(free)
        starts = sorted(r["start"] for r in taken)
        stops = sorted(r["stop"] for r in taken)
    return taken


_RIVALS = pa.list_(
    pa.struct(
        [
            ("score", pa.float64()),
            ("start", pa.int64()),
            ("stop", pa.int64()),
            ("kind", pa.string()),
        ]
    )
)
_RIVALS_DDL = "array<struct<score:double,start:bigint,stop:bigint,kind:string>>"


def _best_of_all(rows: pa.Array) -> pa.Array:
    return pa.array([best_apart(row.as_py()) for row in rows], _RIVALS)


def isotonic(right: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The rising shares that fit ``right`` of ``rows`` at rising scores best: pools of neighbours."""
    pools: list[list[float]] = []  # right, rows, scores
    for good, all_ in zip(right.tolist(), rows.tolist(), strict=True):
        pools.append([good, all_, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            good, all_, n = pools.pop()
            pools[-1] = [pools[-1][0] + good, pools[-1][1] + all_, pools[-1][2] + n]
    return np.concatenate([np.empty(0), *(np.full(int(n), g / a) for g, a, n in pools)])


def thresholds(
    kinds: list[str], scores: np.ndarray, right: np.ndarray, rows: np.ndarray | None = None
) -> dict[str, float]:
    """For each kind the lowest score whose calibrated share of right ones is ``PRECISION``.

    Each place stands for one labelled span or, with ``rows``, for so many, of which ``right``
    are. A kind with fewer than ``MIN_EXAMPLES`` right ones has none.
    """
    rows = np.ones(len(right), int) if rows is None else rows
    found = {}
    for kind in ADDED:
        own = np.array([k == kind for k in kinds], bool)
        if right[own].sum() < MIN_EXAMPLES:
            continue
        score, place = np.unique(scores[own], return_inverse=True)
        share = isotonic(np.bincount(place, right[own]), np.bincount(place, rows[own]))
        if share[-1] >= PRECISION:
            found[kind] = float(score[np.flatnonzero(share >= PRECISION)[0]])
    return found


def _score(model, offered: DataFrame) -> DataFrame:
    scored = model.transform(offered.withColumn("vector", array_to_vector("features")))
    return scored.withColumn("score", F.round(vector_to_array("probability")[1], SCORE_DIGITS))


def _drawn(offered: DataFrame) -> DataFrame:
    """kind, hash: the proposals to learn from, ``SAMPLE`` of each family at most.

    Of each of 64 parts the smallest hashes are taken, every other one, so that no task holds a
    whole family and more are left to set the threshold. Proposals with the same hash, those of
    rows that repeat, are one.
    """
    rank = F.row_number().over(Window.partitionBy("kind", "part").orderBy("hash"))
    return settle(
        offered.select("kind", "hash")
        .distinct()
        .withColumn("part", F.pmod("hash", F.lit(64)))
        .withColumn("rank", rank)
        .filter((F.col("rank") <= 2 * SAMPLE // 64) & (F.col("rank") % 2 == 0))
        .select("kind", "hash")
    )


def selected(
    offered: DataFrame, key: str = "row", lessons: DataFrame | None = None
) -> DataFrame | None:
    """Of the proposals those to be added; None if there is too little to learn from.

    ``lessons`` are labelled spans (key, number, kind, right, features) that are no proposals. At
    most ``SAMPLE`` labelled spans of each family teach, drawn by a hash of ``key`` and their
    place. ``key`` tells rows apart however the table is dealt, so the draw does not depend on
    partitions. All other labelled spans are scored and set the thresholds, by a count for each
    score. What is added of a row does not overlap.
    """
    place = F.xxhash64(key, "kind", "start", "stop").alias("hash")
    told = ("row", "kind", "start", "stop", "right", "known", "features")
    hashed = offered.select(*told, place)
    if lessons is not None:
        lone = [F.lit(None).cast("bigint").alias(c) for c in ("row", "start", "stop")]
        learnt = lessons.select(
            lone[0], "kind", *lone[1:], "right", F.lit(True).alias("known"), "features",
            F.xxhash64(key, "kind", "number", F.lit("lesson")).alias("hash"),
        )
        hashed = hashed.unionByName(learnt)
    drawn = F.broadcast(_drawn(hashed))
    teaching = settle(
        hashed.join(drawn, ["kind", "hash"], "left_semi")
        .select("kind", "hash", "right", "features")
        .dropDuplicates(["kind", "hash"])
        .coalesce(1)
        .sortWithinPartitions("kind", "hash")
    )
    classes = {row["right"]: row["count"] for row in teaching.groupBy("right").count().collect()}
    if min(classes.get(0, 0), classes.get(1, 0)) < MIN_EXAMPLES:
        return None
    trees = GBTClassifier(
        labelCol="right", featuresCol="vector", maxIter=TREES, maxDepth=DEPTH, seed=1
    )
    model = trees.fit(teaching.withColumn("vector", array_to_vector("features")))
    scored = settle(_score(model, hashed).select(*told[:-1], "hash", "score"))
    held = (
        scored.join(drawn, ["kind", "hash"], "left_anti")
        .groupBy("kind", "score")
        .agg(F.sum("right").alias("right"), F.count("*").alias("rows"))
        .collect()
    )
    limits = thresholds(
        [row["kind"] for row in held],
        np.array([row["score"] for row in held], float),
        np.array([row["right"] for row in held], int),
        np.array([row["rows"] for row in held], int),
    )
    limit: Column = F.lit(None).cast("double")
    for kind, value in limits.items():
        limit = F.when(F.col("kind") == kind, F.lit(value)).otherwise(limit)
    fresh = scored.filter("not known").filter(F.col("score") >= limit)
    best = F.arrow_udf(_best_of_all, _RIVALS_DDL).asNondeterministic()
    return (
        fresh.groupBy("row")
        .agg(F.collect_list(F.struct("score", "start", "stop", "kind")).alias("rivals"))
        .select("row", F.inline(best("rivals")))
        .select("row", "kind", "start", "stop")
    )


def find_personal_data(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans: a row for each row of ``docs``.

    Added spans meet no base span and no other; they are listed after those. A null text is empty; rows that
    repeat are found alike, and rows without an id are no exception. Where there is too little
    to learn from, as in an empty table, only base spans are found. Other columns are not read.
    What is kept between the steps is the proposals, a few numbers each.
    """
    look_all = F.arrow_udf(_look_all, _FOUND_DDL).asNondeterministic()
    found = settle(
        docs.select(
            F.col(id).alias("doc_id"),
            F.xxhash64(F.col(id), text_bytes(text)).alias("key"),
            look_all(text_bytes(text)).alias("f"),
        )
        .select("doc_id", "key", "f.*")
        .withColumn("row", F.monotonically_increasing_id())
    )
    offered = found.select("row", "key", F.inline("proposed"))
    lessons = found.select("key", F.posexplode("taught").alias("number", "lesson")).select(
        "key", "number", "lesson.*"
    )
    added = selected(offered, "key", lessons)
    rows = found.drop("proposed", "taught", "key")
    if added is None:
        return rows.withColumnRenamed("base", "spans").drop("row")
    number = F.array_position(F.array(*map(F.lit, ADDED)), F.col("kind"))
    listed = added.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct(number.alias("n"), "start", "stop", "kind"))).alias(
            "added"
        )
    )
    more = F.transform("added", lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"]))
    spans = F.concat_ws(
        ",", F.when(F.col("base") != "", F.col("base")), F.coalesce(more, F.array())
    )
    return rows.join(listed, "row", "left").withColumn("spans", spans).drop("row", "base", "added")


def redact(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with each span replaced by its kind in brackets.

    All rows stay, each once and redacted by its own text, also if they share an id or have none;
    those without a text stay as they are. Rows are told apart by a 64-bit hash of id and text.
    """

    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for whole, listed in zip(texts.to_pylist(), spans.to_pylist(), strict=True):
            if whole is not None and listed:
                named = [s.split(":") for s in listed.split(",")]
                parts, at = [], 0
                for kind, start, stop in sorted(named, key=lambda s: int(s[1])):
                    if int(start) >= at:
                        parts += [whole[at : int(start)], f"[{kind.upper()}]"]
                    at = max(at, int(stop))
                whole = "".join([*parts, whole[at:]])
            out.append(whole)
        return pa.array(out, pa.string())

    row = F.xxhash64(F.col(id), F.col(text))
    keyed = docs.select(row.alias("doc_id"), F.col(text).alias("text"))
    found = find_personal_data(keyed).filter("spans != ''")
    # rows that are equal in id and text have equal spans
    spans = found.groupBy("doc_id").agg(F.first("spans").alias("spans"))
    rows = docs.select(F.struct("*").alias("old"), row.alias("doc_id")).join(
        spans, "doc_id", "left"
    )
    clean = F.arrow_udf(cut, "string")(F.col("old")[text], F.col("spans"))
    return rows.select(
        *[(clean if c == text else F.col("old")[c]).alias(c) for c in docs.columns]
    )

"""Benchmark passages in training text, found by spaced seeds, with built-in functions only.

A seed is the hash of the words at the places of a mask, so a substituted word between them
does no harm. Seeds that a document and a benchmark item share give a diagonal on which the two
are laid, and on it the words are compared one by one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import settle, small_side

#: Places of the words of a seed. With both masks, no pattern of one substitution in 8 words,
#: two in 10 or 12, or three in 15 hides a passage.
MASKS = ((0, 4, 5, 6), (0, 2, 4, 7))
#: Items of fewer words hold no place for a substitution: they are found by the hash of all their
#: words in a row, so a document holds one only verbatim.
MIN_WORDS = 8
#: Words of a passage (or the whole item, if that is shorter) and how many of 100 must be equal.
PASSAGE = 25
PERCENT = 80
#: Rows of seeds or candidates that may be broadcast.
MAX_BROADCAST = 500_000
#: 64-bit words of the bitmap of seeds that is broadcast instead of more seeds than that (16 MB).
BITMAP_WORDS = 1 << 21


def words(text: str) -> Column:
    """Hashes of the words of a text: runs of letters and figures, in lower case."""
    plain = F.trim(F.regexp_replace(F.lower(F.col(text)), r"[^\p{L}\p{N}]+", " "))
    split = F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))
    return F.transform(split, lambda word: F.xxhash64(word))


def once(value: Column) -> Column:
    """``value`` as a column of a row of its own, so that it is not worked out at each use."""
    return F.explode(F.array(value))


def seeds(hashes: Column, masks: Sequence[tuple[int, ...]] = MASKS) -> Column:
    """The seeds of all masks at all places, as (seed, place)."""

    def of(mask: tuple[int, ...]) -> Column:
        # two masks of as many words must not give the same seeds
        number = MASKS.index(mask) if mask in MASKS else len(MASKS) + len(mask)
        last = F.size(hashes) - mask[-1]
        here = F.transform(
            F.sequence(F.lit(0), F.greatest(last - 1, F.lit(0))),
            lambda at: F.struct(
                F.xxhash64(F.lit(number), *[F.get(hashes, at + place) for place in mask]).alias(
                    "seed"
                ),
                at.alias("place"),
            ),
        )
        return F.when(last > 0, here)

    none = F.array().cast("array<struct<seed:bigint,place:int>>")
    return F.concat(*[F.coalesce(of(mask), none) for mask in masks])


def in_a_row(n: int) -> tuple[int, ...]:
    """The mask of all ``n`` words of a short item."""
    return tuple(range(n))


def item_seeds(hashes: Column) -> Column:
    """The seeds by which an item is looked for: those of the masks, or of all its words."""
    found = F.when(F.size(hashes) >= MIN_WORDS, seeds(hashes))
    for n in range(1, MIN_WORDS):
        found = found.when(F.size(hashes) == n, seeds(hashes, [in_a_row(n)]))
    return found


def items(benchmark: DataFrame, id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, item: the words of the different items; of equal ones the smallest id."""
    return (
        benchmark.filter(F.col(id).isNotNull() & F.col(text).isNotNull())
        .select(F.col(id).alias("item_id"), words(text).alias("item"))
        .filter(F.size("item") > 0)
        .groupBy("item")
        .agg(F.min("item_id").alias("item_id"))
    )


def _word_of(seed: Column) -> Column:
    return F.pmod(F.shiftright(seed, 6), F.lit(BITMAP_WORDS)).cast("int")


def _bit_of(seed: Column) -> Column:
    return seed.bitwiseAND(F.lit(63)).cast("int")


def _marked(seed: Column, bits: Column) -> Column:
    return F.getbit(F.get(bits, _word_of(seed)), _bit_of(seed)) == 1


def bitmap(known: DataFrame) -> DataFrame:
    """bits: one row of ``BITMAP_WORDS`` words in which each seed has marked a bit."""
    one_bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), _bit_of(F.col("seed")))
    words = known.groupBy(_word_of(F.col("seed")).alias("id")).agg(F.bit_or(one_bit).alias("w"))
    all_words = known.sparkSession.range(BITMAP_WORDS).join(words, "id", "left")
    ordered = F.array_sort(
        F.collect_list(F.struct("id", F.coalesce("w", F.lit(0).cast("bigint")).alias("w")))
    )
    return all_words.agg(F.transform(ordered, lambda s: s["w"]).alias("bits"))


def equal_words(doc: Column, item: Column, shift: Column) -> Column:
    """1 or 0 for each word of an item laid on a document from word ``shift``."""
    return F.transform(
        item, lambda word, at: F.when(F.get(doc, shift + at) == word, 1).otherwise(0)
    )


def best_window(equal: Column) -> Column:
    """The most equal words of a window."""
    size = F.least(F.size(equal), F.lit(PASSAGE))
    return F.array_max(
        F.transform(
            F.sequence(F.lit(1), F.size(equal) - size + 1),
            lambda at: F.aggregate(F.slice(equal, at, size), F.lit(0), lambda a, b: a + b),
        )
    )


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """doc_id, item_id, item_words, matched, place: a row for each document and item it holds.

    A document holds an item if, laid on it without gaps, ``PERCENT`` of 100 words are equal in
    some ``PASSAGE`` words of the item, or in all of a shorter one; an item of fewer than
    ``MIN_WORDS`` words must be there verbatim. ``matched`` counts the equal
    words of the best such window, ``place`` is the word of the document on which the item would
    begin (the first of equally good ones). Documents without an id or text, and items without,
    hold nothing; rows of a document that repeat give one result; an empty table on either side
    gives an empty one. Other columns are not read.

    Seeds of the benchmark are broadcast if there are at most ``MAX_BROADCAST``. Else a bitmap
    of them is worked out once, of a fixed size, and only seeds of documents that hit it are
    shuffled to those of the benchmark. The candidates are joined with the documents in which they are verified
    by broadcast up to the same number, else by shuffle.
    """
    wanted = settle(items(benchmark, item_id, item_text))
    known = settle(
        wanted.select("item_id", F.inline(item_seeds(F.col("item")))).select(
            "item_id", "seed", F.col("place").alias("item_place")
        )
    )
    whole = docs.filter(F.col(id).isNotNull() & F.col(text).isNotNull()).select(
        F.col(id).alias("doc_id"), F.col(text).alias("text")
    )
    short = wanted.select(F.size("item").alias("n")).filter(F.col("n") < MIN_WORDS).distinct()
    masks = [*MASKS, *(in_a_row(row["n"]) for row in short.orderBy("n").collect())]
    found = whole.select("doc_id", once(words("text")).alias("doc")).select(
        "doc_id", F.inline(seeds(F.col("doc"), masks))
    )
    if known.count() <= MAX_BROADCAST:
        hits = found.join(F.broadcast(known), "seed")
    else:
        hits = found.filter(_marked(F.col("seed"), bitmap(known).scalar())).join(known, "seed")
    candidates = settle(
        hits.select(
            "doc_id", "item_id", (F.col("place") - F.col("item_place")).alias("shift")
        ).distinct()
    )
    laid = (
        whole.join(small_side(candidates, MAX_BROADCAST), "doc_id")
        .join(small_side(wanted, 10_000), "item_id")
        .select("doc_id", "item_id", "shift", "item", once(words("text")).alias("doc"))
    )
    compared = laid.select(
        "doc_id",
        "item_id",
        "shift",
        F.size("item").alias("item_words"),
        once(equal_words(F.col("doc"), F.col("item"), F.col("shift"))).alias("equal"),
    ).withColumn("matched", best_window(F.col("equal")))
    enough = 100 * F.col("matched") >= PERCENT * F.least("item_words", F.lit(PASSAGE))
    best = F.min(F.struct(-F.col("matched"), "shift"))
    return (
        compared.filter(enough)
        .groupBy("doc_id", "item_id", "item_words")
        .agg(best.alias("best"))
        .select(
            "doc_id",
            "item_id",
            "item_words",
            (-F.col("best.col1")).alias("matched"),
            F.col("best.shift").alias("place"),
        )
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item of the benchmark, with all their columns.

    Each row is judged by its own text, whatever its id; rows without a text stay. Texts are told
    apart by 64-bit hashes.
    """
    key = F.xxhash64(F.col(text))
    keyed = docs.select(key.alias("doc_id"), F.col(text).alias("text"))
    found = contaminated(keyed, benchmark)
    held = settle(found.select(F.col("doc_id").alias("held")).distinct())
    whole = docs.select(F.struct("*").alias("doc"), key.alias("held"))
    return whole.join(small_side(held, MAX_BROADCAST), "held", "left_anti").select("doc.*")


def _sql_words(table: str, id: str) -> str:
    plain = r"trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g'))"
    return (
        f"SELECT {id}, CASE WHEN {plain} = '' THEN [] ELSE string_split({plain}, ' ') END AS w"
        f" FROM {table} WHERE {id} IS NOT NULL AND text IS NOT NULL"
    )


def _sql_seeds(table: str, id: str, masks: dict[str, tuple[int, ...]], only: str) -> str:
    def one(name: str, mask: tuple[int, ...]) -> str:
        parts = " || ' ' || ".join(f"w[p + {place + 1}]" for place in mask)
        where = only.format(n=len(mask) if mask not in MASKS else 0)
        return (
            f"SELECT {id}, '{name} ' || {parts} AS seed, p AS place FROM (SELECT {id}, w,"
            f" unnest(range(len(w) - {mask[-1]})) AS p FROM {table} WHERE {where})"
        )

    return " UNION ALL ".join(one(*mask) for mask in masks.items())


_SQL_MASKS = {f"m{i}": mask for i, mask in enumerate(MASKS)} | {
    f"r{n}": in_a_row(n) for n in range(1, MIN_WORDS)
}


#: The same by joins of words, for engines without Spark.
SQL = f"""
WITH docs AS ({_sql_words("documents", "doc_id")}),
wanted AS (
  SELECT min(item_id) AS item_id, w FROM ({_sql_words("benchmark", "item_id")})
  WHERE len(w) > 0 GROUP BY w
),
item_seeds AS ({_sql_seeds(
    "wanted", "item_id", _SQL_MASKS, f"len(w) = {{n}} OR {{n}} = 0 AND len(w) >= {MIN_WORDS}"
)}),
doc_seeds AS ({_sql_seeds(
    "docs", "doc_id", _SQL_MASKS, "{n} = 0 OR {n} IN (SELECT len(w) FROM wanted)"
)}),
candidates AS (
  SELECT DISTINCT doc_id, item_id, d.place - i.place AS shift
  FROM doc_seeds d JOIN item_seeds i USING (seed)
),
laid AS (
  SELECT doc_id, item_id, shift, len(i.w) AS n,
    list_transform(range(len(i.w)), lambda p:
      CASE WHEN shift + p >= 0 AND d.w[shift + p + 1] = i.w[p + 1] THEN 1 ELSE 0 END) AS same
  FROM candidates JOIN docs d USING (doc_id) JOIN wanted i USING (item_id)
),
compared AS (
  SELECT doc_id, item_id, shift, n, list_max(list_transform(
    range(n - least(n, {PASSAGE}) + 1), lambda p:
      list_sum(same[p + 1 : p + least(n, {PASSAGE})]))) AS matched
  FROM laid
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY matched DESC, shift) AS r
  FROM compared WHERE 100 * matched >= {PERCENT} * least(n, {PASSAGE})
)
SELECT doc_id, item_id, CAST(n AS INTEGER) AS item_words, CAST(matched AS INTEGER) AS matched,
  CAST(shift AS INTEGER) AS place
FROM ranked WHERE r = 1
"""

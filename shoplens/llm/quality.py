"""Quality rules whose limits follow the corpus: quantile sketches per language and source.

The sketch of a measure is a histogram over logarithmic classes of whole numbers: a value keeps
its eight leading binary digits, so a quantile read from it is at most 1/128 too low. Sketches
of two sets merge by adding their counts, in any order and with the same result.
"""

from __future__ import annotations

import operator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.common import settle, small_side, text_bytes

#: Words of a window whose repetition counts.
WINDOW = 5
SYMBOLS = b"#*$%&|<>"
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"

#: Fewer words than this fail the base rules, and so do more repeated words than this percentage.
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20

#: Leading binary digits that the sketch keeps of a value.
DIGITS = 8
#: Documents of the wider group that count with those of a language and source, or of a language.
PRIOR = 20
#: Distances between the quartiles that a limit lies above the upper or below the lower quartile.
REACH = 4

COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
    "n_echoes",
)
_COUNTS = pa.struct([(name, pa.int64()) for name in COUNTS])
_COUNTS_DDL = "struct<" + ",".join(f"{name}:bigint" for name in COUNTS) + ">"

#: measure -> numerator, denominator, factor that makes it a whole number, spread of a group whose
#: quartiles are equal, whether there is a lower limit, too
MEASURES = {
    "symbol_share": ("n_symbols", "word_chars", 1_000_000, 10_000, False),
    "dup_line_share": ("n_dup_lines", "n_lines", 1_000_000, 50_000, False),
    "repeat_share": ("n_repeat_words", "n_words", 1_000_000, 30_000, False),
    "echo_share": ("n_echoes", "n_words", 1_000_000, 30_000, False),
    "word_length": ("word_chars", "n_words", 1_000, 500, True),
}


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words found twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    for word in words:
        numbers.setdefault(word, len(numbers))
    if len(numbers) == len(words):
        return 0
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    base = len(numbers)
    code = ids[:n].copy()
    most = base
    for k in range(1, window):
        if most > 2**62 // base:  # so that the codes stay exact, number the different ones
            code = np.unique(code, return_inverse=True)[1]
            most = int(code.max()) + 1
        code = code * base + ids[k : k + n]
        most *= base
    order = np.argsort(code, kind="stable")
    same = np.flatnonzero(code[order[1:]] == code[order[:-1]])
    if not len(same):
        return 0
    starts = np.unique(np.concatenate([order[same], order[same + 1]]))
    edge = np.zeros(len(words) + 1, np.int64)
    edge[starts] += 1
    edge[starts + window] -= 1
    return int(np.count_nonzero(np.cumsum(edge)[:-1]))


def count_text(text: bytes) -> tuple[int, ...]:
    """The counts of one text, in the order of ``COUNTS``."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    bare = text.translate(None, BLANKS)
    return (
        len(words),
        len(bare.decode("utf-8", "replace")),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
        sum(map(operator.eq, words, words[1:])),
    )


def _count(texts: pa.Array) -> pa.Array:
    rows = [count_text(text) for text in texts.to_pylist()]
    columns = zip(*rows, strict=True) if rows else [[] for _ in COUNTS]
    return pa.StructArray.from_arrays(
        [pa.array(column, pa.int64()) for column in columns], fields=list(_COUNTS)
    )


def _value(name: str) -> Column:
    """A measure as a whole number; 0 where its denominator is 0."""
    over, under, factor, _, _ = MEASURES[name]
    return F.expr(f"counts.{over} * {factor} div greatest(counts.{under}, 1)")


def count(text: str = "text") -> Column:
    """A struct of the counts of each whole text; null has no words."""
    return F.arrow_udf(_count, _COUNTS_DDL).asNondeterministic()(text_bytes(text))


def _failed_base() -> Column:
    words = F.col("counts.n_words")
    return (words < MIN_WORDS) | (
        100 * F.col("counts.n_repeat_words") > MAX_REPEATED_PERCENT * words
    )


def sketch(measured: DataFrame) -> DataFrame:
    """lang, source, measure, value, n: the sketches of each language and source.

    ``measured``: lang, source, counts. Only documents that pass the base rules count. Null is
    a language and a source like any other. Each task adds up its own rows first, so a source
    with a third of all documents costs no more than another.
    """
    measures = F.array(
        *[F.struct(F.lit(name).alias("measure"), _value(name).alias("value")) for name in MEASURES]
    )
    lower = f"value - value % shiftleft(1L, greatest(length(bin(value)) - {DIGITS}, 0))"
    return (
        measured.filter(~_failed_base())
        .select("lang", "source", F.inline(measures))
        .withColumn("value", F.expr(lower))
        .groupBy("lang", "source", "measure", "value")
        .agg(F.count("*").alias("n"))
    )


def merge(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """The sketches of larger groups, told apart by ``keys`` only."""
    return sketches.groupBy(*keys, "measure", "value").agg(F.sum("n").alias("n"))


def quartiles(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """keys, measure, size, q1, q3 from the sketches; a group has at most some thousand rows."""
    group = Window.partitionBy(*keys, "measure")
    to_here = F.sum("n").over(group.orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    ranked = sketches.withColumn("to_here", to_here).withColumn("size", F.sum("n").over(group))
    return ranked.groupBy(*keys, "measure", "size").agg(
        F.min(F.when(4 * F.col("to_here") >= F.col("size"), F.col("value"))).alias("q1"),
        F.min(F.when(4 * F.col("to_here") >= 3 * F.col("size"), F.col("value"))).alias("q3"),
    )


def _shrunk(level: DataFrame, wider: DataFrame | None, keys: list[str]) -> DataFrame:
    """keys, measure, q1, q3, spread of the groups of a level, drawn to the wider group of each.

    The spread of a group is the distance of its quartiles; only where these are equal, it is
    that of ``MEASURES``. The wider group counts like ``PRIOR`` documents more, so the fewer
    documents a group has, the nearer it lies to that.
    """
    flat = F.create_map(*[F.lit(x) for name, m in MEASURES.items() for x in (name, m[3])])
    distance = F.col("q3") - F.col("q1")
    own = level.withColumn(
        "spread", F.when(distance > 0, distance).otherwise(flat[F.col("measure")])
    )
    if wider is None:
        return own.select("measure", "q1", "q3", "spread")
    named = wider.select(*[F.col(c).alias(f"wide_{c}") for c in wider.columns])
    same = own["measure"] == named["wide_measure"]
    for key in set(keys) & set(wider.columns):
        same &= own[key].eqNullSafe(named[f"wide_{key}"])
    drawn = [
        F.expr(f"(size * {c} + {PRIOR} * wide_{c}) div (size + {PRIOR})").alias(c)
        for c in ("q1", "q3", "spread")
    ]
    return own.join(named, same).select(*keys, "measure", *drawn)


def limits(sketches: DataFrame) -> DataFrame:
    """lang, source and, for each measure, ``<measure>_low`` and ``<measure>_high``.

    A limit lies ``REACH`` spreads beyond the quartiles of the language and source, both drawn to
    those of the language, which are drawn to those of all documents.
    """
    of_all = _shrunk(quartiles(merge(sketches, []), []), None, [])
    # a row for each measure
    of_lang = _shrunk(
        quartiles(merge(sketches, ["lang"]), ["lang"]), F.broadcast(of_all), ["lang"]
    )
    rows = _shrunk(quartiles(sketches, ["lang", "source"]), of_lang, ["lang", "source"])
    spread = REACH * F.col("spread")
    at = lambda name, value: F.max(F.when(F.col("measure") == name, value))
    return rows.groupBy("lang", "source").agg(
        *[at(name, F.col("q1") - spread).alias(f"{name}_low") for name in MEASURES],
        *[at(name, F.col("q3") + spread).alias(f"{name}_high") for name in MEASURES],
    )


def judge(measured: DataFrame, limit_rows: DataFrame) -> DataFrame:
    """``measured`` with ``base_failed`` and ``kept``.

    A document stays if it passes the base rules and all its measures lie within the limits of
    its language and source. The limits are broadcast if their number of rows allows it.
    """
    table = small_side(
        limit_rows.withColumnsRenamed({"lang": "limit_lang", "source": "limit_source"})
    )
    within = F.lit(True)
    for name, (_, _, _, _, low) in MEASURES.items():
        within &= F.coalesce(_value(name) <= F.col(f"{name}_high"), F.lit(True))
        if low:
            within &= F.coalesce(_value(name) >= F.col(f"{name}_low"), F.lit(True))
    same = F.col("lang").eqNullSafe(F.col("limit_lang")) & F.col("source").eqNullSafe(
        F.col("limit_source")
    )
    return (
        measured.join(table, same, "left")
        .withColumn("base_failed", _failed_base())
        .withColumn("kept", ~F.col("base_failed") & within)
        .drop(*table.columns)
    )


def rate(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
) -> DataFrame:
    """doc_id, the counts, ``base_failed`` and ``kept`` of each document.

    One row for each row of ``docs``, also if rows repeat or an id is null; an empty table gives
    an empty one. Other columns are not read. Texts are read once; what is kept between the
    sketches and the verdict is the counts.
    """
    measured = settle(
        docs.select(
            F.col(id).alias("doc_id"),
            F.col(lang).alias("lang"),
            F.col(source).alias("source"),
            count(text).alias("counts"),
        )
    )
    judged = judge(measured, settle(limits(sketch(measured))))
    return judged.select("doc_id", "counts.*", "base_failed", "kept")


def keep_good(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source"
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Texts are counted twice, once for the limits and once for the verdict, so that no text is
    moved between machines.
    """
    needed = F.struct(
        F.col(lang).alias("lang"), F.col(source).alias("source"), count(text).alias("counts")
    )
    found = settle(limits(sketch(docs.select(needed.alias("m")).select("m.*"))))
    rows = docs.select(F.struct("*").alias("row"), needed.alias("m")).select("row", "m.*")
    return judge(rows, found).filter("kept").select("row.*")


def _sql() -> str:
    values = " UNION ALL ".join(
        f"SELECT doc_id, lang, source, base_failed, '{name}' AS measure,"
        f" {over} * {factor} // greatest({under}, 1) AS value, {low} AS low FROM counted"
        for name, (over, under, factor, _, low) in MEASURES.items()
    )
    whens = " ".join(f"WHEN '{name}' THEN {m[3]}" for name, m in MEASURES.items())
    flat = f"CASE measure {whens} END"

    def drawn(own: str, wide: str) -> str:
        return ", ".join(
            f"({own}.size * {own}.{c} + {PRIOR} * {wide}.{c}) // ({own}.size + {PRIOR}) AS {c}"
            for c in ("q1", "q3", "spread")
        )

    to_here = "ORDER BY value ROWS UNBOUNDED PRECEDING"

    def level(name: str, keys: str) -> str:
        part = f"{keys}measure"
        return f"""
{name} AS (
  SELECT {part}, size, min(value) FILTER (WHERE 4 * here >= size) AS q1,
    min(value) FILTER (WHERE 4 * here >= 3 * size) AS q3
  FROM (
    SELECT {part}, value, sum(n) OVER (PARTITION BY {part} {to_here}) AS here,
      sum(n) OVER (PARTITION BY {part}) AS size
    FROM (SELECT {part}, value, count(*) AS n FROM sketch GROUP BY ALL)
  ) GROUP BY ALL
)"""

    return rf"""
WITH words AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
windows AS (
  SELECT doc_id, p, array_to_string(w[p : p + {WINDOW - 1}], ' ') AS five
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS p FROM words)
),
repeated AS (
  SELECT doc_id, count(DISTINCT q) AS n_repeat_words
  FROM (
    SELECT doc_id, unnest(range(p, p + {WINDOW})) AS q
    FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, five) AS often FROM windows)
    WHERE often > 1
  ) GROUP BY doc_id
),
lines AS (
  SELECT doc_id, list_filter(string_split(text, chr(10)),
    lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM words
),
counted AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words
    AS base_failed
  FROM (
    SELECT doc_id, lang, source, len(w) AS n_words,
      coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
      length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
      len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
      coalesce(n_repeat_words, 0) AS n_repeat_words,
      len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_echoes
    FROM words JOIN lines USING (doc_id) LEFT JOIN repeated USING (doc_id)
  )
),
measured AS ({values}),
sketch AS (
  SELECT lang, source, measure,
    value - value % CAST(power(2, greatest(length(bin(value)) - {DIGITS}, 0)) AS BIGINT) AS value
  FROM measured WHERE NOT base_failed
),
{level("own", "lang, source, ")},
{level("of_lang", "lang, ")},
{level("of_all", "")},
drawn_all AS (
  SELECT measure, q1, q3, CASE WHEN q3 > q1 THEN q3 - q1 ELSE {flat} END AS spread FROM of_all
),
drawn_lang AS (
  SELECT lang, measure, {drawn("o", "w")}
  FROM (SELECT *, CASE WHEN q3 > q1 THEN q3 - q1 ELSE {flat} END AS spread FROM of_lang) o
  JOIN drawn_all w USING (measure)
),
limits AS (
  SELECT o.lang, o.source, o.measure, {drawn("o", "w")}
  FROM (SELECT *, CASE WHEN q3 > q1 THEN q3 - q1 ELSE {flat} END AS spread FROM own) o
  JOIN drawn_lang w ON o.measure = w.measure AND o.lang IS NOT DISTINCT FROM w.lang
),
outside AS (
  SELECT DISTINCT doc_id FROM measured m JOIN limits i USING (measure)
  WHERE m.lang IS NOT DISTINCT FROM i.lang AND m.source IS NOT DISTINCT FROM i.source
    AND (value > q3 + {REACH} * spread OR low AND value < q1 - {REACH} * spread)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND outside.doc_id IS NULL AS kept
FROM counted LEFT JOIN outside USING (doc_id)
"""


#: The same for engines without Spark, for tables whose ids do not repeat.
SQL = _sql()

from collections import Counter

import llm_cases as cases
from pyspark.sql import functions as F
from shoplens.llm import quality


def counted(text):
    text = text or ""
    words = cases.WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if cases.WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_counts_and_base_rules_of_odd_texts(spark):
    result = quality.rate(cases.documents(spark))
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    expected = []
    for doc, text in cases.odd_texts():
        counts = counted(text)
        expected.append((doc, *counts, counts[0] < 10 or 100 * counts[4] > 20 * counts[0]))
    assert cases.found(result, "doc_id", *columns, "base_failed") == sorted(
        expected, key=lambda r: [(v is not None, v) for v in r]
    )
    assert not result.filter("base_failed and kept").count()
    assert quality.rate(cases.none(spark)).collect() == []


def test_repeated_words_with_many_different_words():
    words = [f"{i}".encode() for i in range(20_000)]
    assert quality.repeated_words(words) == 0
    assert quality.repeated_words(words + words[100:105]) == 10
    assert quality.repeated_words([b"a"] * 5) == 0
    assert quality.repeated_words([b"a"] * 6) == 6


def symbol_texts(group, n, symbols):
    return [
        " ".join([cases.prose(1000 * group + i, 60), *(f"#{k}" for k in range(symbols(i)))])
        for i in range(n)
    ]


def test_limits_follow_the_source(spark):
    plain = symbol_texts(1, 300, lambda i: 0)
    odd = symbol_texts(2, 2, lambda i: 60)
    code = symbol_texts(3, 300, lambda i: 55 + i % 10)  # where symbols are usual
    rows = (
        [("en", "web", t) for t in plain + odd]
        + [("en", "code", t) for t in code]
        + [("en", "rare", t) for t in symbol_texts(4, 3, lambda i: 0)]
    )
    data = [(i, t, lang, source) for i, (lang, source, t) in enumerate(rows)]
    docs = spark.createDataFrame(data, "doc_id BIGINT, text STRING, lang STRING, source STRING")
    judged = quality.rate(docs).join(docs.select("doc_id", "source"), "doc_id")
    dropped = {r.doc_id for r in judged.filter("not kept and not base_failed").collect()}
    assert dropped == {300, 301}
    stay = quality.keep_good(docs)
    assert stay.columns == docs.columns
    assert {r.doc_id for r in stay.collect()} == {i for i, *_ in data} - dropped


def test_sketches_merge_to_the_sketch_of_all(spark):
    docs = cases.documents(spark)
    measured = docs.select("lang", "source", quality.count().alias("counts"))
    merged = quality.merge(quality.sketch(measured), [])
    alike = measured.withColumns({"lang": F.lit("x"), "source": F.lit("y")})
    direct = quality.sketch(alike).select("measure", "value", "n")
    assert cases.found(merged) == cases.found(direct)


def test_a_sketch_is_close(spark):
    data = [("a", "b", "m", v - v % max(1, 2 ** (v.bit_length() - 8)), 1) for v in range(1, 5000)]
    sketches = quality.merge(
        spark.createDataFrame(
            data, "lang STRING, source STRING, measure STRING, value LONG, n LONG"
        ),
        ["lang", "source"],
    )
    row = quality.quartiles(sketches, ["lang", "source"]).first()
    assert 1250 * (1 - 1 / 128) <= row.q1 <= 1250
    assert 3750 * (1 - 1 / 128) <= row.q3 <= 3750


def test_keep_good_of_odd_tables(spark):
    docs = cases.documents(spark)
    assert quality.keep_good(docs).schema.names == docs.columns
    assert quality.keep_good(cases.none(spark)).count() == 0


def quartile_rows(spark, rows):
    return spark.createDataFrame(
        rows, "lang STRING, source STRING, measure STRING, value LONG, n LONG"
    )


def test_limits_come_from_the_sketches(spark):
    """A narrow source has narrow limits, a wide one wide limits, without a least distance."""
    narrow = [("en", "narrow", "word_length", 4990 + i, 300) for i in range(21)]
    wide = [("en", "wide", "word_length", 4000 + 100 * i, 300) for i in range(21)]
    few = [("en", "few", "word_length", 5000, 1), ("en", "few", "word_length", 5001, 1)]
    flat = [("en", "flat", "word_length", 5000, 6000)]
    found = quality.limits(quartile_rows(spark, narrow + wide + few + flat))
    at = {r.source: (r.word_length_low, r.word_length_high) for r in found.collect()}
    # quartiles of the narrow source are 4,995 and 5,005, four times their distance is 40
    assert 4900 < at["narrow"][0] <= 4995 - 40 and 5005 + 40 <= at["narrow"][1] < 5100
    assert at["wide"][0] < 2000 and at["wide"][1] > 8000
    # two documents say little, so the limits are those of the language
    assert at["few"][1] - at["few"][0] < 500
    assert 5000 + 4 * 490 < at["flat"][1] <= 5000 + 4 * 500


def test_larger_groups_lean_less_on_the_language(spark):
    def high(n):
        rows = [("en", "own", "echo_share", v, n) for v in (0, 0, 1000, 1000)]
        rows += [("en", "other", "echo_share", v, 100_000) for v in (0, 0, 9000, 9000)]
        return (
            quality.limits(quality.merge(quartile_rows(spark, rows), ["lang", "source"]))
            .filter("source = 'own'")
            .first()
            .echo_share_high
        )

    highs = [high(n) for n in (1, 10, 100, 10_000)]
    assert highs == sorted(highs, reverse=True) and len(set(highs)) == 4
    assert highs[0] > 30_000 and highs[-1] < 5_100

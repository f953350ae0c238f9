import duckdb
import llm_cases as cases
import pytest
from shoplens.llm import decontaminate

ITEMS = "item_id BIGINT, text STRING, doc_id BIGINT, seed STRING, place INT"


def benchmark(spark):
    passage = cases.prose(3, 80)
    data = [
        (1, passage, 0, "x", 0),
        (0, passage, 0, "x", 0),  # the same item under a smaller id
        (2, "one two three", 0, "x", 0),
        (3, None, 0, "x", 0),
        (4, "", 0, "x", 0),
        (None, passage, 0, "x", 0),
        (5, cases.prose(20, 15), 0, "x", 0),
    ]
    return spark.createDataFrame(data, ITEMS)


def with_substitutions(text, every):
    return " ".join("swap" if i % every == every - 1 else w for i, w in enumerate(text.split()))


def leaks():
    passage, short = cases.prose(3, 80), cases.prose(20, 15)
    around = cases.prose(21, 60)
    return [
        (30, f"{around} {with_substitutions(passage, 6)} {around}"),  # 83 of 100 equal
        (31, f"{around} {with_substitutions(passage, 3)} {around}"),  # 66 of 100
        (32, f"{around} {with_substitutions(short, 5)}"),
        (33, f"{short.upper()}!!"),
        (34, " ".join(passage.split()[40:70])),  # part of an item
        (35, " ".join(short.split()[:11])),
        (36, around),
    ]


def test_leaks_are_found_in_spite_of_substitutions(spark):
    docs = cases.documents(spark, cases.odd_texts() + leaks())
    result = decontaminate.contaminated(docs, benchmark(spark))
    assert cases.found(result, "doc_id", "item_id") == [
        (8, 2), (9, 2), (11, 0), (12, 0), (30, 0), (32, 5), (33, 5), (34, 0)
    ]
    stay = decontaminate.drop_contaminated(docs, benchmark(spark))
    assert stay.columns == docs.columns
    gone = {8, 9, 11, 12, 30, 32, 33, 34}
    assert stay.count() == len([i for i, _ in cases.odd_texts() + leaks() if i not in gone])


@pytest.mark.parametrize("limit", [decontaminate.MAX_BROADCAST, 0])
def test_sql_finds_the_same(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST", limit)
    monkeypatch.setattr(decontaminate, "BITMAP_WORDS", 64)
    texts = [(i, t) for i, t in cases.odd_texts() if i != 18] + leaks()
    docs, items = cases.documents(spark, texts), benchmark(spark)
    connection = duckdb.connect()
    for name, frame in (("documents", docs), ("benchmark", items)):
        connection.register(name, frame.toPandas())
    expected = connection.execute(decontaminate.SQL)
    columns = [c[0] for c in expected.description]
    assert cases.found(decontaminate.contaminated(docs, items), *columns) == sorted(
        expected.fetchall()
    )


def test_empty_sides(spark):
    docs, items = cases.documents(spark), benchmark(spark)
    assert decontaminate.contaminated(cases.none(spark), items).count() == 0
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    frame = decontaminate.contaminated(cases.documents(spark), benchmark(spark))
    text = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text


@pytest.mark.parametrize("limit", [decontaminate.MAX_BROADCAST, 0])
def test_short_items_are_found_verbatim(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST", limit)
    items = spark.createDataFrame(
        [(1, "What is two plus five"), (2, "Answer!"), (3, "--"), (4, cases.prose(3, 80))],
        "item_id BIGINT, text STRING",
    )
    texts = [
        (1, f"{cases.prose(1, 30)} what is TWO plus five? {cases.prose(2, 30)}"),
        (2, "what is two plus five"),
        (3, "what is two and five"),
        (4, "the answer"),
        (5, "answers"),
        (6, cases.prose(3, 80)),
    ]
    found = decontaminate.contaminated(cases.documents(spark, texts), items)
    assert cases.found(found, "doc_id", "item_id", "matched") == [
        (1, 1, 5), (2, 1, 5), (4, 2, 1), (6, 4, 25)
    ]
    connection = duckdb.connect()
    connection.register("documents", cases.documents(spark, texts).toPandas())
    connection.register("benchmark", items.toPandas())
    expected = connection.execute(decontaminate.SQL)
    columns = [c[0] for c in expected.description]
    assert cases.found(found, *columns) == sorted(expected.fetchall())


def test_plan_of_a_large_benchmark(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST", 0)
    frame = decontaminate.contaminated(cases.documents(spark), benchmark(spark))
    text = frame._jdf.queryExecution().executedPlan().toString()
    for operator in ("Python", "Arrow", "NestedLoop", "Cartesian"):
        assert operator not in text


def test_rows_are_judged_by_their_texts(spark):
    """Rows that share an id or have none: no leak stays, no clean row goes, none is doubled."""
    passage, clean = cases.prose(3, 80), cases.prose(60, 50)
    rows = [(1, clean), (1, passage), (None, passage), (None, clean), (2, None), (2, passage)]
    docs = cases.documents(spark, rows)
    stay = decontaminate.drop_contaminated(docs, benchmark(spark))
    assert stay.columns == docs.columns
    assert cases.found(stay, "doc_id", "text") == [(None, clean), (1, clean), (2, None)]

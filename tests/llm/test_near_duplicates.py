import itertools
import random

import corpus_pipeline
import llm_cases as cases
import numpy as np
import pytest
from shoplens.llm import near_duplicates as near
from shoplens.llm.components import components, forest


def shingle_set(text):
    words = [
        "".join(c.lower() if c.isascii() else c for c in w) for w in cases.WORD.findall(text or "")
    ]
    if not words:
        return frozenset()
    size = min(4, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute(texts):
    """doc_id -> (n_shingles, component) over all pairs."""
    sets = {}
    for doc, text in texts:
        sets.setdefault(doc, []).append(shingle_set(text))
    component = {doc: doc for doc in sets if doc is not None}
    changed = True
    links = [
        (a, b)
        for a, b in itertools.combinations(component, 2)
        for x in sets[a]
        for y in sets[b]
        if x and y and 100 * len(x & y) >= 80 * len(x | y)
    ]
    while changed:
        changed = False
        for a, b in links:
            low = min(component[a], component[b])
            if component[a] != low or component[b] != low:
                component[a] = component[b] = low
                changed = True
    return sorted((d, max(map(len, sets[d])), component[d], d == component[d]) for d in component)


def test_odd_texts_against_all_pairs(spark):
    result = near.near_duplicates(cases.documents(spark))
    columns = ("doc_id", "n_shingles", "component_id", "kept")
    named = result.filter("doc_id is not null")
    assert cases.found(named, *columns) == brute(cases.odd_texts())
    unnamed = result.filter("doc_id is null")
    assert [(r.component_id, r.kept) for r in unnamed.collect()] == [(None, True)] * 2
    assert near.near_duplicates(cases.none(spark)).collect() == []


def family(size, words=150, seed=5):
    """Copies with more and fewer substitutions, around and beyond the limit."""
    chance = random.Random(seed)
    base = cases.prose(seed, words).split(" ")
    out = []
    for _ in range(size):
        copy = list(base)
        for place in chance.sample(range(words), chance.choice([0, 1, 2, 3, 4, 5, 6, 9])):
            copy[place] = f"w{chance.randint(0, 30)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("seed", [5, 6])
def test_chains_of_near_copies_against_all_pairs(spark, seed):
    texts = list(enumerate(family(120, seed=seed) + family(60, 60, seed + 10)))
    random.Random(seed).shuffle(texts)
    docs = spark.createDataFrame(texts, "doc_id BIGINT, text STRING")
    result = near.near_duplicates(docs)
    columns = ("doc_id", "n_shingles", "component_id", "kept")
    assert cases.found(result, *columns) == brute(texts)


@pytest.mark.parametrize("cell", [3, 20])
def test_crowded_buckets_are_dealt_over_cells(spark, monkeypatch, cell):
    monkeypatch.setattr(near, "CELL", cell)
    texts = list(enumerate(family(100, seed=7)))
    docs = spark.createDataFrame(texts, "doc_id BIGINT, text STRING")
    columns = ("doc_id", "n_shingles", "component_id", "kept")
    assert cases.found(near.near_duplicates(docs), *columns) == brute(texts)


def test_each_pair_of_a_bucket_meets_once(spark, monkeypatch):
    monkeypatch.setattr(near, "CELL", 10)
    members = [(1, n) for n in range(95)] + [(2, n) for n in range(10)] + [(3, 7)]
    rows = spark.createDataFrame(members, "bucket BIGINT, node BIGINT")
    crowded = near._crowded(rows)
    assert cases.found(crowded) == [(1, 10)]
    turned = rows.withColumnRenamed("node", "node_2")
    met = near._in_cells(rows, crowded, "line", "column").join(
        near._in_cells(turned, crowded, "column", "line"), ["bucket", "line", "column"]
    )
    assert cases.found(met, "bucket", "node", "node_2") == sorted(
        (b, x, y) for b, x in members for c, y in members if b == c
    )
    most = met.groupBy("bucket", "line", "column").count().agg({"count": "max"}).first()[0]
    assert most < 25 * 25


def test_keep_one(spark):
    docs = cases.documents(spark)
    stay = near.keep_one(docs)
    assert stay.columns == docs.columns
    kept = [doc for doc, *_, kept in brute(cases.odd_texts()) if kept]
    assert [r[0] for r in cases.found(stay, "doc_id")] == [None, None, *kept]
    assert near.keep_one(cases.none(spark)).count() == 0


def test_rows_are_judged_by_their_texts(spark):
    """Rows that share an id or have none: unrelated texts stay, copies go, none is doubled."""
    one, two, three = cases.prose(80, 60), cases.prose(81, 60), cases.prose(82, 60)
    near_two = two + " end"
    rows = [
        (1, one), (1, two), (2, two), (None, one), (None, three), (None, three), (3, near_two),
        (4, None), (4, None), (None, ""),
    ]
    docs = cases.documents(spark, rows)
    stay = near.keep_one(docs)
    assert stay.columns == docs.columns
    assert cases.found(stay, "doc_id", "text") == sorted(
        [(None, ""), (None, three), (1, one), (1, two), (4, None), (4, None)],
        key=lambda r: [(v is not None, v) for v in r],
    )


def test_the_stage_takes_five_words(spark):
    def changed(word, *places):
        return " ".join(f"new{n}" if n in places else f"{word}{n}" for n in range(120))

    # of sets of four and five words, three changes leave 105 of 129 and 101 of 131, two changes
    # 109 of 125 and 106 of 126
    texts = [changed("w"), changed("w", 20, 60, 100), changed("v"), changed("v", 30, 90)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    assert cases.found(near.keep_one(docs), "doc_id") == [(0,), (2,)]
    stay = corpus_pipeline.one_of_each(spark, docs, "")
    assert cases.found(stay, "doc_id") == [(0,), (1,), (2,)]


def test_signatures_are_those_of_the_sequential_method():
    def one(elements):
        """The method element by element, with early stopping per element left out."""
        places = near.PLACES
        values = [1 << 64] * places
        for element in elements:
            order = list(range(places))
            for step in range(places):
                draw = int(near.mix(np.array([element], np.uint64) + near._STEPS[step])[0])
                other = step + (((draw & 0xFFFFFFFF) * (places - step)) >> 32)
                order[step], order[other] = order[other], order[step]
                value = (step << 32) + (draw >> 32)
                values[order[step]] = min(values[order[step]], value)
        return values

    shapes = ((1, 5), (2, 40), (3, 1), (4, 90))
    sets = [near.shingles(cases.prose(seed, n).encode()) for seed, n in shapes]
    assert near.signatures(sets).tolist() == [one(s.tolist()) for s in sets]


def test_signatures_estimate_similarity():
    a = near.mix(np.arange(1000, dtype=np.uint64))
    b = near.mix(np.arange(111, 1111, dtype=np.uint64))  # 889 of 1111 shared
    x, y = near.signatures([np.sort(a), np.sort(b)])
    assert abs((x == y).mean() - 0.8) < 0.1


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 400)]
    random.Random(1).shuffle(chain)
    star = [(1000, n) for n in range(1001, 1300)]
    links = spark.createDataFrame([*chain, *star, (7, 7), (5, 4)], "a BIGINT, b BIGINT")
    found = cases.found(components(links.repartition(6)))
    assert found == [(i, 1) for i in range(2, 401)] + [(i, 1000) for i in range(1001, 1300)]
    assert components(links.limit(0)).collect() == []


def test_forest():
    assert sorted(forest(iter([(5, 4), (4, 3), (9, 8), (3, 3)]))) == [(4, 3), (5, 3), (9, 8)]

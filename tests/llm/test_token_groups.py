import random

import llm_cases as cases
import numpy as np
from pyspark.sql import functions as F
from shoplens.llm import token_groups


def shingled(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = cases.WORD.findall(lower)
    size = min(4, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def by_hand(rows, percent=85):
    """(doc_id, n_shingles, component_id) over all pairs."""
    sets = [(doc, shingled(text)) for doc, text in rows]
    parent = {doc: doc for doc, _ in sets if doc is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is None or b is None or not x or not y:
                continue
            if 100 * len(x & y) >= percent * len(x | y):
                one, two = root(a), root(b)
                parent[max(one, two)] = min(one, two)
    sizes = {}
    out = []
    for doc, x in sets:
        if doc is None:
            out.append((None, len(x), None))
        else:
            sizes[doc] = max(len(x), sizes.get(doc, 0))
    out += [(doc, n, root(doc)) for doc, n in sizes.items()]
    return sorted(out, key=lambda r: [(v is not None, v) for v in r])


def test_odd_texts(spark):
    result = token_groups.similarity_classes(cases.documents(spark))
    assert cases.found(result) == by_hand(cases.odd_texts())
    empty = token_groups.similarity_classes(cases.none(spark))
    assert empty.collect() == []


def edited(words, share, seed):
    chance = random.Random(seed)
    return " ".join(f"e{seed}x{i}" if chance.random() < share else w for i, w in enumerate(words))


def many_copies():
    """Families of near copies around the threshold, chains, short texts, a common passage."""
    rows = []
    passage = cases.prose(99, 30)
    for family in range(6):
        words = cases.prose(family, 120 + 40 * family).split(" ")
        for k in range(40):
            share = (0.005, 0.02, 0.03, 0.045, 0.06)[k % 5]
            rows.append(edited(words, share, 1000 * family + k) + (" " + passage) * (k % 2))
    words = cases.prose(50, 200).split(" ")
    for k in range(30):  # each is linked with its neighbours only
        rows.append(" ".join(words))
        words = [*words[5:], *cases.prose(700 + k, 5).split(" ")]
    rows += ["a b c", "A  B c", "a b", "a b c d e f", "a b c d e f g", passage, passage + " end"]
    random.Random(5).shuffle(rows)
    return list(enumerate(rows))


def test_families_chains_and_short_texts(spark):
    rows = many_copies()
    expected = by_hand(rows)
    sizes = [r[2] for r in expected]
    assert 20 < len(set(sizes)) < len(sizes) - 100
    result = token_groups.similarity_classes(cases.documents(spark, rows))
    assert cases.found(result) == expected


def test_small_groups(spark, monkeypatch):
    """Groups in many parts, large components that own groups, queries dealt to several tasks."""
    monkeypatch.setattr(token_groups, "GROUP_ROWS", 5)
    monkeypatch.setattr(token_groups, "QUERIES", 7)
    rows = many_copies()
    result = token_groups.similarity_classes(cases.documents(spark, rows))
    assert cases.found(result) == by_hand(rows)


def test_other_similarity(spark):
    rows = many_copies()
    result = token_groups.similarity_classes(cases.documents(spark, rows), percent=70)
    assert cases.found(result) == by_hand(rows, 70)


def test_groups_bound_and_count():
    chance = np.random.default_rng(3)
    sets = [np.unique(chance.integers(0, 300, 120).astype(np.uint64)) for _ in range(20)]
    group = token_groups.TokenGroup(sets)
    for query in [*sets, np.arange(150, dtype=np.uint64), np.array([999], np.uint64)]:
        shared = [len(np.intersect1d(query, s)) for s in sets]
        places = group.places(query)
        assert len(places) >= max(shared)
        assert group.shared(places).tolist() == shared
        for percent in (30, 50, 85):
            linked = [
                i
                for i, s in enumerate(sets)
                if 100 * shared[i] >= percent * (len(query) + len(s) - shared[i])
            ]
            assert group.linked(query, percent).tolist() == linked
            if linked:
                assert group.qualifies(len(query), places, percent)


def test_prefixes_of_linked_sets_share_enough():
    chance = np.random.default_rng(4)
    often = np.unique(chance.integers(0, 400, 60).astype(np.uint64))
    ranks = chance.permutation(len(often))
    for _ in range(300):
        x = np.unique(chance.integers(0, 400, chance.integers(1, 150)).astype(np.uint64))
        y = x.copy()
        drop = chance.random(len(y)) < 0.05
        y = np.unique(np.concatenate([y[~drop], chance.integers(0, 400, 4).astype(np.uint64)]))
        shared = len(np.intersect1d(x, y))
        if 100 * shared < 85 * (len(x) + len(y) - shared):
            continue
        one, two = (token_groups.prefix(s, often, ranks, 85) for s in (x, y))
        least = max(token_groups.least_shared(len(s), 85) for s in (x, y))
        assert len(np.intersect1d(one, two)) >= min(token_groups.HITS, least)


def test_frequent_tokens_are_last(spark):
    rows = [(i, f"{cases.prose(i, 30)} one two three four five") for i in range(60)]
    tokens, ranks = token_groups.frequent_tokens(
        cases.documents(spark, rows).select(F.col("text")).coalesce(1), "text", 4
    )
    assert len(tokens) == 2 and sorted(ranks.tolist()) == [0, 1]

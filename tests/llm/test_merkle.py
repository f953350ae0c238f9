import zlib

import llm_cases as cases
import numpy as np
import pytest
from shoplens.llm import merkle_manifest as merkle


def encoded(row, text):
    fields = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return "".join(
        "-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields
    )


def climbed(nodes):
    """All levels of a tree, the leaves first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([merkle.digest(below[i : i + 3]) for i in range(0, len(below), 3)])
    return levels


def sides(levels, at):
    out = []
    for level in levels[:-1]:
        first = at - at % 3
        out.append(("".join(level[first:at]), "".join(level[at + 1 : first + 3])))
        at //= 3
    return out


def by_hand(rows):
    """The contract, a list at a time."""
    sources = {}
    for row in rows:
        leaf = cases.sha256(encoded(row, row["text"]))
        text = row["text"]
        if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0:
            text = text and text.replace("\n", "")
        bent = cases.sha256(encoded(row, text))
        sources.setdefault(row["source"], []).append((row["doc_id"], leaf, bent))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        sources[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = climbed([leaf for _, leaf, _ in sources[s]])
    crown = climbed([trees[s][-1][0] for s in order])
    root, out = crown[-1][0], []
    for number, s in enumerate(order):
        for at, (doc, leaf, bent) in enumerate(sources[s]):
            proof = sides(trees[s], at) + sides(crown, number)
            folded = merkle.fold(bent, proof)
            whole = merkle.digest([x for pair in proof for x in pair])
            out.append((doc, leaf, trees[s][-1][0], root, whole, folded, folded == root))
    return sorted(out, key=lambda r: [(v is not None, v) for v in r])


def test_odd_rows(spark):
    docs = cases.documents(spark)
    expected = by_hand([row.asDict() for row in docs.collect()])
    proved = merkle.prove(docs)
    assert cases.found(proved) == expected
    assert {row[-1] for row in expected} == {True, False}
    assert cases.found(merkle.prove(docs.drop("kept").withColumnRenamed("n_words", "leaf"))) == (
        expected
    )


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10])
def test_small_trees(spark, n):
    docs = cases.documents(spark, [(i, f"line\n{i % 4}") for i in range(n)])
    assert cases.found(merkle.prove(docs)) == by_hand([r.asDict() for r in docs.collect()])


def test_many_parts_and_blocks(spark):
    """Parts that begin and end within runs, trees of several blocks, sources within a part."""
    docs = spark.range(700).selectExpr(
        "id as doc_id",
        "if(id % 3 = 0, 'hot', concat('s', id % 41)) as source",
        "'en' as lang",
        "id % 7 as n_chars",
        "concat('a\n', id) as text",
    )
    proved = merkle.prove(docs, part_leaves=37, levels=2)
    assert cases.found(proved) == by_hand([r.asDict() for r in docs.collect()])


def test_empty_table(spark):
    empty = merkle.prove(cases.none(spark))
    assert empty.collect() == []
    assert empty.columns == merkle.prove(cases.documents(spark)).columns


def test_lacking_nodes_are_the_fewest():
    """Every lacking node is a sibling that no leaf of the part lies under, and none is left out."""
    chance = np.random.default_rng(1)
    for n in (1, 2, 7, 40, 200):
        for _ in range(10):
            known = np.unique(chance.integers(0, n, chance.integers(1, 12)))
            needed = set()
            for leaf in known.tolist():
                for level in range(merkle.height(n)):
                    at = leaf // 3**level
                    for i in range(at - at % 3, min(at - at % 3 + 3, merkle.width(n, level))):
                        if not any(k // 3**level == i for k in known.tolist()):
                            needed.add((level, i))
            found = [(lv, i) for lv, idx in merkle.missing(known, n) for i in idx.tolist()]
            assert len(found) == len(set(found))
            assert set(found) == needed


def test_parts_get_few_nodes(spark):
    docs = spark.range(3000).selectExpr(
        "id as doc_id", "'one' as source", "'en' as lang", "id as n_chars", "'x' as text"
    )
    per_part = merkle.multiproofs(merkle.build(docs, part_leaves=100)).groupBy("part").count().collect()
    # two siblings at most on each side of a part and level, of 8 levels
    assert len(per_part) == 30
    assert max(row["count"] for row in per_part) <= 4 * 8

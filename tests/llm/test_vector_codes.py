import math
from collections import defaultdict

import llm_cases as cases
import numpy as np
from shoplens.llm import vector_codes

SCHEMA = "embedding ARRAY<FLOAT>, vec_id BIGINT, label INT, part STRING, home STRING, v STRING"


def table(spark, rows):
    return spark.createDataFrame([(v, i, x, "x", "x", "x") for i, v, x in rows], SCHEMA)


def by_hand(rows):
    """The contract for (vec_id, vector, label), a number at a time."""
    kept = []
    for i, vector, label in rows:
        if vector and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((i, [math.floor(256 * float(np.float32(x))) for x in vector], label))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // 16
    parts = [[r[1][p * width : (p + 1) * width] for p in range(16)] for r in kept]
    books = [[row[p] for row in parts[:64]] for p in range(16)]

    def best(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book))

    for _ in range(2):
        for p in range(16):
            members = defaultdict(list)
            for row in parts:
                members[best(row[p], books[p])[1]].append(row[p])
            for e, xs in members.items():
                books[p][e] = [sum(c) // len(xs) for c in zip(*xs, strict=True)]
    text = ",".join(str(c) for book in books for entry in book for c in entry)
    out, totals = [], defaultdict(int)
    for (i, _, label), row in zip(kept, parts, strict=True):
        found = [best(x, books[p]) for p, x in enumerate(row)]
        error = sum(d for d, _ in found)
        totals[label] += error
        out.append((i, "".join(f"{e:02x}" for _, e in found), error, label))
    result = [(i, code, error, totals[x], cases.sha256(text)) for i, code, error, x in out]
    return sorted(result, key=lambda r: [(v is not None, v) for v in r])


def vectors(n, seed, width=2):
    chance = np.random.default_rng(seed)
    centres = chance.normal(size=(9, 16 * width))
    return [
        (i, (centres[i % 9] + chance.normal(scale=0.3, size=16 * width)).tolist(), (None, 3, 7)[i % 3])
        for i in range(n)
    ]


def test_odd_rows(spark):
    rows = vectors(150, 1)
    good = rows[3][1]
    rows += [
        (1, None, 3),
        (2, [], 3),
        (-9, [*good[:-1], float("nan")], 3),
        (-8, [*good[:-1], float("inf")], 3),
        (-7, [*good[:-1], None], 3),
        (5, good, 3),  # another row of an id
        (3, good, 7),
        (3, good, 7),  # a row that repeats
        (None, good, None),
        *[(1000 + i, good, 7) for i in range(120)],
    ]
    result = vector_codes.code_table(table(spark, rows).repartition(4))
    assert cases.found(result) == by_hand(rows)


def test_blocks_and_salts_do_not_matter(spark):
    rows = vectors(400, 2, width=1)
    rows += [(500 + i, rows[0][1], 3) for i in range(300)]
    codes, book = vector_codes.compress(
        table(spark, rows).repartition(3), home_rows=50, salt_rows=100
    )
    expected = by_hand(rows)
    assert cases.found(codes, "vec_id", "code", "error") == [r[:3] for r in expected]
    assert cases.sha256(vector_codes.codebooks_text(book)) == expected[0][-1]


def test_few_rows_and_lengths(spark):
    rows = vectors(5, 3)
    expected = by_hand(rows)
    rows += [(90, [1.0] * 16, 1), (91, [1.0] * 17, 1), (-1, [0.5] * 3, 1), (92, [1e30] * 32, 1)]
    assert cases.found(vector_codes.code_table(table(spark, rows))) == expected


def test_empty_table(spark):
    empty = vector_codes.code_table(table(spark, vectors(5, 3)).limit(0))
    assert empty.collect() == []
    assert empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    none = vector_codes.code_table(table(spark, [(1, None, 1)]))
    assert none.collect() == []


def test_only_changed_members_move(spark):
    """After an update the blocks marked as moved hold what changed its entry, the rest stays."""
    rows = vectors(200, 4)
    whole = vector_codes.whole_vectors(table(spark, rows), "vec_id", "embedding", "label")
    x = np.array([r["v"] for r in whole.orderBy("vec_id").collect()], np.int64)
    old = [c for c in np.split(x[:64], 16, axis=1)]
    new = [c + 40 for c in old]
    first = list(
        vector_codes._split(7, 0, 0, np.arange(200), x[:, :2], vector_codes.nearest(x[:, :2], old[0])[0])
    )
    changed = 0
    for block in first:
        members = np.frombuffer(block["members"], "<i4").astype(np.int64).reshape(-1, 2)
        entry, _ = vector_codes.nearest(members, new[0])
        slots = np.frombuffer(block["slots"], "<i4")
        for piece in vector_codes._split(7, 0, 0, slots, members, entry, block["entry"]):
            assert piece["moved"] == (piece["entry"] != block["entry"])
            changed += len(piece["slots"]) // 4 if piece["moved"] else 0
    before = vector_codes.nearest(x[:, :2], old[0])[0]
    after = vector_codes.nearest(x[:, :2], new[0])[0]
    assert changed == (before != after).sum() > 0

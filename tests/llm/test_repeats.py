import random
from collections import Counter

import llm_cases as cases
import numpy as np
import pytest
from shoplens.llm import repeats


def brute(texts, length=200):
    raws = [(doc, (text or "").encode()) for doc, text in texts]
    counts = Counter(
        raw[a : a + length] for _, raw in raws for a in range(len(raw) - length + 1)
    )
    rows = []
    for doc, raw in raws:
        gone = np.zeros(len(raw), bool)
        for a in range(len(raw) - length + 1):
            if counts[raw[a : a + length]] > 1:
                gone[a : a + length] = True
        edges = np.diff(np.concatenate([[0], gone.astype(int)]))
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        rows.append((doc, len(raw), int(gone.sum()), int((edges == 1).sum()), cases.sha256(kept)))
    return sorted(rows, key=lambda r: [(v is not None, v) for v in r])


COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_odd_texts_against_brute_force(spark):
    docs = cases.documents(spark)
    result = repeats.remove_repeats(docs)
    assert cases.found(result, *COLUMNS) == brute(cases.odd_texts())
    assert all(cases.sha256(bytes(r.kept)) == r.kept_sha256 for r in result.collect())
    assert repeats.remove_repeats(cases.none(spark)).collect() == []


def patched(seed, n):
    """Texts that share passages of 150 to 700 bytes in different surroundings."""
    chance = random.Random(seed)
    shared = [cases.prose(1000 + i, 200) for i in range(4)]
    texts = []
    for i in range(n):
        parts = []
        for _ in range(chance.randint(0, 3)):
            parts.append(cases.prose(chance.randint(0, 10**6), chance.randint(0, 40)))
            passage = chance.choice(shared)
            at = chance.randint(0, 300)
            parts.append(passage[at : at + chance.randint(150, 700)])
        texts.append((i, " ".join(parts)))
    return texts


@pytest.mark.parametrize("hot", [repeats.HOT, 3, 1])
def test_shared_passages_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "AT_ONCE", repeats.AT_ONCE if hot > 3 else 300)
    texts = patched(3, 80) + [(900, "ab" * 400), (901, "ab" * 150), (902, "q" * 199)]
    result = repeats.remove_repeats(spark.createDataFrame(texts, "doc_id BIGINT, text STRING"))
    assert cases.found(result, *COLUMNS) == brute(texts)


@pytest.mark.parametrize("length", [5, 8, 20])
def test_transform_against_counting(length):
    chance = random.Random(length)
    for _ in range(60):
        segments = [
            bytes(chance.choice(b"ab\x00") for _ in range(chance.randint(length, 60)))
            for _ in range(chance.randint(1, 6))
        ]
        segments = list(dict.fromkeys([*segments, segments[0][3:] + b"xx"]))
        weights = [chance.choice([1, 1, 2]) for _ in segments]
        counts = Counter()
        for segment, weight in zip(segments, weights, strict=True):
            for a in range(len(segment) - length + 1):
                counts[segment[a : a + length]] += weight
        found = repeats.repeated_windows(segments, weights, length)
        assert [m.tolist() for m in found] == [
            [counts[s[a : a + length]] > 1 for a in range(max(0, len(s) - length + 1))]
            for s in segments
        ]


def test_anchors_cover_all_windows_once():
    text = (cases.prose(1, 40_000) + "z" * 500).encode()
    parts = repeats.anchors(text)
    first = np.concatenate([p[2] for p in parts])
    windows = np.concatenate([p[3] for p in parts])
    assert first[0] == 0 and first[-1] + windows[-1] == len(text) - repeats.LENGTH + 1
    assert (first[1:] == first[:-1] + windows[:-1]).all()
    assert repeats.anchors(b"x" * 199) == []


@pytest.mark.parametrize("hot", [2, 20])
def test_a_crowded_anchor_is_halved_until_its_pieces_are_few(spark, monkeypatch, hot):
    """One line in many surroundings, some of which repeat on one side or on both."""
    monkeypatch.setattr(repeats, "HOT", hot)
    chance = random.Random(hot)
    line = cases.prose(77, 30)[:110]
    sides = [cases.prose(2000 + i, 60) for i in range(12)]
    texts = []
    for i in range(150):
        before, after = (
            chance.choice(sides) if chance.random() < 0.5 else cases.prose(chance.random(), 60)
            for _ in range(2)
        )
        texts.append((i, before[-chance.randint(20, 160) :] + line + after[: chance.randint(0, 160)]))
    result = repeats.remove_repeats(spark.createDataFrame(texts, "doc_id BIGINT, text STRING"))
    assert cases.found(result, *COLUMNS) == brute(texts)


def test_halves_hold_each_window_once_and_equal_windows_meet():
    text = (cases.prose(5, 300) + "ab" * 300 + cases.prose(6, 100)).encode()
    for _, _, firsts, counts in repeats.anchors(text):
        for first, windows in zip(firsts.tolist(), counts.tolist(), strict=True):
            segment = text[first : first + windows + repeats.LENGTH - 1]
            at, open_, single = repeats.anchor_place(segment), [(0, 0, repeats.REACH - 1)], []
            while open_:
                skip, low, high = open_.pop()
                windows_left = [w for w in range(windows) if low <= at - w <= high]
                piece = segment[skip : skip + len(windows_left) + repeats.LENGTH - 1]
                for least, most, a, b in repeats.halves(piece, low, high):
                    if least == most:
                        single += range(skip + a, skip + b + 1)
                    else:
                        open_.append((skip + a, least, most))
            assert sorted(single) == list(range(windows))

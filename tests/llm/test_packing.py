import random
import zlib

import llm_cases as cases
import numpy as np
import pytest
from shoplens.llm import best_fit, length_buckets, vector_shards
from shoplens.llm.tokens import vocabulary_path, word_tokens
from tokenizers import Tokenizer

TOKENIZER = Tokenizer.from_file(vocabulary_path())


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]


def raw(ids):
    return np.array(ids, "<u4").tobytes()


ODD_WORDS = [
    "a<|endoftext|>b <|startoftext|> x",
    "it's WE'LL don't 'd 12a3 x9y",
    "Ünḯ é\n\tİ ẞ Σ ÀÉ×÷b ÿŸ ñÑß,",
    " ́x  y z \x1c q\x85w a\x00b \x0b c",
    "ＡＢ ① ﬁ \U0001f600 中文 عربى",
    "é àb",
    "z" * 3000,
    "a-b!!9x9 (foo) [bar]...",
]


def test_words_in_turn_are_the_ids_of_the_text():
    texts = [*ODD_WORDS, *(t or "" for _, t in cases.odd_texts())]
    found = list(word_tokens(vocabulary_path()).encode([t.encode() for t in texts]))
    assert found == [raw(ids_of(t)[:-1]) for t in texts]


def test_the_memo_is_bounded(monkeypatch):
    from shoplens.llm import tokens

    monkeypatch.setattr(tokens, "MEMO_WORDS", 50)
    monkeypatch.setattr(tokens, "AT_ONCE", 300)
    coder = tokens.WordTokens(vocabulary_path())
    texts = [cases.prose(s, 200) for s in range(6)]
    assert list(coder.encode([t.encode() for t in texts])) == [raw(ids_of(t)[:-1]) for t in texts]
    assert len(coder.parts) <= 50


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_any_vocabulary(name):
    path = vocabulary_path(name)
    tokenizer = Tokenizer.from_file(path)
    texts = [*ODD_WORDS, *(t or "" for _, t in cases.odd_texts())]
    found = list(word_tokens(path).encode([t.encode() for t in texts]))
    assert found == [raw(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


def test_text_that_is_no_utf8():
    whole = "a \ufffd b"
    assert list(word_tokens(vocabulary_path()).encode([b"a \xff b", None])) == [
        raw(ids_of(whole)[:-1]),
        b"",
    ]


def test_rows_that_repeat_are_dealt_to_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(best_fit, "BLOCK_DOCUMENTS", 20)
    monkeypatch.setattr(length_buckets, "BLOCK_PIECES", 20)
    docs = cases.documents(spark, [(None, "one two three four five")] * 200)
    packed = best_fit.pack(docs, capacity=32)
    rows = packed.select("block", "doc_ids", "starts").collect()
    assert len({r.block for r in rows}) == 10
    assert sum(len(r.doc_ids) for r in rows) == 200
    pieces = length_buckets.pack(length_buckets.cut_documents(docs))
    found = sorted(r.sequence_id for r in pieces.collect())
    assert found == list(range(len(found))) and len(found) >= 200


def test_power_of_two_pieces(spark):
    pieces = length_buckets.cut_documents(cases.documents(spark))
    packed = length_buckets.pack(pieces).collect()
    assert sorted(r.sequence_id for r in packed) == list(range(len(packed)))
    assert {r.length for r in packed} <= {1 << k for k in range(12)}
    assert {r.offset for r in packed} == {0}
    assert [r.length for r in sorted(packed, key=lambda r: r.sequence_id)] == sorted(
        r.length for r in packed
    )
    whole = {}
    for r in sorted(packed, key=lambda r: (str(r.doc_id), r.start)):
        assert zlib.crc32(raw(r.ids)) == r.ids_crc32
        whole.setdefault(r.doc_id, []).append(r)
    for doc, text in cases.odd_texts():
        if doc is not None and doc != 16:
            assert [i for r in whole[doc] for i in r.ids] == ids_of(text)
            assert {r.doc_tokens for r in whole[doc]} == {len(ids_of(text))}
    assert sum(r.length for r in packed) == sum(len(ids_of(t)) for _, t in cases.odd_texts())
    assert length_buckets.pack(length_buckets.cut_documents(cases.none(spark))).collect() == []


def test_decompose():
    assert length_buckets.decompose(2 * 8 + 5, 8) == [(0, 8), (8, 8), (16, 4), (20, 1)]
    assert length_buckets.decompose(1, 8) == [(0, 1)]
    with pytest.raises(ValueError):
        length_buckets.cut_documents(None, capacity=100)


def test_best_fit_decreasing_against_a_search():
    chance = random.Random(4)
    for capacity in (7, 64, 100):
        for _ in range(50):
            lengths = [chance.randint(1, capacity) for _ in range(chance.randint(0, 60))]
            free, expected = [], [0] * len(lengths)
            for p in sorted(range(len(lengths)), key=lambda p: -lengths[p]):
                fits = [f for f in free if f >= lengths[p]]
                if not fits:
                    free.append(capacity)
                    fits = [capacity]
                free[free.index(min(fits))] -= lengths[p]
            found = best_fit.best_fit_decreasing(lengths, capacity)
            used = {}
            for row, length in zip(found, lengths, strict=True):
                used[row] = used.get(row, 0) + length
            assert sorted(used.values()) == sorted(capacity - f for f in free)
            del expected


def test_packed_matrices_hold_every_document(spark, tmp_path):
    packed = best_fit.pack(cases.documents(spark))
    best_fit.write_matrices(packed, str(tmp_path / "out"))
    stored = spark.read.parquet(str(tmp_path / "out"))
    for r in stored.collect():
        ids, positions = np.frombuffer(r.ids, "<u4"), np.frombuffer(r.positions, "<u4")
        assert len(ids) == len(positions) == 2048
        edges = r.cu_seqlens
        assert (ids[edges[-1] :] == best_fit.PAD).all()
        assert zlib.crc32(ids[: edges[-1]].tobytes()) == r.ids_crc32
        for a, b in zip(edges, edges[1:], strict=False):
            assert positions[a:b].tolist() == list(range(b - a))
    whole = {}
    for r in best_fit.unpack(stored).collect():
        whole.setdefault(r.doc_id, {})[r.start] = r.ids
    for doc, text in cases.odd_texts():
        if doc is not None:
            assert [i for s in sorted(whole[doc]) for i in whole[doc][s]] == ids_of(text)
    total = sum(len(ids_of(t)) for _, t in cases.odd_texts())
    assert sum(r.cu_seqlens[-1] for r in stored.collect()) == total
    assert best_fit.pack(cases.none(spark)).collect() == []


def shards_of(spark, texts, **more):
    docs = spark.createDataFrame(texts, "doc_id BIGINT, text STRING")
    return vector_shards.assign(docs, **more).collect()


def test_shards_of_odd_texts(spark):
    found = vector_shards.assign(cases.documents(spark)).collect()
    expected = sorted(
        (len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for _, t in cases.odd_texts()
    )
    assert sorted((r.size, r.text_crc32) for r in found) == expected
    assert {r.law for r in found} == {"bytes"} and {r.grown_shard for r in found} == {None}
    slots = {}
    for r in found:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(24))
    assert vector_shards.assign(cases.none(spark)).collect() == []


def test_shards_are_even_and_keep_equal_texts_together(spark):
    texts = [(i, cases.prose(i, 20 + i * 37 % 200)) for i in range(2000)]
    texts += [(2000 + i, cases.prose(i % 300, 20)) for i in range(900)]
    texts += [(3000 + i, "hot " * 50) for i in range(1500)]  # a third of the rows
    found = shards_of(spark, texts, shards=8)
    by_shard, shards_by_text, text_of = {}, {}, dict(texts)
    for r in found:
        sums = by_shard.setdefault(r.shard, [0, 0])
        sums[0] += r.size
        sums[1] += 1
        shards_by_text.setdefault(text_of[r.doc_id], set()).add(r.shard)
    sizes = [s[0] for s in by_shard.values()]
    counts = [s[1] for s in by_shard.values()]
    assert max(sizes) < 1.01 * min(sizes)
    assert max(counts) < 1.1 * min(counts)
    assert all(len(s) == 1 for t, s in shards_by_text.items() if not t.startswith("hot"))


def test_place_prefers_room_where_an_item_needs_it():
    items = np.array([[10, 1], [1, 10], [9, 1], [1, 9]], float)
    where = vector_shards.place(items, 2).tolist()
    assert where[0] != where[2] and where[1] != where[3]
    assert vector_shards.place(np.zeros((0, 3)), 4).tolist() == []


def test_no_text_in_two_shards_unless_it_exceeds_one(spark, monkeypatch):
    """Against a count of all rows of each text: whole groups, even sizes, slots without gaps."""
    monkeypatch.setattr(vector_shards, "SLOT_ROWS", 50)
    texts = [(i, cases.prose(i, 20 + i * 37 % 200)) for i in range(3000)]
    texts += [(None, "warm " * 40)] * 500  # most rows of a shard, fewer of its bytes
    texts += [(4000 + i, "hot " * 300) for i in range(600)]  # more than a shard
    texts += [(5000 + i, cases.prose(9000 + i % 40, 300)) for i in range(200)]
    found = shards_of(spark, texts, shards=6)
    size_of, shards_by_crc, by_shard, slots = {}, {}, {}, {}
    for _, text in texts:
        crc = zlib.crc32(text.encode())
        size_of[crc] = size_of.get(crc, 0) + len(text.encode()) + 8
    for r in found:
        shards_by_crc.setdefault(r.text_crc32, set()).add(r.shard)
        by_shard[r.shard] = by_shard.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
    share = sum(size_of.values()) / 6
    hot = zlib.crc32(("hot " * 300).encode())
    assert [c for c, s in shards_by_crc.items() if len(s) > 1] == [hot]
    assert size_of[hot] > share > max(n for c, n in size_of.items() if c != hot)
    assert max(by_shard.values()) < 1.02 * min(by_shard.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_words_of_a_text(spark):
    texts = [(1, ""), (2, None), (3, "\n one two\t\n"), (4, "one"), (5, " \n "), (6, "a\x0bb\x0cc")]
    found = vector_shards.describe(cases.documents(spark, texts))
    assert cases.found(found, "doc_id", "n_words") == [
        (1, 0), (2, 0), (3, 2), (4, 1), (5, 0), (6, 3)
    ]

"""Documents with every oddity, and plain Python versions of the base definitions."""

import hashlib
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")

DOCUMENTS = (
    "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, "
    # names that operators use inside
    "kept BOOLEAN, n_words BIGINT, counts STRING, row BIGINT, node BIGINT, bands STRING, "
    "k1 BIGINT, spans STRING, ids STRING, block INT, lot BIGINT, seed BIGINT, s STRING, "
    "component STRING, f STRING, doc STRING, item_id BIGINT, `count` STRING"
)
EXTRA = (True, 1, "x", 2, 3, "x", 4, "x", "x", 5, 6, 7, "x", "x", "x", "x", 8, "x")


def prose(seed, words):
    chance = random.Random(seed)
    syllables = ["an", "thé", "re", "on", "ti", "wh", "ing", "er", "ß", "Ou"]
    out = []
    for n in range(words):
        out.append("".join(chance.choice(syllables) for _ in range(chance.randint(1, 4))))
        if chance.random() < 0.08:
            out[-1] += chance.choice([".", ",", ".\n"])
    return " ".join(out)


def odd_texts():
    """(doc_id, text) of a small corpus: nulls, blanks, copies, near copies, repeated rows."""
    base = prose(1, 300)
    words = base.split(" ")
    near = " ".join([*words[:150], "changed", *words[151:]])
    far = " ".join(w if i % 12 else f"other{i}" for i, w in enumerate(words))
    long = prose(2, 30_000)
    passage = prose(3, 80)
    return [
        (1, base),
        (2, base),
        (3, near),
        (4, far),
        (5, None),
        (6, ""),
        (7, " \n\t "),
        (8, "one two three"),
        (9, "ONE two\tthree"),
        (10, long),
        (11, prose(4, 120) + " " + passage + " " + prose(5, 90)),
        (12, prose(6, 60) + "\n" + passage + "\n" + prose(7, 60)),
        (13, "again and again and again and again and again " * 30),
        (14, "same line\n" * 40),
        (15, "a#b $ % & * | < > " + prose(8, 40)),
        (16, prose(9, 50)),
        (16, prose(9, 50)),  # a row that repeats
        (None, prose(10, 50)),  # a row without an id
        (None, prose(11, 50)),
        (17, "x" * 5000),
        (18, "\x00\x0b\x1c\x85   end \U0001f600"),
        (-5, base.upper()),
    ]


def documents(spark, texts=None):
    texts = odd_texts() if texts is None else texts
    data = [
        (i, t, (None, "en", "de")[n % 3], (None, "src0")[n % 2], None, *EXTRA)
        for n, (i, t) in enumerate(texts)
    ]
    return spark.createDataFrame(data, DOCUMENTS).repartition(5)


def none(spark):
    return documents(spark).limit(0)


def sha256(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def found(frame, *columns):
    """Rows as sorted tuples; nulls first."""
    data = [tuple(row[c] for c in columns or frame.columns) for row in frame.collect()]
    return sorted(data, key=lambda r: [(v is not None, v) for v in r])

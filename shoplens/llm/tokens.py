"""Token ids of whole texts, by a columnar dictionary of words."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

#: The vocabulary file of the registered queries.
VOCABULARY = "word_bpe_49k.json"
#: Parts of words that a worker remembers (about 0.2 kB each).
MEMO_WORDS = 300_000
#: Bytes of text that are cut into words at a time.
AT_ONCE = 1 << 21

# How a tokenizer must treat a text for the ids of the text to be those of its words.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
SPLITTER = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}

# Of words in these letters, figures and signs the parts are known without the whole chain of
# normalizer and splitter: no sign here composes, none is dropped, each has one lower case.
LETTERS = "a-zß-öø-ÿ"
PLAIN = "^[!-&(-~À-ÖØ-öø-ÿ]{1,200}$"
SIMPLE = f"^(?P<core>[{LETTERS}]+)(?P<tail>[^{LETTERS}0-9]*)$"
PARTS = re.compile(f"[{LETTERS}]+|[0-9]|[^{LETTERS}0-9]+")


def _as_strings(texts: pa.Array) -> pa.Array:
    """Texts as strings, null as empty; what is no UTF-8 is replaced."""
    try:
        strings = texts.cast(pa.string())
    except pa.ArrowInvalid:
        decoded = [t and t.decode("utf-8", "replace") for t in texts.to_pylist()]
        strings = pa.array(decoded, pa.string())
    return strings.fill_null("")


class WordTokens:
    """Ids of texts, by a bounded dictionary of parts of words that grows a column at a time.

    Arrow cuts texts into words, tells the different ones apart and cuts letters from what
    follows them; only parts that are new are encoded, and the ids of all words are then gathered
    by their places. Plain words go straight to the merges; all others are kept whole and go
    through the tokenizer. A full dictionary is begun anew. A tokenizer that treats texts
    otherwise than ``NORMALIZER`` and ``SPLITTER`` do gets whole texts.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        self.by_words = (
            settings["normalizer"] == NORMALIZER and settings["pre_tokenizer"] == SPLITTER
        )
        by_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.signs = {
            c: by_bytes.pre_tokenize_str(chr(c))[0][0] for c in [*range(33, 127), *range(192, 256)]
        }
        self.plain = re.compile(PLAIN)
        self._forget()

    def _forget(self) -> None:
        self.parts: dict[str, int] = {"": 0}
        self.ids = np.empty(0, np.uint32)
        self.ends = np.zeros(2, np.int64)  # of the empty part

    def _merged(self, part: str) -> list[int]:
        signs = part if part.isascii() else part.translate(self.signs)
        return [t.id for t in self.merges.tokenize(signs)]

    def _whole(self, word: str) -> list[int]:
        if "<|" in word or not self.plain.match(word):
            return self.tokenizer.encode(word, add_special_tokens=False).ids
        return [i for part in PARTS.findall(word.lower()) for i in self._merged(part)]

    def _learn(self, keys: list[str]) -> None:
        ids, ends = [], []
        for key in keys:
            ids += self._whole(key[1:]) if key[0] == "\0" else self._merged(key)
            ends.append(len(ids))
        first = len(self.parts)
        self.parts.update(zip(keys, range(first, first + len(keys)), strict=True))
        self.ends = np.concatenate([self.ends, len(self.ids) + np.array(ends, np.int64)])
        self.ids = np.concatenate([self.ids, np.array(ids, np.uint32)])

    def _numbered(self, keys: list[str]) -> np.ndarray:
        new = [k for k in set(keys) if k not in self.parts]
        if len(self.parts) + len(new) > MEMO_WORDS:
            self._forget()
            new = [k for k in set(keys) if k]
        if new:
            self._learn(new)
        return np.fromiter(map(self.parts.__getitem__, keys), np.int64, len(keys))

    def _gathered(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of numbered parts after another, and the number of ids of each."""
        begin = self.ends[numbers]
        return _gather(self.ids, begin, self.ends[numbers + 1] - begin)

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different words after another, and the number of ids of each."""
        plain = pc.and_not(
            pc.match_substring_regex(words, PLAIN), pc.match_substring(words, "<|")
        )
        cut = pc.extract_regex(pc.utf8_lower(words), SIMPLE)
        simple = pc.and_(plain, cut.is_valid())
        core, tail = (pc.struct_field(cut, k) for k in ("core", "tail"))
        kept_whole = pc.binary_join_element_wise("\0", words, "")
        empty = pc.equal(words, "")
        first = pc.if_else(simple, core, pc.if_else(empty, "", kept_whole)).dictionary_encode()
        second = pc.if_else(simple, tail, "").dictionary_encode()
        cores, tails = first.dictionary.to_pylist(), second.dictionary.to_pylist()
        number = self._numbered(cores + tails)
        parts = np.empty(2 * len(words), np.int64)
        parts[0::2] = number[: len(cores)][first.indices.to_numpy()]
        parts[1::2] = number[len(cores) :][second.indices.to_numpy()]
        ids, sizes = self._gathered(parts)
        if len(self.parts) > MEMO_WORDS:  # one piece of text may hold more than that
            self._forget()
        return ids, sizes[0::2] + sizes[1::2]

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not self.by_words:
            coded = self.tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)
            lengths = np.array([len(c.ids) for c in coded], np.int64)
            flat = [np.array(c.ids, np.uint32) for c in coded]
            return np.concatenate([np.empty(0, np.uint32), *flat]), lengths
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        of_words, size = self._words(words.dictionary)
        begin = np.cumsum(size) - size
        at = words.indices.to_numpy()
        ids, sizes = _gather(of_words, begin[at], size[at])
        total = np.concatenate([[0], np.cumsum(sizes)])
        edges = split.offsets.to_numpy()
        return ids, np.diff(total[edges - edges[0]])

    def encode_columns(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of some texts after another and the number of ids of each, in turn for all."""
        if not len(texts):
            return
        strings = _as_strings(texts)
        size = np.cumsum(pc.binary_length(strings).to_numpy(zero_copy_only=False))
        first = 0
        while first < len(strings):
            before = size[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(size, before + AT_ONCE, "right")))
            yield self._encode(strings.slice(first, last - first))
            first = last
        # other operators run in the same worker after this one
        pa.default_memory_pool().release_unused()

    def encode(self, texts: Iterable[bytes | None]) -> Iterator[bytes]:
        """The ids of each text in turn as little-endian unsigned 32-bit bytes; none for null."""
        for ids, sizes in self.encode_columns(pa.array(texts, pa.binary())):
            for part in np.split(ids.astype("<u4"), np.cumsum(sizes)[:-1]):
                yield part.tobytes()


def _gather(
    values: np.ndarray, begin: np.ndarray, size: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Runs of values after another, each given by its begin and size."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(begin - ends + size, size) + np.arange(total)], size


def closed(ids: np.ndarray, sizes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts with ``end`` after each: the ids of all, and the number of ids of each."""
    out = np.full(len(ids) + len(sizes), end, np.uint32)
    out[np.arange(len(ids)) + np.repeat(np.arange(len(sizes)), sizes)] = ids
    return out, sizes + 1


_loaded: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """The tokenizer of a worker process, loaded once."""
    if path not in _loaded:
        _loaded[path] = WordTokens(path)
    return _loaded[path]


def vocabulary_path(name: str = VOCABULARY) -> str:
    return public_tokenizers.path(name)

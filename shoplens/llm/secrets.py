"""Secret scan: a keyword automaton, patterns only where a keyword was met, then checksums."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import text_bytes

#: Kinds in the order in which spans that start together are listed.
KINDS = ("assign", "access", "hex", "github", "npm")
BASE = KINDS[:3]

# What announces a secret, and the pattern that must match there.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    rb"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{16,}")
GITHUB = re.compile(rb"gh[oprsu]_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
NPM = re.compile(rb"npm_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

MIN_ASSIGNED = 12
MIN_ACCESS = 18


def base62(number: int, width: int) -> bytes:
    digits = bytearray()
    for _ in range(width):
        number, digit = divmod(number, 62)
        digits.append(BASE62[digit])
    return bytes(reversed(digits))


def carries_crc32(match: re.Match) -> bool:
    """Whether a token ends in the CRC-32 of its random part, as six base-62 digits."""
    return base62(zlib.crc32(match[1]), 6) == match[2]


#: kind -> (keywords in lower case, pattern that begins at the keyword, what a match must pass)
RULES: dict[str, tuple[tuple[str, ...], re.Pattern, Callable[[re.Match], bool]]] = {
    "assign": (ASSIGN_WORDS, ASSIGN, lambda m: len(m[1]) >= MIN_ASSIGNED),
    "access": (("akia",), ACCESS, lambda m: len(m[0]) >= MIN_ACCESS),
    "github": (("gho_", "ghp_", "ghr_", "ghs_", "ghu_"), GITHUB, carries_crc32),
    "npm": (("npm_",), NPM, carries_crc32),
}


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, (words, _, _) in RULES.items():
        for word in words:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


_AUTOMATON = _automaton()


def scan(text: bytes) -> list[tuple[str, int, int]]:
    """(kind, start, end) in bytes of one text, by start and then in the order of the kinds.

    Matches of a kind do not overlap, the leftmost wins, and one that fails its check still
    covers its bytes. Runs of hexadecimal digits have no keyword; one pattern finds them all.
    """
    hits: dict[str, list[int]] = {}
    # one character a byte, so that places in it are places in the text
    for last, (kind, length) in _AUTOMATON.iter(text.lower().decode("latin-1")):
        hits.setdefault(kind, []).append(last - length + 1)
    spans = [("hex", *m.span()) for m in HEX.finditer(text)]
    for kind, starts in hits.items():
        _, pattern, valid = RULES[kind]
        free = 0
        for start in sorted(starts):
            if start >= free and (m := pattern.match(text, start)):
                free = m.end()
                if valid(m):
                    spans.append((kind, start, free))
    return sorted(spans, key=lambda span: (span[1], KINDS.index(span[0])))


def in_characters(text: bytes, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans in code points instead of bytes."""
    if not spans or text.isascii():
        return spans
    place = {}
    at = count = 0
    for edge in sorted({edge for span in spans for edge in span[1:]}):
        count += len(text[at:edge].decode("utf-8", "replace"))
        at = edge
        place[edge] = count
    return [(kind, place[a], place[b]) for kind, a, b in spans]


def redact(text: bytes, spans: list[tuple[str, int, int]]) -> str:
    """The text with each run of overlapping spans replaced by the first one's kind."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda span: span[1]):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]".encode()]
        at = max(at, end)
    return b"".join([*out, text[at:]]).decode("utf-8", "replace")


def digest(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


_FOUND = pa.struct(
    [
        ("n_assign", pa.int64()),
        ("n_access", pa.int64()),
        ("n_hex", pa.int64()),
        ("base_sha256", pa.string()),
        ("spans", pa.string()),
        ("redacted", pa.string()),
    ]
)
_FOUND_DDL = (
    "struct<n_assign:bigint,n_access:bigint,n_hex:bigint,base_sha256:string,spans:string,"
    "redacted:string>"
)


def _scan_all(redacting: bool):
    def scan_all(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts.to_pylist():
            raw = scan(text)
            spans = in_characters(text, raw)
            base = [span for span in spans if span[0] in BASE]
            kinds = [span[0] for span in base]
            rows.append(
                {f"n_{kind}": kinds.count(kind) for kind in BASE}
                | {
                    "base_sha256": hashlib.sha256(digest(base).encode()).hexdigest(),
                    "spans": digest(spans),
                    "redacted": redact(text, raw) if redacting and raw else None,
                }
            )
        return pa.array(rows, _FOUND)

    return scan_all


def found(text: str = "text", redacting: bool = False) -> Column:
    """A struct of the counts, digests and spans of each whole text; null is scanned as empty.

    ``redacted`` is the text without its secrets, null if it has none or if it is not asked for.
    """
    return F.arrow_udf(_scan_all(redacting), _FOUND_DDL).asNondeterministic()(text_bytes(text))


def find_secrets(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans: a row for each row of ``docs``.

    Rows are taken one by one, so repeated rows, null ids and empty tables need no rule. Other
    columns are not read. Nothing is shuffled.
    """
    return (
        docs.select(F.col(id).alias("doc_id"), found(text).alias("f"))
        .select("doc_id", "f.*")
        .drop("redacted")
    )


def redact_secrets(docs: DataFrame, text: str = "text", length: str | None = None) -> DataFrame:
    """``docs`` with each secret replaced by its kind in brackets; all rows stay.

    A null text stays null. ``length``: a column that gets the new number of characters.
    """
    row = docs.select(F.struct("*").alias("row"), found(text, redacting=True).alias("f"))
    clean = F.coalesce("f.redacted", f"row.{text}")
    changed = {text: clean} | ({length: F.length(clean).cast("long")} if length else {})
    return row.select(
        *[
            F.when(F.col("f.redacted").isNotNull(), changed[name])
            .otherwise(F.col("row")[name])
            .alias(name)
            if name in changed
            else F.col("row")[name].alias(name)
            for name in docs.columns
        ]
    )


def _sql_matches(kind: str, pattern: str, valid: str) -> str:
    """Matches of a pattern with their places: what lies between them tells how far they are."""
    return rf"""
  SELECT doc_id, '{kind}' AS kind, first, first + length(found) AS last, found FROM (
    SELECT doc_id, m[k] AS found,
      CAST(list_sum(list_transform(p[1:k], lambda x: length(x)))
      + coalesce(list_sum(list_transform(m[1:k-1], lambda x: length(x))), 0) AS BIGINT) AS first
    FROM (SELECT doc_id, m, p, unnest(range(1, len(m) + 1)) AS k FROM (
      SELECT doc_id, regexp_extract_all(t, '{pattern}') AS m,
        string_split_regex(t, '{pattern}') AS p
      FROM texts))
  ) WHERE {valid}"""


def _sql_tokens(kind: str, keyword: str) -> str:
    """Tokens that end in the CRC-32 of their 30 characters, as six base-62 digits."""
    bits = "list_transform(range(240), lambda i: (ord(body[i // 8 + 1]) >> (i % 8)) & 1)"
    crc = (
        f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}), lambda c, b:"
        " xor(c >> 1, (xor(c, b) & 1) * 3988292384)), 4294967295)"
    )
    return rf"""
  SELECT doc_id, '{kind}' AS kind, first, first + 40 AS last, token AS found FROM (
    SELECT doc_id, first, token, right(token, 6) AS tail, {crc} AS crc FROM (
      SELECT doc_id, first, left(after, 40) AS token, after[5:34] AS body FROM (
        SELECT doc_id, first, substr(t, first + 1, 41) AS after
        FROM ({_sql_matches(kind, keyword, "true")}) JOIN texts USING (doc_id))
      WHERE regexp_matches(after, '^{keyword}[0-9A-Za-z]{{36}}([^0-9A-Za-z]|$)')))
  WHERE tail = list_aggregate(list_transform(range(5, -1, -1), lambda e: substr(
    '{BASE62.decode()}', CAST(crc // CAST(power(62, e) AS BIGINT) % 62 AS INTEGER) + 1, 1)),
    'string_agg', '')"""


def _sql() -> str:
    either = "|".join(
        re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", word)
        for word in ("password", "passwd", "secret", "token", "api_?key")
    )
    head = rf"""({either})["\x27]?\x20*[:=]\x20*["\x27]?"""
    spans = " UNION ALL ".join(
        [
            _sql_matches(
                "assign",
                f"{head}[A-Za-z0-9+/_.=-]+",
                f"length(regexp_replace(found, '^{head}', '')) >= {MIN_ASSIGNED}",
            ),
            _sql_matches("access", "AKIA[A-Z0-9]+", f"length(found) >= {MIN_ACCESS}"),
            _sql_matches("hex", "[0-9a-f]+", "length(found) >= 16"),
            _sql_tokens("github", "gh[oprsu]_"),
            _sql_tokens("npm", "npm_"),
        ]
    )
    kinds = ", ".join(f"'{kind}'" for kind in KINDS)
    listed = "string_agg(kind || ':' || first || ':' || last, ',' ORDER BY first, rank)"
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{kind}') AS n_{kind}" for kind in BASE)
    zeros = ", ".join(f"coalesce(n_{kind}, 0) AS n_{kind}" for kind in BASE)
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
spans AS (SELECT *, list_position([{kinds}], kind) AS rank FROM ({spans})),
found AS (
  SELECT doc_id, {counts}, {listed} FILTER (WHERE rank <= {len(BASE)}) AS base, {listed} AS spans
  FROM spans GROUP BY doc_id
)
SELECT doc_id, {zeros}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN found USING (doc_id)
"""


#: The same for engines without Spark, for tables whose ids do not repeat.
SQL = _sql()

"""Secrets in text: keyword automaton, anchored patterns near its hits, embedded checksums.

An Aho-Corasick automaton over ASCII-lowered text names the places where a secret can begin;
one pattern per kind is then matched exactly there. Runs of hexadecimal digits have no keyword,
so their pattern is its own prefilter. Tokens that carry a checksum count only if it is right.
"""

from __future__ import annotations

import base64
import binascii
import re
import zlib
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loomframe.llm.common import in_batches, text_of

#: Kinds in the order that breaks ties between spans with one start.
KINDS = ("assign", "access", "hex", "github", "npm", "jwt", "private_key")
BASE = KINDS[:3]

_ASSIGN = re.compile(
    "(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("[0-9a-f]{24,}")  # a maximal run: the match before it ended at another character
_GITHUB = re.compile("gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
_NPM = re.compile("npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
_JWT = re.compile(r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+")
_BLOCK = re.compile(r"-----BEGIN ([A-Z ]*)PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END \1PRIVATE KEY-----")

#: Lower-case keyword -> kind. Fixed values.
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign",
    "apikey": "assign", "api_key": "assign", "akia": "access",
    "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github",
    "npm_": "npm", "eyj": "jwt", "-----begin": "private_key",
}
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def crc_base62(payload: str) -> str:
    """The six digits that token issuers append: CRC32 of the payload in base 62."""
    value, digits = zlib.crc32(payload.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = _DIGITS[digit] + digits
    return digits


def _checksum_holds(token: str) -> bool:
    body = token.partition("_")[2]
    return crc_base62(body[:-6]) == body[-6:]


def _header_is_json(token: str) -> bool:
    head = token.partition(".")[0]
    try:
        text = base64.urlsafe_b64decode(head + "=" * (-len(head) % 4))
    except (binascii.Error, ValueError):
        return False
    return text.startswith(b"{") and b'"alg"' in text and text.rstrip().endswith(b"}")


#: kind -> (pattern matched at the keyword, test of the whole match).
RULES = {
    "assign": (_ASSIGN, lambda m: len(m[1]) >= 6),
    "access": (_ACCESS, lambda m: m.end() - m.start() >= 20),
    "github": (_GITHUB, lambda m: _checksum_holds(m[0])),
    "npm": (_NPM, lambda m: _checksum_holds(m[0])),
    "jwt": (_JWT, lambda m: _header_is_json(m[0])),
    "private_key": (_BLOCK, lambda m: True),
}


@lru_cache(1)
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        found.add_word(word, (len(word), kind))
    found.make_automaton()
    return found


def ascii_lower(text: str) -> str:
    """A-Z lowered and nothing else, so that positions stay."""
    return text.lower() if text.isascii() else text.encode().lower().decode()


def find_secrets(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) in code points, by start and then by kind.

    Matches of one kind are leftmost and do not overlap; one that fails its test still uses up
    the text it covers.
    """
    spans = [(m.start(), "hex", m.end()) for m in _HEX.finditer(text)]
    done = dict.fromkeys(RULES, 0)
    for last, (size, kind) in _automaton().iter(ascii_lower(text)):
        start = last - size + 1
        if start < done[kind]:
            continue
        pattern, holds = RULES[kind]
        match = pattern.match(text, start)
        if match:
            done[kind] = match.end()
            if holds(match):
                spans.append((start, kind, match.end()))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[1])))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a column ``secrets``: array of (kind, start, end), by start.

    One pass without a shuffle; null text has no secrets; a column named ``secrets`` is replaced.
    """
    rest = [c for c in docs.columns if c != "secrets"]
    schema = docs.select(rest).schema
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    found = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    at = rest.index(text)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = [
            [{"kind": k, "start": s, "end": e} for s, k, e in find_secrets(t)] if t else []
            for t in batch.column(at).to_pylist()
        ]
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(spans, found)], names=[*rest, "secrets"]
        )

    return in_batches(
        docs.select(*[F.col(f"`{c}`") for c in rest]),
        run,
        f"{kinds}, secrets array<struct<kind:string,start:bigint,end:bigint>>",
        at,
    )


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every secret replaced by ``[secret]``; spans that overlap become one.

    Nulls stay null and every other column is kept; no row is dropped.
    """
    at = docs.columns.index(text)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def clean(value: str | None) -> str | None:
        if not value:
            return value
        parts, end = [], 0
        for start, _, stop in find_secrets(value):
            if start >= end:
                parts += [value[end:start], "[secret]"]
            end = max(end, stop)
        return "".join(parts) + value[end:] if parts else value

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        cleaned = pa.array([clean(t) for t in batch.column(at).to_pylist()], pa.string())
        return batch.set_column(at, batch.schema.field(at).name, cleaned)

    return in_batches(docs, run, kinds, at)


def secret_report(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, digest of the base spans and all spans, one row per row."""
    spans = scan(docs.select("doc_id", text_of().alias("text"))).select("doc_id", "secrets")
    base = F.filter("secrets", lambda s: s["kind"].isin(*BASE))
    joined = lambda items: F.array_join(
        F.transform(items, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    return spans.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in BASE],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
    )

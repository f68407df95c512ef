"""Secrets in texts: keyword automaton, expressions anchored at its hits, checksums inside the tokens.

One Aho-Corasick pass over the text in small ASCII letters finds every keyword. An expression is tried only at a hit,
leftmost first and never inside an earlier match of its kind, which is what a scan by that expression alone would find.
Long hexadecimal runs have no keyword: a run of 32 characters covers four neighbours among every eighth character, so
only that sample is searched and the runs are read near its hits.

Kinds of ``KINDS`` that carry a checksum count only if it is right; a wrong one does not hide a token that begins inside
it. The others count from their least length on.

NULL and empty texts have no secrets; texts are read whole, whatever their length, in time linear in it; repeated rows and
ids are scanned like any other row; only the carried columns are returned, so other columns may have any name; an empty
table gives an empty one. Places are code points, the end exclusive. Spans are sorted by start, then in the order of ``KINDS``.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What stands for a secret by its form alone, and the least length of the part that decides.
BASE = ("assign", "access", "hex")
ASSIGN = r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 8, 16, 32
#: Public token formats with a checksum, and the digits in which it is written.
GITHUB = r"gh[pousr]_[A-Za-z0-9]{36}"
NPM = r"npm_[A-Za-z0-9]{36}"
AGE = r"AGE-SECRET-KEY-1[02-9AC-HJ-NP-Z]{58}"
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BECH32 = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"
BECH32_STEPS = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)
KINDS = (*BASE, "github", "npm", "age")

#: Keywords in small letters, by the kind whose expression begins with them.
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
    "age": ("age-secret-key-1",),
}
#: Arrow rows that are Python objects at a time.
SLICE_ROWS = 256
_SAMPLED = re.compile("[0-9a-f]{4,}")
_HEX = re.compile("[0-9a-f]{%d,}" % HEX_LEAST)
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def base62_crc(token: str) -> bool:
    """The last six digits are the CRC-32 of the thirty before them."""
    crc, digits = zlib.crc32(token[-36:-6].encode()), ""
    for _ in range(6):
        crc, digit = divmod(crc, 62)
        digits = BASE62[digit] + digits
    return token[-6:] == digits


def bech32(token: str) -> bool:
    """The checksum over the part before the last 1 and the digits after it."""
    name, _, digits = token.lower().rpartition("1")
    check = 1
    for value in [*[ord(c) >> 5 for c in name], 0, *[ord(c) & 31 for c in name], *map(BECH32.index, digits)]:
        top, check = check >> 25, (check & 0x1FFFFFF) << 5 ^ value
        for i, step in enumerate(BECH32_STEPS):
            check ^= step if top >> i & 1 else 0
    return check == 1


#: By kind: the expression at a hit, and what a match must hold.
RULES = {
    "assign": (re.compile(ASSIGN, re.IGNORECASE | re.ASCII), lambda m: len(m[1]) >= ASSIGN_LEAST),
    "access": (re.compile(ACCESS), lambda m: len(m[0]) >= ACCESS_LEAST),
    "github": (re.compile(GITHUB), lambda m: base62_crc(m[0])),
    "npm": (re.compile(NPM), lambda m: base62_crc(m[0])),
    "age": (re.compile(AGE), lambda m: bech32(m[0])),
}


def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for word in words:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def _small(text: str) -> str:
    """ASCII capitals made small; every code point keeps its place."""
    return text.lower() if text.isascii() else text.encode().lower().decode()


def _hex_runs(text: str) -> Iterator[tuple[int, int]]:
    for near in _SAMPLED.finditer(text[::8]):
        # the sampled neighbours outside are no digits, so no run crosses these bounds
        for run in _HEX.finditer(text, max(8 * near.start() - 7, 0), 8 * near.end()):
            yield run.span()


def spans(text: str | None, keywords) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` of every secret in one text."""
    if not text:
        return []
    found = [(start, KINDS.index("hex"), end) for start, end in _hex_runs(text)]
    hits = sorted((end + 1 - size, kind) for end, (kind, size) in keywords.iter(_small(text)))
    free = dict.fromkeys(RULES, 0)  # where the next match of a kind may begin
    for start, kind in hits:
        if start < free[kind]:
            continue
        expression, holds = RULES[kind]
        match = expression.match(text, start)
        if match is None:
            continue
        good = holds(match)
        if good:
            found.append((start, KINDS.index(kind), match.end()))
        if good or kind in BASE:
            free[kind] = match.end()
    return [(KINDS[kind], start, end) for start, kind, end in sorted(found)]


def scan(docs: DataFrame, carry: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """The carried columns and ``secrets array<struct<kind string, start bigint, end bigint>>`` of every row."""
    carried = [docs.schema[c] for c in carry]
    names = [f"c{i}" for i in range(len(carry))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keywords = automaton()
        for batch in batches:
            texts = batch.column(len(names))
            found = [spans(t, keywords) for at in range(0, batch.num_rows, SLICE_ROWS) for t in texts.slice(at, SLICE_ROWS).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, _SPANS)], [*names, "secrets"])

    slim = docs.select(*[F.col(c).alias(n) for c, n in zip(carry, names)], F.col(text).cast("string").alias("t"))
    schema = ", ".join([*[f"{n} {f.dataType.simpleString()}" for n, f in zip(names, carried)],
                        "secrets array<struct<kind:string,start:bigint,end:bigint>>"])
    return slim.mapInArrow(run, schema).select(*[F.col(n).alias(c) for n, c in zip(names, carry)], "secrets")


def of_kind(*kinds: str) -> Column:
    return F.filter("secrets", lambda s: s["kind"].isin(*kinds))


def written(found: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

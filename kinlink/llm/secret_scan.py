"""Secret scans: Aho-Corasick keyword prefilter, anchored patterns near hits, checksum validation.

One pass of the automaton finds every keyword; only there is a kind's pattern tried, anchored at the hit. Kinds with an embedded
checksum count only if it holds. Lower-case hex strings have no keyword; their runs are found by a pattern of that one class. Whole texts
are scanned, positions are code points and the end is exclusive.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released

#: Kinds in the order that breaks ties of start; the first three are the base.
KINDS = ("assign", "access", "hex", "crc_token", "extended_key", "bech32_key")
#: Keywords (compared in lower case) by kind.
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "crc_token": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_"),
    "extended_key": ("xprv",),
    "bech32_key": ("age-secret-key-1", "nsec1"),
}
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CRC_TOKEN = re.compile(r"(?:gh[pousr]|npm)_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
_EXTENDED = re.compile(r"xprv[1-9A-HJ-NP-Za-km-z]{107}(?![0-9A-Za-z])")
_BECH32 = re.compile(r"(?:AGE-SECRET-KEY-1[02-9AC-HJ-NP-Z]{58}|nsec1[02-9ac-hj-np-z]{58})(?![0-9A-Za-z])")
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
_BECH32_CHARS = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"
#: The generator of the bech32 checksum.
_BECH32_GENERATOR = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)


def crc_token_holds(body: str, check: str) -> bool:
    """The last six characters are the CRC-32 of the thirty before, in base 62."""
    value = 0
    for c in check:
        value = value * 62 + _BASE62.index(c)
    return value == zlib.crc32(body.encode())


def base58check_holds(text: str) -> bool:
    """The last four bytes are the start of the double SHA-256 of the others."""
    value = 0
    for c in text:
        value = value * 58 + _BASE58.index(c)
    try:
        raw = value.to_bytes(82, "big")
    except OverflowError:
        return False
    return hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


def bech32_holds(text: str) -> bool:
    prefix, _, data = text.lower().rpartition("1")
    value = 1
    for v in [ord(c) >> 5 for c in prefix] + [0] + [ord(c) & 31 for c in prefix] + [_BECH32_CHARS.index(c) for c in data]:
        top = value >> 25
        value = (value & 0x1FFFFFF) << 5 ^ v
        for i in range(5):
            value ^= _BECH32_GENERATOR[i] if top >> i & 1 else 0
    return value == 1


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for w in words:
            a.add_word(w, (kind, len(w)))
    a.make_automaton()
    return a


_ASCII_LOWER = {i: i + 32 for i in range(65, 91)}


def scan(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of each finding, in order."""
    low = text.lower()
    if len(low) != len(text):  # a character whose lower case is longer; the positions must hold
        low = text.translate(_ASCII_LOWER)
    starts: dict[str, list[int]] = {}
    for last, (kind, n) in _automaton().iter(low):
        starts.setdefault(kind, []).append(last - n + 1)
    found = [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    for kind, at in starts.items():
        number, done = KINDS.index(kind), 0
        pattern = (_ASSIGN, _ACCESS, _HEX, _CRC_TOKEN, _EXTENDED, _BECH32)[number]
        for start in sorted(at):
            if start < done or not (m := pattern.match(text, start)):
                continue
            done = m.end()
            if (
                number == 0 and len(m[2]) >= 6
                or number == 1 and len(m[0]) >= 20
                or number == 3 and crc_token_holds(m[1], m[2])
                or number == 4 and base58check_holds(m[0])
                or number == 5 and bech32_holds(m[0])
            ):
                found.append((start, number, done))
    return sorted(found)


def secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) for each row of docs (doc_id, text): an array of (kind, start, end), empty for a null, empty or clean text.

    Repeated rows give repeated rows; other columns of docs are ignored.
    """

    def run(batches):
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            rows = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in scan(t)] if t else [] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], ["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(released(run), "doc_id long, spans array<struct<kind: string, start: bigint, end: bigint>>")


def mask(docs: DataFrame) -> DataFrame:
    """docs with every finding in text replaced by [kind], and n_chars (if docs has it) that of the new text.

    A null text stays null, an empty or clean one as it is. Of findings that overlap, the part behind an earlier one goes with it. Whole texts
    are scanned whatever their length; repeated rows and other columns stay; no rows give no rows.
    """
    columns = docs.columns
    where = columns.index("text")

    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column(where).to_pylist():
                at = 0
                if text and (spans := scan(text)):
                    parts = []
                    for a, k, b in spans:
                        if a >= at:
                            parts += [text[at:a], f"[{KINDS[k]}]"]
                        at = max(at, b)
                    text = "".join(parts) + text[at:]
                out.append(text)
            yield batch.set_column(where, batch.schema.field(where), pa.array(out, batch.schema.field(where).type))

    made = docs.mapInArrow(released(run), docs.schema)
    return made.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in columns else made

"""Secret scan: an Aho-Corasick pass finds keywords, anchored expressions run only there, checksums settle the rest.

Base kinds (assign, access, hex) follow their patterns exactly. Runs of hexadecimal digits have no keyword, so one
expression finds them directly. The kinds behind them are added spans: tokens whose last characters are a checksum of
the others (github, npm: CRC-32 in base 62), tokens whose head must decode (jwt), and fixed forms (google, slack, pem).
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .batches import record_batch, text_chunks

#: Characters of a token's head that are decoded at most; a longer one is no token.
LONGEST_HEAD = 8192
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _base62(n: int, width: int) -> str:
    out = ""
    while n:
        n, r = divmod(n, 62)
        out = _DIGITS[r] + out
    return out.rjust(width, "0")


def checksum_holds(token: str) -> bool:
    """prefix_ + 30 characters + CRC-32 of those in 6 base-62 digits."""
    body = token.partition("_")[2]
    return len(body) == 36 and _base62(zlib.crc32(body[:30].encode()), 6) == body[30:]


def _jwt(token: str) -> bool:
    head = token.partition(".")[0]
    if len(head) > LONGEST_HEAD:
        return False
    try:
        return "alg" in json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except (ValueError, RecursionError):  # no such text, or one nested too deeply
        return False


#: kind, keywords in lower case (each match starts with one), expression, test of the match.
RULES = [
    ("assign", ["password", "passwd", "secret", "token", "api_key", "apikey"], re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 6),
    ("access", ["akia"], re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", [], re.compile(r"[0-9a-f]{24,}"), None),
    ("github", ["ghp_", "gho_", "ghu_", "ghs_", "ghr_"], re.compile(r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"), lambda m: checksum_holds(m[0])),
    ("npm", ["npm_"], re.compile(r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])"), lambda m: checksum_holds(m[0])),
    ("jwt", ["eyj"], re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"), lambda m: _jwt(m[0])),
    ("google", ["aiza"], re.compile(r"AIza[A-Za-z0-9_-]{35}(?![A-Za-z0-9_-])"), lambda m: True),
    ("slack", ["xoxa-", "xoxb-", "xoxp-", "xoxr-", "xoxs-"], re.compile(r"xox[abprs]-[0-9A-Za-z-]{10,}"), lambda m: True),
    ("pem", ["-----begin"], re.compile(r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]{0,20}PRIVATE KEY-----"), lambda m: True),
]
BASE_KINDS = 3
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
_OUT = pa.schema([("doc_id", pa.int64()), ("spans", _SPAN)])
_DDL = "doc_id long, spans array<struct<kind: string, start: int, end: int>>"


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for i, (_, keywords, _, _) in enumerate(RULES):
        for k in keywords:
            found.add_word(k, (i, len(k)))
    found.make_automaton()
    return found


def scan(text: str, automaton: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """(start, rule, end) of all secrets, by start and rule; matches of a rule don't overlap, leftmost first."""
    lower = text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    out, over = [], [0] * len(RULES)
    for last, (rule, n) in automaton.iter(lower):
        start = last + 1 - n
        if start >= over[rule] and (m := RULES[rule][2].match(text, start)):
            over[rule] = m.end()
            if RULES[rule][3](m):
                out.append((start, rule, m.end()))
    out += [(m.start(), 2, m.end()) for m in RULES[2][2].finditer(text)]
    return sorted(out)


def find_secrets(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, spans array of (kind, start, end) in code points, by start, then kind as listed in RULES).

    A row for each row of docs; null and empty texts have no spans.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton()
        for part, texts in text_chunks(batches):
            spans = [[{"kind": RULES[r][0], "start": s, "end": e} for s, r, e in scan(t, automaton)] for t in texts]
            yield record_batch(_OUT, part.column("doc_id"), pa.array(spans, _SPAN))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _DDL)


def digest(spans: DataFrame) -> DataFrame:
    """find_secrets' rows -> (doc_id, n_assign, n_access, n_hex, base_sha256, spans string)."""
    told = lambda xs: F.array_join(F.transform(xs, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = [r[0] for r in RULES[:BASE_KINDS]]
    of_kind = lambda k: F.filter("spans", lambda s: s["kind"] == F.lit(k))
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in base]
    return spans.select("doc_id", *counts, F.sha2(told(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))

"""Secrets in texts: an Aho-Corasick pass finds keywords, anchored patterns run only at the hits, checksums decide.

Kinds, in this order:

* assign, access, hex: the base rules (assignment to a telling name, access key id, long hexadecimal run);
* github, npm: a prefix, 30 base-62 characters and 6 more that are the CRC-32 of those 30, in base 62;
* jwt: two base64url parts that decode to JSON objects, the first with "alg", and a signature;
* card: 13 to 19 digits with a valid Luhn digit, right after a word that names a card number;
* pem: a private key block from its first to its last line.

A hit of a checked kind whose checksum fails is dropped. Per kind, spans are leftmost and do not overlap. Places are code points, the
end is exclusive. A null or empty text has no spans. Each row is judged alone: repeated rows repeat their result.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame

from rolegauge.llm.batches import map_texts

KINDS = ("assign", "access", "hex", "github", "npm", "jwt", "card", "pem")
SCHEMA = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_spans bigint"
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 6, 20, 24

# Keywords in lower case and the pattern that must start there.
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
    "jwt": ("eyj",),
    "card": ("card", "visa", "mastercard"),
    "pem": ("-----begin ",),
}
PATTERNS = {
    "assign": r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    "access": r"AKIA[A-Z0-9]+",
    "github": r"gh[pousr]_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])",
    "npm": r"npm_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])",
    "jwt": r"(eyJ[A-Za-z0-9_-]+)\.(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+",
    "card": r"(?ai:mastercard|visa|card)(?:\x20?(?ai:number|no))?[\"']?\x20?[:=#]?\x20?([0-9](?:[\x20-]?[0-9]){12,18})(?![0-9])",
    "pem": r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----[A-Za-z0-9+/=\s,:-]+?-----END (?:[A-Z]+ )?PRIVATE KEY-----",
}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

COMPILED = {kind: re.compile(pattern) for kind, pattern in PATTERNS.items()}
#: For kinds whose patterns look far ahead: the run that every match from a start inside it must go through. If one start fails at its end,
#: so do all later ones inside it; they are left out, which keeps the scan linear.
RUNS = {
    "jwt": re.compile(r"[A-Za-z0-9_-]+"),
    "pem": re.compile(r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----[A-Za-z0-9+/=\s,:-]*"),
}
HEX_RUN = re.compile(r"[0-9a-f]{%d,}" % HEX_MIN)
HEX_MARK = bytes(120 if chr(b) in "0123456789abcdef" else 46 for b in range(256))
HEX_FOUND = b"x" * HEX_MIN


def base62_crc(body: str) -> str:
    """The CRC-32 of the body as six base-62 digits."""
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        total += digit if place % 2 == 0 else digit * 2 - 9 * (digit > 4)
    return total % 10 == 0


def json_part(part: str) -> object:
    try:
        return json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except ValueError:
        return None


def valid(kind: str, hit: re.Match) -> bool:
    """Length rules of the base kinds and the embedded checksums of the others."""
    if kind == "assign":
        return len(hit[1]) >= ASSIGN_MIN
    if kind == "access":
        return len(hit[0]) >= ACCESS_MIN
    if kind in ("github", "npm"):
        return base62_crc(hit[1]) == hit[2]
    if kind == "jwt":
        head = json_part(hit[1])
        return isinstance(head, dict) and "alg" in head and isinstance(json_part(hit[2]), dict)
    if kind == "card":
        return luhn(re.sub("[^0-9]", "", hit[1]))
    return True


def span_of(kind: str, hit: re.Match) -> tuple[int, int]:
    return hit.span(1) if kind == "card" else hit.span()


@lru_cache(maxsize=1)
def keyword_automaton() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for word in words:
            automaton.add_word(word, (kind, len(word)))
    automaton.make_automaton()
    return automaton


def lower_ascii(text: str) -> str:
    """ASCII letters in lower case; every character keeps its place."""
    return text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def spans(text: str) -> list[tuple[int, int, int]]:
    """(start, rank of the kind, end) of every span, in order."""
    starts: dict[str, set[int]] = {}
    for end, (kind, length) in keyword_automaton().iter(lower_ascii(text)):
        starts.setdefault(kind, set()).add(end - length + 1)
    found = []
    for kind, places in starts.items():
        rank, pattern, free = KINDS.index(kind), COMPILED[kind], 0
        for place in sorted(places):
            if place < free:
                continue
            if hit := pattern.match(text, place):
                free = hit.end()
                if valid(kind, hit):
                    start, end = span_of(kind, hit)
                    found.append((start, rank, end))
            elif kind in RUNS and (run := RUNS[kind].match(text, place)):
                free = run.end()
    if HEX_FOUND in text.encode("utf-8", "surrogatepass").translate(HEX_MARK):
        rank = KINDS.index("hex")
        found += [(hit.start(), rank, hit.end()) for hit in HEX_RUN.finditer(text)]
    return sorted(found)


def joined(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[rank]}:{start}:{end}" for start, rank, end in found)


def scan_secrets(documents: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, digest of the base spans, all spans. Only doc_id and text are read."""

    def work(carried: list[list], texts: list[str]) -> list:
        all_found = [spans(text) for text in texts]
        base = [[f for f in found if f[1] < 3] for found in all_found]
        counts = [[sum(f[1] == rank for f in found) for found in base] for rank in range(3)]
        digests = [hashlib.sha256(joined(found).encode()).hexdigest() for found in base]
        return [carried[0], *counts, digests, [joined(found) for found in all_found], [len(found) for found in all_found]]

    return map_texts(documents, SCHEMA, work, ["doc_id"])

"""Secret scans: Aho-Corasick keyword prefilter, anchored regular expressions
only near its hits, then validation of checksums embedded in the secrets.

One automaton finds all keywords in the ASCII-lowered text; each kind's
expression is then matched at the places of its own keywords, left to right
and without overlap, which gives what a scan with that expression would.
Kind ``hex`` has no keyword and is found as runs of characters.

Kinds beyond the base ones must prove themselves: ``github`` and ``npm``
tokens carry a CRC-32 in base 62 over their 30 random characters, ``jwt`` a
header that decodes to JSON with an ``alg``, ``pem`` its key type.

Defined cases: null text counts as empty; a text without secrets has zero counts,
empty ``spans`` and the SHA-256 of the empty string. Texts of any length are
scanned whole, in linear time. Spans of equal start stand in the order of the kinds. Repeated rows get equal results, null ids are carried
along; other columns, whatever their names, are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm.common import text_udf, whole_text

# The patterns of the base kinds.
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

GITHUB = re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
NPM = re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
JWT = re.compile(r"(eyJ[A-Za-z0-9_-]+)\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
PEM = re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----")

KINDS = ("assign", "access", "hex", "github", "npm", "jwt", "pem")
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
    "jwt": ("eyj",),
    "pem": ("-----begin ",),
}
DIGITS62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def base62(n: int, width: int) -> str:
    out = ""
    while n:
        n, r = divmod(n, 62)
        out = DIGITS62[r] + out
    return out.rjust(width, "0")


def crc_fits(m: re.Match) -> bool:
    return base62(zlib.crc32(m[1].encode()), 6) == m[2]


def jwt_fits(m: re.Match) -> bool:
    try:
        head = json.loads(base64.urlsafe_b64decode(m[1] + "=" * (-len(m[1]) % 4)))
    except ValueError:
        return False
    return isinstance(head, dict) and "alg" in head


# A place of ``jwt`` that does not match: neither does any other up to the end of its characters, since the
# first part of a token goes on to there from each of them. So every character is read a bounded number of times.
JWT_RUN = re.compile(r"eyJ[A-Za-z0-9_-]*")

# kind: (anchored expression, validation of a match)
RULES = {
    "assign": (ASSIGN, lambda m: len(m[2]) >= 6),
    "access": (ACCESS, lambda m: len(m[0]) >= 20),
    "github": (GITHUB, crc_fits),
    "npm": (NPM, crc_fits),
    "jwt": (JWT, jwt_fits),
    "pem": (PEM, lambda m: True),
}


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for w in words:
            found.add_word(w, (kind, len(w)))
    found.make_automaton()
    return found


def ascii_lower(text: str) -> str:
    """A-Z lowered; every code point keeps its place."""
    return text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode(
        "utf-8", "surrogatepass")


def spans_of(text: str, found: ahocorasick.Automaton) -> list[tuple[int, int, str]]:
    """(start, end, kind), by start and then kind as listed."""
    starts: dict[str, list[int]] = {}
    for end, (kind, n) in found.iter(ascii_lower(text)):
        starts.setdefault(kind, []).append(end - n + 1)
    out = [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    for kind, places in starts.items():
        rule, valid = RULES[kind]
        free = 0
        for at in sorted(set(places)):
            if at < free:
                continue
            if m := rule.match(text, at):
                free = m.end()
                if valid(m):
                    out.append((at, free, kind))
            elif kind == "jwt" and (run := JWT_RUN.match(text, at)):
                free = run.end()
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find_secrets(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans,
    n_validated (spans beyond the base kinds)."""
    base = KINDS[:3]

    def make():
        found = automaton()

        def step(texts):
            out = {"n_assign": [], "n_access": [], "n_hex": [], "base_sha256": [], "spans": [],
                   "n_validated": []}
            for text in texts:
                spans = spans_of(text, found)
                own = [s for s in spans if s[2] in base]
                for kind in base:
                    out[f"n_{kind}"].append(sum(s[2] == kind for s in own))
                out["base_sha256"].append(hashlib.sha256(_joined(own).encode()).hexdigest())
                out["spans"].append(_joined(spans))
                out["n_validated"].append(len(spans) - len(own))
            return out
        return step

    found = text_udf(docs, make, "struct<n_assign:long,n_access:long,n_hex:long,base_sha256:string,"
                                 "spans:string,n_validated:long>")
    return (docs.select("doc_id", whole_text().alias("text"))
            .select("doc_id", found.alias("found")).select("doc_id", "found.*"))

"""Secrets in texts: assignments lexed into name-literal pairs, constants propagated, literals scored by their targets' names.

A text is lexed as loosely as its syntax is unknown: ``name = value`` of source, shell and property files, ``name: value`` of
YAML and JSON, ``<name>value</name>``, ``("name", "value")`` and ``--name value``. A value is a literal, a concatenation, or a
reference to another name of the same text; a literal takes the most sensitive name it flows into, through any number of
references. Every text is one row's work, linear in its length; rows never meet, so nothing is shuffled.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import arrow_map, text_bytes

# --- fixed values ---
ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"(?<![0-9a-f])[0-9a-f]{32,}")
#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "named")
#: How sensitive a name is that holds these words side by side.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "passcode": 1.0, "secret": 1.0, "secrets": 1.0,
    "apikey": 1.0, "api key": 1.0, "access key": 1.0, "private key": 1.0, "secret key": 1.0, "signing key": 1.0,
    "encryption key": 1.0, "master key": 1.0, "auth key": 1.0, "pass": 0.9, "token": 0.9, "credential": 0.9,
    "credentials": 0.9, "bearer": 0.8, "jwt": 0.8, "auth": 0.7, "authorization": 0.8, "salt": 0.7, "cookie": 0.7,
}
#: A name that ends in one of these is about a secret and does not hold it.
ABOUT = frozenset(
    "count counts length len size limit name file path dir url uri id ids type hint policy field label expiry ttl timeout min max enabled "
    "regex pattern header prompt required reset".split()
)
PLACEHOLDERS = re.compile(rb"(?i)(?:change.?me|your.*|my.?(?:password|secret|token)|example.*|dummy|placeholder|redacted|none|null|true|false|undefined|todo|"
                          rb"(?:.)\1*|<.*>|\$\{?.*|%.*%|\{\{.*|\*+|x+)".replace(rb"(?:.)\1*", rb"(.)\1*"))  # fmt: skip
# --- end of fixed values ---
#: A literal counts from this product of its name's sensitivity and its own strength on.
THRESHOLD = 0.5
#: Bits of entropy at which a literal is as strong as can be.
STRONG_BITS = 28.0
SCHEMA = "spans array<struct<kind: string, start: long, end: long, name: string, score: double>>"

_NAME = rb"[A-Za-z_$@][\w$@.\-]*+"
_TARGET = re.compile(rb"""(?<![\w$@.\-])(""" + _NAME + rb""")["'`]?\]?[ \t]*+(?::=|=>|\+?=(?![=~>])|:(?![:/=]))[ \t]*+""")
_ELEMENT = re.compile(rb"<(" + _NAME + rb")>([^<>]++)</")
_PAIR = re.compile(rb"""["'](""" + _NAME + rb""")["'][ \t]*+,[ \t]*+(?=["'`])""")
_OPTION = re.compile(rb"(?<![\w-])--?(" + _NAME + rb")[ \t]++(?=[^\s=-])")
_TYPED = re.compile(rb"[A-Za-z_][\w.\[\]|*?]*+[ \t]*+=(?![=~>])[ \t]*+")
_OPEN = re.compile(rb"(?:[ \t]*+(?:\(|\\\n|[|>][+-]?\n)\s*+)?")
_STRING = re.compile(
    rb"""[A-Za-z@]{0,2}+(?:\"{3}(?P<a>(?:[^"\\]|\\.|"(?!""))*+)\"{3}|'{3}(?P<b>(?:[^'\\]|\\.|'(?!''))*+)'{3}"""
    rb"""|"(?P<c>(?:[^"\\\n]|\\.)*+)"|'(?P<d>(?:[^'\\\n]|\\.)*+)'|`(?P<e>(?:[^`\\]|\\.)*+)`)""",
    re.S,
)
_HOLE = re.compile(rb"\$\{(" + _NAME + rb")\}|\{\{[ \t]*+(" + _NAME + rb")[ \t]*+\}\}")
_BARE = re.compile(rb"""[^\s"'`,;(){}\[\]<>|&=:\x80-\xff]++=*+""")
_JOIN = re.compile(rb"\s*+(?:\+|\.\.|\.|&)\s*+|[ \t]*+(?=[\"'`])|\)?\s*+\n\s*+(?=[\"'`])")
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_OUTSIDE = frozenset((b"getenv", b"environ", b"get", b"env", b"input", b"prompt", b"getpass", b"len"))


def sensitivity(name: str) -> float:
    """How likely a value under this name is a secret, from the words the name is made of."""
    words = [w.lower() for w in _WORDS.findall(name)]
    if not words or words[-1] in ABOUT:
        return 0.0
    return max(chain((SENSITIVE.get(w, 0.0) for w in words), (SENSITIVE.get(f"{a} {b}", 0.0) for a, b in zip(words, words[1:], strict=False))))


def strength(value: bytes, quoted: bool) -> float:
    """How much a literal looks like a secret: its entropy; bare words must mix kinds of characters, sentences count little."""
    if len(value) < 6 or PLACEHOLDERS.fullmatch(value):
        return 0.0
    n = len(value)
    bits = n * math.log2(n) - sum(c * math.log2(c) for c in Counter(value).values())
    mixed = sum(bool(re.search(p, value)) for p in (rb"[a-z]", rb"[A-Z]", rb"[0-9]", rb"[^A-Za-z0-9\s]"))
    if mixed < 2 and (not quoted or value.isdigit()):
        return 0.0
    if value.count(b" ") >= 2:
        bits *= 0.3
    return min(1.0, bits / STRONG_BITS)


def _value(t: bytes, at: int) -> list[tuple[str, int, int]]:
    """The parts of the value at ``at``: ``quoted`` and ``bare`` literals, ``ref`` and ``hole`` references, with their places."""
    parts: list[tuple[str, int, int]] = []
    if typed := _TYPED.match(t, at):
        at = typed.end()
    at = _OPEN.match(t, at).end()
    while True:
        if m := _STRING.match(t, at):
            a, b = m.span(m.lastgroup)
            parts += [("hole", *h.span(h.lastindex)) for h in _HOLE.finditer(t, a, b)]
            parts.append(("quoted", a, b))
        elif m := _HOLE.match(t, at):
            parts.append(("hole", *m.span(m.lastindex)))
        elif m := _BARE.match(t, at):
            a, b = m.span()
            word = t[a:b]
            if t[b : b + 1] == b"(":  # a call: its first argument, unless it asks the outside world
                if word.rpartition(b".")[2] in _OUTSIDE or not (inner := _STRING.match(t, b + 1)):
                    return parts
                parts.append(("quoted", *inner.span(inner.lastgroup)))
                return parts
            while b > a and t[b - 1] in b".,:!?":
                b -= 1
            if b > a:
                parts.append(("ref" if re.fullmatch(_NAME, t[a:b]) else "bare", a, b))
            if parts and parts[-1][0] == "bare":
                return parts
        else:
            return parts
        if not (joined := _JOIN.match(t, m.end())) or joined.end() == m.end() and t[m.end() : m.end() + 1] not in (b'"', b"'", b"`"):
            return parts
        at = joined.end()


def pairs(t: bytes) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """All name-value pairs of a text in the order of their places."""
    found = []
    if b"=" in t or b":" in t:
        found += [(m.start(1), m[1], _value(t, m.end())) for m in _TARGET.finditer(t)]
    if b"</" in t:
        found += [(m.start(1), m[1], [("quoted", *m.span(2))]) for m in _ELEMENT.finditer(t)]
    if b"," in t:
        found += [(m.start(1), m[1], _value(t, m.end())) for m in _PAIR.finditer(t)]
    if b"-" in t:
        found += [(m.start(1), m[1], _value(t, m.end())[:1]) for m in _OPTION.finditer(t)]
    found.sort(key=lambda x: x[0])
    return [(name.decode(), parts) for _, name, parts in found]


def _plain(name: str) -> str:
    """What a name is looked up by: no receiver, no sigil."""
    for receiver in ("self.", "this."):
        name = name.removeprefix(receiver)
    return name.lstrip("$@")


def named_literals(t: bytes, threshold: float = THRESHOLD) -> list[tuple[int, int, str, float]]:
    """``(start, end, name, score)`` in bytes of every literal that flows into a sensitive name.

    Assignments are visited from the most sensitive name down, each once, and hand their name's weight on to all assignments
    of the names they refer to (of several values of one name, any may be the one in use).
    """
    all_pairs = pairs(t)
    weights = [sensitivity(name) for name, _ in all_pairs]
    if not any(weights):
        return []
    by_name: dict[str, list[int]] = {}
    for i, (name, _) in enumerate(all_pairs):
        by_name.setdefault(_plain(name), []).append(i)
    out: dict[tuple[int, int], tuple[str, float]] = {}
    seen: set[int] = set()
    opened: set[str] = set()
    for first in sorted((i for i, w in enumerate(weights) if w > 0), key=lambda i: (-weights[i], i)):
        stack, top = [first], all_pairs[first][0]
        while stack:
            i = stack.pop()
            if i in seen:
                continue
            seen.add(i)
            parts, literals = all_pairs[i][1], []
            for kind, a, b in parts:
                name = _plain(t[a:b].decode(errors="replace")) if kind in ("ref", "hole") else ""
                if name in by_name and (kind == "hole" or by_name[name] != [i]):
                    if name not in opened:
                        opened.add(name)
                        stack += by_name[name]
                elif kind != "hole":
                    literals.append((kind, a, b))
            if literals:
                whole = b"".join(t[a:b] for _, a, b in literals)
                score = weights[first] * strength(whole, all(kind == "quoted" for kind, _, _ in literals))
                if score >= threshold:
                    for _, a, b in literals:
                        if a < b and score > out.get((a, b), ("", 0.0))[1]:
                            out[a, b] = (top, score)
    return [(a, b, name, score) for (a, b), (name, score) in sorted(out.items())]


def spans_of(t: bytes, threshold: float = THRESHOLD) -> list[dict]:
    """All spans of a text in code points: the fixed patterns', then the named literals that none of those contains."""
    base = [("assign", *m.span(), None, None) for m in ASSIGN.finditer(t) if len(m[1]) >= 8]
    base += [("access", *m.span(), None, None) for m in ACCESS.finditer(t) if m.end() - m.start() >= 16]
    base += [("hex", *m.span(), None, None) for m in HEX.finditer(t)]
    found = base
    if named := named_literals(t, threshold):
        base.sort(key=lambda s: (s[1], -s[2]))
        reach, at, furthest = [], 0, -1
        for a, b, name, score in named:  # sorted by start: the furthest end of any base span that starts before
            while at < len(base) and base[at][1] <= a:
                furthest = max(furthest, base[at][2])
                at += 1
            if furthest < b:
                reach.append(("named", a, b, name, score))
        found = base + reach
    if not found:
        return []
    points = np.concatenate([[0], np.cumsum((np.frombuffer(t, np.uint8) & 0xC0) != 0x80)])
    found.sort(key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return [{"kind": k, "start": int(points[a]), "end": int(points[b]), "name": n, "score": s} for k, a, b, n, s in found]


def find_secrets(df: DataFrame, keep: list[str], text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The columns ``keep`` of every row and its ``spans``, by start and kind: kind, start and end in code points, for named
    literals also the most sensitive name they flow into and their score.

    Null and empty texts have no spans. Repeated rows are judged each by itself, ids may be null; of further columns, whatever
    their names, only ``keep`` is read. Texts of any length are read whole.
    """
    rows = df.select(*keep, text_bytes(text).alias("secret text"))
    return arrow_map(rows, lambda cols: {"spans": [spans_of(t, threshold) for t in cols["secret text"]]}, SCHEMA, passed=keep)


def listed(base_only: bool = False):
    """The spans as ``kind:start:end``, comma-joined."""
    spans = F.filter("spans", lambda s: s["kind"] != "named") if base_only else F.col("spans")
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def number(kind: str):
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

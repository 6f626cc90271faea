"""URL rules in a sorted digest array.

The rules' 64-bit xxhash keys lie sorted in one file, with the full rule strings beside them. Every task maps the file
into memory, makes a candidate key for each host suffix and each rule-path length of its URLs, finds all of them with one
binary search per batch, and confirms each hit against the stored string, so a collision never matches.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable

import numpy as np
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm.common import arrow_map, share_file

HEADER = struct.Struct("<QQ")
UPPER_TO_LOWER = {c: c + 32 for c in range(65, 91)}


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): the host after the first ``://`` up to ``/``, ``?``, ``#`` or the end with A-Z lower-cased, the path
    up to ``?``, ``#`` or the end. A null, or a URL without ``://``, has neither."""
    at = -1 if url is None else url.find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    for mark in "?#":
        rest = rest.partition(mark)[0]
    host, slash, path = rest.partition("/")
    return host.translate(UPPER_TO_LOWER), slash + path


def digest_array(rules: Iterable[tuple[str, str]], max_bytes: int = 1 << 30) -> tuple[bytes, list[int]]:
    """(verdict, rule) pairs as a sorted digest array, and the distinct lengths of the rules' paths.

    A rule is a host and a path (``example.org/en/``). Layout: counts, sorted keys, string offsets, strings (a verdict
    byte, then the rule). Of one rule given twice the first verdict counts. A list beyond ``max_bytes`` is refused, as
    every executor gets the whole file.
    """
    first: dict[bytes, bytes] = {}
    for verdict, rule in rules:
        if verdict not in ("allow", "block") or "/" not in rule:
            raise ValueError(f"not a rule: {verdict} {rule}")
        host, slash, rest = rule.partition("/")
        first.setdefault((host.translate(UPPER_TO_LOWER) + slash + rest).encode(), verdict[0].encode())
    entries = sorted((xxhash.xxh64_intdigest(rule), verdict + rule) for rule, verdict in first.items())
    strings = [e[1] for e in entries]
    offsets = np.zeros(len(strings) + 1, "<u8")
    np.cumsum([len(s) for s in strings], out=offsets[1:])
    if HEADER.size + 16 * len(strings) + int(offsets[-1]) > max_bytes:
        raise ValueError(f"the rules take more than {max_bytes} bytes")
    keys = np.array([e[0] for e in entries], "<u8")
    data = HEADER.pack(len(strings), int(offsets[-1])) + keys.tobytes() + offsets.tobytes() + b"".join(strings)
    return data, sorted({len(r.partition(b"/")[2].decode()) + 1 for r in first})


class DigestArray:
    """A memory-mapped index file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            n, size = HEADER.unpack(f.read(HEADER.size))
        at = HEADER.size
        self.keys = np.memmap(path, "<u8", "r", at, (n,)) if n else np.zeros(0, "<u8")
        self.offsets = np.memmap(path, "<u8", "r", at + 8 * n, (n + 1,))
        self.strings = np.memmap(path, "u1", "r", at + 16 * n + 8, (size,)) if size else np.zeros(0, "u1")

    def find(self, candidates: list[bytes]) -> list[str | None]:
        """The verdict of each candidate string that is stored, else None."""
        found: list[str | None] = [None] * len(candidates)
        if not len(self.keys) or not candidates:
            return found
        keys = np.fromiter(map(xxhash.xxh64_intdigest, candidates), np.uint64, len(candidates))
        lo = np.searchsorted(self.keys, keys, "left")
        hi = np.searchsorted(self.keys, keys, "right")
        for i in np.nonzero(hi > lo)[0]:
            for k in range(lo[i], hi[i]):  # equal digests: the stored string decides
                stored = self.strings[int(self.offsets[k]) : int(self.offsets[k + 1])].tobytes()
                if stored[1:] == candidates[i]:
                    found[i] = "allow" if stored[:1] == b"a" else "block"
        return found


def judge(pages: DataFrame, rules: Iterable[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """Each row's id, host, path, the longest fitting rule (or null) and its verdict (else ``default``).

    A rule fits its host and all its subdomains where the URL's path starts with the rule's path. Null, empty and odd
    URLs have no host, fit no rule and get ``default``; repeated rows are judged alike; an empty table gives no rows;
    other columns are neither read nor returned. Long URLs are judged whole.
    """
    spark: SparkSession = pages.sparkSession
    data, lengths = digest_array(rules)
    name = share_file(spark, "url-rules", data)
    opened: dict[str, DigestArray] = {}

    def run(rows: dict) -> dict:
        index = opened.get(name) or opened.setdefault(name, DigestArray(SparkFiles.get(name)))
        parts = [split_url(u) for u in rows[url_col]]
        candidates, owner = [], []
        for i, (host, path) in enumerate(parts):
            if not path:
                continue
            starts = [0] + [k + 1 for k, c in enumerate(host) if c == "."]
            for n in lengths:
                if n > len(path):
                    break
                for s in starts:
                    candidates.append((host[s:] + path[:n]).encode("utf-8", "surrogatepass"))
                    owner.append(i)
        best: dict[int, tuple[int, str, str]] = {}
        for i, c, verdict in zip(owner, candidates, index.find(candidates), strict=True):
            if verdict and (i not in best or len(c) > best[i][0]):
                best[i] = (len(c), c.decode(), verdict)
        return {
            id_col: rows[id_col],
            "host": [h for h, _ in parts],
            "path": [p for _, p in parts],
            "rule": [best[i][1] if i in best else None for i in range(len(parts))],
            "verdict": [best[i][2] if i in best else default for i in range(len(parts))],
        }

    kind = pages.schema[id_col].dataType.simpleString()
    return arrow_map(pages.select(id_col, url_col), run, f"{id_col} {kind}, host string, path string, rule string, verdict string")

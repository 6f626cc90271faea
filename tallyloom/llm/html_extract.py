"""Main text through wrappers: union-free regular expressions inferred per host.

Every page becomes a stream of structural tokens (tags with their class names, text slots). Neighbouring equal runs fold into
repeated groups; the distinct folded streams of a host, counted before they travel, are aligned one after another: where
two differ, the differing part becomes an optional group, or joins a repeated group that has the same content. The wrapper's
slots, which are tag paths, are labelled once per host: by their place (article, main, page furniture), outside these containers by whether
all pages of the host show the same text there, and, for repeated slots, by the share of links. A page's text is that of
its main slots.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from difflib import SequenceMatcher

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.common import Scratch, arrow_map, fits
from tallyloom.llm.url_filter import split_url

STREAMS_AT_ONCE = 32
MAX_BROADCAST_SLOTS = 200_000
MAX_PERIOD = 24
FACTOR, MASK = 0x9E3779B97F4A7C15, (1 << 63) - 1  # of digests of several texts

#: Fixed values of HTML: elements by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark nobr q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
FURNITURE = frozenset(
    "nav header footer aside form script style noscript template iframe button select option textarea input svg canvas object "
    "video audio map dialog menu head title fieldset math".split()
)
ROLES = frozenset(
    "ad ads advert adverts advertisement advertising banner sidebar menu nav navbar navigation breadcrumb breadcrumbs cookie cookies "
    "notice notices consent gdpr popup modal overlay alert comment comments commentlist reply replies respond disqus share sharing "
    "social related recommended recommendations promo promoted promotion sponsor sponsored newsletter subscribe subscription signup "
    "footer header masthead pagination pager widget toolbar contentinfo complementary search searchform login hidden".split()
)
CLOSED_BY = {  # an open element on the left ends where one on the right begins
    "p": frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"]),
}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|xmp|noembed|noframes)\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+|[^>]*)>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|itemprop)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def element(name: str, attributes: str) -> tuple[str, bool, int]:
    """(symbol, whether it is page furniture, its level as a container: 2 article, 1 main, else 0)."""
    level = 2 if name == "article" else 1 if name == "main" else 0
    furniture, classes = name in FURNITURE, ""
    if attributes and not attributes.isspace():
        for kind, *values in ATTRIBUTE.findall(attributes):
            kind, value = kind.lower(), "".join(values)
            words = {w.lower() for w in WORD.findall(value)}
            if kind in ("hidden",) or (kind == "aria-hidden" and value.lower() == "true"):
                furniture = True
            elif kind == "itemprop":
                level = max(level, 2 * (value.lower() == "articlebody"))
            elif kind == "role":
                level = max(level, {"article": 2, "main": 1}.get(value.lower(), 0))
                furniture |= bool(words & ROLES)
            elif kind != "hidden":
                furniture |= bool(words & ROLES)
            if kind == "class" and value:
                classes = "." + ".".join(re.sub(r"\d+", "0", value).split())
    return name + classes, furniture, level


class Page:
    """The structural stream of a page and its texts: ``texts`` holds (slot path, level, text, in a link, block number)."""

    def __init__(self, html: str, known: dict):
        self.stream: list[str] = []
        self.texts: list[tuple[str, int, str, bool, int]] = []
        stack: list[tuple[str, str, bool, int, str]] = []  # name, symbol, furniture, level, path
        block = at = links = 0
        path, furniture, level = "", False, 0

        def text(value: str) -> None:
            if value and not value.isspace():
                if not self.stream or self.stream[-1] != "#":
                    self.stream.append("#")
                self.texts.append((path, -1 if furniture else level, value, links > 0, block))
            elif value and self.texts and self.texts[-1][4] == block:
                self.texts.append((path, -1 if furniture else level, " ", False, block))

        for m in TOKEN.finditer(html):
            text(html[at : m.start()])
            at = m.end()
            name = m.group(3)
            if name is None:
                continue
            name = name.lower()
            if not m.group(2):
                key = (name, m.group(4))
                made = known.get(key)
                if made is None:
                    if len(known) > 50_000:
                        known.clear()
                    made = known[key] = element(name, m.group(4))
                symbol, odd, own = made
                inline = name in INLINE and not odd
                if not inline:
                    block += 1
                    if stack and name in CLOSED_BY.get("p", ()) or name in CLOSED_BY:
                        self._close_implied(stack, name)
                if name == "br":
                    text(" ")
                if name in VOID:
                    continue
                if name == "a":
                    links += 1
                up = stack[-1] if stack else ("", "", False, 0, "")
                here = up[4] if inline else f"{up[4]}>{symbol}"
                stack.append((name, symbol, up[2] or odd, max(up[3], own), here))
                if not inline:
                    self.stream.append(f"<{symbol}")
            else:
                if name not in INLINE:
                    block += 1
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == name:
                        if not (name in INLINE and stack[k][1] == name):
                            self.stream.append(f">{stack[k][1]}")
                        if any(s[2] != (stack[k - 1][2] if k else False) for s in stack[k:]):
                            block += 1
                        del stack[k:]
                        break
                    if stack[k][0] not in INLINE and name in INLINE:
                        break  # an inline end tag does not close a block
                if name == "a":
                    links = max(0, links - 1)
            if stack:
                _, _, furniture, level, path = stack[-1]
            else:
                path, furniture, level = "", False, 0
        text(html[at:])

    @staticmethod
    def _close_implied(stack: list, name: str) -> None:
        for k in range(len(stack) - 1, -1, -1):
            if name in CLOSED_BY.get(stack[k][0], ()):
                del stack[k:]
                return
            if stack[k][0] not in INLINE:
                return


def folded(stream: list[str]) -> tuple[str, ...]:
    """The stream with neighbouring equal runs as repeated groups ``(...)+``, innermost first."""
    codes: dict[str, str] = {}
    symbols: list[str] = []

    def code(symbol: str) -> str:
        if symbol not in codes:
            codes[symbol] = chr(0xF0000 + len(symbols))
            symbols.append(symbol)
        return codes[symbol]

    line = "".join(map(code, stream))

    def group(m: re.Match) -> str:
        return code("(" + " ".join(symbols[ord(c) - 0xF0000] for c in m.group(1)) + ")+")

    for _ in range(4):
        shorter = re.sub(rf"(.{{1,{MAX_PERIOD}}}?)\1+", group, line, flags=re.S)
        if shorter == line:
            break
        line = shorter
    return tuple(symbols[ord(c) - 0xF0000] for c in line)


def content(node: str) -> str:
    """What a group holds: ``(x)+`` and ``(x)?`` give x."""
    return node[1:-2] if node[-2:] in (")+", ")?") else node


def merged(a: tuple[str, ...], b: tuple[str, ...]) -> tuple[str, ...]:
    """A union-free expression of both: parts that differ are optional, or join the repeated group they stand beside."""
    out: list[str] = []

    def put(nodes) -> None:
        nodes = list(nodes)
        if not nodes:
            return
        inner = " ".join(nodes)
        plain = content(inner) if len(nodes) == 1 else inner
        if out and content(out[-1]) == plain:
            out[-1] = f"({plain})+"
        elif len(nodes) == 1 and nodes[0].endswith(")?"):
            out.append(nodes[0])
        else:
            out.append(f"({inner})?")

    for kind, i1, i2, j1, j2 in SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
        if kind == "equal":
            for node in a[i1:i2]:
                if out and out[-1].endswith((")?", ")+")) and content(out[-1]) == content(node):
                    out[-1] = f"({content(node)})+"  # beside its own content: repeated
                else:
                    out.append(node)
        else:
            left, right = a[i1:i2], b[j1:j2]
            if len(left) == len(right) == 1 and content(left[0]) == content(right[0]):
                repeated = ")+" in (left[0][-2:], right[0][-2:])
                out.append(f"({content(left[0])}){'+' if repeated else '?'}")
            else:
                put(left)
                put(right)
    return tuple(out)


def _parts(pages: DataFrame) -> DataFrame:
    """Per Arrow batch: (host, stream, null..) with page counts, (host, path) rows with what the slot shows from page to page,
    and one row without either per distinct digest (``lo``) of a page's texts outside furniture."""

    def run(rows: dict) -> dict:
        streams: dict = defaultdict(int)
        slots: dict = {}
        digests: dict = {}
        known: dict = {}
        for url, html in zip(rows["url"], rows["html"], strict=True):
            host = split_url(url)[0]
            page = Page(html or "", known)
            streams[host, "\n".join(folded(page.stream))] += 1
            own: dict = {}
            whole = 0
            for path, level, text, link, _ in page.texts:
                if text == " ":
                    continue
                clean = " ".join(text.split())
                h = xxhash.xxh64_intdigest(clean)
                if level >= 0:
                    whole = (whole * FACTOR + h) & MASK
                s = own.setdefault((path, level), [0, 0, 0])
                s[0] = (s[0] * FACTOR + h) & MASK
                s[1] += len(clean)
                s[2] += len(clean) * link
            digests[host, whole] = None
            for (path, level), (h, chars, links) in own.items():
                s = slots.get((host, path, level))
                if s is None:
                    slots[host, path, level] = [h, h, chars, links, 1]
                else:
                    s[0], s[1] = min(s[0], h), max(s[1], h)
                    s[2] += chars
                    s[3] += links
                    s[4] += 1
        d = [None] * len(digests)
        return {
            "host": [k[0] for k in streams] + [k[0] for k in slots] + [k[0] for k in digests],
            "stream": [k[1] for k in streams] + [None] * len(slots) + d,
            "path": [None] * len(streams) + [k[1] for k in slots] + d,
            "level": [None] * len(streams) + [k[2] for k in slots] + d,
            "n": list(streams.values()) + [s[4] for s in slots.values()] + d,
            "lo": [None] * len(streams) + [s[0] for s in slots.values()] + [k[1] for k in digests],
            "hi": [None] * len(streams) + [s[1] for s in slots.values()] + d,
            "chars": [None] * len(streams) + [s[2] for s in slots.values()] + d,
            "links": [None] * len(streams) + [s[3] for s in slots.values()] + d,
        }

    schema = "host string, stream string, path string, level int, n long, lo long, hi long, chars long, links long"
    return arrow_map(pages.select(F.col("url").cast("string"), F.col("html").cast("string")), run, schema)


def wrappers(parts: DataFrame) -> DataFrame:
    """(host, wrapper, pages): one union-free expression per host, from its distinct streams.

    A host's streams are merged in a tree: groups of about STREAMS_AT_ONCE, as many as its distinct streams need, then groups
    of those results, until one is left; no task sees all of a host of many.
    """
    streams = parts.filter("stream is not null").groupBy("host", "stream").agg(F.sum("n").alias("n"))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n", "stream"], ascending=[False, True])
        wrapper: tuple[str, ...] | None = None
        for stream in pdf.stream:
            nodes = tuple(stream.split("\n")) if stream else ()
            wrapper = nodes if wrapper is None else merged(wrapper, nodes)
        return pd.DataFrame({"host": [pdf.host.iloc[0]], "stream": ["\n".join(wrapper or ())], "n": [int(pdf.n.sum())], "groups": [int(pdf.groups.iloc[0])]})

    schema = "host string, stream string, n long"
    most = streams.groupBy("host").count().agg(F.max("count")).first()[0] or 0
    rounds = 1
    while most > STREAMS_AT_ONCE:
        most = -(-most // STREAMS_AT_ONCE)
        rounds += 1
    each = streams.groupBy("host").agg(F.count(F.lit(1)).alias("groups"))
    merging = streams.join(each, "host")
    for left in range(rounds - 1, -1, -1):
        merging = merging.withColumn("groups", F.ceil(F.col("groups") / STREAMS_AT_ONCE) if left else F.lit(1).cast("long"))
        merging = merging.withColumn("salt", F.pmod(F.xxhash64("stream", "n"), F.col("groups")))
        merging = merging.groupBy("host", "salt").applyInPandas(one, schema + ", groups long")
    return merging.select("host", F.col("stream").alias("wrapper"), F.col("n").alias("pages"))


def slot_labels(parts: DataFrame, found: DataFrame, least_pages: int = 3, link_share: float = 0.6) -> DataFrame:
    """(host, path, level, main) of every text slot of a host.

    Main: not furniture; outside an article or main container, not the same text on all pages of a host, where another such
    slot differs between pages and at least ``least_pages`` pages are distinct (template text); and, for a slot in a repeated
    group outside an article, not mostly links.
    """
    slots = parts.filter("path is not null").groupBy("host", "path", "level").agg(
        F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("chars").alias("chars"), F.sum("links").alias("links")
    )
    distinct = parts.filter("stream is null and path is null").select("host", "lo").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("distinct"))
    slots = slots.join(found.select("host", "pages", "wrapper"), "host").join(distinct, "host")
    same = (F.col("lo") == F.col("hi")) & (F.col("n") == F.col("pages"))
    others = slots.groupBy("host", "level").agg(F.max(~same).alias("others"))
    joined = slots.join(others, ["host", "level"])
    last = F.regexp_extract("path", r">([^>]*)$", 1)
    repeated = F.col("wrapper").contains(F.concat(F.lit("(<"), last)) & F.col("wrapper").contains(")+")
    template = (F.col("level") == 0) & same & (F.col("distinct") >= least_pages) & F.col("others")
    listing = (F.col("level") < 2) & repeated & (F.col("links") > F.col("chars") * link_share)
    return joined.select("host", "path", "level", ((F.col("level") >= 0) & ~template & ~listing).alias("main"))


def main_text(html: str | None, wanted: set[tuple[str, int]], known: dict) -> str:
    """The texts of the page's main slots, a line per block: those in article and main containers, without any all others."""
    page = Page(html or "", known)
    top, any_text = 0, False
    for path, level, text, _, _ in page.texts:
        if (path, level) in wanted and text != " " and not text.isspace():
            top, any_text = max(top, min(level, 1)), True
    if not any_text:
        return ""
    blocks: list[str] = []
    current, pieces = None, []
    for path, level, text, _, block in [*page.texts, ("", 0, "", False, -1)]:
        if block != current:
            joined = " ".join(entities.unescape("".join(pieces)).split())
            if joined:
                blocks.append(joined)
            current, pieces = block, []
        if text == " " or (min(level, 1) == top and (path, level) in wanted):
            pieces.append(text)
    return "\n".join(blocks)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page.

    A null or empty html, and a page without main text, give an empty text; a null url is the host of an empty name;
    repeated rows give the same text; unclosed and stray tags are tolerated; an empty table gives no rows. Other columns
    are not read.
    """
    scratch = Scratch(pages.sparkSession, "html-extract")
    parts = scratch.write(_parts(pages), "parts")
    found = scratch.write(wrappers(parts), "wrappers")
    labels = scratch.write(slot_labels(parts, found).filter("main").select("host", "path", "level"), "labels")
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    host = F.udf(lambda url: split_url(url)[0], T.StringType())
    if fits(labels, MAX_BROADCAST_SLOTS):
        table: dict = defaultdict(set)
        for r in labels.toLocalIterator():
            table[r.host].add((r.path, r.level))
        shared = pages.sparkSession.sparkContext.broadcast(dict(table))
        rows = rows.withColumn("_url", F.col("url"))
    else:
        shared = None
        per_host = labels.groupBy("host").agg(F.collect_list(F.struct("path", "level")).alias("_slots"))
        rows = rows.withColumn("_host", host("url")).join(per_host, F.col("_host") == per_host.host, "left").drop("host", "_host")

    def run(cols: dict) -> dict:
        known: dict = {}
        texts = []
        for i, html in enumerate(cols["html"]):
            if shared is not None:
                wanted = shared.value.get(split_url(cols["_url"][i])[0], set())
            else:
                wanted = {(s["path"], s["level"]) for s in cols["_slots"][i] or ()}
            texts.append(main_text(html, wanted, known))
        return {"text": texts, "n_chars": [len(t) for t in texts]}

    return arrow_map(rows, run, "text string, n_chars long", ["page_id", "url"])

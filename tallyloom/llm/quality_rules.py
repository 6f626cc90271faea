"""Line-first cleaning, in DataFrame functions only.

Each line of a text is judged by punctuation, navigation and boilerplate rules; failing lines go, and a document that loses
too much of its text with them is rejected, as is one that fails the base rules (too few words, too much repetition).
Everything is computed within a row: no shuffle, and a long document costs in proportion to its length (times its
logarithm where it repeats itself).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import SPACE, Scratch

#: Phrases of page furniture, looked for in lines of at most MAX_FURNITURE characters.
BOILERPLATE = (
    "all rights reserved", "cookie policy", "we use cookies", "accept cookies", "privacy policy", "terms of use",
    "terms of service", "terms and conditions", "lorem ipsum", "enable javascript", "javascript is disabled",
    "subscribe to our newsletter", "sign up for", "log in to", "click here", "read more", "share on facebook",
    "share on twitter", "follow us", "back to top", "skip to content", "powered by", "page not found",
)
MAX_FURNITURE = 200
WINDOW = 5


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, f"{SPACE}+"), "")


def line_fails(line: Column, symbol_share: float = 0.1, separators: int = 3, shouts: int = 3, bare_chars: int = 200) -> Column:
    """Whether one line fails a rule; a blank line never does.

    Punctuation: symbols make up over ``symbol_share`` of the line, at least ``shouts`` words end in ``!!`` or more, or
    a short line has no letter or digit, or ends in an open list mark. Navigation: at least ``separators`` separators
    stand alone between words. Boilerplate: a line of at most MAX_FURNITURE characters holds a stock phrase.
    """
    size = F.length(line)
    symbols = F.regexp_count(line, F.lit(r"[#*$%&|<>]"))
    punctuation = (
        (symbols > size * symbol_share)
        | (F.regexp_count(line, F.lit(r"!![ \t]|!!$")) >= shouts)
        | ((size <= bare_chars) & ~line.rlike(r"[\p{L}\p{N}]"))
    )
    navigation = F.regexp_count(line, F.lit(r"[ \t][|>»›·•/][ \t]")) >= separators
    boilerplate = (size <= MAX_FURNITURE) & F.lower(line).rlike("|".join(BOILERPLATE))
    return line.rlike(r"[^\x20\x09-\x0D]") & (punctuation | navigation | boilerplate)


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns with the cleaned text and the measures of every document.

    Each step is a projection of its own, so that no array is computed twice.
    """
    names = [F.col(c) for c in keep]
    w, g, s = F.col("_words"), F.col("_windows"), F.col("_sorted")
    one = docs.select(*names, F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    one = one.select(*names, "_text", _words(F.col("_text")).alias("_words"), F.split("_text", "\n").alias("_lines"))
    windows = F.when(
        F.size(w) >= WINDOW,
        F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])),
    )
    worded = F.filter("_lines", lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    two = one.select(
        *names,
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        worded.alias("_worded"),
        windows.alias("_windows"),
        F.filter("_lines", lambda x: ~line_fails(x)).alias("_left"),
    )
    # Only a text with a window found twice is sorted.
    repeats = F.size(F.array_distinct(g)) < F.size(g)
    three = two.select(
        *names, "n_words", "word_chars", "n_symbols", "_worded", "_left",
        F.when(repeats, F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("_sorted"),
    )
    def twice(k: Column) -> Column:
        here = F.get(s, k)["h"]
        return F.coalesce(here == F.get(s, k - 1)["h"], F.lit(False)) | F.coalesce(here == F.get(s, k + 1)["h"], F.lit(False))

    found = F.filter(F.sequence(F.lit(0), F.size(s) - 1), twice)
    starts = F.when(s.isNotNull(), F.sort_array(F.transform(found, lambda k: F.get(s, k)["i"])))
    four = three.select(
        *names, "n_words", "word_chars", "n_symbols", "_left",
        (F.size("_worded") - F.size(F.array_distinct("_worded"))).cast("long").alias("n_dup_lines"),
        F.length(F.regexp_replace(F.array_join("_worded", ""), f"{SPACE}+", "")).alias("_all_chars"),
        F.length(F.regexp_replace(F.array_join("_left", ""), f"{SPACE}+", "")).alias("_left_chars"),
        starts.alias("_starts"),
    )
    p = F.col("_starts")
    gaps = F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW))))
    covered = F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)
    return four.select(
        *names, "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"),
        F.array_join("_left", "\n").alias("clean_text"), "_all_chars", "_left_chars",
    )


def judge(docs: DataFrame, keep: list[str], min_left: float = 0.5) -> DataFrame:
    """``keep`` columns, the measures, ``base_failed``, ``kept``, and ``clean_text`` without the failing lines.

    A document is rejected on the base rules, or where less than ``min_left`` of its non-white characters is left.
    Null and empty texts have no words and so fail the base rules; repeated rows are judged alike; an empty table gives
    no rows. Columns of ``keep`` are passed through untouched; they must not have the name of a measure.
    """
    left = F.col("_left_chars") >= F.col("_all_chars") * min_left
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (
        measured(docs, keep)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & left)
        .drop("_all_chars", "_left_chars")
    )


def clean(docs: DataFrame, min_left: float = 0.5) -> DataFrame:
    """The documents that pass, with their failing lines removed and ``n_chars`` (if there) counted anew.

    All other columns stay as they are, whatever their names.
    """
    names = {c: f"_in{i}" for i, c in enumerate(docs.columns) if c != "text"}
    packed = docs.select("text", *[F.col(c).alias(n) for c, n in names.items()])
    # Written before it is filtered: a filter would be pushed below the projections, and every measure computed in it again.
    judged = judge(packed, list(names.values()), min_left).select(*names.values(), "clean_text", "kept")
    passed = Scratch(docs.sparkSession, "quality-rules").write(judged, "judged").filter("kept")
    new = {"text": F.col("clean_text")}
    if "n_chars" in names:
        new["n_chars"] = F.length("clean_text").cast(docs.schema["n_chars"].dataType)
    return passed.select(*[new.get(c, F.col(names.get(c, c))).alias(c) for c in docs.columns])

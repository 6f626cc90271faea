import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyloom.llm import queries, spelling
from tallyloom.llm.common import Scratch

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def brute(rows, damage=199, min_length=6, min_count=5, ratio=5):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % damage == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}
    patterns = {}
    for w in words:  # words one edit apart share a word with a place cut out, or one is the other's cut
        for k in range(len(w)):
            patterns.setdefault((w[:k], w[k + 1 :]), set()).add(w)
    near = {w: set() for w in words}
    for w in words:
        for k in range(len(w)):
            near[w] |= patterns[w[:k], w[k + 1 :]] - {w}
            if (cut := w[:k] + w[k + 1 :]) in words:
                near[w].add(cut)
                near[cut].add(w)
    form = {}
    for w, n in words.items():
        if near[w]:
            best = min(near[w], key=lambda o: (-words[o], o))
            if words[best] >= ratio * n:
                form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return sorted(out)


def found(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def pairs_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_query_against_brute_force(spark, documents):
    expected = brute(pairs_of(documents))
    assert found(queries.op13_spelling_variants(spark, "/root/testdata/sf0.001")) == expected
    assert any(r[1] for r in expected)


@pytest.fixture(scope="module")
def variants(spark):
    """Chains of forms, ties, words at the bounds, letters beyond ASCII, very long words and ids that are null."""
    counts = {"colour": 200, "color": 900, "colours": 30, "colourss": 6, "kolour": 35, "kolours": 7, "ünïcode": 50, "ÿnïcode": 9,
              "ünïcodé": 10, "abcdef": 5, "abcdeg": 5, "abcdeh": 4, "aaaaaab": 60, "aaaaab": 10, "x" * 5000: 30, "x" * 4999: 5, "x" * 64: 8, "x" * 63: 50,
              "x" * 65: 8, "ÀÉÎ": 7, "ÀÉÎÕÜÝ": 70, "ÀÉÎÕÜý": 7, "aé×÷éz": 5}
    rows = [(None if i % 5 == 0 else i, " ".join(w.upper() if w.isascii() and i % 2 else w for w, n in counts.items() if i < n)) for i in range(900)]
    return spark.createDataFrame([*rows, (None, None), (7, ""), (8, "1, 2. _")], "doc_id long, text string")


@pytest.mark.parametrize("max_bytes", [spelling.MAX_FILTER_BYTES, 16])
def test_variants_in_one_round_and_in_many(spark, variants, max_bytes):
    done = spelling.spelling_variants(variants, Scratch(spark, "t"), damage=199, max_bytes=max_bytes)
    expected = brute(pairs_of(variants))
    assert found(done) == expected
    roots = {r[0]: r[2] for r in expected}
    assert roots["kolours"] == "colour" and roots["colourss"] != "colourss"


def test_odd_rows_and_no_rows(spark, odd, nothing):
    assert found(spelling.spelling_variants(odd, Scratch(spark, "t"), damage=199)) == brute(pairs_of(odd))
    assert found(spelling.spelling_variants(nothing, Scratch(spark, "t"))) == []


def test_edits_are_hashed_as_the_words_they_make():
    words = ["colour", "bananaé"]
    for w in words:
        codes = spelling.letters([w])
        cut = [spelling.hashes(spelling.letters([w[:k] + w[k + 1 :]]))[0] for k in range(len(w))]
        assert spelling.deletions(codes)[0].tolist() == cut
        changed = [[spelling.hashes(spelling.letters([w[:k] + chr(int(c)) + w[k + 1 :]]))[0] for c in spelling.ALPHABET] for k in range(2, 5)]
        assert np.array_equal(spelling.replacements(codes, 2, 5)[0], np.array(changed, np.uint64))


def test_plan_keeps_rounds_within_their_bytes():
    plan = spelling.Plan({6: 10_000, 7: 1_000_000, 8: 3}, 1 << 16)
    assert {s for r in plan.rounds for s, _ in r} == {6, 7, 8}
    assert all(sum(plan.shape[s][1] * 8 for s, _ in r) <= 1 << 16 for r in plan.rounds)

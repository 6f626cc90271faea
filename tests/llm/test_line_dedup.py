import hashlib
import re

import pytest

from tallyloom.llm import line_dedup
from tallyloom.llm.common import Scratch


def key(line):
    line = re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line)
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line)


def brute(rows, least=40, min_docs=5):
    count, last = {}, {}
    for r in rows:
        for k in {key(x) for x in (r["text"] or "").split("\n")}:
            count[k] = count.get(k, 0) + 1
            last[k] = max(last.get(k, -(1 << 62)), -(1 << 62) if r["doc_id"] is None else r["doc_id"])
    out = []
    for r in rows:
        lines = (r["text"] or "").split("\n")
        left = [x for x in lines if len(key(x)) < least or count[key(x)] < min_docs or last[key(x)] == r["doc_id"]]
        out.append({"doc_id": r["doc_id"], "n_lines": len(lines), "n_dropped": len(lines) - len(left), "kept_text": "\n".join(left)})
    return sorted(out, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, repr(r)))


def made(spark):
    common = "This line stands in a good many of the documents."
    rows = [(i, f"  {common.upper() if i % 2 else common}\t\nown line number {i}\n{'é' * 40}\n{'e' * 39}" + f"\n{common}" * (i == 3)) for i in range(9)]
    return spark.createDataFrame(rows + [(8, common), (None, common)], "doc_id long, text string")


def test_against_brute_force(spark, listed, documents, odd, nothing):
    for docs in (documents, odd, nothing, made(spark)):
        got = listed(line_dedup.dedup_lines(docs, Scratch(spark, "t")))
        assert got == brute(listed(docs.select("doc_id", "text")))


def test_beyond_the_broadcast(spark, listed, documents, monkeypatch):
    monkeypatch.setattr(line_dedup, "MAX_BROADCAST_KEYS", 0)
    assert listed(line_dedup.dedup_lines(documents, Scratch(spark, "t"))) == brute(listed(documents.select("doc_id", "text")))


def test_runs_know_what_is_new_and_compact(spark):
    runs = line_dedup.LineRuns(spark, 4)
    for b in range(6):
        batch = [(i, i * 7, 1, b) for i in range(b * 5, b * 5 + 10)]
        name = runs.add(spark.createDataFrame(batch, "h1 long, h2 long, docs long, last_doc long"))
        if b != 3:  # the fourth run is compacted at once
            assert spark.table(name).filter("fresh").count() == (10 if b == 0 else 5)
    assert [len(x) for x in runs.levels] == [2, 1]
    got = {r.h1: (r.docs, r.last_doc) for r in runs.totals().collect()}
    assert got == {i: (1 + (5 <= i < 30), min(i // 5, 5)) for i in range(35)}
    names = [n for level in runs.levels for n in level]
    runs.drop()
    assert not any(spark.catalog.tableExists(n) for n in names)


def test_runs_are_joined_without_an_exchange_of_their_own(spark, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    runs = line_dedup.LineRuns(spark, 4)
    rows = spark.createDataFrame([(i, i, 1, 1) for i in range(50)], "h1 long, h2 long, docs long, last_doc long")
    runs.add(rows)
    run = runs.runs()[0]
    plan = rows.repartition(4, "h1", "h2").join(run.hint("merge"), ["h1", "h2"], "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    runs.drop()


def test_clean(spark, odd):
    done = line_dedup.clean(odd)
    assert done.columns == odd.columns and done.count() == odd.count()
    assert done.filter("text is null").count() == odd.filter("text is null").count()
    row = line_dedup.clean(made(spark)).filter("doc_id = 3").first()
    assert hashlib.sha256(row.text.encode()).hexdigest() == hashlib.sha256(("own line number 3\n" + "e" * 39).encode()).hexdigest()


@pytest.mark.parametrize("line, want", [(b" A\x0b\x0c\r", b"a"), ("Éa ".encode(), "Éa ".encode())])
def test_key(line, want):
    assert line_dedup.line_key(line) == want

import re

from tallyloom.llm import quality_rules


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return {
        "n_words": n, "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
        "base_failed": n < 10 or 100 * len(covered) > 20 * n,
    }


def assert_base(listed, docs):
    for doc, got in zip(listed(docs.select("doc_id", "text")), listed(quality_rules.judge(docs, ["doc_id", "text"])), strict=True):
        want = brute(doc["text"])
        assert {k: got[k] for k in want} == want
        assert not (got["base_failed"] and got["kept"])


def test_measures(listed, documents, odd, nothing):
    assert_base(listed, documents)
    assert_base(listed, odd)
    assert quality_rules.judge(nothing, ["doc_id"]).count() == 0


def test_repeated_windows(spark, listed):
    words = "a b c d e f g h i j k l m n o p q r s t u v w x y z".split()
    texts = [" ".join(words + words[:5]), " ".join(["x"] * 12), " ".join(words[:6] * 2 + words), "a b c d e a b c d e"]
    assert_base(listed, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_agrees_with_labels(spark):
    sf = "/root/testdata/sf0.01"
    judged = quality_rules.judge(spark.read.parquet(f"{sf}/documents.parquet"), ["doc_id"])
    rows = judged.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").select("kept", "quality", "n_words").collect()
    good = [r.kept for r in rows if r.quality == 1 and r.n_words >= 10]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.05 * len(bad)


def test_lines(spark):
    good = ["A plain sentence that has quite a few words in it.", "Then another one follows, about something else!", "And here it ends."]
    bad = ["Home | News | Sports | About | Contact", "All rights reserved.", "win$$$ cash$$$ now$$$", "BUY!! THIS!! NOW!! TODAY!!", "* * *"]
    text = "\n".join([good[0], *bad, "", *good[1:]])
    df = spark.createDataFrame([(1, text, 5, "x"), (2, "\n".join([good[2], *bad, good[0]]), 1, "y")], "doc_id long, text string, n_chars int, kept string")
    done = quality_rules.clean(df, min_left=0.4)
    row = done.filter("doc_id = 1").first()
    assert row.text.split("\n") == [good[0], "", *good[1:]]
    assert row.n_chars == len(row.text) and row.kept == "x" and done.columns == df.columns
    assert quality_rules.clean(df, min_left=0.7).count() == 0


def test_no_python_and_no_exchange(documents):
    plan = quality_rules.judge(documents, ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)

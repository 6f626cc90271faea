import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns named like the operators' own."""
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
    same = "one two three four five six seven eight nine ten eleven twelve."
    texts = [None, "", " \n\t ", "a", "a b c d", same, same, same.upper(), same + " thirteen", long, long + " more", "é" * 50, "\n\n", "x\r\ny",
             "*** $$$ | a | b | c | d", "<|endoftext|> and <|startoftext|>x İstanbul ΣΑΣ ́e"]
    rows = [(i, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else f"src{i % 3}", 0) for i, t in enumerate(texts)]
    rows += [(6, same, "en", "src0", 0), (None, same, "en", "src1", 1), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    clash = {"kept": 1, "h1": 2, "band": 3, "node": 4, "text_": 5, "_text": 6, "key": 7, "label": 8, "length": 9, "tokens": 10, "_id": 11}
    from pyspark.sql import functions as F

    return df.withColumns({k: F.lit(v) for k, v in clash.items()})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, key="doc_id"):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: (r[key] is not None, r[key] or 0, repr(r)))


@pytest.fixture(scope="session")
def listed():
    return by_id

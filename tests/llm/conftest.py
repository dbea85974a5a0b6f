import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def ready(spark):
    from kestrel.llm.common import prepare

    return prepare(spark)


ODD_TEXTS = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two"), (6, "One  TWO"), (7, "one two"), (8, "ein zwei drei vier"),
    (9, "a@b.c; +1 (234) 567-8901; 4111 1111 1111 1111; 10.0.0.255"), (10, "x" * 50_000), (11, "Wort " * 20_000), (12, "é ß İ Σς     😀 中文"),
    (13, "<|endoftext|> <|startoftext|> &lt; \\n"), (14, "1" * 30_000), (15, "1.2.3." * 3_000), (16, "a b c d e f g\x0b\x0ch"), (17, "a b c d e f g h"),
]


@pytest.fixture(scope="session")
def odd(ready):
    """Nulls, empty, very long, repeated and clashing: every text twice under one id for some, columns with the operators' own names."""
    rows = [*ODD_TEXTS, ODD_TEXTS[7], ODD_TEXTS[7], (None, "no id"), (None, None)]
    df = ready.createDataFrame(rows, "doc_id long, text string")
    from pyspark.sql import functions as F

    extra = {c: F.lit(i) for i, c in enumerate(["rid", "norm", "doc", "fp", "score", "spans", "n", "kept", "words", "quality_text", "simhash_text", "a.b", "n_chars"])}
    return df.withColumns(extra).withColumn("lang", F.lit(None).cast("string"))


@pytest.fixture(scope="session")
def empty(ready):
    return ready.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def corpus():
    import duckdb

    return duckdb.sql("select doc_id, text from '/root/testdata/sf0.001/documents.parquet'").fetchall()

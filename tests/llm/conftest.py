import pytest


def said(a, b):
    """Numbered words a..b."""
    return " ".join(f"w{k}" for k in range(a, b))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and blank texts, ties, repeated rows, repeated ids, odd spaces, and columns with clashing names."""
    rows = [
        (1, None), (2, ""), (3, said(0, 30)), (4, said(0, 30)), (4, said(0, 30)), (4, said(0, 31)), (5, said(5, 35)), (None, said(0, 30)), (6, "a b"), (7, "A B"), (8, "a b c"),
        (9, said(0, 29).upper()), (10, said(100, 120)), (11, said(100, 121)), (12, said(100, 122)), (13, said(99, 123)), (14, " \n "), (15, "a " * 100), (16, "a " * 20 + said(0, 12)),
        (17, said(10, 40) + " " + said(0, 13)), (18, "wörd, " * 300 + "q" * 400 + "  \n" * 60 + "tail"), (19, "a  b\n\n c "), (20, "x" * 50 + " y\n\nz" * 7), (21, " lead and nb  　 trail \n"),
        (22, "hello \x1c! world<|endoftext|> it's don't 0 00 10.5, ΑΣ Σ. İstanbul Á x \U0001f600 é"), (23, "word " * 5000), (24, "\x00a \x00b"), (25, said(0, 30) + "\n" + said(0, 30)),
    ]
    return spark.createDataFrame([(i, t, "en", "x", 1, True, "n") for i, t in rows], "doc_id long, text string, lang string, source string, n_words int, kept boolean, ids string")


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.where("doc_id < 0")


@pytest.fixture(scope="session")
def tables(odd, corpus):
    """The two tables that operators are held against brute force on."""
    return [odd, corpus]


@pytest.fixture(scope="session")
def texts():
    return lambda df: [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]

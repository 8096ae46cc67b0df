import random

import pytest

#: Names the operators use for columns of their own; the inputs carry them as extra columns.
CLASHES = ("ids", "spans", "fingerprint", "lang_pred", "score", "component", "set_id", "n", "key", "part", "hashes", "words", "a", "b")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with NULLs, empty and long texts, repeated rows and clashing column names."""
    rnd = random.Random(5)
    words = ["the", "and", "of", "thing", "Ünder", "dé", "x9", "日本", "end."]
    long = " ".join(rnd.choice(words) for _ in range(30_000))
    base = " ".join(rnd.choice(words) + str(rnd.randint(0, 40)) for _ in range(60))
    near = base.replace(" ", "  ", 3) + " tail"
    rows = [(1, None, "en"), (2, "", "en"), (3, "word", None), (4, long, "en"), (5, base, "de"), (5, base, "de"), (6, near, "de"),
            (7, base.upper(), None), (None, base, "fr"), (8, " \t\n ", "fr"), (9, "123 456 !!", "en"), (10, long[::-1], "en"),
            (11, "y" * 50_000, "en"), (None, None, None), (12, "a b c", "en"), (13, "a b c", "en"), (14, "a b c d", "en")]
    extra = ", ".join(f"{c} string" for c in CLASHES)
    return spark.createDataFrame([(*r, len(r[1] or ""), *CLASHES) for r in rows],
                                 f"doc_id long, text string, lang string, n_chars long, {extra}")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")

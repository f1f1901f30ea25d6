import pytest

# A long text, empty and null texts, repeated rows, a null id and letters of several scripts.
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today."),
    (2, "the QUICK brown fox jumps over the lazy dog near the river bank today."),
    (3, None), (4, ""), (5, ""), (6, "  \n\t "), (7, "É été ÉTÉ ñandú straße"), (8, "é été été ñandú straße"),
    (9, "word " * 30_000), (10, "x" * 70_000), (None, "the quick brown fox"), (None, None),
    (12, "Привет мир, это текст"), (13, "日本語の文章です"), (14, "1234 5678 !!! ???"), (14, "1234 5678 !!! ???"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows, with columns whose names the operators use themselves."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, _hit string, score string, shard int, slot string, keep_id string, _row int, label string"
    rows = [(i, t, None if i == 3 else "en", "s", len(t or ""), "h", "s", 1, "x", "k", 0, "l") for i, t in TEXTS]
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.where("doc_id < 0")


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"

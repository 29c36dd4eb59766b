import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp bigint, id bigint, score double"


def passage(start, n):
    return " ".join(f"w{i}x" for i in range(start, start + n))


#: NULLs in any column, empty and long texts, ties, repeated rows, columns that clash with inner names.
ROWS = [
    (1, passage(0, 60), "en", "a"), (2, passage(0, 60), "en", "b"), (3, passage(0, 30) + " tail " + passage(90, 25), "en", "c"),
    (4, passage(30, 30) + " " + passage(0, 30), None, "d"), (5, None, "fr", "e"), (6, "", "fr", None), (7, "  \t\n ", None, "f"),
    (8, "  two  spaces ▁mark\x00 é ß Ａ\n", "de", "g"), (9, "123 !!! 456", "de", "h"), (10, "A b", "de", "i"),
    (11, "ab ab " * 3000, "en", "j"), (12, "word", None, None), (13, passage(200, 5000), "en", "k"),
    *[(20 + i, f"shared line of all\nown {i}\n\n shared line of all\t", "en", f"s{i}") for i in range(12)],
    (40, "x" * 50_000, "fr", "a"),
]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame([(*r, 0, 1, 2, 0.5) for r in ROWS], SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd(spark):
    """NULL ids and repeated rows."""
    rows = [*ROWS[:5], *ROWS[:2], (None, passage(0, 60), "en", None), (None, None, None, None)]
    return spark.createDataFrame([(*r, 0, 1, 2, 0.5) for r in rows], SCHEMA)

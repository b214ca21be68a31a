import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, _row int, _doc int, id string, size string, run string, count int"

LINE = "This line is on very many pages of the site"
#: Nulls, empty and blank texts, ties, repeated rows, a very long text, near copies.
ROWS = [(k, t, lang, source, len(t or ""), "r", 1, 2, "x", "s", "q", 3) for k, t, lang, source in [
    (0, None, "en", "a"), (1, "", "en", "a"), (2, " \n\t ", None, None), (3, "Alpha beta gamma delta epsilon zeta eta theta", "en", "a"),
    (3, "Alpha beta gamma delta epsilon zeta eta theta", "en", "a"), (4, "ALPHA beta gamma delta epsilon zeta eta theta", "en", "b"),
    (5, f"{LINE} 12\none of a kind", "en", "b"), (6, f"{LINE} 13\nanother thing\n", "en", "b"), (7, f"\n{LINE} 14", "en", None),
    (8, f"{LINE} 15\n{LINE} 16", "fr", "c"), (None, f"{LINE} 17\nno identifier", "fr", "c"), (9, "12 34 ... !!", "fr", "c"),
    (10, " ".join(f"w{(k * k) % 1009}" for k in range(30_000)), "fr", "d"), (11, "x" * 50_000, "de", "d"), (12, "Straße ÉÀ ñ 中文 𝒳", "de", "d"),
    (13, " ".join(f"w{(k * k) % 1009}" for k in range(2_000)) + " end", None, "d")]]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")

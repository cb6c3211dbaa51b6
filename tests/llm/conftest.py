import pytest


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, a column with a clashing name."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    long = " ".join(words[i * i % 10] + str(i % 97) for i in range(30_000))
    rows = [
        (1, "One line\nshared line \nlast", "en", "a", 20, 5, "x"),
        (2, None, "en", "a", None, 5, "x"),
        (3, "", None, None, 0, None, "x"),
        (None, "no id here, but a text\n\n", "de", "b", 3, 7, None),
        (None, "no id here, but a text\n\n", "de", "b", 3, 7, None),
        (4, "  \n\t\n ", "fr", "b", 5, 1, "y"),
        (5, long, "en", "a", len(long), 2, "y"),
        (6, long + " tail", "en", "a", len(long), 2, "y"),
        (7, "Ünïcode 😀   é İ ﬁ ’quoted’ it's \x1c <|endoftext|> naïve", "en", "c", 10, 3, "z"),
        (7, "Ünïcode 😀   é İ ﬁ ’quoted’ it's \x1c <|endoftext|> naïve", "en", "c", 10, 3, "z"),
        (-8, "token = abcdefgh1234 SHARED LINE", "en", "c", 10, 3, "z"),
    ]
    rows += [(100 + i, f"own text {i}\n shared Line\nOther {i % 3}", "en", "a", 30, 4, "k") for i in range(14)]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, rank int, content string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")

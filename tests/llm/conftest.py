import pytest

LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
COPY = " ".join(f"copy{i}" for i in range(90))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows and ids, clashing columns."""
    rows = [(1, COPY), (2, COPY), (2, COPY), (3, COPY + " tail"), (4, None), (5, ""), (6, " \n\t"), (7, LONG), (8, "one two"), (9, "one two"),
            (None, "no id " + COPY), (10, "mail a.b@mail1.example.com under the MIT License, cc by-nc"), (11, "é" * 500 + "x"), (12, "é" * 500 + "y")]
    wide = [(i, t, "en", "s", len(t or ""), True, "a", 1, "k", [1]) for i, t in rows]
    return spark.createDataFrame(wide, "doc_id long, text string, lang string, source string, n_chars long, kept boolean, m string, n int, h string, v array<int>")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (7, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")

import pytest


@pytest.fixture(scope="session")
def small(spark):
    """Documents with every awkward case: nulls, empty and long texts, ties, repeated rows, clashing column names."""
    words = " ".join(f"w{i % 97}x{i % 13}" for i in range(3000))
    rows = [(1, "The quick brown fox jumps over the lazy dog near the river bank today.\nSecond line of text here", "s1"),
            (1, "The quick brown fox jumps over the lazy dog near the river bank today.\nSecond line of text here", "s1"),
            (2, "  the QUICK brown fox jumps over the lazy dog near the river bank today.\t\nother words follow", "s2"),
            (3, None, "s1"), (4, "", None), (None, "no id but words", "s1"), (None, None, None), (5, words, "s1"), (6, words + " tail", "s2"),
            (7, "mail a.b@c.example or +1 (705) 555-6638 or 4111 1111 1111 1111, 10.0.0.1 password=hunter22", "s3"), (7, "same id, another text", "s3"),
            (8, "\n\n\n", "s1"), (9, "é🙂 ñandú\x00 \x85 　 tab\tend", "s2")]
    schema = "doc_id long, text string, source string, n_words int, spans string, owner string, gone string, `row` string"
    return spark.createDataFrame([(*r, 1, "x", "o", "g", "i") for r in rows], schema).repartition(3)


@pytest.fixture(scope="session")
def empty(small):
    return small.where("1 = 0")

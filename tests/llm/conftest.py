import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

PROSE = ("The house of the old man was in a valley and it was known to many that he had lived there for years, with a "
         "garden that is famous for the roses in it. ")


def prose(n_words: int, salt: int = 0) -> str:
    """Distinct sentences of lower-case words between common ones."""
    words, common = [], ("the", "of", "and", "to", "a", "in", "that", "is")
    for i in range(n_words):
        words.append(common[i % 8] if i % 3 else f"w{chr(97 + (i * 7 + salt) % 26)}{chr(97 + i // 26 % 26)}{chr(97 + salt % 26)}")
    return " ".join(words)


@pytest.fixture
def documents(spark):
    def make(rows):
        return spark.createDataFrame(
            [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCUMENTS)
    return make


@pytest.fixture
def odd(spark):
    """Rows that try an operator: nulls in any column, empty and blank texts, ties, repeated rows, a very long text."""
    long_text = "\n".join(prose(200, i) for i in range(150)) + "\n" + "x" * 200_000
    rows = [
        (1, "Same text here.", "en", "a", 15), (2, "Same text here.", None, None, None), (2, "Same text here.", None, None, None),
        (3, None, "en", "a", None), (4, "", "de", "b", 0), (5, " \t\n ", "fr", "b", 4), (None, "No name, no number.", "es", None, 1),
        (None, None, None, None, None), (6, long_text, "en", "c", len(long_text)), (7, "é é 中文 \U0001f642 <|endoftext|>", "xx", "d", 9),
        (2, "another text under the same number", "en", "a", 1),
    ]
    return spark.createDataFrame(rows, DOCUMENTS)


@pytest.fixture
def clashing(odd):
    """The odd rows with further columns, named as operators might name their own."""
    from pyspark.sql import functions as F

    names = ("row", "t", "w", "quality", "fingerprint", "removed", "cuts", "digest", "item", "keeper", "content", "ids", "word", "Row_")
    return odd.withColumns({name: F.lit(name) for name in names})

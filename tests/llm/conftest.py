import pytest

SCHEMA = "doc_id long, text string, lang string, score double, _id string, _text string, n_words string, kept_text string"


@pytest.fixture()
def docs(spark):
    """Documents with columns whose names clash with those operators make."""
    from loadsplit.llm.common import ship
    ship(spark)

    def make(rows):
        return spark.createDataFrame([(i, t, "en", 1.0, "x", "y", "z", "k") for i, t in rows], SCHEMA)

    return make


def odd_texts(long_words: int = 20_000) -> list[tuple]:
    """Nulls, empty, blank and very long texts, repeated rows, ties on the id, wide characters."""
    long_text = " ".join(f"w{k % 977}x{k % 13}" for k in range(long_words))
    return [(1, None), (2, ""), (3, " \t\n "), (4, long_text), (5, "a b c"), (5, "a b c"), (5, "other text"), (None, "no id here"),
            (None, None), (7, "ÄÖ ß 日本語 \U0001f600 word."), (8, "The THE the, \x00 it's <|endoftext|> ▁x"), (9, long_text)]

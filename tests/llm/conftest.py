import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, fp string, score string, _copies string"
EN = "the quick brown fox jumps over the lazy dog and then it runs far away from here because the dog woke up "
DE = "der schnelle braune fuchs springt ueber den faulen hund und dann laeuft er weit weg weil der hund wach ist "


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), "x", "y", "z", "w")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, a repeated id."""
    rows = [row(i, EN + f"number {i} of {i * 7} things", "en", "a") for i in range(40)]
    rows += [row(100 + i, DE + f"nummer {i} von {i * 5} dingen", "de", "b") for i in range(40)]
    rows += [row(200, None), row(201, ""), row(202, " \t\n\x0b\x0c\r "), row(203, "12 34 56", None, None), row(None, EN, "en", None),
             row(None, None, None, None), row(204, EN * 30_000, "en", "c"), row(205, EN, "en", "a"), row(205, EN, "en", "a"),
             row(206, EN, "en", None), row(206, DE, None, "a"), row(207, "é" * 5000 + "\U0001f600 <|im_start|>", "fr", "b"), row(208, "x" * 3_000_000, "en", "d")]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)

"""Small tables of documents with every odd case."""

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, chunk int, Bucket string, score double"

EN = "The quick brown fox jumps over the lazy dog and then the dog sleeps in the warm sun of the long afternoon. "
DE = "Der schnelle braune Fuchs springt über den faulen Hund, und der Hund schläft in der warmen Sonne am Nachmittag. "
FR = "Le renard brun rapide saute par-dessus le chien paresseux, et le chien dort au soleil tout l'après-midi ici. "


def texts() -> list[str | None]:
    long = " ".join(f"w{i * 7919 % 1000}x" for i in range(4000))
    return [
        *[EN * 2 + f"Number {i} of many lines that differ at their end." for i in range(6)],
        *[DE * 2 + f"Zeile {i} von vielen Zeilen." for i in range(5)],
        *[FR * 2 + f"Ligne {i} de beaucoup de lignes." for i in range(5)],
        EN * 3,
        EN * 3,  # an exact copy
        EN.upper() * 3,
        None,
        "",
        " \n\t ",
        "word",
        "x" * 3000,
        "12 345 #*$ %&|<>  \n\n 67",
        "a  b   c\n\n d \u0085 'tis  don't",
        "日本語 テキスト 😀 is mixed",
        long,
        long + " one more word",
        "one line\n" * 40,
    ]


@pytest.fixture(scope="session")
def rows():
    found = [(i * 3, t, ("en", "de", "fr")[i % 3] if i > 15 else ("en" if i < 6 else "de" if i < 11 else "fr"), f"s{min(i % 5, 2)}") for i, t in enumerate(texts())]
    found[20] = (*found[20][:2], None, None)
    return [(*r, None, 1, "b", 0.5) for r in found]


@pytest.fixture(scope="session", autouse=True)
def several_partitions(spark):
    """Groups that must meet do so by their keys, not because all rows lie in one partition."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)

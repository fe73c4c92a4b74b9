import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"wort{i % 977}" for i in range(60_000))
PROSE = " ".join(f"w{i * 7 % 101}x{i}" for i in range(120))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty, blank and very long texts, repeated rows, ties of id and of text."""
    near = PROSE.replace("w7x1 ", "other ", 1)
    return [
        (1, "Hello world, this is one text.\nAnd a second line of it.", "en", "a", 10),
        (1, "Hello world, this is one text.\nAnd a second line of it.", "en", "a", 10),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (4, " \t\n ", "de", "b", 4),
        (5, LONG, "de", "b", len(LONG)),
        (6, PROSE, "fr", None, len(PROSE)),
        (7, PROSE, "fr", "a", len(PROSE)),
        (8, near, "fr", "c", len(near)),
        (None, "A row without id. Ünïcode ß \U0001f600 here", "en", "c", 3),
        (9, "x", "en", "c", 1),
        (9, "another text of the same id", "en", "c", 1),
        (10, "!!! ??? 123", None, "a", 11),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows, tmp_path_factory):
    return written(spark, odd_rows, tmp_path_factory.mktemp("odd"))


@pytest.fixture(scope="session")
def none(spark, tmp_path_factory):
    return written(spark, [], tmp_path_factory.mktemp("none"))


@pytest.fixture(scope="session")
def clashing(odd):
    """The same with more columns, named like what operators add or use inside."""
    from pyspark.sql import functions as F

    names = ["size", "target", "taken", "shard", "slot", "fp", "_id", "id", "h", "key", "score", "ids", "labels", "n_words", "lang_pred", "predicted", "held_out", "fingerprint", "component_id", "node", "_text", "a.b"]
    return odd.select("*", *[F.lit("clash").alias(n) for n in names])


def written(spark, rows, folder):
    path = f"{folder}/documents.parquet"
    spark.createDataFrame(rows, SCHEMA).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def values(df, *columns):
    """Rows of some columns, sorted."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)

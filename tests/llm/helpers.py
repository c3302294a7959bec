"""Tables that the tests of the text operators share."""

from pyspark.sql import DataFrame

SF = "/root/testdata/sf0.001"
LONG = "lorem ipsum dolor sit amet, " * 40_000  # over a MB
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark) -> DataFrame:
    return spark.read.parquet(f"{SF}/documents.parquet")


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows."""
    return [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \t\n\x0b\x0c\r ", None, "a", 6), (4, "one two three four", "en", None, 18),
        (5, "one two three four", "en", "a", None), (5, "one two three four", "en", "a", None), (None, "null id", "en", "a", 7),
        (None, None, None, None, None), (7, LONG, "en", "a", len(LONG)), (8, "été \U0001F642 日本語 ñ ß", "fr", "b", 14),
        (9, "!!! ### $$$ 123", "en", "b", 15), (10, "x" * 5000, "de", "b", 5000),
    ]


def odd(spark) -> DataFrame:
    return spark.createDataFrame(odd_rows(), COLUMNS)


def empty(spark) -> DataFrame:
    return spark.createDataFrame([], COLUMNS)

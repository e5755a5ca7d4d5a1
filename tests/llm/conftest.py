import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """The smallest table, and rows that operators must stand: nulls, empties, repeated rows, blanks, a long text."""
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = [
        (9001, None, "en", "src1", 0), (9002, "", None, None, 0), (9003, " \t\n ", "en", "src1", 3), (None, "a text without an id, twice", "en", "src1", None), (None, "a text without an id, twice", "en", "src1", None),
        (9005, "the of and " * 20_000, "en", "src2", 220_000), (9006, "12345 67890 !!! ???", "en", "src2", 19), (9007, "same same", "en", "src2", 9), (9007, "same same", "en", "src2", 9), (9008, "Ünïcödé 😀 text", "de", None, 15),
    ]
    return table.union(spark.createDataFrame(odd, table.schema)).cache()

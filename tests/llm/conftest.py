import pytest

#: Columns beside those an operator reads, with names that operators use inside.
EXTRA = "row string, id long, text_hash long, size long, kept boolean"
EXTRA_VALUES = ("r", 1, 2, 3, True)


@pytest.fixture(scope="session")
def table(spark):
    def read(name, sf="sf0.01"):
        return spark.read.parquet(f"/root/testdata/{sf}/{name}.parquet")

    return read


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text[, source, lang]) with extra columns whose names clash."""

    def make(*rows):
        full = [(*r, *("s", "en")[len(r) - 2 :], *EXTRA_VALUES) for r in rows]
        return spark.createDataFrame(
            full, f"doc_id long, text string, source string, lang string, {EXTRA}"
        )

    return make

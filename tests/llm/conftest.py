import pytest

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session", autouse=True)
def workers_find_the_package(spark):
    from strata.llm.workers import importable

    importable(spark)


#: Columns beside the ones an operator reads, with names it uses inside.
CLASH = ("id", "n", "key", "score", "label", "line", "row", "a", "b", "shard")


@pytest.fixture(scope="session")
def documents(spark):
    """A frame of (doc_id, text) rows with clashing further columns."""
    def make(rows):
        kind = "doc_id long, text string, " + ", ".join(f"{c} string" for c in CLASH)
        return spark.createDataFrame([(i, t, *(["x"] * len(CLASH))) for i, t in rows], kind)
    return make

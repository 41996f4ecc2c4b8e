import pytest

from revlens.llm.ship import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    return ship(spark)


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (id, text) pairs, with columns whose names operators use inside."""

    def build(rows):
        data = [(i, t, "x", 7, "clash") for i, t in rows]
        return spark.createDataFrame(data, "doc_id bigint, text string, cid string, n int, own string")

    return build

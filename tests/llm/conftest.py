import pytest

from aljibe.llm.workers import find_package


@pytest.fixture(autouse=True)
def package_on_workers(spark):
    find_package(spark)


@pytest.fixture
def with_clashes():
    """A frame with more columns, named like those the operators make."""
    def add(df):
        from pyspark.sql import functions as F

        for name in ("score", "kept", "keep_id", "digest", "fp", "host", "_text", "_spans", "component_id", "rank", "rule", "value", "_score"):
            df = df.withColumn(name, F.lit("x"))
        return df

    return add

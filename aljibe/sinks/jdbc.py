from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def append_rows(df: DataFrame, url: str, table: str, options: Mapping[str, str] | None = None, connections: int = 8) -> None:
    """Append to a relational table over at most ``connections`` connections."""
    (
        df.write.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("numPartitions", str(connections))
        .options(**(options or {}))
        .mode("append")
        .save()
    )

"""The background statement ids and their names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed values, must equal the texts stored by existing installations.
SEED_QUERIES = [
    (0, "0 zero"),
    (1, "1 LogAppender"),
    (2, "2 Flush"),
    (3, "3 compaction"),
    (4, "4 RaftUpdateConsensus"),
    (5, "5 CatalogRequests"),
    (6, "6 LogBackgroundSync"),
    (7, "7 cron ?"),
]


def seed_queries(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"({number}L, '{name}')" for number, name in SEED_QUERIES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(queryid, query)")

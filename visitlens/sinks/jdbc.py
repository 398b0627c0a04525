"""Result tables in a database, through Spark's own jdbc writer."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Fixed value: rows per insert batch.
BATCH_SIZE = 1000


def jdbc_options(url: str, table: str, connections: int = 10, **more: str) -> dict[str, str]:
    """``connections`` bounds how many partitions write at once."""
    return {
        "url": url,
        "dbtable": table,
        "batchsize": str(BATCH_SIZE),
        "numPartitions": str(connections),
        **more,
    }


def write_jdbc(df: DataFrame, url: str, table: str, **more: str) -> None:
    """Append, in batches per partition. A rerun of a task appends its rows again unless they were
    deleted before; a key on the table makes the repeat fail instead of going unnoticed."""
    df.write.format("jdbc").options(**jdbc_options(url, table, **more)).mode("append").save()

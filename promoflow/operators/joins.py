"""Batch-sized tables kept in the shared folder.

No join is hinted: the size of a kept table is known in bytes when the join is planned, so
Spark broadcasts it below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles both sides
beyond it, where adaptive execution splits skewed keys.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from promoflow.session import checkpoint_dir


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to a new table in the shared folder and read back.

    What several sub-plans of a batch read is kept this way instead of in a cache: the plans
    after it start at a scan, so they stay short, read only the columns they need, know the
    size of the table, and a lost executor costs a reread.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/work-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)

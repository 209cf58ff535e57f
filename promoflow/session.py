"""Session settings the engine relies on, and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every plan in this package assumes.  Wall-clock times carry their own zone
# column, so the session zone must be UTC or ``to_utc_timestamp`` shifts twice.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    # Of a repeated key the last value counts, as a plain JSON reader has it.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # A row with a long store list is thousands of times as wide as one with a short list, so
    # the rows a Parquet writer may take in before it looks at its size again are few (Parquet's
    # own bound is 10,000, taken from the first rows' width).
    "parquet.page.size.row.check.min": "20",
    "parquet.page.size.row.check.max": "20",
    "parquet.block.size.row.check.min": "20",
    "parquet.block.size.row.check.max": "20",
}

# Of the offer engine's own queries; the training-data operators write texts, not lists.
LIST_CONF = {
    # The long store lists are few and come in many rows: room for them in a dictionary, by
    # which a row holds a number instead of its list.  What differs by row, as the stores of a
    # list written out, is packed by zstd in pages that hold several lists.
    "parquet.dictionary.page.size": str(16 << 20),
    "parquet.page.size": str(8 << 20),
    "parquet.page.row.count.limit": "1048576",
    "spark.sql.parquet.compression.codec": "zstd",
    # A reader takes in a batch of rows at a time: of rows with long store lists, 4,096 (Spark's
    # own size) are more than an executor's memory.
    "spark.sql.parquet.columnarReaderBatchSize": "256",
    # A query's shuffle files go when it ends, not when the driver happens to collect garbage:
    # what is read again is a table (``joins.kept``).
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def build_session(master: str = "local[*]", app: str = "promoflow",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Session for tests and local runs (cluster jobs pass their own session)."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("PROMOFLOW_DRIVER_MEMORY", "16g"))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in {**ENGINE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_engine_conf(spark)
    return spark


def apply_engine_conf(spark: SparkSession, lists: bool = True) -> None:
    """Set what the engine relies on, and with ``lists`` what tables with long lists need."""
    for k, v in ENGINE_CONF.items():
        spark.conf.set(k, v)
    for k, v in LIST_CONF.items():
        if lists:
            spark.conf.set(k, v)
        elif spark.conf.get(k, None) == v:
            spark.conf.unset(k)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    The deployment sets it to a folder that all executors share.  Where it is unset, a local
    session (one machine, as in tests) gets a scratch folder; a cluster session is refused, as
    no executor would see what another wrote.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="promoflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)

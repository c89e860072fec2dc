"""Session construction and shared scratch space."""

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    # Message times carry no zone; one fixed zone keeps every job consistent.
    "spark.sql.session.timeZone": "UTC",
    # The JVM never compiles methods above this size; splitting them is faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def get_session(app_name: str, hive: bool = False, **conf: str) -> SparkSession:
    """A session with the library's defaults; master and sizes stay with the submitter."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return (builder.enableHiveSupport() if hive else builder).getOrCreate()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder path under the shared folder the cluster names.

    The root is `spark.checkpoint.dir`, whatever the master. Only plain local mode, where
    one machine does all the work, may go without it and then uses a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tramline-")
    return f"{root.rstrip('/')}/tramline/{purpose}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write `df` once as Parquet in shared scratch space and read it back.

    Use before work that scans the same derived rows several times: it cuts the
    lineage, and the files outlive any executor.
    """
    spark = df.sparkSession
    path = work_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let_go(spark: SparkSession) -> None:
    """Has the driver collect its garbage: shuffle files of ended jobs stay on disk until it does."""
    gc.collect()
    for _ in range(2):  # the first may come before Python's objects have left the JVM
        spark.sparkContext._jvm.System.gc()

"""Session construction and the shared folder that derived tables are written to."""

from __future__ import annotations

import hashlib
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "tickloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults; ``master`` is left to spark-submit when not given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local session without the setting gets a fresh temporary folder. A cluster session
    without it is an error: a machine-local folder would be lost with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    application = spark.sparkContext.applicationId
    if application not in _local_roots:
        _local_roots[application] = tempfile.mkdtemp(prefix="tickloom-")
    return _local_roots[application]


def publish(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and return the written table.

    This cuts lineage like a checkpoint, survives lost executors, and keeps column pruning,
    filter pushdown and the size statistics that join planning relies on.
    """
    spark = df.sparkSession
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.parquet(path)


def publish_buckets(df: DataFrame, name: str, key: str) -> DataFrame:
    """``publish`` in buckets of ``key``, as many as shuffles have partitions: grouping the table by it shuffles nothing."""
    spark = df.sparkSession
    unique = f"{name}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").bucketBy(buckets, key).option("path", f"{shared_root(spark)}/{unique}").saveAsTable(unique)
    return spark.table(unique)


_published: dict[tuple[str, str, str], str] = {}


def fingerprint(spark: SparkSession, source: str) -> str:
    """The paths, lengths and times of the files under ``source``, as one hash."""
    path = spark._jvm.org.apache.hadoop.fs.Path(source)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).listFiles(path, True)
    seen = []
    while files.hasNext():
        f = files.next()
        seen.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return hashlib.md5("\n".join(sorted(seen)).encode()).hexdigest()


def is_folder(spark: SparkSession, source: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(source)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).getFileStatus(path).isDirectory()


def publish_once(spark: SparkSession, source: str, name: str, build) -> DataFrame:
    """``publish(build(), name)`` once per application, shared folder and content of the source folder."""
    key = (spark.sparkContext.applicationId + shared_root(spark), source + fingerprint(spark, source), name)
    path = _published.get(key)
    if path:
        try:
            return spark.read.parquet(path)
        except AnalysisException:
            del _published[key]
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    build().write.parquet(path)
    _published[key] = path
    return spark.read.parquet(path)


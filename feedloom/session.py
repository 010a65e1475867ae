"""Session settings and the shared folder that intermediate tables go to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Applied only where the session leaves them unset.
_REDACTED_LITERAL = "(0x|X')[0-9A-Fa-f]{64}'?"
_scratch: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Settings the operators rely on; safe to call any number of times.

    * The file packing is pinned: block numbering reads a feed twice and both
      reads must cut the files the same way, also when executors come and go.
    * Generated methods too large for the JIT compiler (8000 bytes of bytecode)
      are not used: wide rule sets run about twice as fast in smaller ones.
    * 32-byte literals (encryption keys) are redacted in every printed plan.
    """
    conf = spark.conf
    if conf.get("spark.sql.files.minPartitionNum", None) is None:
        conf.set("spark.sql.files.minPartitionNum", str(max(2, spark.sparkContext.defaultParallelism)))
    if conf.get("spark.sql.codegen.hugeMethodLimit", None) in (None, "65535"):
        conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    if conf.get("spark.sql.redaction.string.regex", None) in (None, ""):
        conf.set("spark.sql.redaction.string.regex", _REDACTED_LITERAL)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir`` of the cluster.

    Where it is unset on a single machine, as in tests, a temporary folder of
    this process is used; on a cluster that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _scratch:
        _scratch[app] = tempfile.mkdtemp(prefix="run-")
    return _scratch[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nobody has used yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return it read back.

    Cuts the lineage and fixes the rows, so a lost executor or a second reader
    sees the same values (fresh IVs, row ids) as the first one.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

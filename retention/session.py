"""Session construction and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "retention") -> SparkSession:
    """Local session for tests and the bench; on a cluster use the provided one.

    AQE stays on so partition counts are coalesced and skewed join partitions
    split at run time; the web UI is off (no server is opened).
    """
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or cpus
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def recommended_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Spill-aware sizing for a cluster run over ``input_bytes`` of price data.

    * scan splits of 256 MB (columnar, compressed) keep a task's decoded batch
      well inside executor memory;
    * the first shuffle (partial aggregates by (id, date)) gets about one
      partition per 256 MB of input, never fewer than 2 x cores; AQE then
      coalesces small post-shuffle partitions and splits skewed ones.
    """
    shuffle = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(int(shuffle)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts.

    Uses the cluster's ``spark.checkpoint.dir`` when set. Only in local mode a
    scratch folder is created and registered where it is unset: on a cluster
    other machines could not read it.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc_dir = spark.sparkContext.getCheckpointDir()
    if conf_dir:
        if f"{conf_dir.rstrip('/')}/" not in (sc_dir or ""):      # each call makes a folder of its own
            spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir
    if sc_dir:
        return sc_dir
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local_dir = tempfile.mkdtemp(prefix="retention-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local_dir)
    spark.sparkContext.setCheckpointDir(local_dir)
    return spark.sparkContext.getCheckpointDir() or local_dir


_SCOPES: list[tuple[list[str], list[str]]] = []


def stored_path(spark: SparkSession, name: str) -> str:
    """A new path in the checkpoint folder; it goes with the innermost ``stored_scope``."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    for paths, _ in _SCOPES[-1:]:
        paths.append(path)
    return path


@contextmanager
def stored_scope(spark: SparkSession):
    """What is stored inside (``materialize``, ``bucketed``, ``stored_path``) is dropped at its end.

    For jobs that write their results: nothing that is returned from inside
    may be read after it.
    """
    paths: list[str] = []
    tables: list[str] = []
    _SCOPES.append((paths, tables))
    try:
        yield
    finally:
        _SCOPES.remove((paths, tables))
        for t in tables:
            spark.sql(f"DROP TABLE IF EXISTS {t}")
        for p in paths:
            path = spark._jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back.

    Cuts lineage before iterative work (cross validation re-reads its input
    many times); a lost executor then recomputes from the written table, not
    from the raw price history.
    """
    spark = df.sparkSession
    path = stored_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def bucketed(df: DataFrame, name: str, key: str = "id") -> DataFrame:
    """Store ``df`` as a table bucketed and sorted by ``key``, which must be (nearly) unique.

    There are as many buckets as shuffle partitions, by the hash that an
    exchange uses, so a join or aggregate by ``key`` of such tables, or
    of one with the result of an aggregate by ``key``, shuffles none of them again. A
    table where one key holds many rows stays unbucketed: a bucket is one
    task, while partial sums before an exchange spread a hot key.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = stored_path(spark, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    for _, tables in _SCOPES[-1:]:
        tables.append(table)
    df.repartition(n, key).write.bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(table)
    return spark.table(table)

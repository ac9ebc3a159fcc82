"""Session helpers: local test sessions and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on; they are applied to sessions created here.
# ``check_session`` refuses sessions handed in without those results depend on.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "retailcast", driver_memory: str = "8g") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", driver_memory)
    )
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def check_session(spark: SparkSession) -> None:
    """Raise on a session outside UTC or without adaptive execution (never changed here)."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise RuntimeError(f"spark.sql.session.timeZone is {zone}; the date columns need UTC")
    if spark.conf.get("spark.sql.adaptive.enabled").lower() != "true":
        raise RuntimeError("spark.sql.adaptive.enabled is off; skewed joins need it")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is
    used as-is. Only when it is unset on a local master (tests) a scratch
    folder is created and registered; other masters are refused.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="retailcast-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def shared_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def materialize(df, name: str, **options):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: cuts lineage (a lost executor re-reads files instead of recomputing
    the join), and later scans get column pruning and filter pushdown.
    ``options`` are the writer's."""
    import uuid
    spark = df.sparkSession
    path = shared_path(spark, f"tables/{name}-{uuid.uuid4().hex[:12]}")
    df.write.options(**options).mode("overwrite").parquet(path)
    return spark.read.parquet(path)


_TABLES: dict = {}


def session_table(spark: SparkSession, key: tuple, build, sources: tuple = ()):
    """Materialize ``build()`` once per (application, key) and reuse it: the
    stored feature table that downstream jobs read, as a feature store would.

    The copy is tied to the file lists of ``sources`` (DataFrames): data that Spark
    wrote anew under the same path has other files and makes a new copy."""
    full = (spark.sparkContext.applicationId, *key)
    state = tuple(sorted(f for s in sources for f in s.inputFiles()))
    if full not in _TABLES or _TABLES[full][0] != state:
        _TABLES[full] = state, materialize(build(), "_".join(str(k).replace("/", "_") for k in key))
    return _TABLES[full][1]


def forget_tables(spark: SparkSession) -> None:
    """Drop this application's stored copies from the cache; their files go with the checkpoint folder."""
    for k in [k for k in _TABLES if k[0] == spark.sparkContext.applicationId]:
        del _TABLES[k]

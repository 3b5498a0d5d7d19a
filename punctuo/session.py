"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import contextlib
import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings the engine depends on for correct results (UTC date parts) and
# for scale (AQE re-plans joins and coalesces/splits partitions at runtime).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

# A task's share of a shuffle and of a scan (compressed bytes), whatever the size of the input. By Spark's defaults AQE joins
# shuffle partitions until each core has one, up to 64 MB, which sorts and hash maps hold several times over.
TASK_BYTES = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": 8 << 20, "spark.sql.files.maxPartitionBytes": 16 << 20}
#: Bytes of the input tables to a shuffle partition; AQE joins those that turn out small.
PARTITION_INPUT_BYTES = 4 << 20
#: Queries with these in their names deal out several times their input (FPTF documents: some 6 times) and get so many times the partitions.
WIDE = {"fptf": 4}
INPUT_TABLES = ("customer", "supplier", "part", "orders", "lineitem", "events")


def _bytes(text: str) -> int:
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)i?b?", text.strip().lower()).groups()
    return int(number) << (10 * " kmgtp".index(unit or " "))


def size_tasks(spark: SparkSession, sf_dir: str, query: str = "") -> None:
    """Bound what a task of the coming query gets: more shuffle partitions for a larger input, none larger than ``TASK_BYTES``.

    AQE doesn't split what one partition of an aggregation gets, so a ``query`` that deals out more than its input has more of them.

    A caller's own settings stay where they ask for more partitions or smaller ones.
    """
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    size = 0
    for name in INPUT_TABLES:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        fs = path.getFileSystem(conf)
        size += fs.getContentSummary(path).getLength() if fs.exists(path) else 0
    for name, most in TASK_BYTES.items():
        if _bytes(spark.conf.get(name)) > most:
            spark.conf.set(name, f"{most}b")
    n = -(-size * max([1, *(times for part, times in WIDE.items() if part in query)]) // PARTITION_INPUT_BYTES)
    if n > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))


#: Spark's own setting for the cleaning of shuffle files at the end of a query.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession):
    """Queries within remove their shuffle files when they end; else these stay until the driver happens to collect its garbage."""
    old = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE_SHUFFLES) if old is None else spark.conf.set(FREE_SHUFFLES, old)


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "punctuo", extra: dict | None = None) -> SparkSession:
    """Session for tests and local runs. On a cluster the caller's session is used."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "8g"  # local mode: the driver JVM is the executor
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The cluster names it in ``spark.checkpoint.dir``. Only where it is unset and the master is
    local (tests) a fresh scratch folder is made and registered; elsewhere that is an error.
    """
    cur = spark.conf.get("spark.checkpoint.dir", None)
    if not cur:
        cur = spark.sparkContext.getCheckpointDir()
    if cur:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(cur)
        return cur
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="punctuo-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(path)
    try:
        spark.conf.set("spark.checkpoint.dir", path)
    except Exception:  # static conf in some deployments; the context dir is enough
        pass
    return path


def shared_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder, for tables that cut lineage."""
    base = ensure_checkpoint_dir(spark)
    return base.rstrip("/") + "/" + name

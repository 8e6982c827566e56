"""Session construction and shared scratch locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

LOCAL_MASTER = "local[8]"
LOCAL_PARTITIONS = 8
# Spark's default limit on the buckets of a table.
MAX_BUCKETS = 100_000

# Settings that matter at any scale: AQE re-plans joins and coalesces
# shuffle partitions from runtime sizes, and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def session_conf(given: dict, master: str | None = None, shuffle_partitions: int | None = None,
                 input_bytes: int | None = None, extra: dict | None = None) -> dict:
    """Settings to add to the ``given`` ones (those of spark-submit).

    What the submitter set stays: master, partition counts and any default.
    Only without a master, as in a bare local test, is a local one taken.
    ``input_bytes`` sizes partitions for a run over so much data.
    """
    conf = dict(DEFAULT_CONF)
    if input_bytes is not None:
        conf.update(scale_conf(input_bytes))
    conf = {k: v for k, v in conf.items() if k not in given}
    if master is not None or "spark.master" not in given:
        conf["spark.master"] = master or LOCAL_MASTER
        if input_bytes is None and "spark.sql.shuffle.partitions" not in given:
            conf["spark.sql.shuffle.partitions"] = str(LOCAL_PARTITIONS)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    return conf


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "campuslens", extra: dict | None = None,
                input_bytes: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults this package assumes."""
    SparkContext._ensure_initialized()
    given = dict(SparkConf().getAll())
    builder = SparkSession.builder
    if "spark.app.name" not in given:
        builder = builder.appName(app_name)
    for key, value in session_conf(given, master, shuffle_partitions, input_bytes, extra).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect sessions have no SparkContext
        return None


def session_key(spark: SparkSession):
    """A key identifying the running application, for per-session caches."""
    sc = _context(spark)
    return sc.applicationId if sc is not None else id(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session; only when it is unset
    in a local session (as in bare tests) is a private folder created and
    registered. On a cluster an unset folder is an error: a private one
    would lie on one machine.
    """
    sc = _context(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc is not None and sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="campuslens-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared checkpoint location."""
    return f"{ensure_checkpoint_dir(spark)}/campuslens/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package wrote, in whatever store it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


_READS: dict = {}


def stage(df, name: str = "stage", path: str | None = None):
    """Materialise a frame as parquet in the shared checkpoint folder, read back.

    Written once (one job), it cuts the lineage: later plans read the files
    instead of re-deriving them, stay small for the optimizer, and survive
    the loss of the executors that built them. Unlike an RDD checkpoint, the
    parquet copy gives later reads column pruning, pushed filters and true
    size statistics for join planning. It also freezes values that depend
    on physical layout (``monotonically_increasing_id``), so every later use
    sees the same ones. A caller that is done with the copy can name its
    ``path`` and ``remove`` it; other copies stay in the shared folder until
    it is cleared.
    """
    path = path or scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str):
    """Read one of the driver's parquet tables.

    The input tables are read-only, so a session reuses one read handle per
    table instead of listing files and reading footers again per query.
    """
    key = (session_key(spark), sf_dir.rstrip("/"), name)
    if key not in _READS:
        _READS[key] = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return _READS[key]


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 << 20,
               max_partitions: int = MAX_BUCKETS) -> dict:
    """Settings for a cluster run over ``input_bytes`` of input data.

    The initial shuffle partition count assumes shuffles as large as the
    input (the worst case: a join of the big tables); AQE then coalesces
    partitions toward ``target_partition_bytes`` from the real map output
    sizes, so over-estimating costs little and under-estimating (spill,
    out-of-memory tasks) is avoided. Skew splitting uses the same unit.
    """
    partitions = int(min(max(input_bytes // target_partition_bytes, 200), max_partitions))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(2 * target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }

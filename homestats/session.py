"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, app: str = "homestats") -> SparkSession:
    """Local session used by tests and the benchmark (cluster jobs bring their own)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # per-Column call-site capture costs several JVM round trips per expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    The cluster names it in ``spark.checkpoint.dir``; we only invent one when
    it is unset *and* Spark runs in local mode (tests, laptop runs).
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no SparkContext, the conf must name the folder
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a folder shared by all executors")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises on some versions
            configured = None
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a folder shared by all executors"
            )
        configured = tempfile.mkdtemp(prefix="homestats-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for an intermediate table.

    Results may read such tables until they are written out; ``release_scratch``
    removes them all when the application is done with its results.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/homestats-{name}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


#: Spark removes the shuffle files of an execution at its end where this is on.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes within leave no shuffle files behind: a table that is whole is never made again from them.

    Else they stay until the driver happens to collect its garbage, and many steps' files lie on the disks at once."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the shared checkpoint folder and read back: what several passes read is derived once.

    Columns of no type (``void``) become text. One job runs here."""
    df = df.withColumns({c: F.col(f"`{c}`").cast("string") for c, kind in df.dtypes if kind == "void"})
    path = scratch_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path  # for ``release``
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` or ``materialize`` wrote and that no later job reads."""
    for t in tables:
        path = t._scratch
        try:
            sc = t.sparkSession.sparkContext
        except Exception:  # noqa: BLE001 - Spark Connect: files can't be reached from here, the tables stay
            return
        place = sc._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(sc._jsc.hadoopConfiguration()).delete(place, True)
        if path in _SCRATCH:
            _SCRATCH.remove(path)


def release_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables this application wrote (results that read them end, too)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while _SCRATCH:
        path = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        path.getFileSystem(conf).delete(path, True)

"""Session settings, scratch space and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings worth having on any session that runs these plans.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Few output folders per task: keep their files open instead of sorting rows with audio by folder.
    "spark.sql.maxConcurrentOutputFileWriters": "64",
    "spark.sql.session.timeZone": "UTC",
    # One task uses one core, also inside numpy.
    "spark.executorEnv.OMP_NUM_THREADS": "1",
    "spark.executorEnv.OPENBLAS_NUM_THREADS": "1",
    # Streaming de-duplication keeps its keys on disk instead of on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


# A waveform reaches 640,000 floats, so scans and Arrow batches with audio hold few rows at a time.
AUDIO_BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
    # Few output folders per task: no sort of rows with audio by folder.
    "spark.sql.maxConcurrentOutputFileWriters": "64",
    "spark.sql.parquet.columnarReaderBatchSize": "64",
}

# Texts reach a few hundred KB; a Python worker holds a batch several times over (Arrow, pandas, the one before).
TEXT_BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


def own_settings(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session with all settings of ``spark`` and these; other work in ``spark`` is not touched."""
    session = type(spark)(spark.sparkContext, spark._jsparkSession.cloneSession())
    for key, value in settings.items():
        session.conf.set(key, value)
    return session


def text_session(spark: SparkSession) -> SparkSession:
    """A session whose plans pass texts to Python in small batches; settings made by the user stay."""
    made = spark.sparkContext.getConf()
    return own_settings(spark, {k: v for k, v in TEXT_BATCHES.items() if not made.contains(k)})


@contextmanager
def audio_batches(spark: SparkSession) -> Iterator[None]:
    """Small batches while a plan with audio runs; settings made by the user stay."""
    missing = {k: v for k, v in AUDIO_BATCHES.items() if spark.conf.get(k, None) is None}
    for key, value in missing.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in missing:
            spark.conf.unset(key)


def local_session(cpus: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own session."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("voxloom")
    settings = {
        **RECOMMENDED,
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


_shipped: set[str] = set()
_fallback_dirs: dict[str, str] = {}


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application.

    Not needed where the package is installed on the executors or passed with
    ``--py-files``.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="voxloom-package-")) / "voxloom.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for module in sorted(package.rglob("*.py")):
            z.write(module, module.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster a
    machine-local folder would be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _fallback_dirs:
        _fallback_dirs[app] = tempfile.mkdtemp(prefix="voxloom-")
    return _fallback_dirs[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/voxloom-{label}-{uuid.uuid4().hex[:12]}"


def hadoop_path(spark: SparkSession, path: str):
    """``(filesystem, path)`` for metadata operations on whatever storage ``path`` names."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def materialized(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """``df`` written once to the shared folder and read back, for plans that read it several times.

    The folder goes when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.partitionBy(*partition_by).parquet(path)
    fs, p = hadoop_path(spark, path)
    fs.deleteOnExit(p)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, bytes_per_task: int = 1 << 20, small_bytes: int = 128 << 20) -> DataFrame:
    """Use all cores for heavy work on a small scan.

    A file with one row group is read by one task.  If the whole scan is smaller
    than one split per core, moving it is cheap and the rows are dealt out;
    anything larger already has a task per core and stays where it is read.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    tasks = min(cores, size // bytes_per_task)
    return df.repartition(tasks) if 1 < tasks and size < cores * small_bytes else df


def small_side(df: DataFrame, max_rows: int = 100_000, max_bytes: int = 128 << 20) -> DataFrame:
    """Mark ``df`` for broadcast if it is proven to hold at most ``max_rows`` rows and ``max_bytes``.

    The check is an action on ``df`` (meant for narrow, already aggregated
    frames such as per-file counts).  Larger frames come back unhinted, so the
    join shuffles instead.
    """
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows or rows.nbytes > max_bytes:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))

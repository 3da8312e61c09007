"""Session set-up: the settings every operator relies on, and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Runtime SQL settings. Epoch arithmetic on timestamps assumes UTC.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Sessions are merged in each task before they are shuffled by key.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # RocksDB keeps streaming state on disk, so it is not bound by executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it.

    The package is sent to the executors once per application, so functions that
    run in Python workers find it wherever the driver was started.
    """
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        spark.sparkContext.addPyFile(_package_archive())
        _SHIPPED.add(app)
    return spark


_SHIPPED: set[str] = set()


def _package_archive() -> str:
    """Zip of this package's modules, in a folder of the driver."""
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="millrace-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    target = f"{folder}/{package.name}.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for module in sorted(package.rglob("*.py")):
            archive.write(module, module.relative_to(package.parent))
    return target


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "millrace", memory: str = "8g") -> SparkSession:
    """A local-mode session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, for written tables and checkpoints.

    Read from ``spark.checkpoint.dir``. Only a local-mode session, where every
    executor is this machine, may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        folder = tempfile.mkdtemp(prefix="millrace-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _LOCAL_FOLDERS[app] = folder
    return _LOCAL_FOLDERS[app]


_LOCAL_FOLDERS: dict[str, str] = {}


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme, as Spark resolves it, so that executors do not take it for a local one."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, removed when the application ends."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _scratch_root(spark: SparkSession) -> str:
    """The application's folder below the shared one; its file system removes it at the end."""
    app = spark.sparkContext.applicationId
    if app not in _SCRATCH_ROOTS:
        root = f"{shared_folder(spark)}/millrace-{app}-{uuid.uuid4().hex[:8]}"
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _SCRATCH_ROOTS[app] = root
    return _SCRATCH_ROOTS[app]


_SCRATCH_ROOTS: dict[str, str] = {}

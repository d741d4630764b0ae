"""Session settings and lineage cutting."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(app: str = "riskloom", cores: str = "8") -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_local_folders: dict[str, str] = {}  # by application, where no folder is set
_in_use: set[str] = set()
_scope = threading.local()  # its ``folders``: those made within the innermost ``stored_alone``
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach, as named by ``spark.checkpoint.dir``. A session in one
    process may go without it and then gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="riskloom-stored-")
    return _local_folders[app]


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet to the folder all executors share and read back. It is
    evaluated once, lineage ends there, a lost executor costs nothing, and columns and rows
    that a later step does not need are not read. The folder goes when the process ends."""
    path = new_folder(df.sparkSession)
    with _shuffle_files_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_alone(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """``stored(make())``; what this thread stored on the way is deleted then, so ``make`` hands
    out nothing else that reads it."""
    outer, inner = getattr(_scope, "folders", None), []
    _scope.folders = inner
    try:
        df = make()
    finally:
        _scope.folders = outer
    result = stored(df)
    for folder in inner:
        remove_stored(spark, folder)
    return result


@contextlib.contextmanager
def _shuffle_files_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that run within delete their shuffle files at their end, not when the driver
    happens to collect its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def new_folder(spark: SparkSession) -> str:
    """A name for a new folder in the shared one, deleted with all it holds when the process ends."""
    folder = f"{shared_folder(spark).rstrip('/')}/riskloom-{spark.sparkContext.applicationId}"
    if folder not in _in_use:
        _in_use.add(folder)
        atexit.register(remove_stored, spark, folder)
    path = f"{folder}/{uuid.uuid4().hex}"
    if (inner := getattr(_scope, "folders", None)) is not None:
        inner.append(path)
    return path


def remove_stored(spark: SparkSession, folder: str) -> None:
    """Delete what ``stored`` wrote; nothing may read it any more."""
    with contextlib.suppress(Exception):  # the JVM may be gone by then
        jvm = spark.sparkContext._jvm or spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(path, True)


BROADCAST_ROWS = 500_000


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint for a narrow frame of at most ``limit`` rows, else the frame as
    it is. Counting stops at the limit; give it a materialised frame."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df

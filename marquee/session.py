"""Session settings and the shared scratch folder."""

from __future__ import annotations

import hashlib
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Runtime SQL settings every plan in this package relies on.  Skewed join
# partitions are split by AQE even when that costs one more exchange; a join
# skips its sorts when AQE has seen that every build partition is small.
RUNTIME_CONF = {
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "96MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "marquee", cores: str | int = "*", partitions: int = 8,
                  memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # call-site capture costs a Python stack walk and two JVM calls per column expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="marquee-wh-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Only a local-mode session without the setting gets a folder of its own; on
    a cluster a missing setting is an error, because a machine-local folder
    would be lost with its executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    root = root or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="marquee-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused, so never overwritten."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage with a durable table, so a lost executor re-reads files
    instead of recomputing, and every later reader sees identical rows.
    """
    path = scratch_path(df.sparkSession, label)
    with _shuffles_end(df.sparkSession):
        df.write.parquet(path)
    return staged_at(df.sparkSession, path, df.schema)


SHUFFLES_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_end(spark: SparkSession) -> Iterator[None]:
    """What is written inside the block deletes its shuffle files as soon as it is there, on all executors.

    ``free_shuffles`` can come too early for them: events of the finished job may still hold them.
    """
    before = spark.conf.get(SHUFFLES_END, "false")
    spark.conf.set(SHUFFLES_END, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES_END, before)


_PATH = "_marquee_path"


class _Open(threading.local):
    """The scopes open in this thread, the innermost last."""

    def __init__(self) -> None:
        self.scopes: list[list[tuple[SparkSession, str]]] = []


_open = _Open()


def staged_at(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The frame over a written scratch table; the innermost open scope owns the table."""
    if _open.scopes:
        _open.scopes[-1].append((spark, path))
    out = spark.read.schema(schema).parquet(path)
    setattr(out, _PATH, path)
    return out


def stage_bucketed(df: DataFrame, label: str, by: str, buckets: int) -> DataFrame:
    """``stage`` as a bucketed table: readers know that rows with equal ``by`` lie together, and need no shuffle for it."""
    path = scratch_path(df.sparkSession, label)
    if _open.scopes:
        _open.scopes[-1].append((df.sparkSession, path))
    df.write.format("parquet").option("path", path).bucketBy(buckets, by).saveAsTable(_table_of(path))
    out = df.sparkSession.table(_table_of(path))
    setattr(out, _PATH, path)
    return out


def _table_of(path: str) -> str:
    return path.rsplit("/", 1)[1].replace("-", "_")


def staged_bytes(staged: DataFrame) -> int:
    """Size of the files of a staged frame."""
    return sum(size for _, size, _ in files_below(staged.sparkSession, getattr(staged, _PATH)))


def delete_path(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    spark.sql(f"DROP TABLE IF EXISTS `{_table_of(path)}`")     # of a bucketed one
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def release(*staged: DataFrame) -> None:
    """Delete the files of staged frames that nothing will read again; open scopes and records forget them.

    The shuffle files of finished jobs go too.
    """
    for df in staged:
        path = getattr(df, _PATH)
        delete_path(df.sparkSession, path)
        for owned in _open.scopes:
            owned[:] = [entry for entry in owned if entry[1] != path]
    if staged:
        free_shuffles(staged[0].sparkSession)


def free_shuffles(spark: SparkSession) -> None:
    """Let the shuffle files of finished jobs go.

    They go when the driver collects garbage, which a large heap puts off; it is
    asked to do so here, so that the executors' disks do not fill up.
    """
    spark._jvm.System.gc()


def paths_read(df: DataFrame) -> set[str]:
    """The paths, files or folders, that the frame's relations were opened with; no file is listed."""
    leaves, out = df._jdf.queryExecution().analyzed().collectLeaves(), set()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName().startswith("LogicalRelation"):
            roots = leaf.relation().location().rootPaths() if hasattr(leaf.relation(), "location") else None
            out |= {roots.apply(j).toUri().getPath() for j in range(roots.size())} if roots is not None else set()
    return out


def is_scan(df: DataFrame) -> bool:
    """The rows come straight from files: nothing but columns and filters lies between."""
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.children().apply(0)
    return node.nodeName() == "LogicalRelation"


def _forget(owned: list[tuple[SparkSession, str]]) -> None:
    _open.scopes[:] = [s for s in _open.scopes if s is not owned]


@contextmanager
def recording(owned: list[tuple[SparkSession, str]]) -> Iterator[None]:
    """Tables that ``stage`` writes inside the block are added to ``owned``; the caller deletes them when it can tell that nobody reads them."""
    _open.scopes.append(owned)
    try:
        yield
    finally:
        _forget(owned)


def free_unread(owned: list[tuple[SparkSession, str]], *frames: DataFrame) -> None:
    """Delete the recorded tables that none of the frames reads, and forget them."""
    read = {path.rstrip("/").rsplit("/", 1)[-1] for df in frames for path in paths_read(df)}
    for entry in [e for e in owned if e[1].rsplit("/", 1)[-1] not in read]:
        owned.remove(entry)
        delete_path(*entry)


@contextmanager
def scratch_scope() -> Iterator[list[tuple[SparkSession, str]]]:
    """Owns the tables that ``stage`` writes inside the block and deletes them at its end.

    Results must be written, or collected, inside.  A table staged in a nested
    scope belongs to that one.  ``stage_once`` keeps its tables: later callers read them.
    """
    owned: list[tuple[SparkSession, str]] = []
    _open.scopes.append(owned)
    try:
        yield owned
    finally:
        _forget(owned)
        for spark, path in owned:
            delete_path(spark, path)


AT_ONCE = 4   # jobs that share the cores: the last tasks of one leave none idle


def at_once(spark: SparkSession, *steps: Callable[[], DataFrame | None]) -> list[DataFrame | None]:
    """Results of independent steps that each write a table, a few of them at a time.

    What they ``stage`` belongs to the innermost scope open here.  Their shuffle files go as soon as a
    write is done, so a step reads no frame twice that it has not stored.
    """
    stored: list[tuple[SparkSession, str]] = []

    def run(step: Callable[[], DataFrame | None]) -> DataFrame | None:
        owned: list[tuple[SparkSession, str]] = []
        try:
            with recording(owned):
                return step()
        finally:
            stored.extend(owned)

    try:
        # the setting is the session's: set around all steps, it is the same in each of them
        with _shuffles_end(spark), ThreadPoolExecutor(AT_ONCE) as pool:
            return list(pool.map(inheritable_thread_target(spark)(run), steps))
    finally:
        if _open.scopes:
            _open.scopes[-1].extend(stored)


def files_below(spark: SparkSession, pattern: str) -> list[tuple[str, int, int]]:
    """(path, size, time in milliseconds) of the files at and below the paths that match, empty files included."""
    path, told = spark._jvm.org.apache.hadoop.fs.Path(pattern), []
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for top in fs.globStatus(path) or []:
        files = fs.listFiles(top.getPath(), True)
        while files.hasNext():
            f = files.next()
            told.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return told


def fingerprint(spark: SparkSession, *paths: str) -> str:
    """A digest of the files at and below the paths, by path, size and time; contents are not read."""
    told = sorted(f for path in paths for f in files_below(spark, path))
    return hashlib.blake2b(repr(told).encode(), digest_size=16).hexdigest()


_once: dict[tuple, tuple[str, StructType]] = {}


def stage_once(spark: SparkSession, key: tuple, build: Callable[[], DataFrame]) -> DataFrame:
    """``stage`` with a name: the first call writes, later calls of the application read.

    A table that has since been cleaned up is written again.
    """
    full = (spark.sparkContext.applicationId, *key)
    if full in _once:
        path, schema = _once[full]
        mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        if mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark):
            return spark.read.schema(schema).parquet(path)
    df, path = build(), scratch_path(spark, key[-1])
    df.write.parquet(path)
    _once[full] = (path, df.schema)
    return spark.read.schema(df.schema).parquet(path)

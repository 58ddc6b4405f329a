"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the coverage arithmetic and the skew handling assume.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def cluster_conf(input_bytes: int, target_partition_bytes: int = 256 << 20,
                 executors: int = 1000, cores_per_executor: int = 4) -> dict[str, str]:
    """Shuffle and scan sizing for a large cluster.

    The large inputs (snapshot history, usage transactions) are reduced by
    partial aggregates before they shuffle, so shuffles carry far less than
    the input. Initial shuffle partitions: at least 3 per core, about one per
    GB of input, at most 50k (map-status tracking grows with mappers x
    reducers). AQE then merges partitions to ``target_partition_bytes`` and
    splits skewed ones; scans read ``target_partition_bytes`` splits.
    """
    slots = executors * cores_per_executor
    initial = min(max(slots * 3, input_bytes // (1 << 30)), 50_000)
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def build_session(master: str | None = None, app: str = "shortfall",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if master:
        b = b.master(master)
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder for pinned stages: the session checkpoint dir.

    On a cluster this must come from ``spark.checkpoint.dir`` (a shared
    folder). Only a local-mode session without one gets a scratch folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no SparkContext, read the setting
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
        if not conf_dir:
            raise RuntimeError("spark.checkpoint.dir is not set") from None
        return conf_dir
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(pinned intermediate stages are written there)")
    path = tempfile.mkdtemp(prefix="shortfall-ckpt-")
    sc.setCheckpointDir(path)
    return path


def pin_folder(spark: SparkSession) -> str:
    """A fresh folder for one run's pinned stages, under the checkpoint folder."""
    import uuid

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/pins/{uuid.uuid4().hex}"


def pin(df, name: str, folder: str | None = None):
    """Write ``df`` once as Parquet under the session's checkpoint folder and
    read it back: cuts the lineage (cheap recovery after executor loss), lets
    several branches share one computation and gives Catalyst real size
    statistics for its join choices."""
    spark = df.sparkSession
    path = f"{folder or pin_folder(spark)}/{name}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)   # known schema: no footer inference


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path exists in the cluster file system."""
    _, fs, home = _file_system(spark, path)
    return bool(fs.exists(home))


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Folders right under a path; none if it does not exist."""
    _, fs, home = _file_system(spark, path)
    if not fs.exists(home):
        return []
    return [st.getPath().toString() for st in fs.listStatus(home) if st.isDirectory()]


def drop_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder through the cluster file system (Hadoop FileSystem API).
    Without a JVM handle (Spark Connect) the folder is left to the cluster's
    scratch-space cleanup."""
    try:
        jvm = spark.sparkContext._jvm
    except Exception:  # noqa: BLE001
        return False
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(p, True))


def list_pin_folders(spark: SparkSession) -> set[str]:
    """Run folders currently under ``<checkpoint dir>/pins`` (empty set without a JVM handle)."""
    try:
        jvm = spark.sparkContext._jvm
    except Exception:  # noqa: BLE001
        return set()
    base = jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark).rstrip("/") + "/pins")
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return set()
    return {st.getPath().toString() for st in fs.listStatus(base)}


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return jvm, fs, fs.makeQualified(p)


def has_data_files(spark: SparkSession, path: str) -> bool:
    """Whether a table folder holds a data file (at any depth; names with ``_`` or ``.`` first do not count)."""
    jvm, fs, home = _file_system(spark, path)
    if not fs.exists(home):
        return False
    for st in fs.listStatus(home):
        name = st.getPath().getName()
        if not name.startswith(("_", ".")) and (has_data_files(spark, st.getPath().toString()) if st.isDirectory() else True):
            return True
    return False


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Move a partition folder by renaming; into a target that exists, file by file."""
    jvm, fs, home = _file_system(spark, source)
    goal = _file_system(spark, target)[2]
    fs.mkdirs(goal.getParent())
    if not fs.exists(goal):
        if not fs.rename(home, goal):
            raise OSError(f"cannot move {home}")
        return
    for st in fs.listStatus(home):
        file = jvm.org.apache.hadoop.fs.Path(goal, st.getPath().getName())
        if not st.getPath().getName().startswith(("_", ".")) and not fs.rename(st.getPath(), file):
            raise OSError(f"cannot move {st.getPath()}")
    fs.delete(home, True)


def move_mark(spark: SparkSession, path: str, text: str | None = None) -> str | None:
    """Read the text of a small mark file (None without one); with ``text`` write it, with "" delete it."""
    jvm, fs, home = _file_system(spark, path)
    if text is None:
        if not fs.exists(home):
            return None
        stream = fs.open(home)
        try:
            return stream.readUTF()
        finally:
            stream.close()
    if not text:
        fs.delete(home, False)
        return None
    stream = fs.create(home, True)
    try:
        stream.writeUTF(text)
    finally:
        stream.close()
    return text


def reads_from(df, path: str) -> bool:
    """Whether ``df`` reads files of the folder ``path`` (or ``path`` lies in a folder it reads)."""
    spark = df.sparkSession
    target = _file_system(spark, path)[2].toUri().getPath().rstrip("/") + "/"
    for name in df.inputFiles():
        file = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name).toUri().getPath()
        if file.startswith(target):
            return True
    return False


def replace_folder(df, path: str, fmt: str = "parquet", partition_by: str | None = None) -> int:
    """Replace the table in folder ``path`` by ``df``, which may read that folder, and return
    its rows. The new table is written beside the old one and counted; then the folders change
    names, and the old one is deleted last. A failure on the way leaves one whole table in place
    (at worst under the name ``path`` + ``.old``, put back by the next call)."""
    spark = df.sparkSession
    jvm, fs, home = _file_system(spark, path)
    beside = lambda suffix: jvm.org.apache.hadoop.fs.Path(home.toString() + suffix)
    fresh, old = beside(".new"), beside(".old")
    if not fs.exists(home) and fs.exists(old):
        fs.rename(old, home)
    writer = df.write.mode("overwrite").format(fmt)
    (writer.partitionBy(partition_by) if partition_by else writer).save(fresh.toString())
    rows = spark.read.schema(df.schema).format(fmt).load(fresh.toString()).count()
    fs.delete(old, True)
    if fs.exists(home) and not fs.rename(home, old):
        raise OSError(f"cannot move {home}")
    if not fs.rename(fresh, home):
        raise OSError(f"cannot move {fresh}")
    fs.delete(old, True)
    return rows

"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


class SkipBatch(Exception):
    """The batch holds nothing to process; callers stop without an error."""


def build_session(app: str = "contrail", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the package relies on.

    `master` is left to spark-submit unless given. Shuffle partitions are left
    to the cluster's own default; AQE coalesces or splits them at run time.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session clock to UTC; all timestamps here are zone-less UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by `spark.checkpoint.dir`.

    Only a local session may fall back to a temporary folder of this machine.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="contrail-"))
    return sc.getCheckpointDir().rstrip("/")


_ENDING: set[str] = set()


def scratch_root(spark: SparkSession) -> str:
    """This application's folder in the shared folder; it goes when the driver's JVM ends."""
    root = f"{shared_dir(spark)}/contrail/{spark.sparkContext.applicationId}"
    if root not in _ENDING:
        fs, path = _hadoop(spark, root)
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _ENDING.add(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the application's scratch folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def clean_scratch(spark: SparkSession) -> None:
    """Delete the application's scratch folder, once no frame that was settled in it is read any more."""
    root = f"{shared_dir(spark)}/contrail/{spark.sparkContext.applicationId}"
    fs, path = _hadoop(spark, root)
    fs.delete(path, True)
    _ENDING.discard(root)


def settle(df: DataFrame, label: str = "part", **options: str) -> DataFrame:
    """Write `df` once to the shared folder and return it read back.

    Cuts lineage in a way that survives the loss of executors, and gives the
    optimizer the real size: a later join broadcasts the result only if it is
    below `spark.sql.autoBroadcastJoinThreshold`, and shuffles it otherwise.
    `options` go to the Parquet writer.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.options(**options).parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._scratch = path
    return stored


def discard(df: DataFrame) -> None:
    """Delete the files of a settled frame whose readers are done."""
    discard_path(df.sparkSession, df._scratch)


def discard_path(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _hadoop(spark, path)
    fs.delete(hadoop_path, True)


def _hadoop(spark: SparkSession, path: str):
    """The file system that a path names, and the path as that file system takes it."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """Write one small file to whatever file system the path names."""
    fs, hadoop_path = _hadoop(spark, path)
    out = fs.create(hadoop_path, True)
    try:
        out.write(content)
    finally:
        out.close()


def publish_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """Write one small file that appears whole or not at all; `FileExistsError` if it is there already."""
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder, name = path.rsplit("/", 1)
    staged = f"{folder}/.{name}-{uuid.uuid4().hex}"
    write_bytes(spark, staged, content)
    source, target = (jvm.org.apache.hadoop.fs.Path(x) for x in (staged, path))
    plain = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), hadoop).rename(source, target, plain)
    except Exception as refused:
        discard_path(spark, staged)
        if path_exists(spark, path):
            raise FileExistsError(path) from refused
        raise


def read_bytes(spark: SparkSession, path: str) -> bytes:
    """The content of one small file."""
    fs, hadoop_path = _hadoop(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return bytes(stream.readAllBytes())
    finally:
        stream.close()


def listed(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names in a folder and when each was changed (milliseconds); a missing folder is empty."""
    fs, hadoop_path = _hadoop(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return [(entry.getPath().getName(), entry.getModificationTime()) for entry in fs.listStatus(hadoop_path)]


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    fs, hadoop_path = _hadoop(spark, path)
    return fs.exists(hadoop_path)

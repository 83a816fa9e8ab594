"""Session settings and the shared folder for written stages."""

from __future__ import annotations

import hashlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cpus: int = 8, app: str = "lexiloom", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_path(
    spark: SparkSession, label: str, root: str | None = None, run_id: str | None = None
) -> str:
    """A path for a stage in the folder all executors share.

    Without a ``run_id`` nobody has written to it yet. The folder is ``root``, else the session's ``spark.checkpoint.dir``. Only a local
    session, whose executors share the machine, may fall back to a temporary folder.
    """
    root = root or spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        if run_id is not None:
            raise ValueError("a run that is to go on later needs a folder: give one, or set spark.checkpoint.dir")
        root = tempfile.mkdtemp(prefix="run-")
    place = f"{label}-{uuid.uuid4().hex}" if run_id is None else f"{run_id}/{label}"
    return f"{root.rstrip('/')}/{place}"


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a job has written ``path`` to the end."""
    marker, files = _file_system(spark, f"{path}/_SUCCESS")
    return files.exists(marker)


def _file_system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it does not exist."""
    place, files = _file_system(spark, path)
    if not files.exists(place):
        return []
    return [entry.getPath().getName() for entry in files.listStatus(place) if entry.isDirectory()]


def remove_folder(spark: SparkSession, path: str) -> None:
    place, files = _file_system(spark, path)
    files.delete(place, True)


def read_note(spark: SparkSession, path: str) -> str | None:
    """The one line of a small file, or nothing where there is none."""
    place, files = _file_system(spark, path)
    return spark.read.text(path).first()[0] if files.exists(place) else None


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears with its whole content or not at all; an existing one is an error."""
    place, files = _file_system(spark, path)
    draft = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}-{uuid.uuid4().hex}")
    out = files.create(draft)
    out.write(bytearray(text.encode()))
    out.close()
    if not files.rename(draft, place):
        raise FileExistsError(path)


def input_files(spark: SparkSession, paths: str | list[str]) -> list[tuple[str, int, int]]:
    """Address, length and time of change of the files below the paths (files, folders, patterns), without hidden ones."""
    found = []

    def walk(files, status) -> None:
        name = status.getPath().getName()
        if name[0] in "._":
            return
        if status.isFile():
            found.append((status.getPath().toUri().toString(), status.getLen(), status.getModificationTime()))
        else:
            for inner in files.listStatus(status.getPath()):
                walk(files, inner)

    for text in [paths] if isinstance(paths, str) else paths:
        place, files = _file_system(spark, text)
        matches = files.globStatus(place)
        if not matches:
            raise FileNotFoundError(text)
        for match in matches:
            walk(files, match)
    return sorted(found)


def digest_of(*parts: object) -> str:
    """A short name for what a stage is made of: the digests of its inputs, and its parameters."""
    return hashlib.sha256(repr(parts).encode()).hexdigest()[:16]


def claim_run(spark: SparkSession, label: str, facts: object, root: str | None, run_id: str) -> None:
    """Tie a run to what it computes: a repeat with other ``facts`` is an error.

    A digest of ``facts`` (paths, parameters, stop lists, by their ``repr``) lies beside the
    run's stages.
    """
    digest = hashlib.sha256(repr(facts).encode()).hexdigest()
    path = work_path(spark, label, root, run_id)
    if is_complete(spark, path):
        found = spark.read.text(path).first()[0]
        if found != digest:
            raise ValueError(f"run {run_id} was started with other input or parameters")
    else:
        row = spark.range(1).select(F.lit(digest).alias("value"))
        row.write.mode("overwrite").text(path)


def materialize(
    df: DataFrame,
    label: str,
    root: str | None = None,
    run_id: str | None = None,
    digest: str | None = None,
    codec: str | None = None,
) -> DataFrame:
    """Write ``df`` as Parquet and return the table read back.

    A written stage survives lost executors, is computed once however often it is read,
    and has a known size, so Spark decides from facts whether a join side is small
    enough to broadcast. It also leaves both join sides with an exchange of their own,
    which is what the adaptive skew-join split needs.

    With a ``run_id`` the stage has a fixed place in that run. A stage the run has
    already completed is read and not computed again, so a failed run goes on where it
    stopped. Give the ``digest`` of what the stage is made of, and it is computed anew
    when that has changed. ``codec`` is one of Parquet's, if not the session's: ``"zstd"`` takes less disk.
    """
    spark = df.sparkSession
    path = work_path(spark, label if digest is None else f"{label}-{digest}", root, run_id)
    if run_id is None or not is_complete(spark, path):
        df.write.mode("errorifexists" if run_id is None else "overwrite").parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Shuffle a scan with fewer splits than cores, so that no core idles.

    Large tables have more splits than cores and are left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)

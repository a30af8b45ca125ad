"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on. Adaptive execution coalesces small shuffle
# partitions and splits skewed join partitions; ANSI keeps bad casts loud.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # The JVM does not compile methods beyond 8000 bytes; a wide normalization
    # fused into one larger method would run interpreted, several times slower.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app_name: str = "panelforge", master: str | None = None, **extra: str) -> SparkSession:
    """Return a session with the settings above; ``extra`` uses ``__`` for dots."""

    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def keep_methods_compiled(spark: SparkSession) -> None:
    """Lower the session's limit for generated methods to the size the JVM compiles, also in a session built elsewhere."""

    name = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(name)) > int(SETTINGS[name]):
        spark.conf.set(name, SETTINGS[name])


_owned: ContextVar[str | None] = ContextVar("owned_scratch", default=None)


@contextmanager
def scratch(spark: SparkSession, folder: str | None = None) -> Iterator[str]:
    """Own the scratch folder of a block of work: everything landed inside goes below it.

    ``folder`` defaults to a new one under the shared checkpoint folder. It is deleted
    when the block ends, so results must be written or collected before.
    """

    path = folder or work_dir(spark, "scratch")
    token = _owned.set(path)
    try:
        yield path
    finally:
        _owned.reset(token)
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def work_dir(spark: SparkSession, label: str) -> str:
    """Return a new folder path under the cluster's shared checkpoint folder.

    Executors must all see what one of them wrote, so the path comes from
    ``spark.checkpoint.dir``. Only a local-mode session may fall back to a
    temporary folder of the machine. Inside a :func:`scratch` block it is below the
    block's folder, which goes with the block; elsewhere the folder stays.
    """

    if _owned.get():
        return f"{_owned.get()}/{label}-{uuid.uuid4().hex}"

    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        shared = tempfile.mkdtemp(prefix="panelforge-")
    return f"{shared.rstrip('/')}/panelforge/{label}-{uuid.uuid4().hex}"


def land(df: DataFrame, label: str) -> DataFrame:
    """Write rows to a new shared folder and read them back.

    For an intermediate result that later steps read more than once, and for
    one that should be broadcast only if it is small: the size of a stored table
    is known when the next plan is made, so Spark checks it against its
    broadcast threshold and shuffles otherwise. A lost executor costs no
    recomputation of it.
    """

    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Functions that run there import from it; this makes them independent of the folder
    and the PYTHONPATH that the executors were started with.
    """

    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="panelforge-")) / "panelforge-package.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, str(file.relative_to(root.parent)))
    context.addPyFile(str(path))
    _shipped.add(context.applicationId)


def map_arrow(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow`` for a function of this package."""

    ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)

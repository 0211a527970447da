"""SparkSession helpers: sane defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``ideaweave`` importable in Python workers (``addPyFile`` of a zip of the package).

    Functions run by ``mapInPandas`` / pandas UDFs are pickled by reference, so executors need
    the package; this is what ``--py-files`` does for a submitted job. Once per application.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="iw-pyfiles-"), "ideaweave.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(app)


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "ideaweave",
                  extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench. On a cluster, pass master=None and let spark-submit decide."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
    }
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. ``fallback`` is only used where the setting
    is unset (tests, local runs); on a cluster it must be a shared path.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if not d:
        if fallback is None:
            raise RuntimeError("spark.checkpoint.dir is not set; pass a shared folder as fallback")
        d = fallback
        spark.conf.set("spark.checkpoint.dir", d)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def ensure_checkpointing(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable; local runs get a fresh scratch folder."""
    if spark.sparkContext.getCheckpointDir() is not None:
        return
    fallback = None
    master = spark.sparkContext.master or ""
    if master.startswith("local"):
        import tempfile
        fallback = tempfile.mkdtemp(prefix="iw-ckpt-", dir=os.environ.get("IW_SCRATCH", "/tmp"))
    checkpoint_dir(spark, fallback)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as compressed Parquet below the shared checkpoint folder, and read back."""
    spark = df.sparkSession
    ensure_checkpointing(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{label}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never a local checkpoint)."""
    ensure_checkpointing(df.sparkSession)
    return df.checkpoint(eager=True)

"""Session helpers: a configured SparkSession, reliable lineage cuts and their release.

Library code never picks a master, a memory size or a shuffle width, and no storage location
on a cluster: intermediates go to the folder the cluster names in ``spark.checkpoint.dir``.
Only a local-mode session without that setting (tests, ``bench.py``) gets a fresh scratch
folder. What was written there is deleted when its result is released.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "canopus",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """The running or a new session. Master and shuffle partitions are set only if given, so
    what ``spark-submit`` or the cluster's defaults say stays."""
    b = (SparkSession.builder.appName(app)
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ship_package(spark)
    return spark


_shipped: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``canopus`` importable by the Python workers of this session (what
    ``--py-files`` does): the package is zipped once per driver process and added with
    ``addPyFile``, so pandas UDFs work whatever the workers' working directory is."""
    sc = spark.sparkContext
    if id(sc) in _shipped:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="canopus-pkg-"), "canopus.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _shipped.add(id(sc))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, reading it from the session first."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if sc.master.startswith("local"):
        scratch = tempfile.mkdtemp(prefix="canopus-ckpt-")
        sc.setCheckpointDir(scratch)
        return scratch
    raise RuntimeError("spark.checkpoint.dir is unset: name a shared folder (HDFS/S3/ABFS) for checkpoints")


_written: dict[int, list[tuple[str, str | None]]] = {}   # by session: folders and tables of intermediates


def _record(spark: SparkSession, path: str, table: str | None = None) -> None:
    _written.setdefault(id(spark.sparkContext), []).append((path, table))


def written_so_far(spark: SparkSession) -> int:
    """The number of intermediates, for :func:`release`."""
    return len(_written.get(id(spark.sparkContext), []))


def release(spark: SparkSession, first: int = 0, keep: tuple[str, ...] = (), last: int | None = None) -> None:
    """Deletes the intermediates written since the ``first``-th (and before the ``last``-th), but for the
    folders ``keep``. DataFrames that read them can't be used afterwards."""
    sc = spark.sparkContext
    written = _written.get(id(sc), [])
    for path, table in written[first:last]:
        if path in keep:
            continue
        if table:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        folder = sc._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)
    written[first:last] = [x for x in written[first:last] if x[0] in keep]


@contextlib.contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Intermediates written inside are deleted at its end: for jobs that store their result."""
    first = len(_written.setdefault(id(spark.sparkContext), []))
    try:
        yield
    finally:
        release(spark, first)


def new_folder(spark: SparkSession, prefix: str) -> str:
    """A new name in the checkpoint folder, deleted with the other intermediates."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{prefix}_{uuid.uuid4().hex}"
    _record(spark, path)
    return path


def cut_lineage(df: DataFrame, prefix: str = "canopus_stage") -> DataFrame:
    """Materialise ``df`` as Parquet in the shared checkpoint folder and read it back.

    One job (``Dataset.checkpoint`` computes the plan twice: once to count, once to
    write), the result survives executor loss, and the file scan carries size
    statistics that AQE uses for its join decisions.
    """
    spark = df.sparkSession
    path = new_folder(spark, prefix)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def write_bucketed(df: DataFrame, key: str, num_buckets: int, sort_cols: list[str] | None = None,
                   prefix: str = "canopus", dealt: bool = False) -> DataFrame:
    """Write ``df`` once as an external table bucketed by ``key`` in the checkpoint folder
    and read it back. Scans of a bucketed table report ``HashPartitioning(key)``, so
    later joins, aggregations and windows keyed by ``key`` need no exchange (a plain
    checkpoint forgets the partitioning). The lineage is cut as with a checkpoint. ``dealt`` rows
    are partitioned by ``key`` into as many partitions already."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    name = f"{prefix}_{uuid.uuid4().hex}"
    w = (df if dealt else df.repartition(num_buckets, key)).write.bucketBy(num_buckets, key)
    if sort_cols:
        w = w.sortBy(*sort_cols)
    w.format("parquet").option("path", f"{base}/{name}").saveAsTable(name)
    _record(spark, f"{base}/{name}", name)
    return spark.table(name)

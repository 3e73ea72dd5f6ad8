"""Session helpers."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tradelake",
                  driver_memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark (UI off, AQE on, UTC)."""
    spark = (SparkSession.builder.master(f"local[{cores}]").appName(app)
             .config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", driver_memory)
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    tune_session(spark)
    return spark


# Spark's own advice for HotSpot JVMs: a generated method above 8000 bytes of
# bytecode is never JIT-compiled, so a wide stage (the landing projection, a
# dozen coercions and the keep-first sort fused into one method) would run
# interpreted for its whole life, ~20x slower.  With the limit at 8000 Spark
# runs such a subtree operator by operator instead, with every projection
# compiled as small split methods.
#
# Children are de-duplicated where the join with their parents left them, without
# a second shuffle.  A document with most of the children is then split all the
# same, at the price of that shuffle, which otherwise nothing asks for.
SESSION_DEFAULTS = {"spark.sql.codegen.hugeMethodLimit": "8000",
                    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true"}


def tune_session(spark: SparkSession) -> None:
    """Apply :data:`SESSION_DEFAULTS` where the session has no explicit value
    (a cluster's own setting always wins).  Runtime SQL settings only."""
    for key, value in SESSION_DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


@contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Session settings (dots written as ``__``) for the jobs run inside."""
    conf = {k.replace("__", "."): v for k, v in conf.items()}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for intermediate data: the one the cluster names in
    ``spark.checkpoint.dir``, or another one that the context was given with
    ``setCheckpointDir``.  Without either, a scratch folder of our own, on a
    local master only: on a cluster every machine would have its own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    given = spark.sparkContext.getCheckpointDir()
    if given and not (named and _plain(given).startswith(_plain(named))):
        return given
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="tradelake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named


def _plain(path: str) -> str:
    return "/" + path.removeprefix("file:").strip("/") + "/"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint()`` write under :func:`checkpoint_root` and
    return the root (stable across restarts, unlike the per-context subdir)."""
    root = checkpoint_root(spark)
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root

"""What the operators share: inputs, shared scratch tables, text batches, connected components."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

M64 = (1 << 64) - 1
#: Odd multipliers of the 64-bit mixing steps (fixed values).
MIX_A, MIX_B, BASE = 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x9E3779B97F4A7C15


def tune(spark: SparkSession) -> None:
    """Batches for Python of a few MB: a worker holds one at a time, whatever the texts' lengths. A setting of the session, as
    results are computed when they are asked for."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def give_back() -> None:
    """Returns freed memory to the system; a worker process outlives its task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tune(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, where it is unset
    (a single machine, as in tests), a temporary folder that is then set as the checkpoint folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = "file://" + tempfile.mkdtemp(prefix="loomgraph-")
        atexit.register(shutil.rmtree, found[len("file://") :], True)
        spark.conf.set("spark.checkpoint.dir", found)
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


@contextlib.contextmanager
def freeing(spark: SparkSession):
    """Writes in this block remove their shuffle files as soon as they are done; nothing else reads those."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


class Scratch:
    """Tables written once into the shared folder and read again, so that lineage ends there and a lost
    executor costs no recomputation. drop() frees a table that later steps don't read."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        tune(spark)
        # held for the end of the program, when the session may have stopped
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        self._fs = self._path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        atexit.register(self._forget)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, name: str, df: DataFrame) -> DataFrame:
        with freeing(self.spark):
            df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
        out = self.spark.read.schema(df.schema).parquet(self.path(name))
        self.sweep()
        return out

    def sweep(self) -> None:
        """Let Spark remove shuffle files that nothing refers to any more."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        for name in names:
            p = jvm.org.apache.hadoop.fs.Path(self.path(name))
            p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    def _forget(self) -> None:
        """Removes the tables, on whatever file system they are, once no result can be read any more."""
        if self.root.startswith("file://"):
            shutil.rmtree(self.root[len("file://") :], ignore_errors=True)
            return
        with contextlib.suppress(Exception):  # the JVM may be gone, and its tables with the cluster
            self._fs.delete(self._path, True)


def slices(batches, most_bytes: int = 4 << 20, text: int = 1) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches in runs of about most_bytes of column number text; a longer value stands alone."""
    for b in batches:
        if not b.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(b.column(text)), 0)
        at, held = 0, 0
        for i, n in enumerate(sizes.to_pylist()):
            if held and held + n > most_bytes:
                yield b.slice(at, i - at)
                at, held = i, 0
            held += n
        yield b.slice(at)
    give_back()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit words."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(MIX_A)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(MIX_B)
    return x ^ (x >> np.uint64(33))


def words_of(text: str | bytes | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ of the text with A-Z in lower case, as UTF-8: what bytes.split() cuts at is
    exactly those six bytes, and bytes.lower() touches exactly those letters."""
    if not text:
        return []
    return (text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text).lower().split()


class Forest:
    """Union-find over any hashable nodes; the root is the smallest node."""

    def __init__(self):
        self.up: dict = {}

    def find(self, x):
        up = self.up
        root = x
        while (p := up.get(root, root)) != root:
            root = p
        while x != root:
            up[x], x = root, up.get(x, x)
        return root

    def join(self, a, b) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        if b < a:
            a, b = b, a
        self.up[b] = a
        self.up.setdefault(a, a)
        return True


def _contract(batches):
    """Edges of one partition to their spanning stars: (node, smallest node of its local component)."""
    f = Forest()
    for b in batches:
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            f.join(u, v)
    pairs = [(x, f.find(x)) for x in list(f.up)]
    pairs = [p for p in pairs if p[0] != p[1]]
    for i in range(0, len(pairs), 50_000):
        part = pairs[i : i + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in part], pa.int64()), pa.array([p[1] for p in part], pa.int64())], ["u", "v"])


def components(scratch: Scratch, edges: DataFrame, name: str, rounds: int = 60) -> DataFrame:
    """Connected components of edges (u, v: long) as (node, component), component the smallest node.

    Each partition first contracts its own edges to stars; then large-star and small-star steps alternate
    (both are aggregations and joins on a node, so a hot node is split by AQE) until no edge changes.
    Every round is written to the shared folder. Nodes without edges do not appear.
    """
    contracted = edges.mapInArrow(_contract, "u long, v long")
    cur = scratch.save(f"{name}-0", contracted.distinct())
    for k in range(rounds):
        ends = cur.select(F.col("u").alias("node"), F.lit(1).alias("c"), F.lit(0).alias("p")).union(cur.select("v", F.lit(0), F.lit(1)))
        if ends.groupBy("node").agg(F.sum("c").alias("c"), F.max("p").alias("p")).filter("c > 1 or (c = 1 and p = 1)").isEmpty():
            return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).union(cur.select("v", "v").distinct())
        both = cur.select("u", "v").union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        # small star: each node's smaller neighbours, and itself, to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = small.union(least.select("u", F.col("m").alias("v"))).filter("u != v")
        cur = scratch.save(f"{name}-{k + 1}", stars.mapInArrow(_contract, "u long, v long").distinct())
        scratch.drop(f"{name}-{k}")
    raise RuntimeError("components did not settle")


def pages_of(n: int, per: int) -> int:
    return max(1, -(-n // per))


def env_single_thread() -> None:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ.setdefault("RAYON_NUM_THREADS", "1")

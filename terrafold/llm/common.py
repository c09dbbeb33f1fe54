"""Helpers shared by the operators: shared-folder tables, word hashing, components."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package

#: Word pattern of all contracts: runs of anything but blank and U+0009-U+000D.
WORD_RE = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Where the setting is absent (tests on a local master) a temporary folder
    is created and used; on a cluster its absence is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="terrafold-")
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir() or base
    return base.rstrip("/")


@contextlib.contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Inside, each finished Spark action removes its shuffle files: what it gave is written or small."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


class Workspace:
    """Intermediate tables, written as Parquet below the shared folder.

    A written table cuts the lineage, survives the loss of executors and is
    read back with column pruning.  ``drop`` removes tables not needed again;
    the folder itself goes when the application ends.
    """

    def __init__(self, spark: SparkSession, tag: str):
        ship_package(spark)
        self.spark = spark
        self.root = f"{shared_folder(spark)}/terrafold/{tag}-{uuid.uuid4().hex}"
        self.serial = 0
        path, files = self._files(self.root)
        files.mkdirs(path)
        files.deleteOnExit(path)

    def _files(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def save(self, df: DataFrame, name: str) -> DataFrame:
        self.serial += 1
        path = f"{self.root}/{name}-{self.serial}"
        schema = df.schema
        with tidy(self.spark):
            df.write.parquet(path)
        back = self.spark.read.schema(schema).parquet(path)
        back._terrafold_path = path
        return back

    def save_counted(self, df: DataFrame, name: str, **counted: Column) -> tuple[DataFrame, dict]:
        """Like ``save``; also returns aggregates of the written rows, taken on the way."""
        seen = Observation()
        back = self.save(df.observe(seen, *[c.alias(k) for k, c in counted.items()]), name)
        return back, seen.get

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            path, files = self._files(df._terrafold_path)
            files.delete(path, True)


# -- words and shingles -------------------------------------------------------


def splitmix(x: np.ndarray) -> np.ndarray:
    """Finaliser of the splitmix64 generator, on uint64 arrays."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[32, 9, 10, 11, 12, 13]] = False
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
with np.errstate(over="ignore"):
    _BYTE_VALUE = splitmix((_FOLD.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    _PLACE = splitmix(np.arange(101, 133, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
_powers: list[np.ndarray] = [np.ones(0, np.uint64), np.ones(0, np.uint64)]


def bytes_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            for k, base in enumerate((_BASE, _INVERSE)):
                row = np.full(size, base, dtype=np.uint64)
                row[0] = 1
                _powers[k] = np.multiply.accumulate(row)
    return _powers[0], _powers[1]


def piece_words(data) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(bytes, starts, ends, hashes)`` of the words of UTF-8 bytes, A-Z folded in the 64-bit hashes."""
    b = np.frombuffer(data, dtype=np.uint8)
    inside = np.zeros(len(b) + 2, dtype=np.int8)
    inside[1:-1] = _IS_WORD[b]
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    with np.errstate(over="ignore"):
        up, down = bytes_powers(len(b) + 1)
        total = np.zeros(len(b) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUE[b] * up[: len(b)], out=total[1:])
        return b, starts, ends, splitmix((total[ends] - total[starts]) * down[starts])


def word_hashes(data: bytes, piece: int = 1 << 18) -> np.ndarray:
    """64-bit hashes of the words of UTF-8 text, A-Z folded, in text order.

    Works in pieces of about ``piece`` bytes cut at white space, so that the
    temporary arrays stay small for texts of any length.
    """
    raw = np.frombuffer(data, dtype=np.uint8)
    parts, at = [], 0
    with np.errstate(over="ignore"):
        while at < len(raw):
            end = min(len(raw), at + piece)
            while end < len(raw) and _IS_WORD[raw[end]]:  # cut at white space
                gap = np.flatnonzero(~_IS_WORD[raw[end : end + 4096]])
                end = end + int(gap[0]) if len(gap) else min(len(raw), end + 4096)
            parts.append(piece_words(raw[at:end])[3])
            at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def shingle_set(data: bytes | None, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles of a text.

    A text of fewer words has one shingle, its whole word sequence; a text
    without words, and a null text, has none.
    """
    if not data:
        return np.zeros(0, np.uint64)
    w = word_hashes(data)
    if not len(w):
        return w
    k = min(width, len(w))
    with np.errstate(over="ignore"):
        h = np.full(len(w) - k + 1, np.uint64(k), dtype=np.uint64)
        for i in range(k):
            h += w[i : len(w) - k + 1 + i] * _PLACE[i]
        return np.unique(splitmix(h))


def set_signature(u: np.ndarray) -> tuple[int, int]:
    """128 order-free bits of a set of hashes, as two signed 64-bit numbers."""
    with np.errstate(over="ignore"):
        a = np.sum(splitmix(u ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)
        b = np.sum(splitmix(u + np.uint64(0x14057B7EF767814F)), dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def arrow_bytes(column) -> Iterator[bytes | None]:
    """The values of an Arrow string column as UTF-8 bytes, without decoding."""
    import pyarrow as pa

    return iter(column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist())


# -- bitmaps of wanted keys ----------------------------------------------------

#: Bits for each key, and bounds of a bitmap (2 and 32 MB).
KEY_BITS, LEAST_BITS, MOST_BITS = 16, 1 << 24, 1 << 28


def bitmap(keys: DataFrame, column: str, count: int) -> bytes:
    """A bit for each residue that ``column`` takes, in a size that suits ``count`` keys.

    A key that is absent may find its bit set (more often where the largest
    size is too small); one that is there never finds it unset.
    """
    size = LEAST_BITS
    while size < min(MOST_BITS, KEY_BITS * count):
        size *= 2
    bits = keys.withColumn("r", F.expr(f"pmod({column}, {size}L)"))
    words = bits.groupBy(F.expr("cast(r DIV 64 AS int)").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(r % 64 AS int))")).alias("bits")).toArrow()
    dense = np.zeros(size // 64, dtype=np.uint64)
    dense[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return dense.tobytes()


def bitmap_hit(bits: bytes, keys: np.ndarray) -> np.ndarray:
    words = np.frombuffer(bits, dtype=np.uint64)
    r = keys % (64 * len(words))
    return ((words[r // 64] >> (r % 64).astype(np.uint64)) & np.uint64(1)).astype(bool)


def give_back() -> None:
    """Return free memory of this worker to the system: workers stay for later stages, beside those of other tasks."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches, rows: int = 2048) -> Iterator:
    """Record batches of at most ``rows`` rows, so that what is made of one stays small."""
    give_back()
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        del batch
    give_back()


# -- connected components -----------------------------------------------------


def connected_components(edges: DataFrame, ws: Workspace, max_rounds: int = 60) -> DataFrame:
    """Components of an undirected graph: ``(node, component)``, component = least node.

    ``edges`` has long columns ``a`` and ``b``; only nodes of edges appear in
    the result.  Alternates the large-star and small-star steps (each one an
    aggregation and a join, so no node's neighbours are gathered in one task)
    until the edge set is stable.
    """
    pairs = edges.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    mark = {"n": F.count(F.lit(1)), "s": F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))}
    e, seen = ws.save_counted(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc", **mark)
    for _ in range(max_rounds):
        if not seen["n"]:
            break
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(low.select("u", F.col("m").alias("v")))
        before = seen
        after, seen = ws.save_counted(small.distinct(), "cc", **mark)
        ws.drop(e)
        e = after
        if seen == before:
            break
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )

"""What the corpus operators share: scratch tables, Arrow text blocks and vectorised word hashing.

Scratch tables replace lineage by Parquet files in the folder that the cluster names in
``spark.checkpoint.dir``; a lost executor then costs a re-read and never a recomputation from
unstable row order. Only where that setting is absent and Spark runs in this process (tests, a laptop)
a temporary folder is made; on a cluster its absence is an error.

Scratch tables go when the interpreter ends, or earlier: ``drop_table`` removes one that is read no more, and
``scratch_scope`` all those made inside it.
"""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes in an Arrow batch. Whole texts travel in them, so the default of 10,000 rows would be large.
ARROW_ROWS, ARROW_BYTES = 512, 32 << 20
#: Bytes of input that a task should sort at most.
PARTITION_BYTES = 128 << 20
#: Bytes of text worked on at a time; a longer single text still forms one block.
BLOCK_BYTES = 1 << 19

_own_scratch: str | None = None


def ship_package(spark: SparkSession) -> None:
    """Give executors this package, once per Spark context: their Python need not find it on a path."""
    context = spark.sparkContext
    if getattr(context, "_package_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="package-")
    atexit.register(shutil.rmtree, folder, True)
    with zipfile.ZipFile(f"{folder}/{package.name}.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    context.addPyFile(f"{folder}/{package.name}.zip")
    context._package_shipped = True


def prepare(spark: SparkSession) -> None:
    """Ship the package, and bound memory and disk: small Arrow batches, shuffle files dropped after each job.

    The settings stay in the session, as the frames that operators return run later; where the session already
    has smaller batches, those are kept.
    """
    ship_package(spark)
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)):
        have = spark.conf.get(key)
        if not have.isdigit() or not 0 < int(have) <= most:
            spark.conf.set(key, str(most))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``, or a folder of our own where that is unset and all tasks run here."""
    global _own_scratch
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if _own_scratch is None:
        _own_scratch = "file://" + tempfile.mkdtemp(prefix="scratch-")
        spark.sparkContext.setCheckpointDir(_own_scratch)
    return _own_scratch


def drop_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _drop_quietly(spark: SparkSession, path: str) -> None:
    try:
        drop_path(spark, path)
    except Exception:  # noqa: BLE001  the session may be gone when the interpreter ends
        pass


_scopes: list[list[str]] = []


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a scratch table and read it back: the cut in the lineage."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    atexit.register(_drop_quietly, spark, path)
    if _scopes:
        _scopes[-1].append(path)
    made = spark.read.schema(df.schema).parquet(path)
    made._scratch_path = path
    return made


def drop_table(df: DataFrame) -> None:
    """Remove the scratch table that ``df`` reads, if it is one; no frame may need it any more."""
    path = getattr(df, "_scratch_path", None)
    if path:
        drop_path(df.sparkSession, path)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch tables made inside are removed at the end; what is to stay must have been written elsewhere."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            _drop_quietly(spark, path)


def keep_table(df: DataFrame) -> DataFrame:
    """Take a scratch table out of the innermost scope, so that it outlives it."""
    path = getattr(df, "_scratch_path", None)
    if _scopes and path in _scopes[-1]:
        _scopes[-1].remove(path)
        if len(_scopes) > 1:
            _scopes[-2].append(path)
    return df


def partitions_for(df: DataFrame) -> int:
    """How many partitions to sort ``df`` in: as many as shuffles have, more if its files are larger than those can hold."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(-(-size // PARTITION_BYTES), 1 << 20))


#: The C library's call that gives back freed memory, where it has one.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release_memory() -> None:
    """Give freed memory back to the system. Arrow's pool and the C library keep it, and Python workers live on beside an executor's heap."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


_kept: dict[str, object] = {}


def worker_cache(key: str, make):
    """What ``make`` returns, kept in this Python worker until another operator keeps something: workers live on between stages."""
    if key not in _kept:
        drop_worker_cache()
        _kept[key] = make()
        release_memory()
    return _kept[key]


def drop_worker_cache() -> None:
    _kept.clear()
    release_memory()


def in_fold(key: Column, folds: int, held: int) -> Column:
    """True where crc32(key as text) mod folds is ``held``; false for a null key."""
    return F.coalesce(F.crc32(key.cast("string")) % folds == held, F.lit(False))


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with k1, k2: equal for equal (doc_id, text) only, never null."""
    return docs.withColumn("k1", F.coalesce(F.col("doc_id"), F.lit(0))).withColumn("k2", F.xxhash64("text", F.col("doc_id").isNull()))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class TextBlock:
    """Rows ``first`` to ``last`` of a batch: their bytes, end to end, and where each row starts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int):
        self.data, self.offsets, self.first = data, offsets, first
        self.rows = len(offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[TextBlock]:
    """Cut a string column into blocks of at most ``limit`` bytes, at least a row each. Null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return
    wide = pa.types.is_large_string(column.type)
    raw = column.buffers()
    offsets = np.frombuffer(raw[1], dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(raw[2], dtype=np.uint8) if raw[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield TextBlock(data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at], at)
        at = end


_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True


def word_spans(block: TextBlock) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` and, for each row, the index of its first word (one more at the end)."""
    inside = np.zeros(len(block.data) + 2, dtype=bool)
    np.logical_not(_SEPARATOR[block.data], out=inside[1:-1])
    cut = np.zeros(len(block.data) + 1, dtype=bool)
    cut[block.offsets] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
    return starts, ends, np.searchsorted(starts, block.offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values: two multiply and shift rounds."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_STEP = np.uint64(0xD6E8FEB86659FD93)
#: Places in a word whose values are looked up; those of later places are computed.
_PLACES = 64
_VALUES = mix(np.arange(1, _PLACES * 256 + 1, dtype=np.uint64) * _STEP)
_HASHED_BYTES = 1 << 20


def _place_values(data: np.ndarray, place: np.ndarray) -> np.ndarray:
    key = place * 256 + data
    if len(place) == 0 or place.max() < _PLACES:
        return _VALUES[key]
    return mix((key.astype(np.uint64) + np.uint64(1)) * _STEP)


def word_hashes(block: TextBlock, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Tabulation hashes of data[start:end]: the sum of a pseudo-random value for each byte at its place in the word.

    Words that differ anywhere differ in independent values, so no structure of a word makes it collide.
    """
    out = np.empty(len(starts), dtype=np.uint64)
    size = ends - starts
    until = np.cumsum(size)
    at = 0
    while at < len(starts):
        before = int(until[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(until, before + _HASHED_BYTES, "right")))
        if end == at + 1 and size[at] > _HASHED_BYTES:  # one huge word, piece by piece
            total = 0
            for s in range(0, int(size[at]), _HASHED_BYTES):
                piece = block.data[starts[at] + s : min(starts[at] + s + _HASHED_BYTES, ends[at])]
                total += int(mix((np.arange(s, s + len(piece), dtype=np.uint64) * np.uint64(256) + piece + np.uint64(1)) * _STEP).sum(dtype=np.uint64))
            out[at] = total & ((1 << 64) - 1)
        else:
            own = size[at:end]
            first = until[at:end] - own - before
            place = np.arange(first[-1] + own[-1]) - np.repeat(first, own)
            values = _place_values(block.data[np.repeat(starts[at:end], own) + place], place)
            out[at:end] = np.add.reduceat(values, first)
        at = end
    return mix(out)


def joined_words(block: TextBlock, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All words of a block with one space after each, and where each begins and ends there."""
    size = ends - starts
    after = np.cumsum(size + 1)
    begin = after - size - 1
    length = int(after[-1]) if len(after) else 0
    whole = np.full(length, 0x20, dtype=np.uint8)
    inside = np.ones(length, dtype=bool)
    inside[after - 1] = False
    edge = np.zeros(len(block.data) + 1, dtype=np.int8)
    edge[starts] += 1
    edge[ends] -= 1
    whole[inside] = block.data[np.cumsum(edge[:-1], dtype=np.int8).astype(bool)]
    return whole.tobytes(), begin, after - 1


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by doubling; len(x) - width + 1 values."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return x if have == width else np.minimum(x[: len(x) - (width - have)], x[width - have :])

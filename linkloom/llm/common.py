"""What the corpus operators share: column picking, cutting lineage, and byte-level tokenising in numpy.

Words are maximal runs of ASCII letters, ASCII digits and non-ASCII characters of the
lower-cased text. A batch of texts is one byte buffer with offsets, as Arrow holds it, so
words are found and hashed for all texts at once and no Python object is made per word.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

try:
    _libc = ctypes.CDLL("libc.so.6")
    _libc.malloc_trim  # noqa: B018
except (OSError, AttributeError):  # another C library
    _libc = None

#: Texts are handled in slices of about this many bytes, so that memory doesn't follow Arrow's batch size.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table of that name in a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names; others can't clash with what it adds."""
    return df.select(*[df[c].alias(n) for n, c in columns.items()])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared folder from spark.checkpoint.dir. Only where that is unset, as in tests, a local one is made."""
    sc = spark.sparkContext
    known = sc.getCheckpointDir()
    if known:
        return known
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile

        named = tempfile.mkdtemp(prefix="linkloom-checkpoint-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Writes the rows as Parquet to the shared checkpoint folder and reads them from there: they survive lost executors."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_cut(df: DataFrame) -> None:
    """Deletes what ``cut`` wrote, when nothing will read it again."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file).getParent()
        if folder.getName().startswith("table-"):
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def shared_file(spark: SparkSession, payload: bytes, name: str) -> str:
    """Writes bytes to a file in the shared folder through Hadoop's file system; returns its URI."""
    root = ensure_checkpoint_dir(spark)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{root}/{name}-{uuid.uuid4().hex}")
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path, True)
    try:
        out.write(bytearray(payload))
    finally:
        out.close()
    return path.toString()


def partitions(df: DataFrame) -> int:
    """The session's number of shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def release() -> None:
    """Gives memory that this worker has freed back to the system; workers live on from one stage to the next."""
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


def text_or_empty(c: str | Column = "text") -> Column:
    """Null texts count as empty."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose bits all depend on all bits of the input (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _inverse_pow2(a: int) -> int:
    return pow(a, -1, 1 << 64)


_BASE = 0x9E3779B97F4A7C15
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, SLICE_BYTES + 1024)
        for k, b in (("up", _BASE), ("down", _inverse_pow2(_BASE))):
            a = np.full(size, b, np.uint64)
            a[0] = 1
            _powers[k] = np.multiply.accumulate(a)
    return _powers["up"], _powers["down"]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each begins and the last ends. Nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    large = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if large else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if not len(texts) or texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have about so many bytes, one row at least."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the number of its text. Words never cross texts."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    inside = np.empty(len(data) + 1, np.int8)
    inside[:-1] = _WORD[data]
    inside[-1] = 0
    edge = np.empty(len(data) + 1, bool)
    edge[0] = inside[0]
    np.not_equal(inside[1:], inside[:-1], out=edge[1:])
    cut_at = offsets[1:-1]
    both = cut_at[(cut_at > 0) & (cut_at < len(data))]
    both = both[(inside[both - 1] & inside[both]) > 0]
    at = np.flatnonzero(edge)
    if len(both):
        extra = np.unique(both)
        at = np.sort(np.concatenate([at, extra, extra]), kind="stable")
    start, end = at[0::2], at[1::2]
    return start, end, np.searchsorted(offsets, start, "right") - 1


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, by prefix sums of a polynomial modulo 2**64, then mixed."""
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = _power(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    v = _BYTE[data]
    v *= up[: len(data)]
    np.cumsum(v, out=sums[1:])
    h = sums[end]
    h -= sums[start]
    h *= down[start]
    return mix(h)


def gram_hashes(hashes: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of n words of one text, and the number of the text; a text of fewer words, but one at least, is one shorter gram."""
    if not len(hashes):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    m = len(hashes)
    odd = [np.uint64((0x9E3779B97F4A7C15 * (2 * k + 3)) & (2**64 - 1) | 1) for k in range(n)]
    if m >= n:
        g = np.zeros(m - n + 1, np.uint64)
        for k in range(n):
            g += hashes[k : m - n + 1 + k] * odd[k]
        keep = of[: m - n + 1] == of[n - 1 :]
        g, text = mix(g[keep]), of[: m - n + 1][keep]
    else:
        g, text = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    count = np.diff(np.r_[first, m])
    short = np.flatnonzero(count < n)
    if len(short):
        few = np.zeros(len(short), np.uint64)
        for k in range(n - 1):
            has = count[short] > k
            few[has] += hashes[first[short][has] + k] * odd[k]
        few = mix(few + count[short].astype(np.uint64))
        g, text = np.concatenate([g, few]), np.concatenate([text, of[first[short]]])
        order = np.argsort(text, kind="stable")
        g, text = g[order], text[order]
    return g, text

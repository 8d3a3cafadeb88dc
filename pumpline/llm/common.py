"""Helpers shared by the text operators.

Texts reach Python as Arrow string arrays; ``utf8`` gives their bytes without
decoding them, and ``segments`` cuts a batch into blocks of bounded size that
never split a word, so the numpy work of one block is small however long a
single document is.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pumpline.session import scratch_path

# A word is a run of anything but space, tab, LF, VT, FF and CR.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACES = bytes([0x20, *range(0x09, 0x0E)])
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SPACES)] = True
BLOCK_BYTES = 1 << 20
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch of texts takes, in rows and in bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test data; queries read their input with it first, so it
    also bounds the session's Arrow batches."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null for a null id)."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus))


def is_fold(doc_id: Column, modulus: int, fold: int) -> Column:
    """True where the id's remainder is ``fold``; false for a null id."""
    return F.coalesce(remainder(doc_id, modulus) == fold, F.lit(False))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: cuts the
    lineage and survives a lost executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def utf8(texts: pa.Array) -> tuple[memoryview, np.ndarray]:
    """The bytes of a string array and its n + 1 offsets; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    if pa.types.is_string(texts.type):
        kind = np.int32
    elif pa.types.is_large_string(texts.type):
        kind = np.int64
    else:
        return utf8(texts.cast(pa.large_string()))
    _, offsets, data = texts.buffers()
    if offsets is None or not len(texts):
        return memoryview(b""), np.zeros(len(texts) + 1, dtype=np.int64)
    off = np.frombuffer(offsets, dtype=kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    return memoryview(data) if data is not None else memoryview(b""), off


def _cut(data: memoryview, at: int, end: int) -> int:
    """The first place from ``at`` on where a space begins, or ``end``."""
    while at < end:
        piece = np.frombuffer(data[at:min(end, at + 65536)], dtype=np.uint8)
        hit = np.flatnonzero(IS_SPACE[piece])
        if len(hit):
            return at + int(hit[0])
        at += len(piece)
    return end


def segments(data: memoryview, off: np.ndarray, limit: int = BLOCK_BYTES):
    """Yield lists of (row, start, end): together all bytes of all non-empty
    rows in order, about ``limit`` bytes a list.  A row longer than that comes
    in several segments, cut before a space."""
    block: list[tuple[int, int, int]] = []
    size = 0
    for row in range(len(off) - 1):
        start, end = int(off[row]), int(off[row + 1])
        while start < end:
            stop = end if end - start <= limit else _cut(data, start + limit, end)
            if size and size + stop - start > limit:
                yield block
                block, size = [], 0
            block.append((row, start, stop))
            size += stop - start
            start = stop
    if block:
        yield block


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end places of the words in a byte array."""
    inside = np.zeros(len(buf) + 2, dtype=np.int8)
    np.logical_not(IS_SPACE[buf], out=inside[1:-1].view(bool))
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


class WordHash:
    """64-bit hashes of byte spans: a polynomial over random byte values,
    taken from prefix sums modulo 2**64, then mixed."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.value = rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
        base = 0x9E3779B97F4A7C15 | 1
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            for name, base in (("up", self.base), ("down", self.inverse)):
                p = np.full(size, base, dtype=np.uint64)
                p[0] = 1
                setattr(self, name, np.cumprod(p))

    def spans(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = len(buf) + 1
        self._powers(n)
        total = np.zeros(n, dtype=np.uint64)
        np.cumsum(self.value[buf] * self.down[:n - 1], out=total[1:])
        return mix((total[ends] - total[starts]) * self.up[ends] + (ends - starts).astype(np.uint64))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


class KeyIndex:
    """Positions of known 64-bit keys, looked up for whole arrays at once
    (open addressing with linear probing)."""

    def __init__(self, keys: np.ndarray):
        keys = np.asarray(keys, dtype=np.uint64)
        bits = max(4, int(2 * len(keys)).bit_length())
        self.mask = np.int64((1 << bits) - 1)
        self.shift = np.uint64(64 - bits)
        self.keys = np.zeros(1 << bits, dtype=np.uint64)
        self.place = np.full(1 << bits, -1, dtype=np.int32)
        slot, todo = self._slot(keys), np.arange(len(keys), dtype=np.int32)
        while len(todo):
            free = self.place[slot] < 0
            _, first = np.unique(slot[free], return_index=True)
            won = np.flatnonzero(free)[first]
            self.place[slot[won]] = todo[won]
            self.keys[slot[won]] = keys[todo[won]]
            left = np.ones(len(todo), dtype=bool)
            left[won] = False
            todo, slot = todo[left], (slot[left] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The position of each key, -1 where it is unknown."""
        keys = np.asarray(keys, dtype=np.uint64)
        slot = self._slot(keys)
        out = self.place[slot]
        todo = np.flatnonzero((out >= 0) & (self.keys[slot] != keys))
        slot = slot[todo]
        while len(todo):
            slot = (slot + 1) & self.mask
            got = self.place[slot]
            out[todo] = got
            again = (got >= 0) & (self.keys[slot] != keys[todo])
            todo, slot = todo[again], slot[again]
        return out


def sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of values[start:end] along the first axis (float64), empty spans 0."""
    shape = (len(starts), *values.shape[1:])
    full = ends > starts
    out = np.zeros(shape)
    if full.any():
        pad = np.concatenate([values, np.zeros((1, *values.shape[1:]), dtype=values.dtype)])
        edges = np.stack([starts[full], ends[full]], 1).ravel()
        out[full] = np.add.reduceat(pad, edges, axis=0, dtype=np.float64)[::2]
    return out

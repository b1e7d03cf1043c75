"""Shared helpers: table access, materialised intermediates, bounded Arrow batches, fast word hashing.

A *word* is a maximal run of characters other than space and U+0009..U+000D, as in the
pattern ``[^\\x20\\x09-\\x0D]+``. Words are located and hashed with numpy over the UTF-8
bytes of a whole Arrow batch, so no Python code runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, shared_root

# Rows per Arrow batch while these operators run (Spark's default of 10,000 long
# documents would be hundreds of megabytes in one Python worker).
ARROW_ROWS = 1000
# Bytes of text hashed at once; a word longer than this is hashed on its own.
HASH_BLOCK = 1 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch size to :data:`ARROW_ROWS` unless it already is lower."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > ARROW_ROWS:
        spark.conf.set(key, ARROW_ROWS)


def released(run):
    """``run`` (Arrow batches to Arrow batches), giving the memory that Arrow's pool no longer uses back after every batch.

    The pool keeps it otherwise, in each of an executor's Python workers, for as long as they live.
    """
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in run(batches):
            yield out
            del out
            pa.default_memory_pool().release_unused()
        pa.default_memory_pool().release_unused()
    return each


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back (cuts the lineage; survives lost executors)."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpoint_root(spark: SparkSession) -> str:
    return shared_root(spark)


def fresh_names(df: DataFrame, *names: str) -> list[str]:
    """``names`` made different from every column of ``df`` (extra columns may clash)."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


# ------------------------------------------------------------------ joins that move few rows

# Bits of the map below: 2**17 words of 64 bits, 2 MB in a broadcast however many keys there are.
MAP_BITS = 1 << 23


def mark_by_keys(rows: DataFrame, key: Column, keys: DataFrame, mark: str, name: str = "k") -> DataFrame:
    """``rows`` with ``mark``: false where the 64-bit ``key`` surely isn't in column ``name`` of ``keys``.

    One bit per key in a map of fixed size, joined as a broadcast; the more keys, the more rows are marked that have none.
    """
    slot, word, bits = fresh_names(rows, "_slot", "_word", "_bits")

    def at(k: Column) -> Column:
        return F.pmod(F.xxhash64(k), F.lit(MAP_BITS))

    chart = keys.select(at(F.col(name)).alias(slot)).groupBy(F.shiftright(slot, 6).alias(word)).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast({slot} & 63 as int))")).alias(bits))
    marked = rows.withColumn(slot, at(key)).withColumn(word, F.shiftright(slot, 6)).join(F.broadcast(chart), word, "left")
    hit = F.coalesce(F.expr(f"(shiftright({bits}, cast({slot} & 63 as int)) & 1) = 1"), F.lit(False))
    return marked.select(*rows.columns, hit.alias(mark))


def split_by_keys(rows: DataFrame, key: Column, keys: DataFrame, name: str = "k") -> tuple[DataFrame, DataFrame]:
    """(maybe, surely_not): the rows whose 64-bit ``key`` may be, and those whose ``key`` isn't, in column ``name`` of ``keys``.

    Rows ruled out there needn't be shuffled for an exact join; no answer depends on the map.
    """
    mark, = fresh_names(rows, "_mark")
    marked = mark_by_keys(rows, key, keys, mark, name)
    return marked.where(F.col(mark)).drop(mark), marked.where(~F.col(mark)).drop(mark)


# ------------------------------------------------------------------ word hashing

_U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = np.random.default_rng(0x5EED).integers(0, 2**64, 256, dtype=np.uint64)
_R = 0x9E3779B97F4A7C15 | 1
_RINV = pow(_R, -1, 2**64)
_POW: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """First ``n`` powers of the multiplier and of its inverse modulo 2**64."""
    if len(_POW[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((_R, _RINV)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _POW[i] = np.multiply.accumulate(p)
    return _POW[0][:n], _POW[1][:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (spreads every input bit over the whole word)."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, offsets) of a string column; NULL counts as the empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_string())
    offs = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset: col.offset + len(col) + 1]
    data = col.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    if len(offs) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    return data[offs[0]: offs[-1]], offs - offs[0]


class Words:
    """Words of a batch of texts: byte spans, owner document, and each document's word range.

    ``first[d]:first[d + 1]`` are the words of document ``d``.
    """

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        self.data, self.offs = data, offs
        space = _SPACE[data]
        before = np.empty(len(data), dtype=bool)
        after = np.empty(len(data), dtype=bool)
        if len(data):
            before[0] = after[-1] = True
            before[1:] = space[:-1]
            after[:-1] = space[1:]
            full = offs[1:] > offs[:-1]
            before[offs[:-1][full]] = True
            after[offs[1:][full] - 1] = True
        self.start = np.flatnonzero(before & ~space)
        self.end = np.flatnonzero(after & ~space) + 1
        self.first = np.searchsorted(self.start, offs, "left")

    def __len__(self) -> int:
        return len(self.start)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offs) - 1), np.diff(self.first))

    def hashes(self, lower: bool = False) -> np.ndarray:
        """64-bit hash of every word; with ``lower``, A-Z count as a-z."""
        out = np.empty(len(self), dtype=np.uint64)
        byte = _BYTE
        if lower:
            byte = _BYTE.copy()
            byte[65:91] = byte[97:123]
        i = 0
        while i < len(out):
            j = max(i + 1, int(np.searchsorted(self.end, self.start[i] + HASH_BLOCK, "right")))
            lo, hi = int(self.start[i]), int(self.end[j - 1])
            p, q = _powers(hi - lo + 1)
            cum = np.zeros(hi - lo + 1, dtype=np.uint64)
            np.cumsum(byte[self.data[lo:hi]] * p[:-1], out=cum[1:])
            s, e = self.start[i:j] - lo, self.end[i:j] - lo
            out[i:j] = mix64((cum[e] - cum[s]) * q[s] + (e - s).astype(np.uint64))
            i = j
        return out


def gram_hashes(wh: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive word hashes (position i covers words i..i+n-1)."""
    m = len(wh) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    acc = np.zeros(m, dtype=np.uint64)
    for k in range(n):
        acc = mix64(acc * _U(_R) + wh[k: k + m])
    return acc


class RangeHash:
    """Hash of any word range in O(1) after one prefix sum."""

    def __init__(self, wh: np.ndarray):
        self.p, self.q = _powers(len(wh) + 1)
        self.cum = np.zeros(len(wh) + 1, dtype=np.uint64)
        np.cumsum(wh * self.p[:-1], out=self.cum[1:])

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return mix64((self.cum[hi] - self.cum[lo]) * self.q[lo] + (hi - lo).astype(np.uint64))


def text_slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into row slices of about ``limit`` text bytes (one row at least)."""
    col = batch.column(column)
    sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
    i = 0
    while i < batch.num_rows:
        j, total = i, 0
        while j < batch.num_rows and (j == i or total + sizes[j] <= limit):
            total += int(sizes[j])
            j += 1
        yield batch.slice(i, j - i)
        i = j


def signed(x: np.ndarray) -> np.ndarray:
    """uint64 values as the int64 with the same bits (Spark has no unsigned long)."""
    return x.view(np.int64)

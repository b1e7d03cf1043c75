"""Operator 9: cost-balanced packing of tokenised documents into fixed-length sequences.

Tokenising and cutting run in the map tasks: a document's ids (its text's, then id 0) are cut into pieces of the
sequence length; full pieces are sequences of their own, and the rest of the document goes, with its ids, to one of many shards
chosen by a hash. Each shard, of a bounded number of documents, packs its rests: in descending length, a rest goes to
the sequence of least estimated cost (``LINEAR * tokens + QUADRATIC * sum of squared piece lengths``, the attention within
pieces) that still has room. There are just enough sequences for the shard's tokens; a rest that fits in none
is cut to fill the largest gaps, so a shard pads one sequence's worth of tokens at most.

Edge cases: NULL or empty text is the single id 0; a document longer than a sequence is cut; repeated
rows are packed as separate documents; NULL doc_id is kept; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, mark_by_keys, read_table, released, text_slices

SEQUENCE_TOKENS = 1024
END_ID = 0
LINEAR, QUADRATIC = 1.0, 1.0 / 1024
DOCS_PER_SHARD = 4096
#: Fragments kept per worker (about 200 bytes each); the store is emptied when full, so its memory is bounded.
CACHE_FRAGMENTS = 500_000
VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"


class Encoder(dict):
    """Fragment -> ids of the fragment with a space before it, as 16-bit values.

    The pre-tokeniser never joins a space to what precedes it, so a text whose spaces each stand between two
    non-space characters can be cut before every space and its fragments encoded apart.
    ``ranks`` holds the same vocabulary as ``vocabulary`` but for its added tokens: a text with the string of one goes to
    ``vocabulary``'s own tokeniser, which gives that token's id. The tests compare both encoders.
    """

    def __init__(self, vocabulary: str, ranks: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer
        super().__init__()
        self.reference = Tokenizer.from_file(vocabulary)
        if self.reference.get_vocab_size() > 1 << 16:
            raise ValueError("ids of this vocabulary don't fit in 16 bits")
        self.added = [t.content for t in self.reference.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._bpe = tiktoken.Encoding("fragments", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                                      special_tokens={})

    def __missing__(self, fragment: str) -> bytes:
        ids = array("H", self._bpe.encode_ordinary(" " + fragment)).tobytes()
        if len(fragment) <= 64:
            if len(self) >= CACHE_FRAGMENTS:
                self.clear()
            self[fragment] = ids
        return ids

    def ids(self, text: str) -> np.ndarray:
        if any(a in text for a in self.added):
            return np.array(self.reference.encode(text, add_special_tokens=False).ids, dtype=np.uint16)
        parts = text.split(" ")
        # White space next to a space, or at an end: such texts are encoded whole.
        if "" in parts or " ".join(map(str.strip, parts)) != text:
            return np.array(self._bpe.encode_ordinary(text), dtype=np.uint16)
        raw = array("H", self._bpe.encode_ordinary(parts[0])).tobytes() + b"".join(map(self.__getitem__, parts[1:]))
        return np.frombuffer(raw, dtype=np.uint16)


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(vocabulary: str | None = None, ranks: str | None = None) -> Encoder:
    """This worker's encoder; the files default to the installed public vocabulary."""
    import public_tokenizers as P
    key = (vocabulary or P.path(VOCABULARY), ranks or P.path(RANKS))
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]


def crc32_ids(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def pack_lengths(lengths: np.ndarray, capacity: int) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (item, start, length); ``lengths`` are all in 1..capacity, in the caller's order.

    Items descend by length (ties keep their order) into the sequence of least cost with room; where none has
    room, an item is cut into the largest gaps.
    """
    total = int(lengths.sum())
    count = -(-total // capacity)
    room = np.full(count, capacity, dtype=np.int64)
    cost = np.zeros(count)
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(count)]

    def put(s: int, item: int, start: int, n: int) -> None:
        out[s].append((item, start, n))
        room[s] -= n
        cost[s] += LINEAR * n + QUADRATIC * n * n

    for item in np.argsort(-lengths, kind="stable"):
        n, start = int(lengths[item]), 0
        while n:
            fits = np.where(room >= n, cost, np.inf)
            s = int(np.argmin(fits))
            if np.isinf(fits[s]):
                s = int(np.argmax(room))
            take = min(n, int(room[s]))
            put(s, int(item), start, take)
            start, n = start + take, n - take
    return out


def _cut(capacity: int, vocabulary: str | None, ranks: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary, ranks)
        for whole in batches:
            for b in text_slices(whole, "text"):
                rows = []
                for shard, doc, text in zip(*(b.column(n).to_pylist() for n in ("shard", "doc_id", "text"))):
                    ids = np.append(enc.ids(text or ""), np.uint16(END_ID))
                    full = len(ids) // capacity * capacity
                    rows += [(shard, doc, i, capacity, crc32_ids(ids[i: i + capacity]), len(ids), None)
                             for i in range(0, full, capacity)]
                    if full < len(ids):
                        rows.append((shard, doc, full, len(ids) - full, 0, len(ids), ids[full:].tobytes()))
                types = [pa.int32(), b.column("doc_id").type, pa.int64(), pa.int64(), pa.int64(), pa.int64(),
                         pa.binary()]
                cols = list(zip(*rows)) or [()] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=[
                    "shard", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])
    return run


def _pack_shard(capacity: int, spread: int):
    """One shard's rows -> its pieces; sequence ids are ``shard + spread * (0, 1, ...)``."""
    def run(table: pa.Table) -> pa.Table:
        c = {n: table.column(n).to_pylist() for n in table.column_names}
        # Rows arrive in no fixed order; this one is total but for rows that are alike.
        order = sorted(range(table.num_rows), key=lambda i: (c["doc_id"][i] is None, c["doc_id"][i] or 0, c["start"][i],
                                                             c["ids"][i] or b"", c["ids_crc32"][i]))
        shard, out, seq = c["shard"][0], [], 0
        rests = [i for i in order if c["ids"][i] is not None]
        for i in order:
            if c["ids"][i] is None:
                out.append((c["doc_id"][i], c["start"][i], capacity, c["ids_crc32"][i], c["doc_tokens"][i],
                            shard + spread * seq, 0))
                seq += 1
        for pieces in pack_lengths(np.array([c["length"][i] for i in rests], dtype=np.int64), capacity):
            offset = 0
            for item, start, n in pieces:
                i = rests[item]
                ids = np.frombuffer(c["ids"][i], dtype=np.uint16)[start: start + n]
                out.append((c["doc_id"][i], c["start"][i] + start, n, crc32_ids(ids), c["doc_tokens"][i],
                            shard + spread * seq, offset))
                offset += n
            seq += 1
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        cols = list(zip(*out)) or [()] * 7
        types = [table.schema.field("doc_id").type] + [pa.int64()] * 6
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(cols, types)], names=names)
    return run


def pack(documents: DataFrame, capacity: int = SEQUENCE_TOKENS, docs_per_shard: int = DOCS_PER_SHARD,
         vocabulary: str | None = None, ranks: str | None = None) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one row per piece."""
    spark = documents.sparkSession
    bounded_batches(spark)
    shards = max(1, -(-documents.count() // docs_per_shard))
    kind = dict(documents.dtypes)["doc_id"]
    # Rows alike in both columns have one hash; where they outnumber a shard, they are dealt over all shards.
    alike = documents.select(F.xxhash64("doc_id", "text").alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("m")) \
        .where(F.col("m") > docs_per_shard)
    rows = mark_by_keys(documents.select("doc_id", "text"), F.xxhash64("doc_id", "text"), alike, "many")
    rows = rows.select(F.pmod(F.xxhash64("doc_id", "text", F.when(F.col("many"), F.monotonically_increasing_id())),
                              F.lit(shards)).cast("int").alias("shard"), "doc_id", "text")
    pieces = rows.mapInArrow(released(_cut(capacity, vocabulary, ranks)),
                             f"shard int, doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
                             "ids binary")
    return pieces.groupBy("shard").applyInArrow(
        _pack_shard(capacity, shards), f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
                                       "sequence_id long, offset long")


def op9_pack_sequences(spark, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))

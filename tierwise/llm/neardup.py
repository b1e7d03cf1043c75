"""Operator 4: MinHash near-duplicates with odd sketches.

A document's set is its distinct word shingles (64-bit hashes); documents with equal sets form one class,
and classes are linked when ``100 * |A & B| >= threshold * |A | B|``.

1. One scan gives every document its set's size and 128-bit digest, ``BANDS x ROWS`` MinHashes folded into band keys, and
   an odd sketch: the 1,024 smallest shingle hashes, each flipping one of 1,024 bits. Two sketches differ in no more
   bits than their samples differ in members, so for sets within the sample the XOR population count bounds the
   symmetric difference from below and discarding on it loses nothing; for larger sets the bound follows from both
   sizes and is six standard deviations wide.
2. Classes that share a band key are candidates. Round one pairs each class with one class of its buckets (the smallest
   whose sketch allows a link); verified links are joined into components. Round two compares the
   classes that lie outside the most frequent component of a bucket with the rest of the bucket: every pair of a bucket
   whose components differ, and no pair within a component. The sketch test runs inside the join, so pairs it rejects
   are never rows.
3. Pairs that pass are confirmed on the full sets, and components follow by :func:`graph.components`.

Edge cases: NULL or wordless text has an empty set and no links; fewer words than a shingle
count as one shingle; rows with a NULL doc_id aren't linked and are kept (component NULL); rows that share a doc_id are
one document and stay or go together; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import (
    Words, bounded_batches, gram_hashes, materialise, mix64, read_table, released, signed, split_by_keys, text_buffers, text_slices,
)
from .graph import components

BANDS, ROWS = 32, 4
SAMPLE = 1024
SKETCH_BITS = 1024
_LONGS = SKETCH_BITS // 64

_rng = np.random.default_rng(0xBA5E)
_MUL = _rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**64, BANDS * ROWS, dtype=np.uint64)
del _rng


def shingle_sets(col: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): document d's distinct shingle hashes, ascending, are ``hashes[first[d]:first[d + 1]]``."""
    w = Words(*text_buffers(col))
    wh, n = w.hashes(lower=True), np.diff(w.first)
    docs, values = [], []
    for size in range(1, width + 1):
        has = (n == size) if size < width else (n >= size)
        if not has.any():
            continue
        grams = gram_hashes(wh, size)
        ok = has[w.doc[: len(grams)]]
        ok &= np.arange(len(grams)) + size <= w.first[w.doc[: len(grams)] + 1]
        values.append(mix64(grams[ok] + np.uint64(size)))
        docs.append(w.doc[: len(grams)][ok])
    if not values:
        return np.zeros(0, np.uint64), np.zeros(len(n) + 1, np.int64)
    h, d = np.concatenate(values), np.concatenate(docs)
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return h[new], np.searchsorted(d[new], np.arange(len(n) + 1), "left")


def _signatures(width: int, bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole, "text", 2 << 20):
                h, first = shingle_sets(b.column("text"), width)
                n = np.diff(first)
                full = np.flatnonzero(n)
                at = first[:-1][full]
                keys = np.zeros((len(full), bands), dtype=np.uint64)
                digest = np.zeros((2, b.num_rows), dtype=np.uint64)
                sketch = np.zeros((b.num_rows, _LONGS), dtype=np.int64)
                if len(full):
                    for band in range(bands):
                        key = np.full(len(full), band + 1, dtype=np.uint64)
                        for r in range(band * ROWS, band * ROWS + ROWS):
                            key = mix64(key * _MUL[0] + np.minimum.reduceat(h * _MUL[r] + _ADD[r], at))
                        keys[:, band] = key
                    for k in range(2):
                        digest[k, full] = mix64(np.add.reduceat(mix64(h ^ _ADD[k]), at) + n[full].astype(np.uint64))
                    doc = np.repeat(np.arange(b.num_rows), n)
                    sampled = np.arange(len(h)) - first[doc] < SAMPLE
                    bit = (mix64(h[sampled] ^ _ADD[2]) % np.uint64(SKETCH_BITS)).astype(np.int64)
                    odd = np.bincount(doc[sampled] * SKETCH_BITS + bit, minlength=b.num_rows * SKETCH_BITS) & 1
                    sketch = np.packbits(odd.astype(np.uint8)).view(np.int64).reshape(b.num_rows, _LONGS)
                ends = np.zeros(b.num_rows + 1, dtype=np.int32)
                ends[1:] = np.cumsum(np.where(n > 0, bands, 0))
                yield pa.RecordBatch.from_arrays([
                    b.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(signed(digest[0])),
                    pa.array(signed(digest[1])), pa.ListArray.from_arrays(ends, signed(keys.ravel())),
                    pa.ListArray.from_arrays(np.arange(b.num_rows + 1, dtype=np.int32) * _LONGS, sketch.ravel())],
                    names=["doc_id", "n", "c1", "c2", "bands", "sketch"])
    return run


def _blobs(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole, "text", 2 << 20):
                h, first = shingle_sets(b.column("text"), width)
                raw = [h[first[i]: first[i + 1]].tobytes() for i in range(b.num_rows)]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(raw, pa.binary())],
                                                 names=["doc_id", "shingles"])
    return run


def _confirm(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column("xa"), b.column("xb")):
                p, q = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                common = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * common >= threshold * (len(p) + len(q) - common))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def may_link(a: str, b: str, threshold: int) -> Column:
    """Sizes and odd sketches of rows ``a`` and ``b`` allow a link at ``threshold`` percent."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    differ = sum((F.bit_count(F.col(f"{a}.sketch")[i].bitwiseXOR(F.col(f"{b}.sketch")[i])) for i in range(_LONGS)),
                 F.lit(0))
    # Within the sample: |A ^ B| <= (100 - t)(|A| + |B|) / (100 + t) for every linked pair.
    exact = (100 + threshold) * differ <= (100 - threshold) * (na + nb)
    # Beyond it: a linked pair has t (|A| + |B|) / (100 + t) common members or more; the samples share those of them that are among
    # the larger set's SAMPLE smallest (never less than the share of the smaller set's). Six deviations of that number, then six of
    # the odd bits that so many differing members leave.
    p = F.least(threshold * (na + nb) / ((100 + threshold) * F.greatest(na, nb)), F.lit(1.0))
    noise = F.sqrt(SAMPLE * F.when(p >= 0.5, p * (1 - p)).otherwise(0.25))
    members = F.least(na, F.lit(SAMPLE)) + F.least(nb, F.lit(SAMPLE)) - 2 * (SAMPLE * p - 6 * noise)
    odd = (1 - F.exp(-2 * members / SKETCH_BITS)) / 2
    wide = F.ceil(F.least(members, SKETCH_BITS * odd + 6 * F.sqrt(SKETCH_BITS * odd * (1 - odd))))
    small = (na <= SAMPLE) & (nb <= SAMPLE)
    return ((100 * F.least(na, nb) >= threshold * F.greatest(na, nb))
            & ((small & exact) | (~small & (differ <= wide))))


def _verified(pairs: DataFrame, documents: DataFrame, width: int, threshold: int) -> DataFrame:
    """The pairs (a, b) of document ids that are linked on their full sets."""
    ids = pairs.select(F.col("a").alias("_id")).unionByName(pairs.select(F.col("b").alias("_id"))).distinct()
    ids = materialise(ids, "needed_ids")
    needed, _ = split_by_keys(documents.select("doc_id", "text"), F.col("doc_id"), ids, "_id")
    needed = needed.join(ids, F.col("doc_id") == F.col("_id"), "left_semi")
    kind = dict(documents.dtypes)["doc_id"]
    sets = needed.mapInArrow(released(_blobs(width)), f"doc_id {kind}, shingles binary")
    sets = materialise(sets, "shingles")
    left, right = (sets.select(F.col("doc_id").alias(i), F.col("shingles").alias(x)) for i, x in (("a", "xa"), ("b", "xb")))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "xa", "xb")
    return both.mapInArrow(released(_confirm(threshold)), f"a {kind}, b {kind}").distinct()


def near_duplicates(documents: DataFrame, width: int = 5, threshold: int = 80, bands: int = BANDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per document.

    A pair at exactly 85 percent shares no band key with probability 6e-11, at 80 percent with 5e-8 (32 x 4).
    """
    if bands > BANDS:
        raise ValueError(f"at most {BANDS} bands")
    spark = documents.sparkSession
    bounded_batches(spark)
    kind = dict(documents.dtypes)["doc_id"]
    docs = documents.select("doc_id", "text")
    sig = materialise(docs.mapInArrow(released(_signatures(width, bands)), f"doc_id {kind}, n long, c1 long, c2 long, "
                                      "bands array<long>, sketch array<long>"), "signatures")
    reps = materialise(sig.where((F.col("n") > 0) & F.col("doc_id").isNotNull()).groupBy("c1", "c2", "n").agg(
        F.min("doc_id").alias("node"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "classes")

    keys = reps.select("node", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("m")).where(F.col("m") > 1)
    members = materialise(keys.join(shared.drop("m"), "key"), "buckets")
    thin = reps.select("node", "n", "sketch")
    star = members.where(F.col("node") != F.col("pivot")).select("node", "pivot").distinct()
    star = star.join(thin.alias("x"), "node").join(
        thin.withColumnRenamed("node", "pivot").alias("y"), "pivot").where(may_link("x", "y", threshold))
    star = materialise(star.groupBy("node").agg(F.min("pivot").alias("b")).select(F.col("node").alias("a"), "b"), "star")
    links = materialise(_verified(star, docs, width, threshold), "links")
    part = components(links)

    rows = members.select("key", "node").join(part, "node", "left") \
        .withColumn("component", F.coalesce("component", "node"))
    rows = materialise(rows, "bucket_parts")
    sizes = rows.groupBy("key", "component").agg(F.count(F.lit(1)).alias("m"))
    main = sizes.groupBy("key").agg(F.max(F.struct("m", "component")).alias("x"), F.count(F.lit(1)).alias("parts")) \
        .where(F.col("parts") > 1).select("key", F.col("x.component").alias("main"))
    mixed = materialise(rows.join(main, "key").join(thin, "node"), "mixed_buckets")
    stray = mixed.where(F.col("component") != F.col("main")).alias("x")
    crossing = stray.join(mixed.alias("y"), (F.col("x.key") == F.col("y.key"))
                          & (F.col("x.component") != F.col("y.component")) & may_link("x", "y", threshold))
    crossing = materialise(crossing.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
                           .distinct(), "crossing")
    more = _verified(crossing, docs, width, threshold)
    part = materialise(components(links.unionByName(more)), "parts")

    classes = reps.select("c1", "c2", "n", "node").join(part, "node", "left") \
        .select("c1", "c2", "n", F.coalesce("component", "node").alias("_c"))
    out = sig.select("doc_id", "n", "c1", "c2").join(classes, ["c1", "c2", "n"], "left")
    component = F.when(F.col("n") > 0, F.least("_c", "doc_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("doc_id").isNotNull(), component).alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_representatives(documents: DataFrame, width: int = 5, threshold: int = 80) -> DataFrame:
    """The documents without those whose component has a smaller doc_id."""
    found = near_duplicates(documents, width, threshold)
    gone = materialise(found.where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct(), "duplicates")
    maybe, kept = split_by_keys(documents, F.col("doc_id"), gone, "_gone")
    return kept.unionByName(maybe.join(gone, F.col("doc_id") == gone["_gone"], "left_anti"))


def op4_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), width=3, threshold=85)

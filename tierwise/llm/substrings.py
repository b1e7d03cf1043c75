"""Operator 10: remove repeated word passages by seed and extend.

A window is ``length`` consecutive words of a document; a word goes if some window that covers it has the
word sequence of a window that starts earlier (smaller doc_id, or same document and smaller start).

*Seeds.* Each window's anchor is its ``SEED_WORDS``-gram of least hash (leftmost if tied), so equal windows have
equal anchors at equal offsets, and about one word in eight starts an anchor. Anchors that occur twice anywhere are found by a
partially aggregated count, and only occurrences of those go on.

*Extension.* The windows that share one anchor occurrence are a run. The run is extended to both sides as one stretch of
words: where the whole stretch is an exact repeat of an earlier one, all of its windows go at once. Only one
occurrence of each distinct stretch is left; where several distinct stretches hold the same anchor, the place where
their repeats end lies inside them, and their single windows are compared by hash.

*Maximal repeats.* The union of a document's repeated windows: every maximal repeated passage of at least ``length`` words.

No occurrences are paired with each other: of any group only the smallest position is sent on, to the document that
holds it, and each document subtracts what it got from what it has.

Edge cases: NULL or short text has no window and loses nothing; rows with a NULL doc_id come after all others; rows that
share a doc_id count as one document, at equal starts ordered by a 64-bit hash and the length of their text, which tell them apart; repeated rows are alike and get
equal results; an empty table gives an empty result. Hashes have 64 bits, and windows are compared on anchor and window hash
together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (RangeHash, Words, bounded_batches, gram_hashes, materialise, mix64, read_table, signed, text_buffers,
                     text_slices)
from .graph import SALTS

WINDOW_WORDS = 20
SEED_WORDS = 5
LAST = (1 << 63) - 1
#: A run has at most ``length - SEED_WORDS + 1`` windows, fewer than this; positions are packed as start * RUN + windows.
RUN = 64


class _Runs:
    """Runs of a batch of texts: arrays ``lo`` (first window start, global word index), ``n`` windows, ``doc``."""

    def __init__(self, col: pa.Array, length: int):
        self.w = Words(*text_buffers(col))
        wh = self.w.hashes()
        self.range = RangeHash(wh)
        self.length = length
        grams = gram_hashes(wh, SEED_WORDS)
        m = len(wh) - length + 1
        if m <= 0:
            self.lo = self.n = self.doc = np.zeros(0, np.int64)
            self.anchor = np.zeros(0, np.uint64)
            return
        doc = self.w.doc
        p = np.flatnonzero(np.arange(m) + length <= self.w.first[doc[:m] + 1])
        per = np.lib.stride_tricks.sliding_window_view(grams, length - SEED_WORDS + 1)
        at = np.empty(len(p), dtype=np.int64)
        for i in range(0, len(p), 1 << 16):
            q = p[i: i + (1 << 16)]
            at[i: i + (1 << 16)] = q + per[q].argmin(axis=1)
        new = np.ones(len(p), dtype=bool)
        new[1:] = (at[1:] != at[:-1]) | (p[1:] != p[:-1] + 1) | (doc[p[1:]] != doc[p[:-1]])
        s = np.flatnonzero(new)
        self.lo, self.n = p[s], np.diff(np.append(s, len(p)))
        self.doc, self.anchor = doc[self.lo], grams[at[s]]
        self.offset = at[s] - self.lo

    def stretch(self) -> np.ndarray:
        """Hash of each run's words, its anchor's offset and its number of windows."""
        h = self.range(self.lo, self.lo + self.n - 1 + self.length)
        return mix64(h * np.uint64(3) + (self.offset * RUN + self.n).astype(np.uint64))


def _anchors(length: int):
    """Distinct anchors of a slice of text with their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole, "text"):
                a, n = np.unique(_Runs(b.column("text"), length).anchor, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(signed(a)), pa.array(n.astype(np.int64))], names=["anchor", "m"])
    return run


def _occurrences(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole, "text"):
                r = _Runs(b.column("text"), length)
                o, tag, size = (b.column(x).to_numpy(zero_copy_only=False) for x in ("o", "tag", "size"))
                yield pa.RecordBatch.from_arrays([
                    pa.array(signed(r.anchor)), pa.array(signed(r.stretch()) if len(r.lo) else np.zeros(0, np.int64)),
                    pa.array(o[r.doc]), pa.array(((r.lo - r.w.first[r.doc]) * RUN + r.n).astype(np.int64)),
                    pa.array(tag[r.doc]), pa.array(size[r.doc])], names=["anchor", "stretch", "o", "pos", "tag", "size"])
    return run


def _spread(pos: np.ndarray) -> np.ndarray:
    """Window starts of packed runs."""
    n = pos % RUN
    ends = np.cumsum(n)
    return np.repeat(pos // RUN, n) + np.arange(int(ends[-1]) if len(n) else 0) - np.repeat(ends - n, n)


def _windows(length: int):
    """Texts with their open runs (array<struct<pos, anchor>>) -> every window of these runs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole, "text"):
                w = Words(*text_buffers(b.column("text")))
                h = RangeHash(w.hashes())
                opened = b.column("open")      # NULL for texts without open runs
                sizes = pc.fill_null(opened.value_lengths(), 0).to_numpy(zero_copy_only=False)
                doc = np.repeat(np.arange(b.num_rows), sizes)
                flat = opened.flatten()
                pos, anchor = (flat.field(i).to_numpy() for i in (0, 1))
                n = pos % RUN
                start, doc, anchor = _spread(pos), np.repeat(doc, n), np.repeat(anchor, n)
                at = start + w.first[doc]
                o, tag, size = (b.column(x).to_numpy(zero_copy_only=False) for x in ("o", "tag", "size"))
                yield pa.RecordBatch.from_arrays([
                    pa.array(anchor), pa.array(signed(h(at, at + length))), pa.array(o[doc]), pa.array(start),
                    pa.array(tag[doc]), pa.array(size[doc])], names=["anchor", "hash", "o", "start", "tag", "size"])
    return run


def _strip(length: int, texts: bool):
    """Subtract: windows of found runs, less those of first runs, plus windows of open runs, less surviving starts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole, "text"):
                data, offs = text_buffers(b.column("text"))
                w = Words(data, offs)
                raw = data.tobytes()
                cols = {n: b.column(n) for n in ("found", "firsts", "open", "alive")}
                out = ([], [], [], [], [])
                for i in range(b.num_rows):
                    a, z = int(w.first[i]), int(w.first[i + 1])
                    gone = np.zeros(z - a + 1, dtype=np.int64)
                    if cols["found"][i].is_valid:
                        ls = {n: (np.array(c[i].values, dtype=np.int64) if c[i].is_valid else np.zeros(0, np.int64))
                              for n, c in cols.items()}
                        first = ls["firsts"]
                        go = np.concatenate([_spread(np.setdiff1d(ls["found"], first)),
                                             np.setdiff1d(_spread(ls["open"]), ls["alive"])])
                        np.add.at(gone, go, 1)
                        np.add.at(gone, go + length, -1)
                    keep = np.cumsum(gone)[:-1] == 0
                    kept = b" ".join([raw[s:e] for s, e in zip(w.start[a:z][keep].tolist(), w.end[a:z][keep].tolist())])
                    for x, v in zip(out, (z - a, int((~keep).sum()), hashlib.sha256(kept).hexdigest(),
                                          kept.decode() if texts else None)):
                        x.append(v)
                arrays = [b.column("doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                          pa.array(out[2], pa.string())]
                names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
                if texts:
                    arrays.append(pa.array(out[3], pa.string()))
                    names.append("kept_text")
                yield pa.RecordBatch.from_arrays(arrays, names=names)
    return run


def strip_repeats(documents: DataFrame, length: int = WINDOW_WORDS, texts: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, kept_text]) per row; kept words are joined by one space."""
    if not SEED_WORDS < length < RUN:
        raise ValueError(f"length must lie between {SEED_WORDS} and {RUN}")
    spark = documents.sparkSession
    bounded_batches(spark)
    kind = dict(documents.dtypes)["doc_id"]
    docs = documents.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("o"),
                            F.xxhash64(F.coalesce("text", F.lit(""))).alias("tag"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"),
                            "text")
    counts = docs.select("text").mapInArrow(_anchors(length), "anchor long, m long")
    twice = materialise(counts.groupBy("anchor").agg(F.sum("m").alias("m")).where(F.col("m") > 1).select("anchor"),
                        "seeds")
    runs = docs.select("o", "tag", "size", "text").mapInArrow(_occurrences(length),
                                                      "anchor long, stretch long, o long, pos long, tag long, size int")
    found = materialise(runs.join(twice, "anchor", "left_semi"), "seed_runs")
    first = materialise(found.groupBy("anchor", "stretch").agg(F.min(F.struct("o", "pos", "tag", "size")).alias("x")).select(
        "anchor", "x.o", "x.pos", "x.tag", "x.size"), "first_runs")
    several = first.groupBy("anchor").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > 1).select(
        "anchor", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    opened = first.withColumn("_salt", F.pmod(F.xxhash64("o", "pos"), F.lit(SALTS)).cast("int")) \
        .join(several, ["anchor", "_salt"], "left_semi").drop("_salt")
    opened = materialise(opened, "open_runs")

    # Both joins keep every text and the same columns of it, so that they share one shuffle of the texts.
    texts_by_doc = docs.select("doc_id", "o", "tag", "size", "text")
    open_lists = opened.groupBy("o", "tag", "size").agg(F.collect_list(F.struct("pos", "anchor")).alias("open"))
    windows = texts_by_doc.join(open_lists, ["o", "tag", "size"], "left").select("doc_id", "o", "tag", "size", "text", "open") \
        .mapInArrow(_windows(length), "anchor long, hash long, o long, start long, tag long, size int")
    alive = windows.groupBy("anchor", "hash").agg(F.min(F.struct("o", "start", "tag", "size")).alias("x"))
    none = F.lit(None).cast("long")
    marks = (found.select("o", "tag", "size", F.col("pos").alias("f"), none.alias("g"), none.alias("h"), none.alias("s"))
             .unionByName(first.select("o", "tag", "size", none.alias("f"), F.col("pos").alias("g"), none.alias("h"), none.alias("s")))
             .unionByName(opened.select("o", "tag", "size", none.alias("f"), none.alias("g"), F.col("pos").alias("h"),
                                        none.alias("s")))
             .unionByName(alive.select("x.o", "x.tag", "x.size", none.alias("f"), none.alias("g"), none.alias("h"),
                                       F.col("x.start").alias("s"))))
    marks = marks.groupBy("o", "tag", "size").agg(F.collect_list("f").alias("found"), F.collect_list("g").alias("firsts"),
                                          F.collect_list("h").alias("open"), F.collect_list("s").alias("alive"))
    joined = texts_by_doc.join(marks, ["o", "tag", "size"], "left").select("doc_id", "o", "tag", "text", "found", "firsts", "open", "alive")
    schema = f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if texts else "")
    return joined.mapInArrow(_strip(length, texts), schema)


def op10_repeated_passages(spark, sf_dir: str) -> DataFrame:
    return strip_repeats(read_table(spark, sf_dir, "documents"))

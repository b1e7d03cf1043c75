"""Operator 1: quality classifier from an interpolated modified Kneser-Ney model.

*Training.* Character trigrams of the trusted documents (labelled quality 1 and not toxic) are counted per language; all
of them count, so the model grows with the corpus. Grouped aggregations give the continuation counts of the lower orders, the
counts of counts with their three discounts per order, and the interpolation weights.

*Scoring by sharded count joins.* A trigram's probability needs only tables that share its middle character:
trigram ``abc``, context ``ab``, bigram ``bc`` and context ``b``. The model is cut into shards by a hash of that character. Every
document's trigram counts are cut the same way, packed for a slice of documents, joined with the model shard of their
language, and turned into partial log-likelihoods; summing a document's shards gives its perplexity. Neither the model nor the
documents are ever whole in one place.

*Decision.* A document's log-likelihood of n trigrams strays from its language's mean by more, the longer it is, and its
perplexity by less. What it strays by is therefore divided by the root of n + ``SPREAD`` n^2 + ``PRIOR_CHARS`` (chance within a
document, and differences between documents), and a document is kept if the quotient lies between two quantiles of its
language's trusted documents. ``low`` and ``high`` are these bounds put as log-perplexities of a document of its length.

Edge cases: NULL or empty text has no perplexity and is rejected; a language without trusted documents (or NULL) has
no model, and its documents are kept undecided; rows that share a doc_id are scored row by row, and a label holds for all rows of
its id; repeated rows get equal results; without labels everything that has text is kept; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, materialise, read_table, released, split_by_keys, text_slices
from .trigrams import BITS, MASK, Accumulator, counted

SHARDS = 8
SLICE_BYTES = 1 << 20
LOW, HIGH = 0.0005, 0.995       # quantiles of the trusted documents' standardised log-perplexity
SPREAD = 1e-4                   # variance between documents, as a share of the variance of one character
PRIOR_CHARS = 60                # so that a few characters alone never stray far
VOCABULARY = 0x110000           # characters the uniform distribution spreads over
NO_LANG = "\x00"


def _shard(middle: np.ndarray) -> np.ndarray:
    return (middle * 2654435761 % (1 << 32) >> 7) % SHARDS


def _discounted(counts: DataFrame, context: str) -> DataFrame:
    """Rows (lang, ``context``, gram, m) -> with the discounted share ``p`` of the context and its weight ``gamma``.

    Discounts follow from the counts of counts n1..n4: D_i = i - (i + 1) * Y * n_{i+1} / n_i with Y = n1 / (n1 + 2 n2); where a
    count of counts is missing or D_i isn't between 0 and i, it is i / 2, so that gamma stays positive.
    """
    n = counts.groupBy("lang").agg(*[F.sum((F.col("m") == i).cast("double")).alias(f"n{i}") for i in (1, 2, 3, 4)])
    y = F.col("n1") / F.nullif(F.col("n1") + 2 * F.col("n2"), F.lit(0.0))

    def d(i: int):
        plain = F.lit(float(i)) - (i + 1) * y * F.col(f"n{i + 1}") / F.nullif(F.col(f"n{i}"), F.lit(0.0))
        usable = (F.col(f"n{i}") > 0) & (F.col("n1") > 0) & (plain > 0) & (plain < i)
        return F.when(usable, plain).otherwise(F.lit(0.5 * i)).alias(f"d{i}")

    n = n.select("lang", d(1), d(2), d(3))
    c = counts.join(n, "lang").withColumn(
        "d", F.when(F.col("m") == 1, F.col("d1")).when(F.col("m") == 2, F.col("d2")).otherwise(F.col("d3")))
    sums = c.groupBy("lang", context).agg(F.sum("m").alias("_all"), F.sum("d").alias("_off"))
    return c.join(sums, ["lang", context]).select(
        "lang", context, "gram", ((F.col("m") - F.col("d")) / F.col("_all")).alias("p"),
        (F.col("_off") / F.col("_all")).alias("gamma"))


def train(counts: DataFrame) -> dict[str, DataFrame]:
    """The model's tables from trigram counts (lang, gram, m): probabilities of seen grams and weights of seen contexts.

    ``p3`` (lang, gram=abc, p), ``g3`` (lang, gram=ab, p), ``p2`` (lang, gram=bc, p), ``g2`` (lang, gram=b, p), ``p1`` (lang,
    gram=c, p) and ``p0`` (lang, p): p3 and p2 are interpolated, g3 and g2 are weights of the lower order, p0 is the
    probability of an unseen character.
    """
    three = materialise(counts, "trigrams")
    low = F.col("gram").bitwiseAND(MASK)
    three = three.withColumn("ab", F.shiftright("gram", BITS))
    two = three.groupBy("lang", F.col("gram").bitwiseAND((1 << 2 * BITS) - 1).alias("gram")).agg(F.count(F.lit(1)).alias("m")) \
        .withColumn("b", F.shiftright("gram", BITS))
    one = two.groupBy("lang", low.alias("gram")).agg(F.count(F.lit(1)).alias("m")).withColumn("z", F.lit(0))
    d1, d2 = _discounted(one, "z"), _discounted(two, "b")
    p1 = materialise(d1.select("lang", "gram", (F.col("p") + F.col("gamma") / VOCABULARY).alias("p"),
                               (F.col("gamma") / VOCABULARY).alias("p0")), "p1")
    p2 = materialise(d2.join(p1.select("lang", low.alias("c"), F.col("p").alias("q")),
                             (d2["lang"] == p1["lang"]) & (d2["gram"].bitwiseAND(MASK) == F.col("c"))).select(
        d2["lang"], d2["gram"], (F.col("p") + F.col("gamma") * F.col("q")).alias("p"), "b", "gamma"), "p2")
    d3 = _discounted(three, "ab")
    q2 = p2.select(F.col("lang").alias("l2"), F.col("gram").alias("bc"), F.col("p").alias("q"))
    p3 = materialise(d3.join(q2, (F.col("lang") == F.col("l2"))
                             & (F.col("gram").bitwiseAND((1 << 2 * BITS) - 1) == F.col("bc")))
                     .select("lang", "gram", (F.col("p") + F.col("gamma") * F.col("q")).alias("p"), "ab", "gamma"), "p3")
    return {"p3": p3.select("lang", "gram", "p"),
            "g3": p3.select("lang", F.col("ab").alias("gram"), F.col("gamma").alias("p")).distinct(),
            "p2": p2.select("lang", "gram", "p"),
            "g2": p2.select("lang", F.col("b").alias("gram"), F.col("gamma").alias("p")).distinct(),
            "p1": p1.select("lang", "gram", "p"),
            "p0": p1.select("lang", F.lit(0).cast("long").alias("gram"), F.col("p0").alias("p")).distinct()}


_KINDS = ("p3", "g3", "p2", "g2", "p1", "p0")


def _model_shard(table: pa.Table) -> pa.Table:
    """The entries of one (lang, shard) in one row: for each kind its sorted grams and probabilities."""
    lang, shard = table.column("lang")[0].as_py(), table.column("shard")[0].as_py()
    kind, gram, p = (table.column(n).to_numpy() for n in ("kind", "gram", "p"))
    out = {"lang": pa.array([lang], pa.string()), "shard": pa.array([shard], pa.int32())}
    for k, name in enumerate(_KINDS):
        at = np.flatnonzero(kind == k)
        at = at[np.argsort(gram[at], kind="stable")]
        out[f"{name}_k"] = pa.array([gram[at].tobytes()], pa.binary())
        out[f"{name}_v"] = pa.array([p[at].astype(np.float64).tobytes()], pa.binary())
    return pa.table(out)


def model_shards(model: dict[str, DataFrame]) -> DataFrame:
    """One row per language and shard. Tables without a middle character (p1, p0: an alphabet's size) go to every shard."""
    middle = {"p3": F.shiftright("gram", BITS).bitwiseAND(MASK), "g3": F.col("gram").bitwiseAND(MASK),
              "p2": F.shiftright("gram", BITS), "g2": F.col("gram")}
    rows = None
    for k, name in enumerate(_KINDS):
        own = (F.array(F.pmod(F.shiftright(F.pmod(middle[name] * F.lit(2654435761), F.lit(1 << 32)), 7), F.lit(SHARDS)))
               if name in middle else F.sequence(F.lit(0).cast("long"), F.lit(SHARDS - 1).cast("long")))
        part = model[name].select("lang", F.explode(own).alias("shard"), F.lit(k).alias("kind"), "gram", "p") \
            .withColumn("shard", F.col("shard").cast("int"))
        rows = part if rows is None else rows.unionByName(part)
    schema = "lang string, shard int, " + ", ".join(f"{n}_k binary, {n}_v binary" for n in _KINDS)
    return rows.groupBy("lang", "shard").applyInArrow(_model_shard, schema)


def _planes(x: np.ndarray) -> bytes:
    """32-bit values by byte plane: the planes of small values are zeros, which compress to nothing."""
    return x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unplane(raw: bytes, n: int, at: int) -> np.ndarray:
    return np.frombuffer(raw, np.uint8, 4 * n, at).reshape(4, n).T.copy().view("<u4").ravel().astype(np.int64)


def _encode(ids: np.ndarray, doc: np.ndarray, n: np.ndarray) -> bytes:
    """Trigram counts ordered by trigram and document: distinct trigrams, entries of each, document gaps, counts."""
    grams, length = np.unique(ids, return_counts=True)
    first = np.cumsum(length) - length
    gap = np.diff(doc, prepend=0)
    gap[first] = doc[first]
    step = np.diff(grams, prepend=0)
    return b"".join([np.array([len(grams), len(ids)], dtype=np.int64).tobytes(), _planes(step & 0xFFFFFFFF),
                     _planes(step >> 32), _planes(length), _planes(gap), _planes(n)])


def _decode(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct trigrams, entries of each, document, count)."""
    g, n = (int(x) for x in np.frombuffer(raw, np.int64, 2))
    low, high, length = (_unplane(raw, g, 16 + 4 * g * i) for i in range(3))
    gap, count = (_unplane(raw, n, 16 + 12 * g + 4 * n * i) for i in range(2))
    total = np.cumsum(gap)
    first = np.cumsum(length) - length
    doc = total - np.repeat(total[first] - gap[first], length)
    return np.cumsum(low | high << 32), length, doc, count


_PACKED = "block string, lang string, shard int, docs int, ids binary, payload binary"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents -> for each slice, language and shard its packed trigram counts; shard 0 also names the rows."""
    packer, part, turn = zstandard.ZstdCompressor(level=3), TaskContext.get().partitionId(), 0
    for whole in batches:
        for b in text_slices(whole, "text", SLICE_BYTES):
            langs, texts, rows = b.column("lang").to_pylist(), b.column("text").to_pylist(), []
            doc_id, tag = (b.column(n).to_numpy(zero_copy_only=False) for n in ("o", "tag"))
            for lang in sorted(set(langs)):
                at = np.array([i for i, x in enumerate(langs) if x == lang])
                ids, doc, n = counted([texts[i] or "" for i in at])
                shard = _shard(ids >> BITS & MASK)
                for s in range(SHARDS):
                    mine = np.flatnonzero(shard == s)
                    if not len(mine) and s:
                        continue
                    payload = packer.compress(_encode(ids[mine], doc[mine], n[mine]))
                    names = doc_id[at].astype(np.int64).tobytes() + tag[at].astype(np.int64).tobytes() if s == 0 else None
                    rows.append((f"{part}:{turn}:{lang}", lang, s, len(at), names, payload))
            turn += 1
            cols = list(zip(*rows)) or [()] * 6
            types = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             names=["block", "lang", "shard", "docs", "ids", "payload"])


def _look_up(keys: np.ndarray, table: dict, kind: str, missing: np.ndarray | float) -> np.ndarray:
    k, v = table[kind]
    if not len(k):
        return np.broadcast_to(missing, keys.shape).astype(np.float64)
    at = np.minimum(np.searchsorted(k, keys), len(k) - 1)
    return np.where(k[at] == keys, v[at], missing)


def probabilities(grams: np.ndarray, table: dict) -> np.ndarray:
    """P(c | ab) of trigram ids by one shard's tables: kind -> (sorted grams, values)."""
    one = _look_up(grams & MASK, table, "p1", table["p0"][1][0])
    two = _look_up(grams & ((1 << 2 * BITS) - 1), table, "p2", _look_up(grams >> BITS & MASK, table, "g2", 1.0) * one)
    return _look_up(grams, table, "p3", _look_up(grams >> BITS, table, "g3", 1.0) * two)


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed counts with their model shard (NULL without a model) -> log-likelihood and length per document."""
    opener = zstandard.ZstdDecompressor()
    for b in batches:
        out = []
        for j in range(b.num_rows):
            raw = opener.decompress(b.column("payload")[j].as_py(), max_output_size=1 << 31)
            grams, length, doc, count = _decode(raw)
            docs = b.column("docs")[j].as_py()
            if b.column("p0_v")[j].is_valid:
                table = {k: (np.frombuffer(b.column(f"{k}_k")[j].as_buffer(), np.int64),
                             np.frombuffer(b.column(f"{k}_v")[j].as_buffer(), np.float64)) for k in _KINDS}
                logp = np.repeat(np.log(probabilities(grams, table)), length)
            else:
                logp = np.full(len(doc), np.nan)
            out.append((b.column("block")[j].as_py(), b.column("lang")[j].as_py(), b.column("ids")[j].as_py(),
                        np.bincount(doc, weights=logp * count, minlength=docs).tobytes(),
                        np.bincount(doc, weights=count, minlength=docs).tobytes()))
        cols = list(zip(*out)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.string()] * 2 + [pa.binary()] * 3)],
                                         names=["block", "lang", "ids", "loglik", "n"])


def _sum_block(table: pa.Table) -> pa.Table:
    """The shards of one slice and language -> (o, tag, lang, loglik, n) per document."""
    ids = np.frombuffer(next(x for x in table.column("ids").to_pylist() if x is not None), np.int64)
    total, n = (sum(np.frombuffer(x, np.float64) for x in table.column(c).to_pylist()) for c in ("loglik", "n"))
    rows = len(ids) // 2
    return pa.table({"o": ids[:rows], "tag": ids[rows:], "lang": pa.array([table.column("lang")[0].as_py()] * rows, pa.string()),
                     "loglik": total, "n": n.astype(np.int64)})


LAST = (1 << 63) - 1


def _rows(documents: DataFrame) -> DataFrame:
    return documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("o"),
                            F.xxhash64(F.coalesce("text", F.lit(""))).alias("tag"),
                            F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), "text")


def pack_trigrams(documents: DataFrame) -> DataFrame:
    """The documents' trigram counts in slices and shards: the only pass over the texts."""
    bounded_batches(documents.sparkSession)
    return materialise(_rows(documents).mapInArrow(released(_cut), _PACKED), "packed_trigrams")


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids = [np.frombuffer(x, np.int64) for x in b.column("ids").to_pylist()]
        n = [len(x) // 2 for x in ids]
        cols = [pa.array(np.repeat(b.column("block").to_numpy(zero_copy_only=False), n), pa.string()),
                pa.array(np.concatenate([np.arange(m) for m in n] or [np.zeros(0)]).astype(np.int32)),
                pa.array(np.concatenate([x[:m] for x, m in zip(ids, n)] or [np.zeros(0)]).astype(np.int64))]
        yield pa.RecordBatch.from_arrays(cols, names=["block", "at", "o"])


def _picked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed counts with the picked documents of their slice -> trigram totals per language."""
    opener, total = zstandard.ZstdDecompressor(), Accumulator()
    for b in batches:
        for lang, payload, picks in zip(*(b.column(n).to_pylist() for n in ("lang", "payload", "picks"))):
            grams, length, doc, count = _decode(opener.decompress(payload, max_output_size=1 << 31))
            ok = np.isin(doc, np.array(picks))
            total.add(lang, np.repeat(grams, length)[ok], count[ok])
        if total.full():
            yield total.drain()
    yield total.drain()


def trusted_counts(packed: DataFrame, trusted: DataFrame) -> DataFrame:
    """(lang, gram, m) over the documents whose id is in ``trusted`` (column ``_trusted``)."""
    names = packed.where(F.col("ids").isNotNull()).select("block", "ids").mapInArrow(released(_named), "block string, at int, o long")
    picks = names.join(trusted, F.col("o") == F.col("_trusted"), "left_semi").groupBy("block").agg(
        F.collect_list("at").alias("picks"))
    return packed.join(picks, "block").select("lang", "payload", "picks").mapInArrow(
        released(_picked), "lang string, gram long, m long").groupBy("lang", "gram").agg(F.sum("m").alias("m"))


def log_likelihoods(packed: DataFrame, model: dict[str, DataFrame]) -> DataFrame:
    """(o, tag, lang, loglik, n) per row: n trigrams and their log-likelihood (NaN without a model of the language)."""
    shards = materialise(model_shards(model), "model_shards")
    partial = packed.join(shards, ["lang", "shard"], "left").select(
        "block", "lang", "docs", "ids", "payload", *[f"{k}_{x}" for k in _KINDS for x in "kv"]) \
        .mapInArrow(released(_partial), "block string, lang string, ids binary, loglik binary, n binary")
    return partial.groupBy("block").applyInArrow(_sum_block, "o long, tag long, lang string, loglik double, n long")


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(o, tag, lang, n, log_perplexity, low, high, keep) per row of the documents."""
    trusted = labels.where((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)) \
        .select(F.col("doc_id").cast("long").alias("_trusted")).where(F.col("_trusted").isNotNull()).distinct()
    packed = pack_trigrams(documents)
    scores = materialise(log_likelihoods(packed, train(trusted_counts(packed, trusted))), "log_likelihoods")
    good = scores.join(trusted, F.col("o") == F.col("_trusted"), "left_semi").where((F.col("n") > 0) & ~F.isnan("loglik"))
    mean = good.groupBy("lang").agg((-F.sum("loglik") / F.sum("n")).alias("mean"))

    def strayed(rows: DataFrame) -> DataFrame:
        n = F.col("n").cast("double")
        scale = F.sqrt(n + SPREAD * n * n + PRIOR_CHARS)
        known = (n > 0) & ~F.isnan("loglik")
        rows = rows.join(mean, "lang", "left").withColumn("_unit", F.when(n > 0, scale / n))
        return rows.withColumn("log_perplexity", F.when(known, -F.col("loglik") / n)) \
            .withColumn("stray", (F.col("log_perplexity") - F.col("mean")) / F.col("_unit"))

    bounds = strayed(good).groupBy("lang").agg(F.percentile_approx("stray", [LOW, HIGH], 10000).alias("q")).select(
        "lang", F.col("q")[0].alias("_low"), F.col("q")[1].alias("_high"))
    out = strayed(scores).join(materialise(bounds, "quality_bounds"), "lang", "left")
    within = F.coalesce(F.col("stray").between(F.col("_low"), F.col("_high")), F.lit(True))
    return out.select("o", "tag", F.nullif("lang", F.lit(NO_LANG)).alias("lang"), "n", "log_perplexity",
                      *[(F.col("mean") + F.col(f"_{x}") * F.col("_unit")).alias(x) for x in ("low", "high")],
                      ((F.col("n") > 0) & within).alias("keep"))


def op1_quality_classifier(spark, sf_dir: str) -> DataFrame:
    found = classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    doc_id = F.nullif("o", F.lit(LAST))
    return found.select(doc_id.alias("doc_id"), "lang", F.col("n").alias("n_trigrams"), "log_perplexity", "low", "high", "keep")


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier keeps."""
    gone = classify(documents, labels).where(~F.col("keep")).select(F.xxhash64("o", "tag").alias("k"), "o", "tag").distinct()
    gone = materialise(gone, "rejected")
    o = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    tag = F.xxhash64(F.coalesce("text", F.lit("")))
    maybe, kept = split_by_keys(documents, F.xxhash64(o, tag), gone)
    return kept.unionByName(maybe.join(gone, (o == gone["o"]) & (tag == gone["tag"]), "left_anti"))

"""The quality model against a plain Python Kneser-Ney model, and the pipeline's stages on their own inputs."""
import collections
import math
import random

import numpy as np
from llm_data import documents, empty


def _model(texts):
    """Interpolated modified Kneser-Ney over character trigrams, written out."""
    def pad(t):
        return "\x02\x02" + " ".join(t.split())
    three = collections.Counter(p[i:i + 3] for p in map(pad, texts) for i in range(len(p) - 2))
    two = collections.Counter(g[1:] for g in three)
    one = collections.Counter(g[1] for g in two)

    def smooth(counts, split):
        n = collections.Counter(min(c, 5) for c in counts.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + n[2] else 0
        d = {}
        for i in (1, 2, 3):
            v = i - (i + 1) * y * n[i + 1] / n[i] if n[i] and n[1] else 0
            d[i] = v if 0 < v < i else 0.5 * i
        total, off = collections.Counter(), collections.Counter()
        for g, c in counts.items():
            total[g[:split]] += c
            off[g[:split]] += d[min(c, 3)]
        return ({g: (c - d[min(c, 3)]) / total[g[:split]] for g, c in counts.items()},
                {x: off[x] / total[x] for x in total})
    (p1, g1), (p2, g2), (p3, g3) = smooth(one, 0), smooth(two, 1), smooth(three, 2)

    def prob(g):
        a = p1.get(g[2], 0) + g1[""] / 0x110000
        b = p2.get(g[1:], 0) + g2.get(g[1], 1) * a
        return p3.get(g, 0) + g3.get(g[:2], 1) * b
    return lambda t: sum(math.log(prob(pad(t)[i:i + 3])) for i in range(len(pad(t)) - 2))


def _corpus(spark):
    rnd = random.Random(8)
    syllables = ["the", "re", "ti", "on", "an", "er"]

    def clean():
        return " ".join("".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 3))) for _ in range(rnd.randint(4, 60)))
    rows = [(i, clean(), "en") for i in range(60)] + [(100 + i, "%%% ###" * 20 + "é", "en") for i in range(5)]
    rows += [(200, None, "en"), (201, "", "en"), (202, "unmodelled", "xx"), (203, "null", None), (None, clean(), "en")]
    docs = spark.createDataFrame([(*r, "s", len(r[1] or "")) for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)] + [(100, 0, 0), (101, 1, 1), (None, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    return rows, docs, labels


def test_perplexity_is_that_of_the_written_out_model(spark):
    from tierwise.llm import quality as Q
    rows, docs, labels = _corpus(spark)
    trusted = labels.where("quality = 1 and toxic = 0 and doc_id is not null").selectExpr("doc_id as _trusted")
    packed = Q.pack_trigrams(docs)
    got = {(r.o, r.lang): r for r in Q.log_likelihoods(packed, Q.train(Q.trusted_counts(packed, trusted))).collect()}
    score = _model([t for i, t, _ in rows if i is not None and i < 40])
    for i, t, lang in rows:
        r = got[Q.LAST if i is None else i, lang or Q.NO_LANG]
        assert r.n == len(" ".join((t or "").split()))
        if lang == "en" and t:
            assert abs(r.loglik - score(t)) < 1e-6 * abs(score(t))
        elif t:
            assert math.isnan(r.loglik)


def test_classifier_keeps_clean_and_rejects_junk(spark):
    from tierwise.llm.quality import classify, keep_good
    rows, docs, labels = _corpus(spark)
    kept = {r.doc_id for r in keep_good(docs, labels).collect()}
    assert len([i for i in range(60) if i in kept]) >= 58 and not kept & {100, 101, 102, 103, 104, 200, 201}
    assert {202, 203} <= kept and keep_good(docs, labels).columns == docs.columns
    assert classify(docs.where("false"), labels).count() == 0
    assert keep_good(docs, labels.where("false")).count() == len(rows) - 2


def test_trigram_counts_round_trip():
    from tierwise.llm.quality import _decode, _encode
    from tierwise.llm.trigrams import counted
    texts = ["the theatre", "", "日本語 the", "a" * 50]
    ids, doc, n = counted(texts)
    grams, length, d, c = _decode(_encode(ids, doc, n))
    assert (np.repeat(grams, length) == ids).all() and (d == doc).all() and (c == n).all()
    want = collections.Counter()
    for i, t in enumerate(texts):
        p = "\x02\x02" + t
        for k in range(len(p) - 2):
            want[tuple(map(ord, p[k:k + 3])), i] += 1
    assert {((g >> 42, g >> 21 & 0x1FFFFF, g & 0x1FFFFF), d): c for g, d, c in zip(ids.tolist(), doc.tolist(), n.tolist())} == want


def test_stages(spark, tmp_path):
    import corpus_pipeline as P
    docs = documents(spark).select("doc_id", "text", "lang", "source", "n_chars")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    current = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in P.STAGES[:-1]:
        after = stage(spark, current, str(tmp_path))
        assert after.columns == docs.columns, name
        after.write.parquet(str(tmp_path / name.replace(" ", "_")))
        after = spark.read.parquet(str(tmp_path / name.replace(" ", "_")))
        if name == "secret scan":
            assert after.count() == current.count()
        current = after
    out = P.STAGES[-1][1](spark, current, str(tmp_path))
    assert out.agg({"length": "sum"}).first()[0] > 0
    nothing = empty(spark).select(*docs.columns)
    for name, stage in P.STAGES:
        assert stage(spark, nothing, str(tmp_path)).count() == 0, name


def test_split_by_keys_never_rules_out_a_key(spark):
    from tierwise.llm.common import split_by_keys
    rows = spark.range(5000).selectExpr("id", "id as _slot", "id as _word")
    maybe, other = split_by_keys(rows, rows["id"], spark.range(0, 5000, 7), "id")
    maybe = {r.id for r in maybe.collect()}
    assert set(range(0, 5000, 7)) <= maybe and len(maybe) < 900
    assert maybe | {r.id for r in other.collect()} == set(range(5000))


def test_stages_give_arrow_memory_back(monkeypatch):
    import pyarrow as pa

    from tierwise.llm import common

    class Pool:
        n = 0

        def release_unused(self):
            self.n += 1

    pool = Pool()
    monkeypatch.setattr(common.pa, "default_memory_pool", lambda: pool)
    batches = [pa.RecordBatch.from_arrays([pa.array([i])], names=["a"]) for i in range(3)]
    assert list(common.released(iter)(iter(batches))) == batches
    assert pool.n == 4

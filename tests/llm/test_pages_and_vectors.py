"""Page and vector operators against brute force, round trips and held-out accuracy."""
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

PAGES = "page_id long, url string, html string, digest string, body string"


def _pages(spark):
    big = "<p>" + "é" * 80 + "</p>"
    rows = [(5, "http://a.example.com/x", big), (2, "http://b.example.com/\r\nX: y", big), (9, None, big), (9, None, big),
            (1, "http://c", "tiny"), (3, "http://c", "tiny"), (4, "u", None), (6, "u", ""), (7, "u", "a\r\n\r\nWARC/1.1\r\n" * 20),
            (None, "u", "<b>" + "z" * 200)]
    return rows, spark.createDataFrame([(*r, "clash", "clash") for r in rows], PAGES)


def test_archive_round_trip(spark, tmp_path):
    from tierwise.llm.archive import export_warc, parse_header, read_archive, write_archive
    rows, pages = _pages(spark)
    write_archive(pages, str(tmp_path / "a"))
    records = read_archive(spark, str(tmp_path / "a"))
    got = records.collect()
    assert len(got) == len(rows)
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    want = []
    for i, _, h in rows:
        raw = (h or "").encode()
        revisit = len(raw) >= 100 and i is not None and i != first[h or ""]
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response",
                     first[h or ""] if revisit else None))
    assert sorted(map(str, want)) == sorted(str(tuple(r)[:5]) for r in got)
    for r in got:
        head, body = bytes(r.record).split(b"\r\n\r\n", 1)
        fields = parse_header(head + b"\r\n\r\n")
        own = bytes(r.payload) if r.record_type == "response" else b""
        assert body == own + b"\r\n\r\n" and int(fields["Content-Length"]) == len(own)
    assert spark.read.parquet(str(tmp_path / "a" / "payloads")).count() == len({h or "" for _, _, h in rows})
    assert sorted(p.name for p in (tmp_path / "a").iterdir()) == ["payloads", "records"]    # no second copy of payloads
    export_warc(records.coalesce(1), str(tmp_path / "w"))
    files = [p.read_bytes() for p in (tmp_path / "w").glob("part-*")]
    assert sorted(b"".join(files)) == sorted(b"".join(bytes(r.record) for r in got))


def test_damaged_payload_fails(spark, tmp_path):
    from tierwise.llm.archive import read_archive, write_archive
    import zlib
    _, pages = _pages(spark)
    write_archive(pages, str(tmp_path / "a"))
    bad = spark.read.parquet(str(tmp_path / "a" / "payloads")).withColumn("body", F.lit(bytearray(zlib.compress(b"other"))))
    bad.write.mode("overwrite").parquet(str(tmp_path / "b"))
    bad = spark.read.parquet(str(tmp_path / "b"))
    bad.write.mode("overwrite").parquet(str(tmp_path / "a" / "payloads"))
    with pytest.raises(Exception):
        read_archive(spark, str(tmp_path / "a")).collect()


def test_empty_archive(spark, tmp_path):
    from tierwise.llm.archive import read_archive, write_archive
    write_archive(spark.createDataFrame([], PAGES), str(tmp_path / "e"))
    assert read_archive(spark, str(tmp_path / "e")).count() == 0


VECTORS = "vec_id long, embedding array<float>, id int, node int"


def _vectors(spark, n=900, d=6, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * rng.lognormal(0, 1.0, (n, 1))
    x[100:220] = x[100]                                     # ties
    rows = [(int(i), [float(np.float32(v)) for v in r]) for i, r in enumerate(x)]
    good = dict(rows)
    rows += [(2000, None), (2100, []), (2200, [math.nan] * d), (2300, [None] + [1.0] * (d - 1)), (2400, [math.inf] * d),
             (None, [1.0] * d), (0, rows[0][1])]
    return good, spark.createDataFrame([(*r, 1, 1) for r in rows], VECTORS)


def test_exact_top_k(spark):
    from tierwise.llm.exact_topk import top_k
    good, df = _vectors(spark)
    ids = np.array(list(good))
    v = np.floor(1024 * np.array(list(good.values())))
    got = {}
    for r in top_k(df.select("vec_id", "embedding"), 10, F.col("id") % 100 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == {i for i in good if i % 100 == 0}
    for q, rows in got.items():
        s = v @ v[ids == q][0]
        s[ids == q] = -np.inf
        best = np.lexsort((ids, -s))[:10]
        assert sorted(rows) == [(k + 1, int(ids[i]), int(s[i])) for k, i in enumerate(best)]
    assert top_k(df.where("false"), 10, F.col("id") % 100 == 0).count() == 0


def test_pruning_keeps_every_vector_that_can_reach_the_bound():
    from tierwise.llm.exact_topk import survivors
    rng = np.random.default_rng(4)
    p = np.floor(1024 * (rng.normal(size=(400, 5)) * 0.2 + rng.normal(size=5))).astype(np.int32)
    length = np.sqrt((p.astype(float) ** 2).sum(axis=1))
    for q in p[:40]:
        s = p.astype(np.int64) @ q.astype(np.int64)
        for theta in np.quantile(s, [0.2, 0.5, 0.9, 0.99, 1.0]):
            kept = set(survivors(q, p, length, float(theta)).tolist())
            assert set(np.flatnonzero(s >= theta).tolist()) <= kept


def test_nearest_neighbours(spark):
    from tierwise.llm.nn_descent import nearest
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1200, 12))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[:150] = x[0]                                          # one very common vector
    rows = [(int(i), [float(np.float32(v)) for v in r]) for i, r in enumerate(x)]
    good = dict(rows)
    rows += [(3000, None), (3020, [0.0] * 12), (3040, [math.nan] * 12), (None, [1.0] * 12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in nearest(df, 20, F.col("id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    ids, v = np.array(list(good)), np.array(list(good.values()))
    assert set(got) == {i for i in good if i % 20 == 0}
    hits = 0
    for q, rows in got.items():
        s = v @ v[ids == q][0]
        t = s.copy()
        t[ids == q] = -np.inf
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, 21)) and all(i != q and abs(s[i] - w) < 1e-12 for _, i, w in rows)
        assert all((-a[2], a[1]) < (-b[2], b[1]) for a, b in zip(rows, rows[1:]))
        hits += len({i for _, i, _ in rows} & set(ids[np.lexsort((ids, -t))[:20]].tolist()))
    assert hits / (20 * len(got)) >= 0.9
    assert nearest(df.where("false"), 20, F.col("id") % 20 == 0).count() == 0


def _one_dense_group(n, d, cosine, seed):
    """Unit vectors, a third of them distinct members of one group of that mean cosine."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    m = n // 3
    x[:m] = x[0] + math.sqrt((1 / cosine - 1) / d) * rng.normal(size=(m, d))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def test_neighbours_within_a_dense_group(spark):
    from tierwise.llm.nn_descent import nearest
    x = _one_dense_group(1500, 32, 0.9998, 9)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for r in nearest(df, 20, (F.col("id") % 20 == 0) & (F.col("id") < 500)).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    x = x.astype(np.float64)
    hits = 0
    for q, found in got.items():
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(found & set(np.argsort(-s)[:20].tolist()))
    assert len(got) == 25 and hits / (20 * 25) >= 0.98


def test_graph_is_built_until_few_lists_change(spark, monkeypatch):
    from tierwise.llm import nn_descent as N
    monkeypatch.setattr(N, "CELL", 8)                       # so that the start is far from exact
    x = _one_dense_group(1500, 24, 0.975, 10).astype(np.float64)
    nodes = spark.createDataFrame([(i, x.shape[1], bytearray(r.tobytes())) for i, r in enumerate(x)],
                                  "node long, dim int, v binary")
    hits = 0
    for r in N.build_graph(nodes, len(x)).collect():
        s = x @ x[r.a]
        s[r.a] = -np.inf
        hits += len(set(np.frombuffer(r.b, np.int64).tolist()) & set(np.argsort(-s)[:N.DEGREE].tolist()))
    assert hits / (N.DEGREE * len(x)) >= 0.97


def _texts(seed, n):
    rnd = random.Random(seed)
    alphabets = {"en": ["the", "ing", "tion", "er", "wh"], "fr": ["é", "eau", "ou", "qu", "ment"], "de": ["sch", "ü", "ung", "ein", "ß"]}
    return [(i, lang, " ".join("".join(rnd.choice(alphabets[lang]) for _ in range(rnd.randint(1, 4))) for _ in range(40)))
            for i, lang in enumerate(rnd.choice(list(alphabets)) for _ in range(n))]


def test_language_id(spark):
    from tierwise.llm.langid import identify, train
    docs = spark.createDataFrame([(i, t, x) for i, x, t in _texts(1, 90)] + [(900, None, "en"), (901, "x", None)],
                                 "doc_id long, text string, lang string")
    held_out = _texts(2, 60)
    pages = [(i, f"http://h{i % 4}.example.{'fr' if x == 'fr' else 'com'}/{x}/1", f"<html lang='{x}'><script>the</script><p>{t}")
             for i, x, t in held_out]
    pages += [(500, "http://h.example.com/fr/2", "<html lang=fr></html>"), (501, None, None), (502, "http://[bad", "<p>the thing</p>")]
    df = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, host string")
    got = {r.page_id: r for r in identify(df, train(docs)).collect()}
    assert len(got) == len(pages)
    assert sum(got[i].text_lang == x for i, x, _ in held_out) >= 0.95 * len(held_out)
    assert sum(got[i].lang == x for i, x, _ in held_out) >= 0.95 * len(held_out)
    assert got[500].lang == "fr"                            # no text: the other evidence decides
    assert got[501].lang is not None and 0 < got[501].posterior <= 1 and got[502].text_lang == "en"
    assert train(docs.where("false")) is None and identify(df, None).where("lang is not null").count() == 0
    assert identify(df.where("false"), train(docs)).count() == 0


def test_rows_that_share_an_id_lose_no_row(spark):
    from tierwise.llm.nn_descent import nearest
    a, b, c, q = [1.0, 0.0], [0.0, 1.0], [0.6, 0.8], [1.0, 1.0]
    df = spark.createDataFrame([(5, a), (5, b), (7, b), (8, a), (9, c), (20, q), (20, [2.0, 0.0])], "vec_id long, embedding array<float>")
    got = [(r.rank, r.vec_id, round(r.score, 6)) for r in sorted(nearest(df, 20, F.col("id") == 20).collect(), key=lambda r: r.rank)]
    assert got == [(1, 5, 2.0), (2, 8, 2.0), (3, 9, 1.4), (4, 7, 1.0)]


def test_large_components_score_exactly(spark):
    from tierwise.llm.exact_topk import top_k
    big = 2.0 ** 20
    df = spark.createDataFrame([(100, [1.0, 1.0]), (1, [3e6, 0.0]), (2, [1.0, 0.0]), (200, [big, 3.0]), (3, [1024.5, -2.0])],
                               "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id): r.score for r in top_k(df, 10, F.col("id") % 100 == 0).collect()}
    vec = {r.vec_id: [math.floor(1024 * x) for x in r.embedding] for r in df.collect()}
    assert got[100, 1] == 3_145_728_000_000
    assert got == {(q, i): sum(x * y for x, y in zip(vec[q], vec[i])) for q in (100, 200) for i in vec if i != q}
    with pytest.raises(Exception):                      # no long holds this score
        top_k(spark.createDataFrame([(100, [2.0 ** 30]), (1, [2.0 ** 30])], "vec_id long, embedding array<double>"), 1,
              F.col("id") == 100).collect()


def test_every_language_label_is_modelled(spark):
    from tierwise.llm.langid import identify, train
    rows = [(i, " ".join(chr(97 + j % 26) + chr(97 + (i * 7 + j) % 26) + chr(97 + i % 26) for j in range(60)), f"l{i:02d}") for i in range(70)]
    model = train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.langs == [r[2] for r in rows]
    pages = spark.createDataFrame([(i, f"http://h{i}.org/", f"<p>{t}</p>") for i, t, _ in rows], "page_id long, url string, html string")
    got = {r.page_id: r.lang for r in identify(pages, model).collect()}
    assert sum(got[i] == lang for i, _, lang in rows) == 70

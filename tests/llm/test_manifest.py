"""The manifest against a tree written out in plain Python."""
import hashlib
import zlib

import pytest
from llm_data import documents, empty


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, text):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, r.n_chars, text)))


def grow(hashes):
    """(root, proof of each node: per level the digests left and right of it)."""
    proofs, place = [[] for _ in hashes], list(range(len(hashes)))
    while len(hashes) > 1:
        runs = [hashes[i:i + 3] for i in range(0, len(hashes), 3)]
        for i, p in enumerate(place):
            run, j = runs[p // 3], p % 3
            proofs[i].append((run[:j], run[j + 1:]))
            place[i] = p // 3
        hashes = [h(*run) for run in runs]
    return hashes[0], proofs


def expected(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r.source, []).append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by_source[s].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
        trees[s] = grow([leaf(r, r.text) for r in by_source[s]])
    root, above = grow([trees[s][0] for s in order])
    out = []
    for s, up in zip(order, above):
        for r, own in zip(by_source[s], trees[s][1]):
            path = own + up
            cur = leaf(r, r.text)
            if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and r.text is not None:
                cur = leaf(r, r.text.replace("\n", ""))
            for a, b in path:
                cur = h(*a, cur, *b)
            out.append((r.doc_id, leaf(r, r.text), trees[s][0], root, h(*(x for a, b in path for x in a + b)), cur, cur == root))
    return sorted(map(str, out))


@pytest.mark.parametrize("pick", ["true", "source = 'a'", "doc_id = 100", "doc_id is null", "doc_id in (100, 101)",
                                  "doc_id between 4 and 13", "source is null"])
def test_manifest(spark, pick):
    from tierwise.llm.manifest import RESULT, manifest
    docs = documents(spark, extra=[(200 + i, "x\ny" * i, "en", f"s{i}") for i in range(12)]).where(pick)
    got = manifest(docs)
    assert got.columns == list(RESULT)
    assert sorted(str(tuple(r)) for r in got.collect()) == expected(docs.collect())


def test_deep_tree_of_one_hot_source(spark, monkeypatch):
    """Several doublings, and salted joins, with two thirds of the rows in one source."""
    from pyspark.sql import functions as F
    from tierwise.llm import manifest as M
    monkeypatch.setattr(M, "PER_SALT", 2)
    docs = spark.range(1500).select(F.col("id").alias("doc_id"), F.concat(F.lit("t\n"), F.col("id")).alias("text"), F.lit("en")
                                    .alias("lang"), F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 40))
                                    .alias("source"), F.lit(3).cast("long").alias("n_chars"))
    got = M.manifest(docs).collect()
    assert sorted(str(tuple(r)) for r in got) == expected(docs.collect())
    assert 0 < sum(r.verified for r in got) < 1500


def test_empty_manifest(spark):
    from tierwise.llm.manifest import RESULT, manifest
    got = manifest(empty(spark))
    assert got.columns == list(RESULT) and got.count() == 0


def test_sql_agrees_with_the_plain_tree(spark, tmp_path):
    import duckdb
    from tierwise.llm.manifest import OP12_SQL
    docs = documents(spark).select("doc_id", "text", "lang", "source", "n_chars")
    docs.toPandas().to_parquet(tmp_path / "d.parquet")
    docs = spark.read.parquet(str(tmp_path / "d.parquet")).selectExpr("cast(doc_id as long) doc_id", "text", "lang", "source", "n_chars")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * REPLACE (CAST(doc_id AS BIGINT) AS doc_id) FROM '{tmp_path}/d.parquet'")
    assert sorted(map(str, con.execute(OP12_SQL).fetchall())) == expected(docs.collect())

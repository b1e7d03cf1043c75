"""Operator 12: Merkle manifest of a dataset, with a proof for every row by pointer jumping.

*Tree.* Every row of ``documents`` is a leaf, the hash of its columns. The leaves of a source, ascending by doc_id, are grouped by
three into parents until one node is left, the source's subroot; the subroots, by source, are grouped likewise up to the root.
Leaves are numbered over sorted ranges of (source, doc_id) in many tasks, whatever a source's share of the rows; a level is one
grouping by (source, position div 3), so a group has three rows at most, and each level is written before the next.

*Proofs.* Each node starts with a pointer to its parent and the segment of its siblings' digests. In every round a node whose
pointer isn't the root joins the node that it points at, takes over that node's pointer and appends its segment: the distance
doubles until every leaf points at the root, after as many rounds as the logarithm of the tree's height. A node is kept for
a round only if it lies high enough to be pointed at over that distance. As up to ``3**distance`` nodes point at one, the joins
are salted in proportion.

*Verification.* A proof folds a leaf's hash with its segment, sibling by sibling, into the root. Where a row was tampered with, its
leaf is hashed anew and folded with the original siblings; ``verified`` tells whether that gives the root.

Edge cases: NULL columns hash as ``-`` (an empty text as ``0:``); NULL source is a source of its own, ordered first; NULL doc_id comes
first in its source and is never tampered with; rows that share source and doc_id are ordered by their leaf hash, and
repeated rows are leaves of their own; a lone leaf is its source's subroot, a lone subroot the root, with an empty proof; other
columns are never read; an empty table has no root and gives an empty result. Digests travel as 32 bytes and are shown as hex.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.keys import sorted_ranges
from .common import materialise, read_table

FANOUT = 3
#: Nodes of one salt that may point at one node, and the most salts of a round.
PER_SALT, MAX_SALTS = 81, 4096
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: (tree, level, position): the tree is a source's, or that of the subroots, whose name is the empty text.
KEY = "struct<tree: string, level: int, pos: long>"
RESULT = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def digest(text: Column) -> Column:
    """SHA-256 as 32 bytes."""
    return F.unhex(F.sha2(text, 256))


def hexed(value: Column) -> Column:
    return F.lower(F.hex(value))


def leaf_hash(**changed: Column) -> Column:
    """Digest of a row's columns, each as ``byte count:value`` or ``-``; ``changed`` replaces columns."""
    def part(name: str) -> Column:
        value = changed.get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))
    return digest(F.concat(*map(part, LEAF_COLUMNS)).cast("binary"))


def without_line_breaks() -> tuple[Column, Column]:
    """(rows tampered with, their text): where 2 divides the CRC-32 of the decimal doc_id, ``\\n`` is deleted from the text."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))


def _tree_name(source: str) -> Column:
    """Never NULL or empty; NULL comes first, then sources bytewise."""
    return F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("n"))


def _positions(rows: DataFrame, tree: str, order: list[Column]) -> DataFrame:
    """``rows`` with ``pos`` (from 0) and ``n`` of their tree along ``order``."""
    ranked = sorted_ranges(rows, [F.col(tree), *order], "part", "place")
    # One row per range and tree in it: at most as many rows of a tree as there are ranges.
    runs = ranked.groupBy(tree, "part").agg(F.min("place").alias("start"), F.count(F.lit(1)).alias("m"))
    before = Window.partitionBy(tree).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(tree, "part", (F.coalesce(F.sum("m").over(before), F.lit(0)) - F.col("start")).alias("shift"),
                       F.sum("m").over(Window.partitionBy(tree)).alias("n"))
    return ranked.join(runs, [tree, "part"]).withColumn("pos", F.col("place") + F.col("shift")) \
        .drop("part", "place", "shift")


def _level(nodes: DataFrame, level: int, subroots: bool) -> DataFrame:
    """Parents of ``nodes`` (tree, pos, n, hash, height, own, doc): (tree, level, pos, n, kids)."""
    kid = F.struct("pos", "hash", "height", "own", "doc")
    kids = F.transform(F.array_sort(F.collect_list(kid)), lambda k: F.struct(
        k["hash"].alias("hash"), k["height"].alias("height"), k["own"].alias("own"), k["doc"].alias("doc"),
        F.when(F.lit(subroots), k["hash"]).alias("subroot")))
    return nodes.groupBy("tree", F.floor(F.col("pos") / FANOUT).cast("long").alias("parent")).agg(
        kids.alias("kids"), F.any_value("n").alias("n")).select(
        "tree", F.lit(level + 1).alias("level"), F.col("parent").alias("pos"),
        F.ceil(F.col("n") / FANOUT).cast("long").alias("n"), "kids")


def _nodes(parents: DataFrame) -> DataFrame:
    """Rows of :func:`_level` as nodes of the next level."""
    return parents.select(
        "tree", "pos", "n", digest(F.array_join(F.transform("kids", lambda k: hexed(k["hash"])), "").cast("binary")).alias("hash"),
        (F.array_max(F.transform("kids", lambda k: k["height"])) + 1).alias("height"),
        F.struct("tree", "level", "pos").cast(KEY).alias("own"),
        F.lit(None).cast("struct<doc_id: bigint, tampered: binary>").alias("doc"))


def _climb(nodes: DataFrame, rounds: int, subroots: bool) -> tuple[list[DataFrame], list[DataFrame]]:
    """(parent tables of all levels, tables of the nodes that are left alone in their tree)."""
    parents, tops = [], []
    for level in range(rounds):
        tops.append(nodes.where("n = 1"))
        parents.append(materialise(_level(nodes.where("n > 1"), level, subroots and level == 0), "manifest_level"))
        nodes = _nodes(parents[-1])
    return parents, [*tops, nodes]


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _levels(n: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    out = 0
    while n > 1:
        n, out = -(-n // FANOUT), out + 1
    return out


def _edges(parents: DataFrame) -> DataFrame:
    """(own, to, segment, hash, height, doc) of every child: its siblings, in order, on both of its sides."""
    def others(keep) -> Column:
        return F.array_join(F.transform(F.filter("kids", keep), lambda k: hexed(k["hash"])), "")
    kids = parents.select("kids", F.struct("tree", "level", "pos").cast(KEY).alias("to"), F.posexplode("kids").alias("i", "kid"))
    sides = [F.unhex(others(lambda k, j: j < F.col("i"))), F.unhex(others(lambda k, j: j > F.col("i")))]
    return kids.select("kid.own", "to", F.array(F.struct(sides[0].alias("left"), sides[1].alias("right"), F.col("kid.subroot")
                                                         .alias("subroot"))).alias("segment"),
                       "kid.hash", "kid.height", "kid.doc")


def _jump(rows: DataFrame, inner: DataFrame, salts: int) -> DataFrame:
    """``rows`` with the pointers of the nodes that they point at, and their segments appended."""
    left = rows.withColumn("salt", F.pmod(F.xxhash64("own"), F.lit(salts)).cast("int"))
    right = inner.select(F.col("own").alias("at"), F.col("to").alias("next"), F.col("segment").alias("more")) \
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, (F.col("to") == F.col("at")) & (left["salt"] == right["salt"])).select(
        "own", F.col("next").alias("to"), F.concat("segment", "more").alias("segment"), "hash", "height", "doc")


def build(rows: DataFrame) -> tuple[DataFrame, str, bytes] | None:
    """(leaf edges that reach the root, root, key of the root) for (tree, doc_id, leaf, tampered); None without rows."""
    placed = materialise(_positions(rows, "tree", [F.col("doc_id").asc_nulls_first(), F.col("leaf")]).select(
        "tree", "pos", "n", F.col("leaf").alias("hash"), F.lit(0).alias("height"),
        F.struct("tree", F.lit(0).alias("level"), "pos").cast(KEY).alias("own"), F.struct("doc_id", "tampered").alias("doc")),
        "manifest_leaves")
    largest = placed.agg(F.max("n")).first()[0]
    if largest is None:
        return None
    parents, tops = _climb(placed, _levels(largest), False)
    subroots = materialise(_union(tops).withColumnRenamed("tree", "source").drop("pos", "n").withColumn("tree", F.lit("")),
                           "manifest_subroots")
    placed = materialise(_positions(subroots, "tree", [F.col("source")]).drop("source"), "manifest_subroots")
    above, tops = _climb(placed, _levels(placed.count()), True)
    top = materialise(_union(tops), "manifest_root")
    root = top.first()
    edges = [_edges(p) for p in (*parents, *above)]
    # A lone leaf is the root: it has no edge, and an empty segment.
    alone = top.where(F.col("doc").isNotNull()).select(
        "own", F.col("own").alias("to"), F.array().cast("array<struct<left: binary, right: binary, subroot: binary>>")
        .alias("segment"), "hash", "height", "doc")
    return _proofs(_union([*edges, alone]), root["own"], root["height"]), root["hash"]


def _proofs(edges: DataFrame, root, height: int) -> DataFrame:
    """The leaves' edges, each led to the root by pointer jumping."""
    end = F.struct(F.lit(root["tree"]).alias("tree"), F.lit(root["level"]).alias("level"), F.lit(root["pos"]).alias("pos")).cast(KEY)
    edges = materialise(edges, "manifest_edges")
    leaves, inner = edges.where("height = 0"), edges.where("height > 0")
    done, distance = [], 1
    while distance < height:
        salts = min(max(1, FANOUT ** distance // PER_SALT), MAX_SALTS)
        at = inner.where(F.col("height") >= distance)
        done.append(leaves.where(F.col("to") == end))
        leaves = materialise(_jump(leaves.where(F.col("to") != end), at, salts), "manifest_jump")
        # Nodes that nothing can point at over the doubled distance are dropped.
        high = at.where(F.col("height") >= 2 * distance)
        inner = materialise(high.where(F.col("to") == end).unionByName(_jump(high.where(F.col("to") != end), at, salts)),
                            "manifest_inner")
        distance *= 2
    return _union([*done, leaves])


def manifest(documents: DataFrame, tampering=without_line_breaks) -> DataFrame:
    """One row per document: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` (digests in hex).

    ``tampering`` gives the condition under which a row's text was changed after the manifest was made, and the changed text.
    """
    spark = documents.sparkSession
    kind = dict(documents.dtypes)["doc_id"]
    changed, text = tampering()
    rows = documents.select(_tree_name("source").alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf_hash().alias("leaf"),
                            F.when(changed, leaf_hash(text=text)).alias("tampered"))
    built = build(materialise(rows, "manifest_rows"))
    schema = ", ".join([f"doc_id {kind}", *(f"{c} string" for c in RESULT[1:-1]), "verified boolean"])
    if built is None:
        return spark.createDataFrame([], schema)
    proofs, root = built
    folded = F.aggregate("segment", hexed(F.coalesce("doc.tampered", "hash")), lambda h, s: F.sha2(
        F.concat(hexed(s["left"]), h, hexed(s["right"])).cast("binary"), 256))
    siblings = F.array_join(F.transform("segment", lambda s: F.concat(hexed(s["left"]), hexed(s["right"]))), "")
    root_hex = F.lit(bytes(root).hex())
    subroot = F.filter("segment", lambda s: s["subroot"].isNotNull())
    return proofs.select(
        F.col("doc.doc_id").cast(kind).alias("doc_id"), hexed(F.col("hash")).alias("leaf"),
        F.coalesce(hexed(F.get(subroot, F.lit(0))["subroot"]), root_hex).alias("subroot"), root_hex.alias("root"),
        F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"), folded.alias("folded_root")) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    return manifest(read_table(spark, sf_dir, "documents"))


_PARTS = " || ".join(f"coalesce(strlen(CAST({{{c}}} AS VARCHAR)) || ':' || CAST({{{c}}} AS VARCHAR), '-')" for c in LEAF_COLUMNS)
_LEAF = "sha256(" + _PARTS.format(**{c: c for c in LEAF_COLUMNS}) + ")"
_TAMPERED = "sha256(" + _PARTS.format(**{c: c for c in LEAF_COLUMNS} | {"text": "replace(text, chr(10), '')"}) + ")"
#: CRC-32, bit by bit over the decimal digits of an id.
CRC32_SQL = ("xor(list_reduce([CAST(4294967295 AS BIGINT)] || flatten(list_transform(string_split(CAST({c} AS VARCHAR), ''), "
             "lambda ch: list_transform(range(8), lambda i: CAST((ascii(ch) >> CAST(i AS INTEGER)) & 1 AS BIGINT)))), "
             "lambda c, b: xor(c >> 1, CAST(3988292384 AS BIGINT) * (xor(c, b) & 1))), CAST(4294967295 AS BIGINT))")

OP12_SQL = f"""
WITH RECURSIVE rows AS (
  SELECT doc_id, source, {_LEAF} AS leaf, CASE WHEN {CRC32_SQL.format(c='doc_id')} % 2 = 0 THEN {_TAMPERED} END AS tampered
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER () AS id, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY source) AS n FROM rows),
low AS (
  SELECT source, 0 AS lvl, pos, n, leaf AS h FROM leaves
  UNION ALL
  SELECT source, lvl + 1, pos // 3, (any_value(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY pos))
  FROM low WHERE n > 1 GROUP BY source, lvl, pos // 3),
subroots AS (
  SELECT source, lvl AS top, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM low WHERE n = 1),
high AS (
  SELECT 0 AS lvl, pos, n, h FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 3, (any_value(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY pos))
  FROM high WHERE n > 1 GROUP BY lvl, pos // 3),
nodes AS (
  SELECT l.source, l.lvl, l.pos, l.h FROM low l WHERE l.n > 1
  UNION ALL
  SELECT s.source, s.top + h.lvl, h.pos, h.h FROM subroots s JOIN high h ON h.n > 1),
climb AS (
  SELECT l.id, l.source, 0 AS lvl, l.pos, coalesce(l.tampered, l.leaf) AS cur, '' AS proof FROM leaves l
  UNION ALL
  SELECT c.id, any_value(c.source), any_value(c.lvl) + 1,
         any_value(c.pos) // 3, sha256(string_agg(CASE WHEN k.pos = c.pos THEN c.cur ELSE k.h END, '' ORDER BY k.pos)),
         any_value(c.proof) || coalesce(string_agg(k.h, '' ORDER BY k.pos) FILTER (WHERE k.pos <> c.pos), '')
  FROM (SELECT c.id, c.source, c.lvl, CASE WHEN c.lvl = s.top THEN s.pos ELSE c.pos END AS pos, c.cur, c.proof
        FROM climb c JOIN subroots s ON s.source IS NOT DISTINCT FROM c.source) c
  JOIN nodes k ON k.source IS NOT DISTINCT FROM c.source AND k.lvl = c.lvl AND k.pos // 3 = c.pos // 3
  GROUP BY c.id)
SELECT l.doc_id, l.leaf, s.h AS subroot, r.h AS root, sha256(c.proof) AS proof_sha256, c.cur AS folded_root,
       c.cur = r.h AS verified
FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source
JOIN (SELECT id, arg_max(cur, lvl) AS cur, arg_max(proof, lvl) AS proof FROM climb GROUP BY id) c ON c.id = l.id
JOIN high r ON r.n = 1"""

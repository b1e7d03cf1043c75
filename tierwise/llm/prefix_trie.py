"""Operator 13: prefix trie of conversations as burst tries.

*Suffixes.* A turn is the digest of its role and text; a conversation is the binary string of its turns' digests, so that
bytewise order is trie order and a prefix of turns is a prefix of bytes. Conversations that are alike are one row: their ids are
joined in blocks of ids (``ID_BLOCK`` consecutive values), which any number of tasks do at once, and a stream over the sorted
blocks hashes them, holding one block.

*Bursting.* At first all suffixes lie in one container under the root. A container of more than ``CONTAINER`` rows is burst:
its head becomes a node, and each suffix goes to the container of its next turn, under a head one turn deeper. The joins that mark
the rows of oversized containers are salted, so a turn that opens a third of all conversations is dealt over many tasks. There are as many
rounds as the deepest oversized head has turns, and only rows of oversized containers go on.

*Sweep.* The containers that remain are dealt over tasks by head, sorted, and swept once into nodes: a suffix opens the nodes that it
doesn't share with its predecessor. What a container adds up to goes to its head's parent, and the burst heads are summed from the deepest to the
root, with partial aggregation, since a head may have any number of children.

The unit of work is one conversation (its turns' digests, 16 bytes each) and a container of at most ``CONTAINER`` distinct ones.

Edge cases: NULL role or text is the empty text; turns are ordered by number, NULL first, those that share one by digest; repeated
rows are turns of their own; rows with NULL conv_id belong to no conversation and are left out; a conversation whose base is
absent starts with its own turns after the first h; a turnless one ends at the root; an empty table has no members and hence no nodes; other
columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, read_table
from .manifest import CRC32_SQL

WORD = r"[^\x20\x09-\x0D]+"
#: Conversations that share a base, and the number of openings that the hash of an id picks from.
FAMILY, OPENINGS = 20, 4
#: Bytes of a turn's digest, distinct suffixes per container, consecutive ids per block, salts of a hot head.
TURN, CONTAINER, ID_BLOCK, SALTS = 16, 1024, 4096, 64
NO_ENDS = hashlib.sha256(b"").hexdigest()
NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def _short(text: Column) -> Column:
    """First 16 bytes of the SHA-256."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 2 * TURN))


def turn_lists(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns array<struct<turn, id, words>>) in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn = F.struct(F.col("turn"), _short(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
                    .alias("id"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"),
                                                                    turn.alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuild(lists: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's first h turns replaced by those of its family's first; h from its id's CRC-32."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % OPENINGS).cast("int")
    bases = lists.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base"),
                                                               F.slice("turns", 1, OPENINGS - 1).alias("opening"))
    joined = lists.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY).join(bases, "base", "left")
    own = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    opening = F.slice("opening", F.lit(1), h)
    return joined.select("conv_id", F.coalesce(F.concat(opening, own), own).alias("turns"))


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted blocks (ids, words, block, ids joined, n, first) -> one row per sequence with the hash of all its ids."""
    held = sha = None
    out: list[tuple] = []

    def batch():
        cols = list(zip(*out)) or [()] * 5
        types = (pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                          names=["ids", "words", "n", "first", "ends"])
    for b in batches:
        for ids, words, joined, n, first in zip(*(b.column(c).to_pylist() for c in ("ids", "words", "joined", "n", "first"))):
            if held is not None and held[0] == ids:
                sha.update(b"," + joined.encode())
                held[2] += n
            else:
                if held is not None:
                    out.append((*held, sha.hexdigest()))
                held, sha = [ids, words, n, first], hashlib.sha256(joined.encode())
        yield batch()
        out = []
    if held is not None:
        out.append((*held, sha.hexdigest()))
    yield batch()


def sequences(rebuilt: DataFrame) -> DataFrame:
    """Distinct conversations: (ids, words, n conversations, first of them, ends)."""
    ids = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["id"])), ""))
    rows = rebuilt.select("conv_id", ids.alias("ids"), F.transform("turns", lambda t: t["words"]).alias("words"))
    blocks = rows.groupBy("ids", "words", F.floor(F.col("conv_id") / ID_BLOCK).alias("block")) \
        .agg(F.sort_array(F.collect_list("conv_id")).alias("convs")).select(
            "ids", "words", "block", F.array_join(F.col("convs").cast("array<string>"), ",").alias("joined"),
            F.size("convs").cast("long").alias("n"), F.col("convs")[0].alias("first"))
    return blocks.repartition("ids").sortWithinPartitions("ids", "block").mapInArrow(
        _merge, "ids binary, words array<long>, n long, first long, ends string")


# ------------------------------------------------------------------ bursting

def _mark(rows: DataFrame, oversized: DataFrame) -> DataFrame:
    """``rows`` with ``big``: whether their container is oversized."""
    salted = oversized.select("key", F.lit(True).alias("big"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return rows.withColumn("salt", F.pmod(F.xxhash64("ids"), F.lit(SALTS)).cast("int")).join(salted, ["key", "salt"], "left") \
        .drop("salt").withColumn("big", F.coalesce("big", F.lit(False)))


def burst(suffixes: DataFrame, container: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """(containers left, heads burst), a frame a round; containers: (key, parent, depth, ids, words, n, first, ends)."""
    rows = suffixes.withColumns({"key": F.lit(b""), "parent": F.lit(None).cast("binary"), "depth": F.lit(0)})
    left, heads = [], []
    while True:
        oversized = materialise(rows.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > container), "trie_oversized")
        if oversized.isEmpty():
            return [*left, rows], heads
        marked = materialise(_mark(rows, oversized), "trie_marked")
        left.append(marked.where(~F.col("big")).drop("big"))
        rows = marked.where("big").drop("big")
        ended = F.octet_length("ids") == TURN * F.col("depth")
        heads.append(materialise(rows.groupBy("key").agg(
            F.max("parent").alias("parent"), F.max("depth").alias("depth"),
            F.max(F.coalesce(F.try_element_at("words", F.when(F.col("depth") > 0, F.col("depth"))), F.lit(0))).alias("last"),
            F.max(F.when(ended, F.struct("n", "first", "ends"))).alias("end")), "trie_heads"))
        turn = F.substring(F.col("ids"), TURN * F.col("depth") + 1, F.lit(TURN))
        rows = materialise(rows.where(~ended).withColumns({
            "key": _short(F.concat("key", turn)), "parent": F.col("key"), "depth": F.col("depth") + 1}), "trie_suffixes")


# ------------------------------------------------------------------ sweep

def sweep(rows: list[tuple], top: int) -> list[tuple]:
    """Nodes of one container under a head ``top`` turns deep, the head first, each as (conv_id, depth, parent's conv_id,
    members, children, leaves, saved tokens, ends); ``rows`` are (ids, words, n, first, ends) ascending by ids."""
    last = rows[0][1][top - 1] if top else 0
    depth, parent, members, low, kids, leaves, tokens, ends = [top], [-1], [0], [None], [0], [0], [last], [NO_ENDS]
    path, before = [0], b""
    for ids, words, n, first, end in rows:
        m, shared = len(ids) // TURN, top
        most = min(m, len(before) // TURN)
        while shared < most and ids[shared * TURN: (shared + 1) * TURN] == before[shared * TURN: (shared + 1) * TURN]:
            shared += 1
        del path[shared - top + 1:]
        for d in range(shared, m):
            kids[path[-1]] += 1
            for column, value in zip((depth, parent, members, low, kids, leaves, tokens, ends),
                                     (d + 1, path[-1], 0, None, 0, 0, words[d], NO_ENDS)):
                column.append(value)
            path.append(len(depth) - 1)
        at, before = path[-1], ids
        members[at], low[at], ends[at] = n, first, end
    # Children follow their parents, so every node is complete when its turn comes from the back.
    for i in range(len(depth) - 1, -1, -1):
        leaves[i] += kids[i] == 0
        tokens[i] = (members[i] - 1) * tokens[i]
        p = parent[i]
        if p >= 0:
            members[p] += members[i]
            leaves[p] += leaves[i]
            low[p] = low[i] if low[p] is None else min(low[p], low[i])
    for i in range(len(depth) - 1, 0, -1):
        tokens[parent[i]] += tokens[i]
    return [(low[i], depth[i], low[parent[i]] if parent[i] >= 0 else None, members[i], kids[i], leaves[i], tokens[i], ends[i])
            for i in range(len(depth))]


_SWEPT = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, " \
         "ends_sha256 string, top boolean, parent binary"


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffixes sorted by (key, ids) -> nodes; a container's head is marked ``top``."""
    key, rows, out = None, [], []

    def close():
        head, top, parent = key
        out.extend((*node, i == 0, parent if i == 0 else None) for i, node in enumerate(sweep(rows, top)))

    def batch():
        cols = list(zip(*out)) or [()] * 10
        types = [pa.int64()] * 7 + [pa.string(), pa.bool_(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                          names=[f.split()[0] for f in _SWEPT.split(", ")])
    for b in batches:
        columns = [b.column(c).to_pylist() for c in ("key", "depth", "parent", "ids", "words", "n", "first", "ends")]
        for *own, ids, words, n, first, ends in zip(*columns):
            if own != key:
                if rows:
                    close()
                if len(out) > 20_000:
                    yield batch()
                    out = []
                key, rows = own, []
            rows.append((ids, words, n, first, ends))
    if rows:
        close()
    yield batch()


def _up(heads: DataFrame, children: DataFrame) -> DataFrame:
    """Burst heads with what their children add up to."""
    sums = children.groupBy("parent").agg(
        F.sum("n_convs").alias("n"), F.min("conv_id").alias("low"), F.count(F.lit(1)).alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved")).withColumnRenamed("parent", "key")
    n = F.col("n") + F.coalesce("end.n", F.lit(0))
    return heads.join(sums, "key").select(
        "key", "parent", F.least("low", "end.first").alias("conv_id"), F.col("depth").cast("long").alias("depth"), n.alias("n_convs"),
        "n_children", "n_leaves", (F.col("saved") + (n - 1) * F.col("last")).alias("saved_tokens"),
        F.coalesce("end.ends", F.lit(NO_ENDS)).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame, container: int = CONTAINER) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations, with the columns of :data:`NODE`."""
    lists = materialise(turn_lists(conversations), "trie_turns")
    left, heads = burst(materialise(sequences(rebuild(lists)), "trie_sequences"), container)
    rows = left[0]
    for more in left[1:]:
        rows = rows.unionByName(more)
    swept = materialise(rows.repartition("key").sortWithinPartitions("key", "ids").mapInArrow(_sweep, _SWEPT), "trie_swept")
    own = [c for c in NODE if c != "parent_conv_id"]
    tops = swept.where("top").select("parent", *own)
    done, below = [], None
    for depth in range(len(heads) - 1, -1, -1):
        children = tops.where(F.col("depth") == depth + 1)
        if below is not None:
            children = children.unionByName(below.select("parent", *own))
        below = materialise(_up(heads[depth], children), "trie_up")
        done.append(below)
    inner = swept.where(~F.col("top")).select(*NODE)
    if not done:
        return inner.unionByName(swept.where("top").select(*NODE))
    burst_heads = done[0]
    for more in done[1:]:
        burst_heads = burst_heads.unionByName(more)
    known = burst_heads.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"),
                               F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    hung = tops.unionByName(burst_heads.select("parent", *own)).withColumn("salt", F.pmod(F.xxhash64("conv_id"), F.lit(SALTS)).cast("int"))
    return inner.unionByName(hung.join(known, ["parent", "salt"], "left").select(*NODE))


def op13_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(read_table(spark, sf_dir, "conversations"))


OP13_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS w
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, list({{'k': k, 'w': w}} ORDER BY turn NULLS FIRST, k) AS s, {CRC32_SQL.format(c='conv_id')} % {OPENINGS} AS h
  FROM t GROUP BY conv_id),
rebuilt AS (
  SELECT c.conv_id, CASE WHEN c.h = 0 THEN c.s ELSE coalesce(b.s[1:c.h], []) || c.s[c.h + 1:] END AS s
  FROM c LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % {FAMILY}),
p AS (
  SELECT conv_id, d, sha256(array_to_string(list_transform(s[1:d], lambda x: x.k), ',')) AS path,
         sha256(array_to_string(list_transform(s[1:d - 1], lambda x: x.k), ',')) AS up,
         CASE WHEN d > 0 THEN s[d].w ELSE 0 END AS w, len(s) = d AS ends
  FROM (SELECT conv_id, s, unnest(range(len(s) + 1)) AS d FROM rebuilt)),
n AS (
  SELECT d, path, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(w) AS w,
         sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM p GROUP BY d, path),
kids AS (SELECT d - 1 AS d, up AS path, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
-- every node below (or at) a node, through one member of the lower one
under AS (
  SELECT a.d, a.path, n.n_convs, n.w, k.n_children
  FROM n JOIN p a ON a.conv_id = n.conv_id AND a.d <= n.d LEFT JOIN kids k ON k.d = n.d AND k.path = n.path),
sums AS (
  SELECT d, path, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves,
         CAST(sum((n_convs - 1) * w) AS BIGINT) AS saved_tokens FROM under GROUP BY ALL)
SELECT n.conv_id, n.d AS depth, m.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves,
       s.saved_tokens, n.ends_sha256
FROM n JOIN sums s ON s.d = n.d AND s.path = n.path LEFT JOIN kids k ON k.d = n.d AND k.path = n.path
LEFT JOIN n m ON m.d = n.d - 1 AND m.path = n.up"""

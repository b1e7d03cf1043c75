"""The trie against plain Python over all prefixes."""
import hashlib
import random
import re
import zlib

import pytest

SCHEMA = "conv_id long, turn long, role string, text string, depth int, parent string"


def _rows(n=130, seed=4):
    rnd = random.Random(seed)
    out = []
    for c in rnd.sample(range(-40, 400), n):
        for t in range(rnd.choice([0, 1, 2, 2, 3, 5])):
            text = rnd.choice(["hello there", "yes", "a  b\tc", None, "", "no no"]) if t < 3 else f"own {c} {t}"
            out.append((c, t if rnd.random() > 0.1 else None, rnd.choice(["user", "user", None]), text))
    out += [(400 + i, t, "user", "same words here") for i in range(30) for t in range(4)]        # copies
    out += [(500 + i, t, "user", f"hot {t}" if t < 3 else f"{i}") for i in range(30) for t in range(4)]
    out += [(600, t, "u", f"long {t}") for t in range(150)]
    out += [(700, 1, "a", "b"), (700, 1, "a", "b"), (701, 1, "ab", ""), (702, 1, "a", "c"), (702, 1, "a", "b"), (None, 1, "a", "b")]
    return out


def expected(rows):
    def turn(role, text):
        role, text = role or "", text or ""
        return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest(), \
            len(re.findall(r"[^\x20\x09-\x0D]+", text))
    lists = {}
    for c, t, role, text in rows:
        if c is not None:
            lists.setdefault(c, []).append((t is not None, t or 0, *turn(role, text)))
    lists = {c: [x[2:] for x in sorted(v)] for c, v in lists.items()}
    nodes = {}
    for c, own in lists.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        s = tuple(lists.get(base, [])[:h] + own[h:])
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append((c, d == len(s)))
    kids = {}
    for s in nodes:
        if s:
            kids.setdefault(s[:-1], []).append(s)
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for s, m in nodes.items():
        for d in range(len(s) + 1):
            leaves[s[:d]] += s not in kids
            saved[s[:d]] += (len(m) - 1) * (s[-1][1] if s else 0)
    return sorted(str((min(m)[0], len(s), min(nodes[s[:-1]])[0] if s else None, len(m), len(kids.get(s, [])), leaves[s], saved[s],
                       hashlib.sha256(",".join(str(c) for c, e in sorted(m) if e).encode()).hexdigest()))
                  for s, m in nodes.items())


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "clash") for r in rows], SCHEMA)


@pytest.mark.parametrize("container", [1, 7, 40, 1024])
def test_prefix_trie(spark, container):
    from tierwise.llm.prefix_trie import NODE, prefix_trie
    rows = [r for r in _rows() if container > 1 or r[0] != 600]
    got = prefix_trie(frame(spark, rows), container)
    assert got.columns == list(NODE)
    assert sorted(str(tuple(r)) for r in got.collect()) == expected(rows)


def test_blocks_of_ids_are_hashed_in_order(spark, monkeypatch):
    from tierwise.llm import prefix_trie as T
    monkeypatch.setattr(T, "ID_BLOCK", 3)
    rows = _rows()
    got = T.prefix_trie(frame(spark, rows), 40)
    assert sorted(str(tuple(r)) for r in got.collect()) == expected(rows)


def test_few_conversations(spark):
    from tierwise.llm.prefix_trie import NODE, prefix_trie
    nothing = prefix_trie(frame(spark, _rows()).where("false"))
    assert nothing.columns == list(NODE) and nothing.count() == 0
    turnless = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 > 1)
    for rows in ([(turnless, 0, "a", "b")], [(0, None, None, None)], [(20, 1, "a", "b"), (21, 1, "a", "b")]):
        assert sorted(str(tuple(r)) for r in prefix_trie(frame(spark, rows), 1).collect()) == expected(rows)


def test_sql_agrees_with_plain_prefixes(spark, tmp_path):
    import duckdb
    from tierwise.llm.prefix_trie import OP13_SQL
    rows = _rows()
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert sorted(map(str, con.execute(OP13_SQL).fetchall())) == expected(rows)

"""Small made-up tables with the awkward rows every operator must stand."""
import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, o string, node int, Key string"


def documents(spark, n=40, seed=3, extra=()):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 7))) for _ in range(300)]
    rows = []
    base = " ".join(rnd.choice(vocabulary) for _ in range(120))
    for i in range(n):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(1, 90))]
        if i % 5 == 0:                        # near copies of one text
            words = base.split()
            for _ in range(rnd.randint(0, 5)):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
        if i % 7 == 0:                        # a passage that many share
            words = words[:40] + base.split()[20:55] + words[40:]
        sep = rnd.choice([" ", "\n", "  ", "\t"])
        rows.append((i, sep.join(words), rnd.choice(["en", "de"]), rnd.choice(["a", "b", "B", "é"])))
    rows += [(100, None, "en", "a"), (101, "", "de", "b"), (102, " \n\t", None, "a"), (103, "one", "en", None),
             (104, rows[0][1], "en", "a"), (105, rows[0][1].upper(), "en", "a"), (106, "x " * 3000, "en", "é"),
             (107, rows[3][1], "en", "a"), (107, rows[3][1], "en", "a"), (None, rows[5][1], "en", None),
             (108, "übergroß zwei drei 日本 語", "zz", "b")]
    rows += list(extra)
    return spark.createDataFrame([(*r, len(r[1] or ""), "clash", 1, "k") for r in rows], DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)

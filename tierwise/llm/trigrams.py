"""Character trigrams of text batches: 63-bit ids (three code points), counted with numpy.

Runs of white space count as one space; every text starts with two boundary characters.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BITS = 21
MASK = (1 << BITS) - 1
START = 2                   # boundary character; control characters below 32 count as spaces
_DENSE_ALPHABET = 160       # up to this many distinct characters, trigrams are counted in a dense table


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points, owner) of texts, each preceded by two :data:`START` characters."""
    parts = [("\x02\x02" + " ".join(t.split())) for t in texts]
    c = np.frombuffer("".join(parts).encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.int64)
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    low = (c < 32) & (c != START)
    c[low] = 32
    return c, owner


def counted(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(trigram, text, count), ordered by trigram and then text."""
    c, owner = code_points(texts)
    if len(c) < 3:
        return (np.zeros(0, np.int64),) * 3
    ok = owner[2:] == owner[:-2]
    alphabet, code = np.unique(c, return_inverse=True)
    n = len(alphabet)
    t = ((code[:-2] * n + code[1:-1]) * n + code[2:])[ok]
    doc = owner[2:][ok]
    if n <= _DENSE_ALPHABET:
        seen = np.flatnonzero(np.bincount(t, minlength=n ** 3))
        rank = np.zeros(n ** 3, dtype=np.int64)
        rank[seen] = np.arange(len(seen))
        t = rank[t]
    else:
        seen, t = np.unique(t, return_inverse=True)
    key, count = np.unique(t * len(texts) + doc, return_counts=True)
    ids = (alphabet[seen // (n * n)] << 2 * BITS) | (alphabet[seen // n % n] << BITS) | alphabet[seen % n]
    order = np.argsort(ids)
    where = np.empty(len(order), dtype=np.int64)
    where[order] = np.arange(len(order))
    g, d = key // len(texts), key % len(texts)
    by = np.argsort(where[g], kind="stable")
    return ids[g[by]], d[by], count[by]


def totals(ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum the counts of equal ids."""
    u, inverse = np.unique(ids, return_inverse=True)
    return u, np.bincount(inverse, weights=counts, minlength=len(u)).astype(np.int64)


class Accumulator:
    """Trigram totals per label over a task's batches; emitted whenever they grow past ``limit`` entries."""

    def __init__(self, limit: int = 2_000_000):
        self.limit, self.parts = limit, {}

    def add(self, label, ids: np.ndarray, counts: np.ndarray) -> None:
        old = self.parts.get(label)
        if old is not None:
            ids, counts = np.concatenate([old[0], ids]), np.concatenate([old[1], counts])
        self.parts[label] = totals(ids, counts)

    def full(self) -> bool:
        return sum(len(i) for i, _ in self.parts.values()) > self.limit

    def drain(self) -> pa.RecordBatch:
        parts, self.parts = self.parts, {}
        labels = [x for x, (i, _) in parts.items() for _ in range(len(i))]
        ids = np.concatenate([i for i, _ in parts.values()]) if parts else np.zeros(0, np.int64)
        n = np.concatenate([c for _, c in parts.values()]) if parts else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(labels, pa.string()), pa.array(ids), pa.array(n)],
                                          names=["lang", "gram", "m"])

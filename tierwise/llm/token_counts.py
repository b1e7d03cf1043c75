"""Operator 11: token counts by batch encoding in Arrow functions that return lengths only.

The rows of a map task are regrouped into blocks of about ``BLOCK_BYTES`` of text, whatever the row sizes: short texts
share a block, and a text longer than a block is cut. Every cut lies at a safe boundary, next to one of the ASCII white-space
characters, which the vocabulary's pre-tokeniser drops and never joins to a neighbour: the tokens of a text are those
of its pieces between white space, one after the other. So a block is cut into all of its pieces, each distinct piece
is encoded once, in a batch, and only its number of tokens goes on: numbers are looked up per piece and summed per
document with numpy. A worker remembers the lengths of recent short pieces, in two generations of bounded size.

The counts are those of the whole text under the library's defaults: no special tokens added, strings of special tokens
inside a text found as such, no truncation or padding. :func:`safe` refuses a vocabulary whose settings would make the cuts unsafe.

Edge cases: NULL or empty text, or only white space, has 0 tokens; a text without white space is one piece, encoded whole;
repeated rows, ties and NULL doc_id are kept row by row; an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _SPACE, read_table, text_buffers, text_slices

VOCABULARY = "word_bpe_49k.json"
MAX_TOKENS = 2048
#: Fixed value: the vocabulary's pattern; none of its alternatives matches white space.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Bytes of text encoded at once.
BLOCK_BYTES = 4 << 20
#: Pieces remembered per generation, and the longest one in characters (about 100 MB for both generations).
REMEMBERED, REMEMBERED_CHARS = 400_000, 64


def safe(settings: dict) -> bool:
    """Whether white space separates tokens under these tokeniser settings (the content of the JSON file).

    Holds where each string of an added token has no white space and doesn't take in its neighbours', normalising maps
    characters one by one or composes them, and the pre-tokeniser keeps only matches of a pattern that can't match white space.
    """
    def parts(x: dict | None, key: str) -> list[dict]:
        return [] if x is None else x[key] if x["type"] == "Sequence" else [x]
    added = all(not (a["lstrip"] or a["rstrip"] or a["single_word"]) and not any(map(str.isspace, a["content"]))
                for a in settings["added_tokens"])
    normal = all(n["type"] in ("NFC", "Lowercase") or n["type"] == "Replace" and n["pattern"] == {"Regex": r"\s+"}
                 and n["content"] == " " for n in parts(settings["normalizer"], "normalizers"))
    pre = parts(settings["pre_tokenizer"], "pretokenizers")
    split = bool(pre) and pre[0]["type"] == "Split" and pre[0]["invert"] and pre[0]["behavior"] == "Removed" \
        and pre[0]["pattern"] == {"Regex": PATTERN}
    plain = all(p["type"] == "ByteLevel" and not p["add_prefix_space"] for p in pre[1:])
    return bool(added and normal and split and plain)


class PieceLengths:
    """Numbers of tokens of pieces without ASCII white space."""

    def __init__(self, vocabulary: str):
        # One Spark task is one core; the library's own threads would take others'.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        with open(vocabulary, encoding="utf-8") as f:
            if not safe({k: v for k, v in json.load(f).items() if k != "model"}):
                raise ValueError(f"white space doesn't separate tokens under {vocabulary}")
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.recent: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def _remember(self, piece: str, n: int) -> None:
        if len(piece) <= REMEMBERED_CHARS:
            if len(self.recent) >= REMEMBERED:
                self.recent, self.older = {}, self.recent
            self.recent[piece] = n

    def of(self, pieces: list[str]) -> np.ndarray:
        out = np.zeros(len(pieces), dtype=np.int64)
        unknown = []
        for i, piece in enumerate(pieces):
            n = self.recent.get(piece)
            if n is None:
                n = self.older.get(piece)
                if n is None:
                    unknown.append(i)
                    continue
                self._remember(piece, n)
            out[i] = n
        for k in range(0, len(unknown), 4096):
            group = unknown[k: k + 4096]
            encoded = self.tokenizer.encode_batch_fast([pieces[i] for i in group], add_special_tokens=False)
            for i, e in zip(group, encoded):
                out[i] = len(e)
                self._remember(pieces[i], len(e))
        return out


_LENGTHS: dict[str, PieceLengths] = {}


def piece_lengths(vocabulary: str | None = None) -> PieceLengths:
    """This worker's lengths; the file defaults to the installed public vocabulary."""
    import public_tokenizers as P
    key = vocabulary or P.path(VOCABULARY)
    if key not in _LENGTHS:
        _LENGTHS[key] = PieceLengths(key)
    return _LENGTHS[key]


def cut(data: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """``data`` in parts of at least ``limit`` bytes that end before white space (the last part may be shorter)."""
    a = 0
    while a < len(data):
        b = a + limit
        while b < len(data):
            near = np.flatnonzero(_SPACE[data[b: b + (1 << 16)]])
            if len(near):
                b += int(near[0])
                break
            b += 1 << 16
        yield data[a: b]
        a = b


def _tokens(data: np.ndarray, offs: np.ndarray, lengths: PieceLengths) -> np.ndarray:
    """Tokens of each text ``data[offs[i]:offs[i + 1]]``."""
    space = _SPACE[data]
    first = ~space
    first[1:] &= space[:-1]
    starts = offs[:-1][offs[1:] > offs[:-1]]
    first[starts] = ~space[starts]
    begin = np.flatnonzero(first)
    # Without the white space the pieces lie end to end: a string column over the remaining bytes.
    at = np.cumsum(~space)[begin] - 1
    bounds = np.append(at, len(data) - int(space.sum())).astype(np.int64)
    column = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(bounds), pa.py_buffer(data[~space].tobytes()))
    coded = column.dictionary_encode()
    each = lengths.of(coded.dictionary.to_pylist())
    total = np.append(0, np.cumsum(each[coded.indices.to_numpy()])) if len(begin) else np.zeros(1, np.int64)
    return np.diff(total[np.searchsorted(begin, offs, "left")])


def count_tokens(column: pa.Array, lengths: PieceLengths, block: int = BLOCK_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, tokens) of each text of a column that is a block or one text of any length."""
    data, offs = text_buffers(column)
    if len(offs) == 2 and len(data) > 2 * block:
        parts = (_tokens(part, np.array([0, len(part)]), lengths) for part in cut(data, block))
        return np.diff(offs), sum(parts, np.zeros(1, np.int64))
    return np.diff(offs), _tokens(data, offs, lengths)


def blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.Table]:
    """The same rows in tables of about ``limit`` bytes of text; a longer text is a table of its own."""
    held, size = [], 0
    for batch in batches:
        for part in text_slices(batch, column, limit):
            n = int(text_buffers(part.column(column))[1][-1])
            if held and size + n > limit:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            held.append(part)
            size += n
    if held:
        yield pa.Table.from_batches(held)


def _count(vocabulary: str | None, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = piece_lengths(vocabulary)
        for table in blocks(batches, "text", block):
            if table.num_rows:
                n_bytes, n_tokens = count_tokens(table.column("text"), lengths, block)
                yield pa.RecordBatch.from_arrays([table.column("doc_id").combine_chunks(), pa.array(n_bytes.astype(np.int64)),
                                                  pa.array(n_tokens)], names=["doc_id", "n_bytes", "n_tokens"])
    return run


def token_counts(documents: DataFrame, max_tokens: int = MAX_TOKENS, vocabulary: str | None = None,
                 block: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per row; ``vocabulary`` is a path that every worker can read."""
    kind = dict(documents.dtypes)["doc_id"]
    return documents.select("doc_id", "text").mapInArrow(
        _count(vocabulary, block), f"doc_id {kind}, n_bytes long, n_tokens long") \
        .withColumn("over_limit", F.col("n_tokens") > max_tokens)


def op11_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"))

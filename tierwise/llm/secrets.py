"""Operator 2: secret scan with dictionary-primed compression novelty.

Three patterns find the base kinds (``assign``, ``access``, ``hex``). Beyond them these strings in sensitive context are
candidates: what follows a sensitive name (``SENSITIVE`` below) as its value (after a mere space only with letters and digits); an unbroken run of key characters with letters and digits,
up to ``NEAR`` characters after such a name, on its line or the next; a password within a URL; the body of a private key. A
candidate's novelty is what it adds to the zstandard size of the text around it, per byte, with a dictionary of the identifiers that
are most frequent around all measured strings of the whole corpus (the strings themselves are left out). Names, paths and repeated
placeholders compress against that dictionary or their surroundings; keys don't, and are reported as kind ``novel``. Every sensitive
name starts a candidate of its own, also one inside another candidate's string; only candidates that lie wholly within a base span, or
within a novel one, are not reported. Values of base spans are measured alike: the spans stay, ``n_base_novel`` tells how many of them
are as novel as a key.

Edge cases: NULL text counts as empty; without spans the digest is that of the empty string and ``spans`` is empty;
repeated rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, read_table, released, text_slices

ASSIGN = re.compile(r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"
                    r"[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
                    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "novel")
MIN_ASSIGNED, MIN_ACCESS, MIN_HEX = 6, 20, 24

SENSITIVE = ("password", "passwd", "pwd", "secret", "token", "key", "credential", "auth", "bearer", "private", "signature")
_VALUE = r"[a-z0-9+/_=.~$@!%^&*-]"
# Consumes the sensitive name only; the first characters of its string are looked ahead to.
CANDIDATE = re.compile(r"(?:" + "|".join(SENSITIVE) + r")(?=[a-z0-9_-]{0,24}[\"']?[\x20\t]*(:=|=>|->|[:=\x20])[\x20\t]*"
                       r"[\"'`<]?(" + _VALUE + r"{12}))", re.IGNORECASE | re.ASCII)
VALUE = re.compile(_VALUE + "+", re.IGNORECASE | re.ASCII)
NAME = re.compile("|".join(SENSITIVE), re.IGNORECASE | re.ASCII)
RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}", re.ASCII)
LETTER, DIGIT = re.compile("[A-Za-z]"), re.compile("[0-9]")
NEAR = 80                   # characters between a name and a run
URL_PASSWORD = re.compile(r"://[^\s/:@]{1,64}:([!-.0-?A-~]{8,})@", re.ASCII)
PRIVATE_KEY = re.compile(r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----\s*([A-Za-z0-9+/=][A-Za-z0-9+/=\s]{23,})", re.ASCII)
IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]{3,31}", re.ASCII)
AROUND = 256                # characters of surroundings on either side
DICTIONARY_BYTES = 16384    # bound of what is sent to the tasks
DICTIONARY_WORDS = 2048
NOVELTY = 0.75              # added compressed bytes per byte of the candidate
PART_BYTES = 64             # by how much the end of a string may add more than the whole string
MASK = "<secret>"

_HEX_MAP = bytes(120 if chr(i) in "0123456789abcdef" else 32 for i in range(256))
_HEX_RUN = b"x" * MIN_HEX
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Spans of the three patterns, leftmost and non-overlapping within a kind, by start and then kind."""
    out: list[Span] = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGNED]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    # A run of 24 hex digits in the UTF-8 bytes is one in the text: other characters have no such bytes.
    if _HEX_RUN in text.encode("utf-8", "surrogatepass").translate(_HEX_MAP):
        out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def _near(text: str) -> Iterator[tuple[int, int, int]]:
    """(start of the nearest name before it, start, end) of each run of key characters close after a name."""
    names = [(m.end(), m.start()) for m in NAME.finditer(text)]
    ends = [e for e, _ in names]
    for m in RUN.finditer(text):
        i = bisect_right(ends, m.start())
        if i and m.start() - ends[i - 1] <= NEAR and text.count("\n", ends[i - 1], m.start()) <= 1 \
                and DIGIT.search(m[0]) and LETTER.search(m[0]):
            yield names[i - 1][1], m.start(), m.end()


def _named(text: str) -> list[tuple[int, int, int]]:
    """(start of its context, start, end) of each distinct string in sensitive context, by start of the string."""
    low = text.lower()
    out: dict[int, tuple[int, int, int]] = {}
    if "://" in low:
        out.update((m.start(1), (m.start(), m.start(1), m.end(1))) for m in URL_PASSWORD.finditer(text))
    if not any(k in low for k in SENSITIVE):
        return [out[s] for s in sorted(out)]
    out.update((s, (k, s, e)) for k, s, e in _near(text))
    begin = end = 0
    for m in CANDIDATE.finditer(text):
        s = m.start(2)
        if not begin <= s < end:                # else it is the rest of the same run of characters
            begin, end = s, VALUE.match(text, s).end()
        if m[1] == " " and not (DIGIT.search(text, s, end) and LETTER.search(text, s, end)):
            continue                            # a word of prose after the name
        out[s] = (m.start(), s, end)            # of several names before a string, the nearest
    out.update((m.start(1), (m.start(), m.start(1), m.end(1))) for m in PRIVATE_KEY.finditer(text))
    return [out[s] for s in sorted(out)]


def base_values(text: str, spans: list[Span]) -> list[tuple[int, int]]:
    """The secret strings of base spans: of an assignment what is assigned, else the whole span."""
    return [(ASSIGN.match(text, s).start(2) if kind == "assign" else s, e) for kind, s, e in spans]


def _outside(text: str, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Those that don't lie wholly within a base span."""
    taken = base_spans(text) if found else []
    starts, reach = [s for _, s, _ in taken], list(accumulate((e for _, _, e in taken), max))
    return [x for x in found if not (i := bisect_right(starts, x[1])) or reach[i - 1] < x[2]]


def candidates(text: str) -> list[tuple[int, int]]:
    """Strings in sensitive context that don't lie wholly within a base span."""
    return [(s, e) for _, s, e in _outside(text, _named(text))]


def anchors(text: str) -> list[tuple[int, int]]:
    """The measured strings around which identifiers are counted: values of base spans, and the candidates but for those that
    are names of other candidates."""
    found = _outside(text, _named(text))
    names = sorted(k for k, _, _ in found)
    own = [(s, e) for _, s, e in found if (i := bisect_right(names, s - 1)) == len(names) or names[i] >= e]
    return sorted(own + base_values(text, base_spans(text)))


def blanked(text: str, spans: list[tuple[int, int]]) -> str:
    """The text with spaces for the given stretches (ordered by start)."""
    out, at = [], 0
    for s, e in spans:
        if e > at:
            out += [text[at:s], " " * (e - max(at, s))]
            at = e
    return "".join([*out, text[at:]])


def surroundings(text: str, start: int, end: int) -> str:
    return text[max(0, start - AROUND): start] + text[end: end + AROUND]


def compressor(identifiers: bytes) -> zstandard.ZstdCompressor:
    prime = zstandard.ZstdCompressionDict(identifiers, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if identifiers else None
    return zstandard.ZstdCompressor(level=9, dict_data=prime, write_content_size=False)


def added_bytes(packer: zstandard.ZstdCompressor, text: str, start: int, end: int) -> int:
    """Compressed bytes that the candidate adds to its surroundings."""
    around, own = surroundings(text, start, end).encode(), text[start:end].encode()
    return len(packer.compress(around + b"\n" + own)) - len(packer.compress(around + b"\n"))


def novel_spans(text: str, packer: zstandard.ZstdCompressor) -> list[Span]:
    """The candidates that add at least :data:`NOVELTY` bytes per byte (they are ASCII) and lie in no other such candidate."""
    out: list[Span] = []
    run, most, covered = -1, 0.0, 0
    for s, e in candidates(text):
        if e <= covered:
            continue
        if e != run:
            run, most = e, float("inf")
        if NOVELTY * (e - s) > most:            # the whole string's bytes leave too few for this part of it
            continue
        n = added_bytes(packer, text, s, e)
        most = min(most, n + PART_BYTES)
        if n >= NOVELTY * (e - s):
            out.append(("novel", s, e))
            covered = e
    return out


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for whole in batches:
        for b in text_slices(whole, "text"):
            yield b, [x or "" for x in b.column("text").to_pylist()]


def _identifiers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, texts in _texts(batches):
        seen: Counter[str] = Counter()
        for t in texts:
            words: set[str] = set()
            around = anchors(t)
            clear = blanked(t, around) if around else t
            for s, e in around:
                words.update(IDENTIFIER.findall(surroundings(clear, s, e)))
            seen.update(words)
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                                         names=["word", "m"])


def identifier_dictionary(documents: DataFrame) -> bytes:
    """The most frequent identifiers around the measured strings of all documents, at most :data:`DICTIONARY_BYTES` bytes."""
    bounded_batches(documents.sparkSession)
    counts = documents.select("text").mapInArrow(released(_identifiers), "word string, m long").groupBy("word").agg(F.sum("m").alias("m"))
    top = counts.where(F.col("m") > 1).orderBy(F.col("m").desc(), "word").limit(DICTIONARY_WORDS).collect()
    # Matches near the end of a dictionary cost least: the most frequent words come last.
    out = "\n".join(r["word"] for r in reversed(top)).encode()
    return out[-DICTIONARY_BYTES:]


def novel_values(text: str, spans: list[Span], packer: zstandard.ZstdCompressor) -> int:
    """How many of the base spans hold a value that is as novel as a key."""
    return sum(added_bytes(packer, text, s, e) >= NOVELTY * (e - s) for s, e in base_values(text, spans))


def all_spans(text: str, packer: zstandard.ZstdCompressor) -> list[Span]:
    return sorted(base_spans(text) + novel_spans(text, packer), key=lambda s: (s[1], KINDS.index(s[0])))


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _scan(identifiers: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = compressor(identifiers)
        for b, texts in _texts(batches):
            rows = []
            for t in texts:
                spans = all_spans(t, packer)
                base = [s for s in spans if s[0] != "novel"]
                n = Counter(s[0] for s in spans)
                rows.append((n["assign"], n["access"], n["hex"], hashlib.sha256(_joined(base).encode()).hexdigest(),
                             _joined(spans), n["novel"], novel_values(t, base, packer)))
            cols = list(zip(*rows)) or [()] * 7
            types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()] * 2
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, t) for c, t in zip(cols, types))], names=[
                "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel", "n_base_novel"])
    return run


def scan(documents: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_novel, n_base_novel) per row; spans are kind:start:end in code
    points."""
    bounded_batches(documents.sparkSession)
    kind = dict(documents.dtypes)["doc_id"]
    return documents.select("doc_id", "text").mapInArrow(
        released(_scan(identifier_dictionary(documents))),
        f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_novel long, "
        "n_base_novel long")


def mask(text: str, packer: zstandard.ZstdCompressor) -> str:
    """The text with every stretch that spans cover replaced by :data:`MASK`."""
    out, at = [], 0
    for _, s, e in all_spans(text, packer):
        if s >= at:
            out += [text[at:s], MASK]
        at = max(at, e)
    return "".join([*out, text[at:]]) if out else text


def mask_secrets(documents: DataFrame) -> DataFrame:
    """The documents with their secrets masked (and ``n_chars`` counted anew where there is such a column)."""
    bounded_batches(documents.sparkSession)
    identifiers = identifier_dictionary(documents)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = compressor(identifiers)
        for whole in batches:
            for b in text_slices(whole, "text"):
                new = [None if t is None else mask(t, packer) for t in b.column("text").to_pylist()]
                yield b.set_column(b.schema.get_field_index("text"), "text", pa.array(new, pa.string()))

    out = documents.mapInArrow(released(run), documents.schema)
    if "n_chars" in documents.columns:
        kind = dict(documents.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(kind))
                             .otherwise(F.col("n_chars")))
    return out.select(*documents.columns)


def op2_secret_scan(spark, sf_dir: str) -> DataFrame:
    return scan(read_table(spark, sf_dir, "documents"))

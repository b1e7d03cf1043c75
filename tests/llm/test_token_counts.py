"""Token counts against the library's own counts of whole texts."""
import json

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import documents, empty


def _library():
    import public_tokenizers as P
    from tokenizers import Tokenizer
    return Tokenizer.from_file(P.path("word_bpe_49k.json"))


AWKWARD = ["", " ", "\n\t", "<|endoftext|>", "a<|endoftext|>b <|startoftext|>", "<|ENDOFTEXT|>", "it's 'S 'll he'd", "x y z",
           "é ́a", "İI ſ ΑΣ ς", "a\x0bb\x0cc\x1cd\x85e", "12 345,6", "日本 語", "가 ᆨ", "x" * 5000]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n'<|>éÉsS1,"))), max_size=8))
def test_pieces_add_up_to_the_text(texts):
    from tierwise.llm.token_counts import count_tokens, piece_lengths
    texts = texts + AWKWARD
    n_bytes, n_tokens = count_tokens(pa.array(texts), piece_lengths())
    assert n_tokens.tolist() == [len(e) for e in _TOKENIZER.encode_batch(texts, add_special_tokens=False)]
    assert n_bytes.tolist() == [len(t.encode()) for t in texts]


_TOKENIZER = _library()


def test_long_texts_are_cut_at_white_space():
    from tierwise.llm.token_counts import count_tokens, cut, piece_lengths
    text = " ".join(AWKWARD * 40)
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    parts = [bytes(p) for p in cut(data, 300)]
    assert b"".join(parts) == text.encode() and len(parts) > 20
    assert all(p[:1].isspace() for p in parts[1:]) and all(len(p) >= 300 for p in parts[:-1])
    for t in (text, "y" * 200_000):
        got = count_tokens(pa.array([t]), piece_lengths(), block=300)[1]
        assert got.tolist() == [len(_TOKENIZER.encode(t, add_special_tokens=False))]


def test_memory_of_pieces_is_bounded(monkeypatch):
    from tierwise.llm import token_counts as T
    monkeypatch.setattr(T, "REMEMBERED", 10)
    import public_tokenizers as P
    lengths = T.PieceLengths(P.path(T.VOCABULARY))
    words = [f"w{i % 37}" for i in range(200)]
    want = [len(_TOKENIZER.encode(w, add_special_tokens=False)) for w in words]
    assert [int(lengths.of([w])[0]) for w in words] == want and lengths.of(words).tolist() == want
    assert len(lengths.recent) <= 10 and len(lengths.older) <= 10


def test_unsafe_vocabularies_are_refused():
    import public_tokenizers as P
    from tierwise.llm.token_counts import PieceLengths, safe
    with open(P.path("word_bpe_49k.json"), encoding="utf-8") as f:
        good = {k: v for k, v in json.load(f).items() if k != "model"}
    assert safe(good)
    assert not safe({**good, "pre_tokenizer": None})
    assert not safe({**good, "added_tokens": [{**good["added_tokens"][0], "content": "a b"}]})
    assert not safe({**good, "added_tokens": [{**good["added_tokens"][0], "lstrip": True}]})
    assert not safe({**good, "normalizer": {"type": "Strip"}})
    with pytest.raises(ValueError):
        PieceLengths(P.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("block", [50, 4 << 20])
def test_token_counts(spark, block):
    from tierwise.llm.token_counts import token_counts
    docs = documents(spark, extra=[(400 + i, t, "en", "a") for i, t in enumerate(AWKWARD)])
    rows = docs.collect()
    got = token_counts(docs, max_tokens=60, block=block).collect()
    want = [(r.doc_id, len((r.text or "").encode()), n := len(_TOKENIZER.encode(r.text or "", add_special_tokens=False)), n > 60)
            for r in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want)) and any(r.over_limit for r in got)
    assert token_counts(empty(spark)).count() == 0 and token_counts(empty(spark)).columns == [
        "doc_id", "n_bytes", "n_tokens", "over_limit"]

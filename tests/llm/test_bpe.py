import base64
import hashlib

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from engram.llm import bpe
from tests.llm.helpers import docs_frame

PATH, PATTERN = bpe.default_vocabulary()
with open(PATH, "rb") as f:
    RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})


def packed(text):
    return np.array(LIBRARY.encode_ordinary(text), "<u4").tobytes()


@pytest.mark.parametrize("text", ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "\n\n x", "it's we'll", "naïve café", "日本語 テキスト",
                                  "🎉🎉 x", "<|endoftext|>", "x" * 5000, "ab" * 9000, "qzj" * 700 + "é" * 500, "a\x1cb \x1f c\x85 d　e   f"])
def test_ids_equal_the_library(text):
    codec = bpe.Codec.load(PATH, PATTERN)
    ids = codec.encode_many([text])[0]
    assert ids == packed(text) and codec.decode(ids) == text.encode()


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=80))
def test_any_text(text):
    assert bpe.Codec.load(PATH, PATTERN).encode_many([text])[0] == packed(text)


@settings(max_examples=50, deadline=None)
@given(st.binary(min_size=1, max_size=64))
def test_scalar_and_lane_trees_agree(piece):
    codec = bpe.Codec.load(PATH, PATTERN)
    own = np.array(codec.piece(piece), "<u4").tobytes()
    lane = codec.pieces([piece])[0]
    assert own == lane and codec.decode(own) == piece


def test_cache_generations(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 20)
    codec = bpe.Codec(RANKS, PATTERN)
    texts = [f"word{i} again the other{i % 7} line" for i in range(100)] * 2
    assert [b for k in range(0, 200, 10) for b in codec.encode_many(texts[k:k + 10])] == [packed(t) for t in texts]


def test_frames(spark):
    rows = [(1, "the cat"), (2, None), (3, ""), (1, "the cat"), (None, "x y")]
    df = docs_frame(spark, rows, extra="ids")
    out = bpe.round_trip(df, PATH, PATTERN)
    assert sorted(out.columns) == sorted([*df.columns, "decoded"])
    got = sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(out).collect()), key=str)
    want = sorted(((i, len(packed(t or "")) // 4, hashlib.sha256(packed(t or "")).hexdigest(),
                    hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows), key=str)
    assert got == want
    two = bpe.decode(bpe.encode(df, PATH, PATTERN), PATH, PATTERN)
    assert {bytes(r.decoded) for r in two.collect()} == {b"the cat", b"", b"x y"}
    assert bpe.digests(bpe.round_trip(df.limit(0), PATH, PATTERN)).collect() == []


def test_unknown_id_raises():
    with pytest.raises(IndexError):
        bpe.Codec.load(PATH, PATTERN).decode(np.array([10 ** 6], "<u4").tobytes())

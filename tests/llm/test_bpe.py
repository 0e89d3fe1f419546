"""Byte-pair encoding of many long words without blanks, within the memory of one worker's database."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import tiktoken

from peerlight.llm import bpe
from peerlight.llm.queries import vocabulary


def test_long_words_are_contracted_in_bounded_queries(monkeypatch):
    path, pattern = vocabulary()
    codec = bpe.Codec(path, pattern)
    sizes, contract = [], codec._contract
    monkeypatch.setattr(codec, "_contract", lambda words: sizes.append([len(w) for w in words]) or contract(words))
    rnd = random.Random(1)
    texts = ["".join(chr(rnd.randrange(0x4E00, 0x9FFF)) for _ in range(165)) for _ in range(60)]
    texts += [" ".join("".join(rnd.choices("etaoinsrh", k=rnd.randrange(1, 14))) for _ in range(2000)), "", None]
    got = codec.encode(pa.array(texts)).to_pylist()
    library = tiktoken.Encoding("x", pat_str=pattern, mergeable_ranks=codec.ranks, special_tokens={})
    for ids, text in zip(got, texts):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text or "")
    assert len(sizes) > 5 and all(len(s) <= bpe.WORDS_PER_QUERY for s in sizes)
    assert all(sum(n * n for n in s) <= bpe.SQUARES_PER_QUERY for s in sizes)


def test_decode_looks_ids_up(monkeypatch):
    """Decoding needs no query: every id has its piece in the vocabulary."""
    path, pattern = vocabulary()
    codec = bpe.Codec(path, pattern)
    texts = [None, "", "é 🙂  x\n", " a  b", "zqxj" * 300, "one two　three"]
    ids = codec.encode(pa.array(texts))
    monkeypatch.setattr(codec, "db", None)
    assert codec.decode(ids).to_pylist() == [(t or "").encode() for t in texts]
    assert codec.decode(ids.slice(2, 2)).to_pylist() == [t.encode() for t in texts[2:4]]
    assert codec.decode(pa.array([None, b""], pa.binary())).to_pylist() == [b"", b""]
    assert codec.decode(pa.array([], pa.binary())).to_pylist() == []

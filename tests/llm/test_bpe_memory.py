"""How many words a worker remembers changes what it contracts, never its ids."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import tiktoken

from peerlight.llm import bpe
from peerlight.llm.queries import vocabulary


def test_remembered_words(monkeypatch):
    path, pattern = vocabulary()
    rnd = random.Random(3)
    words = ["".join(rnd.choices("zqxjkvwy", k=9)) for _ in range(300)]
    batches = [pa.array([" ".join(rnd.sample(words, 100)) + rnd.choice([".", "!?", "\n", ""]) for _ in range(5)]) for _ in range(6)]
    contracted = {}
    for remembered in (20, 10_000):
        codec = bpe.Codec(path, pattern, remembered)
        library = tiktoken.Encoding("x", pat_str=pattern, mergeable_ranks=codec.ranks, special_tokens={})
        seen, contract = [], codec._contract
        monkeypatch.setattr(codec, "_contract", lambda some, seen=seen, contract=contract: seen.extend(some) or contract(some))
        for texts in batches:
            for ids, text in zip(codec.encode(texts).to_pylist(), texts.to_pylist()):
                assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        contracted[remembered] = len(seen)
        assert remembered == 20 or len(seen) == len(set(seen))
    assert contracted[10_000] < contracted[20]

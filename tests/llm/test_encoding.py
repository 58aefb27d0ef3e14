"""Token ids by pieces against the library's ids of whole texts."""

from __future__ import annotations

from collections import Counter
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from reviewpulse.llm import encoding

LATIN = ["a", "the", "Été", "ÀÈß", "×", "÷a", "don't", "'S", "12", "x9", "<|endoftext|>", "<|ENDOFTEXT|>", "<|StartOfText|>", "|", "!", "***",
         "_", "\\", "\x7f", " ", "  ", "\n", "\n\n", " \n", "\n ", "Straße", "ÿÞ", "Z", "z@[`{"]
FOREIGN = ["\t", "\r", "\u00a0", "\u2028", "\u65e5\u672c", "e\u0301", "\u00c9\u0301", "\u201c", "\u20ac", "\x00", "\x1c", "\u00b5", "\u00aa", "\x85", "\u3000"]
MODELS = [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)]


@pytest.mark.parametrize("name, keeps_space", MODELS)
def test_columns_of_odd_texts_have_the_ids_of_whole_texts(monkeypatch, name, keeps_space):
    path, rng = public_tokenizers.path(name), np.random.default_rng(5)
    encoder, whole = encoding.Encoder(path, keeps_space), Tokenizer.from_file(path)
    for turn in range(60):
        monkeypatch.setattr(encoding, "HELD_PARTS", int(rng.choice([4, 50, 500_000])))
        texts = [None if rng.random() < 0.05 else rng.choice(["", " "]).join(rng.choice(LATIN + FOREIGN * int(rng.random() < 0.3), rng.integers(25)))
                 for _ in range(rng.integers(30))]
        column = pa.array(["before", *texts, "behind"], pa.large_string() if turn % 2 else pa.string()).slice(1, len(texts))
        expected = [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert [x.tolist() for x in encoder.encode_column(column)] == expected
        assert [x.tolist() for x in encoder.encode(texts)] == expected


@pytest.mark.parametrize("name, keeps_space", MODELS)
def test_parts_in_use_outlive_a_full_memory(monkeypatch, name, keeps_space):
    monkeypatch.setattr(encoding, "HELD_PIECES", 150)
    monkeypatch.setattr(encoding, "HELD_PARTS", 150, raising=False)
    encoder, seen = encoding.Encoder(public_tokenizers.path(name), keeps_space), Counter()
    library = encoder.whole

    def tokenize(text):
        seen[text] += 1
        return library.model.tokenize(text)

    encoder.whole = SimpleNamespace(model=SimpleNamespace(tokenize=tokenize), encode_batch_fast=library.encode_batch_fast)
    letters = "abcdefghijklmnopqrstuvwxyz"
    for turn in range(12):
        # Twenty words that come back with other signs behind them, and forty that do not.
        common = [f"common{c}" + "!#%&*+"[turn % 6] * (1 + turn // 6) for c in letters[:20]]
        encoder.encode([" " + " ".join(common * 2 + [f"rare{letters[turn]}{a}{b}" for a in letters[:8] for b in letters[:5]])])
    assert max(n for text, n in seen.items() if "common" in text) == 1

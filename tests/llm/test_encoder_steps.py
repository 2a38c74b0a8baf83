"""What the encoder asks the tokenizer for, and that its ids are those of whole texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from ledgerleaf.llm import tokens


class Watched:
    """A tokenizer that keeps what it is asked to encode as a whole."""

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer, self.asked = tokenizer, []

    def __getattr__(self, name: str):
        got = getattr(self.tokenizer, name)
        if not name.startswith("encode"):
            return got

        def call(texts, **kw):
            self.asked += texts
            return got(texts, **kw)

        return call


def _texts() -> list[str]:
    rng = np.random.default_rng(5)
    letters = np.array(list(tokens.LETTERS))
    words = ["".join(rng.choice(letters, int(k))) for k in rng.integers(1, 90, 3000)] + list(tokens.LETTERS)
    return [" ".join(words[i : i + 50]) for i in range(0, len(words), 50)]


def test_words_of_letters_do_not_pass_the_whole_tokenizer():
    enc = tokens.Encoder(tokens.vocabulary_path())
    enc.tokenizer = watched = Watched(enc.tokenizer)
    texts = [*_texts(), "Some words, and (a mark) or it's odd... 12 é İx"]
    whole = [np.array(e.ids) for e in watched.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):  # the second time from what is known
        ids, n = enc.encode_array(pa.array(texts, pa.string()))
        assert n.tolist() == list(map(len, whole)) and np.array_equal(ids, np.concatenate(whole))
    assert watched.asked and not any(x and set(x) <= set(tokens.LETTERS + " ") for x in watched.asked)


def test_a_tokenizer_with_words_of_its_own_is_asked_for_whole_words(tmp_path):
    t = Tokenizer.from_file(tokens.vocabulary_path())
    t.add_tokens(["hello"])
    t.save(path := str(tmp_path / "t.json"))
    enc = tokens.Encoder(path)
    ids, _ = enc.encode_array(pa.array(["say hello twice", "hello"], pa.string()))
    assert not enc.alone and ids.tolist() == [x for s in ("say hello twice", "hello") for x in t.encode(s, add_special_tokens=False).ids]


def test_known_pieces_of_each_kind_stay_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 20)
    enc = tokens.Encoder(tokens.vocabulary_path())
    texts = _texts()
    for _ in range(2):
        for text in texts:
            ids, _ = enc.encode_array(pa.array([text], pa.string()))
            assert ids.tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids
            assert max(len(enc.words.length), len(enc.others.length)) <= 21

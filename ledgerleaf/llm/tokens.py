"""Token ids of whole texts by the tokenizers library, memoised by word.

The tokenizer collapses white space and never merges across it, so the ids of a text are the ids of its
space- and newline-separated pieces in order.  Each distinct piece is encoded by the library; pieces seen
again come from a bounded cache.  ``tests/llm`` holds this against encoding whole texts.
"""

from __future__ import annotations

import os
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces of each kind kept per worker, and the longest one kept (in bytes).
CACHE_WORDS, CACHE_BYTES = 600_000, 64
#: A piece of letters and then marks of these kinds is split exactly there by the tokenizer's pattern, which
#: matches runs of letters and runs of marks; it has alternatives of its own for the apostrophe only.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, (*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100))))
MARKS = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"
_ENCODERS: dict = {}


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Pieces:
    """The pieces of one kind that were seen, their ids one after the other, and the number of each one's ids; the first is no piece at all."""

    def __init__(self):
        self.known, self.flat, self.length = pa.array([""], pa.string()), np.zeros(0, "<u2"), np.zeros(1, np.int64)

    def numbers(self, pieces: pa.Array, encode) -> np.ndarray:
        """Numbers of distinct pieces among the known ones, which new ones join; encode gives (ids, ids of each) of those."""
        at = pc.index_in(pieces, value_set=self.known)
        new = np.asarray(pc.is_null(at))
        out = at.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        if new.any():
            rows = pieces.filter(pa.array(new))
            ids, n = encode(rows.to_pylist())
            out[new] = len(self.length) + np.arange(len(n))
            self.known = pa.concat_arrays([self.known, rows])
            self.flat, self.length = np.concatenate([self.flat, ids]), np.concatenate([self.length, n])
        return out

    def forget(self, base: int, most: int) -> None:
        """Keeps of the pieces from number base on the short ones, as long as there is room."""
        short = np.asarray(pc.less_equal(pc.binary_length(self.known.slice(base)), CACHE_BYTES))
        keep = base + np.flatnonzero(short)[: max(0, most - base)]
        if len(keep) < len(self.length) - base:
            start = np.cumsum(self.length) - self.length
            ends = int(start[base]) if base < len(start) else len(self.flat)
            self.flat = np.concatenate([self.flat[:ends], self.flat[runs(start[keep], self.length[keep])]])
            self.known = pa.concat_arrays([self.known.slice(0, base), self.known.take(pa.array(keep))])
            self.length = np.concatenate([self.length[:base], self.length[keep]])


class Encoder:
    """Ids as unsigned 16-bit numbers (the vocabulary has 49,408 ids)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 65_536:
            raise ValueError("ids must fit in 16 bits")
        self.words, self.others = Pieces(), Pieces()
        self.model, self.written = self.tokenizer.model, str.maketrans({c: self._written(c) for c in LETTERS})
        # a tokenizer that reads words in another way than letter by letter is asked for each as a whole
        self.alone = not any(t.content.isalpha() for t in self.tokenizer.get_added_tokens_decoder().values())
        self.alone = self.alone and all(np.array_equal(self._by_model([w])[0], self._whole([w])[0]) for w in ("a", "the", LETTERS, LETTERS[::-1]))

    def _written(self, letter: str) -> str:
        """A letter as the model reads it, by the tokenizer's own normalizer and pre-tokenizer."""
        normal, split = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        text = normal.normalize_str(letter) if normal else letter
        return "".join(x for x, _ in split.pre_tokenize_str(text)) if split else text

    def _whole(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of each) of any pieces."""
        got = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        return np.frombuffer(array("H", chain.from_iterable(got)), "<u2"), np.fromiter(map(len, got), np.int64, len(got))

    def _by_model(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of words of letters: normalizer and pre-tokenizer leave such a word in one part, letter by letter, so the model alone is called."""
        ids, n, tokenize = array("H"), [], self.model.tokenize
        for word in " ".join(words).translate(self.written).split(" "):
            got = [t.id for t in tokenize(word)]
            n.append(len(got))
            ids.extend(got)
        return np.frombuffer(ids, "<u2"), np.array(n, np.int64)

    def encode_array(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids per text), each text followed by end_id if that is given.

        Every distinct piece of the array is looked up once; the ids are gathered by piece number.  ASCII is
        lower-cased first, as the tokenizer does, unless a text may hold a special token's name.
        """
        if not pc.any(pc.match_substring(texts, "<|")).as_py():
            texts = pc.ascii_lower(texts)
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = lists.flatten().dictionary_encode()
        pieces = coded.dictionary
        word, mark = pc.utf8_rtrim(pieces, characters=MARKS), pc.utf8_ltrim(pieces, characters=LETTERS)
        plain = pc.equal(pc.add(pc.binary_length(word), pc.binary_length(mark)), pc.binary_length(pieces))
        # a piece is a word and a mark, or an odd piece and nothing
        words = pc.if_else(plain, word, "").dictionary_encode()
        others = pc.if_else(plain, mark, pieces).dictionary_encode()
        kinds = ((self.words, words, self._by_model if self.alone else self._whole), (self.others, others, self._whole))
        base = [len(kind.length) for kind, _, _ in kinds]
        parts = np.stack([kind.numbers(x.dictionary, encode)[x.indices.to_numpy()] for kind, x, encode in kinds], 1)
        # both kinds side by side: marks are numbered on from the last word
        parts[:, 1] += len(self.words.length)
        flat, each = (np.concatenate([getattr(kind, x) for kind, _, _ in kinds]) for x in ("flat", "length"))
        start = np.cumsum(each) - each
        table, length = flat[runs(start[parts.reshape(-1)], each[parts.reshape(-1)])], each[parts].sum(1)
        for (kind, _, _), n in zip(kinds, base):
            kind.forget(n, CACHE_WORDS)
        if end_id is not None:
            table, length = np.append(table, np.array([end_id], "<u2")), np.append(length, 1)
        start = np.cumsum(length) - length
        number, ends = coded.indices.to_numpy(), np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy())))
        if end_id is not None:
            number = np.insert(number, ends[1:], len(length) - 1)
            ends = ends + np.arange(len(ends))
        each = length[number]
        upto = np.concatenate(([0], np.cumsum(each)))
        return table.take(runs(start[number], each)), np.diff(upto[ends])

    def encode(self, texts: list[str]) -> list[bytes]:
        ids, n = self.encode_array(pa.array(texts, pa.string()))
        ends = np.cumsum(n) * 2
        raw = ids.tobytes()
        return [raw[e - 2 * k : e] for e, k in zip(ends.tolist(), n.tolist())]


def encoder(path: str) -> Encoder:
    """One per worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the concatenated runs [start, start + length)."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    kind = np.int32 if total < 1 << 31 and int(starts.max(initial=0)) + int(lengths.max(initial=0)) < 1 << 31 else np.int64
    out = np.repeat((starts - before).astype(kind), lengths)
    out += np.arange(total, dtype=kind)
    return out


def batches(texts: pa.Array, most_bytes: int = 8_000_000):
    """(from, to) of consecutive texts of about most_bytes."""
    n = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    a = 0
    while a < len(n):
        before = n[a - 1] if a else 0
        b = min(len(n), int(np.searchsorted(n, before + most_bytes)) + 1)
        yield a, b
        a = b

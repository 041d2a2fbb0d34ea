"""Token ids of many texts, each distinct word encoded once per worker.

For tokenizers whose pre-tokens never hold white space, so that the ids of a text are the ids of its
words one after another.
"""

from __future__ import annotations

import functools
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .words import slices, split_words

#: A worker that knows so many words forgets those that only one slice had.
MOST_WORDS = 400_000
#: What a worker holds beside its words is a few tens of bytes for each byte of a slice.
SLICE_BYTES = 2 << 20


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordCoder:
    """Ids by ``tokenizers`` for words, kept for as long as the worker has room."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has one worker for each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.starts, self.sizes = np.zeros(1024, np.int64), np.zeros(1024, np.int32)
        self.hits = np.zeros(1024, np.int32)
        self.flat, self.used = np.zeros(8192, np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32), 0

    def _forget_rare(self) -> None:
        """Keeps the words that came in more than one slice; all go if those alone are too many."""
        n, slots, starts, sizes, flat, hits = len(self.slots), self.slots, self.starts, self.sizes, self.flat, self.hits
        self._forget()
        if (hits[:n] > 1).sum() <= MOST_WORDS // 2:
            for word, slot in slots.items():
                if hits[slot] > 1:
                    self._store(word, flat[starts[slot]:starts[slot] + sizes[slot]])

    def _store(self, word: str, ids: list[int]) -> None:
        slot, end = len(self.slots), self.used + len(ids)
        if slot == len(self.starts):
            self.starts, self.sizes = np.resize(self.starts, 2 * slot), np.resize(self.sizes, 2 * slot)
            self.hits = np.resize(self.hits, 2 * slot)
        if end > len(self.flat):
            self.flat = np.resize(self.flat, 2 * end)
        self.flat[self.used:end] = ids
        self.starts[slot], self.sizes[slot], self.hits[slot], self.used = self.used, len(ids), 0, end
        self.slots[word] = slot

    def _learn(self, words: list[str]) -> None:
        """Lower-case Latin words are one pre-token that no normalisation changes: they go straight to the
        tokenizer's merges. All others take the whole way."""
        model, others = self.tokenizer.model, []
        for word in words:
            if word.isalpha() and word.islower() and max(word) < "ɐ":
                spelt = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
                self._store(word, [t.id for t in model.tokenize(spelt)])
            else:
                others.append(word)
        for word, found in zip(others, self.tokenizer.encode_batch_fast(others, add_special_tokens=False)):
            self._store(word, found.ids)

    def _slots_of(self, words: pa.Array) -> np.ndarray:
        coded = words.dictionary_encode()
        listed = coded.dictionary.to_pylist()
        self._learn([w for w in listed if w not in self.slots])
        own = np.fromiter((self.slots[w] for w in listed), np.int32, len(listed))
        self.hits[own] += 1
        return own[coded.indices.to_numpy()] if len(words) else np.empty(0, np.int32)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another and where each text's ids begin (one more entry than texts)."""
        if len(self.slots) > MOST_WORDS:
            self._forget_rare()
        words, at = split_words(texts)
        if not len(words):
            return np.empty(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        coded = words.dictionary_encode()
        own = coded.dictionary
        own = pc.if_else(pc.match_substring(own, "<|"), own, pc.ascii_lower(own))  # not the names of special tokens
        cut = pc.extract_regex(own, r"^(?P<stem>.*[\p{L}\p{N}])(?P<mark>[.,!?;:]+)$")  # the marks are a pre-token
        stems = self._slots_of(pc.coalesce(pc.struct_field(cut, "stem"), own))
        marks = self._slots_of(pc.fill_null(pc.struct_field(cut, "mark"), ""))
        parts = np.stack([stems, marks], axis=1)[coded.indices.to_numpy()].ravel()
        sizes = self.sizes[parts]
        ends = np.cumsum(sizes, dtype=np.int64)
        places = np.repeat(self.starts[parts] - ends + sizes, sizes)
        places += np.arange(len(places))
        return self.flat[places], np.concatenate([[0], ends])[2 * at]


@functools.cache
def coder(path: str) -> WordCoder:
    return WordCoder(path)


def encoded(texts: pa.Array, path: str):
    """The ids of each text as an array of unsigned integers, null as an empty text."""
    own = coder(path)
    for start, stop in slices(texts, SLICE_BYTES):
        flat, at = own.encode(texts.slice(start, stop - start))
        for a, b in zip(at[:-1], at[1:]):
            yield flat[a:b]

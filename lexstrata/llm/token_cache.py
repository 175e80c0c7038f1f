"""Token ids of texts, made once for each distinct stretch (a word, or a unit of a piece model).

Of use where a tokenizer never joins what white space separates: the ids of a text are then
those of its stretches, one after another.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable

import numpy as np

from lexstrata.llm.kernels import Words, equal_spans, span_hashes

MOST_WORDS = 600_000


class IdCache:
    """Ids by the hash of a stretch of bytes, whose bytes are kept and compared on every hit.

    It starts afresh beyond `most` stretches, so memory stays bounded. make(list of bytes) gives
    (ids one after another, the number for each).
    """

    def __init__(self, make: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], most: int = MOST_WORDS):
        self.make, self.most = make, most
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at, self.count, self.place, self.size = (np.zeros(0, np.int64) for _ in range(4))
        self.ids, self.bytes = np.zeros(0, np.uint32), np.zeros(0, np.uint8)

    def learn(self, keys: np.ndarray, stretches: list[bytes]) -> None:
        ids, count = self.make(stretches)
        size = np.fromiter(map(len, stretches), np.int64, len(stretches))
        order = np.argsort(all_keys := np.concatenate([self.keys, keys]))
        self.keys = all_keys[order]
        self.at = np.concatenate([self.at, len(self.ids) + np.cumsum(count) - count])[order]
        self.count = np.concatenate([self.count, count])[order]
        self.place = np.concatenate([self.place, len(self.bytes) + np.cumsum(size) - size])[order]
        self.size = np.concatenate([self.size, size])[order]
        self.ids = np.concatenate([self.ids, ids])
        self.bytes = np.concatenate([self.bytes, np.frombuffer(b"".join(stretches), np.uint8)])

    def counts(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, ids: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all stretches one after another (empty unless asked for), and the number for each."""
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        h, example, inverse = np.unique(span_hashes(data, start, end), return_index=True, return_inverse=True)
        new = np.flatnonzero(~np.isin(h, self.keys, assume_unique=True))
        if len(self.keys) + len(new) > self.most:
            self.clear()
            new = np.arange(len(h))
        if len(new):
            some = example[new]
            self.learn(h[new], [data[a:b].tobytes() for a, b in zip(start[some].tolist(), end[some].tolist(), strict=True)])
        own, size = np.searchsorted(self.keys, h)[inverse], end - start
        wrong = np.flatnonzero((self.size[own] != size) | ~equal_spans(data, start, self.bytes, self.place[own], np.minimum(size, self.size[own])))
        at, count, held = self.at[own], self.count[own], self.ids
        if len(wrong):  # another stretch has this hash
            more, each = self.make([data[start[i] : end[i]].tobytes() for i in wrong])
            at[wrong], count[wrong] = len(held) + np.cumsum(each) - each, each
            held = np.concatenate([held, more])
        if len(self.keys) > self.most:  # one block alone has more
            self.clear()
        if not ids:
            return np.zeros(0, np.uint32), count
        sums = np.cumsum(count) - count
        return held[np.repeat(at - sums, count) + np.arange(int(count.sum()))], count


class LibraryWords:
    """Words to ids by the tokenizers library, each word as a text of its own; nothing is added.

    What is surely the same is asked once, for words in ASCII without an added token's first character: all
    spellings in upper and lower case, where the file's normaliser lower-cases; and the letters before
    punctuation at the end of a word, where the file's pre-tokenizer cuts between letters and other signs.
    """

    TAIL = ".,;:!?*#$%&"
    MOST_KNOWN = 300_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.library, self.known = Tokenizer.from_file(path), {}
        self.starts = {t.content[:1] for t in self.library.get_added_tokens_decoder().values()}
        told = json.loads(self.library.to_str())
        norm = told["normalizer"] or {}
        self.lowers = "Lowercase" in {n["type"] for n in norm.get("normalizers", [norm]) if n}
        cut = json.dumps(told["pre_tokenizer"])
        self.parts = self.lowers and "|[\\\\p{L}]+|[\\\\p{N}]|[^\\\\s\\\\p{L}\\\\p{N}]+" in cut

    def split(self, word: str) -> tuple[str, str]:
        """What to ask for: a stem and its tail, or the whole word and nothing."""
        if not self.lowers or not word.isascii() or any(c in word for c in self.starts):
            return word, ""
        word = word.lower()
        stem = word.rstrip(self.TAIL) if self.parts else word
        return (stem, word[len(stem) :]) if stem and stem[-1].isalpha() else (word, "")

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        asked = [self.split(w.decode()) for w in words]
        if len(self.known) > self.MOST_KNOWN:
            self.known.clear()
        known = self.known
        new = list({x: None for pair in asked for x in pair if x and x not in known})
        known |= zip(new, (np.array(e.ids, np.uint32).tobytes() for e in self.library.encode_batch_fast(new, add_special_tokens=False)), strict=True)
        raw = [known[stem] + known[tail] if tail else known[stem] for stem, tail in asked]
        return np.frombuffer(b"".join(raw), np.uint32), np.fromiter(map(len, raw), np.int64, len(raw)) // 4


class WordIds:
    """Ids of whole texts from those of their words."""

    def __init__(self, words: Callable, most: int = MOST_WORDS):
        self.cache = IdCache(words, most)

    def encode(self, data: np.ndarray, offs: np.ndarray, ids: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after another (empty unless asked for), and the number for each row."""
        words = Words(data, offs)
        flat, count = self.cache.counts(data, words.start, words.end, ids)
        sums = np.concatenate([[0], np.cumsum(count)])
        return flat, sums[words.first[1:]] - sums[words.first[:-1]]


_shared: dict[str, WordIds] = {}


def shared_cache(path: str) -> WordIds:
    """One cache for each Python worker and file."""
    if path not in _shared:
        _shared[path] = WordIds(LibraryWords(path))
    return _shared[path]


def vocabulary_size(path: str) -> int:
    """One more than the greatest id of a tokenizers file."""
    from tokenizers import Tokenizer

    return 1 + max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values())

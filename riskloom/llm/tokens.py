"""Token ids of whole texts by a public tokenizer file, each distinct word tokenized about once per task.

``word_bpe_49k.json`` drops white space and never joins pieces over it, so the ids of a text are those of its words
in order.  Words are also cut between an ASCII letter and punctuation other than an apostrophe, where the tokenizer's
own splitting always ends a piece; ASCII capitals are lowered first, as it does, unless the texts hold combining marks
(composition comes before lowering).  The tests compare the ids with those of whole texts.
"""

from __future__ import annotations

import numpy as np

from riskloom.llm import bytesops

MAX_WORDS = 1_500_000  # words remembered by one task, about 40 bytes each

LETTER = np.zeros(256, bool)
LETTER[97:123] = LETTER[65:91] = True
PUNCT = np.zeros(256, bool)
PUNCT[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"]] = True


class WordTokenizer:
    """Ids of texts as one array and its bounds."""

    def __init__(self, name: str = "word_bpe_49k.json", max_words: int = MAX_WORDS):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer, pre_tokenizers

        path = public_tokenizers.path(name)
        self.whole = Tokenizer.from_file(path)
        self.plain = Tokenizer.from_file(path)  # for words of ASCII lower-case letters only
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        size = self.whole.get_vocab_size()
        self.ends = np.zeros(size, bool)
        for token, i in self.whole.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.size = size
        self.dtype = np.uint16 if size <= 1 << 16 else np.uint32
        self.max_words = max_words
        self._forget()

    def _forget(self):
        self.keys = np.zeros(0, np.uint64)  # sorted hashes of known words
        self.first = np.zeros(0, np.int64)  # where a word's ids begin in the pool
        self.count = np.zeros(0, np.int32)
        self.pool, self.used = np.zeros(1 << 16, self.dtype), 0

    def encode(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): the ids of text i are ids[bounds[i]:bounds[i + 1]].

        Texts with what may be a special token, or with the character NUL, are tokenized as a whole.
        """
        whole = [i for i, t in enumerate(texts) if t and (b"<|" in t or b"\0" in t)]
        if not whole:
            return self._by_words(texts)
        ids, bounds = self._by_words([None if t and (b"<|" in t or b"\0" in t) else t for t in texts])
        parts = np.split(ids, bounds[1:-1])
        for i, e in zip(whole, self.whole.encode_batch([texts[i].decode() for i in whole], add_special_tokens=False)):
            parts[i] = np.array(e.ids, self.dtype)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def _by_words(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = bytesops.joined(texts, None)
        if not ((data == 0xCC) | (data == 0xCD)).any():
            data, offsets = bytesops.joined(texts)
        starts, ends = self._pieces(data)
        if not len(starts):
            return np.zeros(0, self.dtype), np.zeros(len(texts) + 1, np.int64)
        words, place, back = np.unique(
            bytesops.segment_hashes(data, starts, ends), return_index=True, return_inverse=True
        )
        at = np.searchsorted(self.keys, words)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == words[known]
        if not known.all():
            if len(self.keys) > self.max_words:
                self._forget()
                known[:] = False
            new = np.flatnonzero(~known)
            raw = data.tobytes()
            s, e = starts[place[new]].tolist(), ends[place[new]].tolist()
            self._learn(words[new], [raw[i:j] for i, j in zip(s, e)])
            at = np.searchsorted(self.keys, words)
        at = at[back]
        count = self.count[at]
        total = np.concatenate([[0], np.cumsum(count, dtype=np.int64)])
        ids = self.pool[np.repeat(self.first[at] - total[:-1], count) + np.arange(total[-1])]
        return ids, total[np.searchsorted(starts, offsets)]

    @staticmethod
    def _pieces(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        space = bytesops.SPACE[data]
        cut = np.zeros(len(data), bool)
        cut[1:] = PUNCT[data[1:]] & LETTER[data[:-1]]
        begin = ~space
        begin[1:] &= space[:-1] | cut[1:]
        end = np.zeros(len(data), bool)
        end[1:] = ~space[:-1] & (space[1:] | cut[1:])
        return np.flatnonzero(begin), np.flatnonzero(end)

    def _learn(self, keys: np.ndarray, words: list[bytes]) -> None:
        count = np.zeros(len(words), np.int32)
        ids: list = [None] * len(words)
        easy = [i for i, w in enumerate(words) if w.isalpha() and w.islower()]
        hard = sorted(set(range(len(words))) - set(easy))
        for lo in range(0, len(easy), 4096):
            part = easy[lo : lo + 4096]
            found = np.array(
                self.plain.encode(b" ".join([words[i] for i in part]).decode(), add_special_tokens=False).ids, self.dtype
            )
            for i, x in zip(part, np.split(found, np.flatnonzero(self.ends[found])[:-1] + 1), strict=True):
                ids[i], count[i] = x, len(x)
        for lo in range(0, len(hard), 4096):
            part = hard[lo : lo + 4096]
            for i, e in zip(part, self.whole.encode_batch([words[i].decode() for i in part], add_special_tokens=False)):
                ids[i] = np.array(e.ids, self.dtype)
                count[i] = len(ids[i])
        flat = np.concatenate(ids) if ids else np.zeros(0, self.dtype)
        if self.used + len(flat) > len(self.pool):
            bigger = np.zeros(max(2 * len(self.pool), self.used + len(flat)), self.dtype)
            bigger[: self.used] = self.pool[: self.used]
            self.pool = bigger
        self.pool[self.used : self.used + len(flat)] = flat
        first = self.used + np.concatenate([[0], np.cumsum(count[:-1], dtype=np.int64)])
        self.used += len(flat)
        where = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, where, keys)
        self.first = np.insert(self.first, where, first)
        self.count = np.insert(self.count, where, count)

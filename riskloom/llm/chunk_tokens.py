"""Token ids of whole texts by public byte-level and sentence-piece BPE files, each distinct chunk tokenized about once.

Texts are cut where neither tokenizer ever joins anything: before a space or line end whose previous byte surely ends no
white space, between a Latin letter and ASCII punctuation, and after a single line end.
The byte-level tokenizer splits at these places before merging; that no piece of the other one goes on over them is
verified on loading.  So the ids of a text are those of its chunks in order.  Texts are not separated by any byte; no
character is special.
"""

from __future__ import annotations

import re

import numpy as np

from riskloom.llm import bytesops

MAX_CHUNKS = 1_500_000  # chunks remembered by a process, about 50 bytes each

#: Bytes that are no white space and never the last byte of any: ASCII beyond the space, and what no Unicode white
#: space (U+0085, U+00A0, U+1680, U+2000 to U+200A, U+2028, U+2029, U+202F, U+205F, U+3000) ends with.
SAFE = np.zeros(256, bool)
SAFE[33:127] = SAFE[128:] = True
SAFE[[*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = False
GAP = np.zeros(256, bool)
GAP[[10, 32]] = True  # other white space stands inside pieces, so texts are not cut there
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True
PUNCT = np.zeros(256, bool)
PUNCT[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "|"]] = True  # special tokens hold "text|"
PRINTED = np.zeros(256, bool)  # a character other than white space begins so
PRINTED[33:127] = PRINTED[0xC3] = True
LATIN = 0xC3  # first byte of U+00C0 to U+00FF, letters but for the signs of multiplication and division
SIGNS = (0x97, 0xB7)
LATIN_TEXT = re.compile(r"[\x00-\x7F\xC0-\xFF]*").fullmatch


def flat_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, start of each text and the end of all) without anything between texts."""
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    return np.frombuffer(b"".join(texts), np.uint8), bounds


def chunk_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The first byte of each chunk; every non-empty text begins one."""
    begin = np.zeros(len(data), bool)
    if len(data) > 1:
        gap, safe = GAP[data], SAFE[data]
        letter = LETTER[data]
        letter[1:] |= (data[:-1] == LATIN) & (data[1:] != SIGNS[0]) & (data[1:] != SIGNS[1])
        begin[1:] = (gap[1:] & safe[:-1]) | (letter[:-1] & PUNCT[data[1:]])
        # x, one line end, y: the line end is a token of its own
        begin[2:] |= safe[:-2] & (data[1:-1] == 10) & PRINTED[data[2:]]
    begin[bounds[:-1][bounds[:-1] < len(data)]] = True
    return np.flatnonzero(begin)


class ChunkTokenizer:
    """Ids of texts as one array and its bounds; subclasses say what a token's bytes and a chunk's ids are."""

    size: int

    def __init__(self, max_chunks: int = MAX_CHUNKS):
        self.dtype = np.uint16 if self.size <= 1 << 16 else np.uint32
        self.max_chunks = max_chunks
        self._forget()

    def _chunk_ids(self, chunks: list[bytes]) -> list[list[int]]:
        raise NotImplementedError

    def _forget(self) -> None:
        self.keys = np.full(1, 2**64 - 1, np.uint64)  # sorted hashes of known chunks, and one beyond them
        self.first = np.zeros(1, np.int64)  # where a chunk's ids begin in the pool
        self.count = np.zeros(1, np.int64)
        self.pool, self.used = np.zeros(1 << 16, self.dtype), 0

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): the ids of text i are ids[bounds[i]:bounds[i + 1]]."""
        data, bounds = flat_texts(texts)
        return self.encode_flat(data, bounds, chunk_starts(data, bounds))

    def encode_flat(
        self, data: np.ndarray, bounds: np.ndarray, starts: np.ndarray, hashes: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        if not len(starts):
            return np.zeros(0, self.dtype), np.zeros(len(bounds), np.int64)
        ends = np.append(starts[1:], len(data))
        if hashes is None:
            hashes = bytesops.segment_hashes(data, starts, ends)
        at = self._places(hashes)
        new = at < 0
        if new.any() and len(self.keys) > self.max_chunks:
            self._forget()
            at = self._places(hashes)
            new[:] = True
        first, count = self.first[at], self.count[at]  # of unknown chunks: overwritten below
        if new.any():
            keys, place = np.unique(hashes[new], return_index=True)
            where = np.flatnonzero(new)[place]
            raw = data.tobytes()
            self._learn(keys, self._chunk_ids([raw[i:j] for i, j in zip(starts[where].tolist(), ends[where].tolist())]))
            at = self._places(hashes[new])
            first[new], count[new] = self.first[at], self.count[at]
        total = np.zeros(len(count) + 1, np.int64)
        np.cumsum(count, out=total[1:])
        ids = self.pool[np.repeat(first - total[:-1], count) + np.arange(total[-1])]
        return ids, total[np.searchsorted(starts, bounds)]

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        """Where each hash stands among the known ones, -1 if it is new."""
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, at, -1)

    def _learn(self, keys: np.ndarray, ids: list[list[int]]) -> None:
        count = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((x for own in ids for x in own), self.dtype, int(count.sum()))
        if self.used + len(flat) > len(self.pool):
            bigger = np.zeros(max(2 * len(self.pool), self.used + len(flat)), self.dtype)
            bigger[: self.used] = self.pool[: self.used]
            self.pool = bigger
        self.pool[self.used : self.used + len(flat)] = flat
        first = self.used + np.cumsum(count) - count
        self.used += len(flat)
        where = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, where, keys)
        self.first = np.insert(self.first, where, first)
        self.count = np.insert(self.count, where, count)


class ByteTokenizer(ChunkTokenizer):
    """A byte-level BPE file of the ``tokenizers`` library.

    With ``plain`` the strings of special tokens inside texts are ordinary text; otherwise they become these tokens, as
    the library does by default.
    """

    def __init__(self, name: str = "byte_bpe_50k.json", plain: bool = False, **options):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(public_tokenizers.path(name))
        self.model.encode_special_tokens = plain
        self.special = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.size = self.model.get_vocab_size()
        self.quick = _ranked(public_tokenizers, name.replace(".json", ".tiktoken"))
        super().__init__(**options)

    def _chunk_ids(self, chunks: list[bytes]) -> list[list[int]]:
        """Chunks of ASCII and Latin letters by the same vocabulary as ranks, which is faster; others by the file."""
        texts = [c.decode() for c in chunks]
        easy = [self.quick and LATIN_TEXT(t) and not any(x in t for x in self.special) for t in texts]
        found = map(self.quick.encode_ordinary, [t for t, e in zip(texts, easy) if e]) if any(easy) else iter(())
        hard = [t for t, e in zip(texts, easy) if not e]
        rest = iter(e.ids for e in self.model.encode_batch_fast(hard, add_special_tokens=False))
        return [next(found) if e else next(rest) for e in easy]

    def token_bytes(self) -> list[bytes]:
        """The bytes of each id: its entry, byte-level decoded."""
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        byte_of = {chr(b): b for b in shown}
        byte_of |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in set(shown))}
        out = [b""] * self.size
        for entry, i in self.model.get_vocab().items():
            out[i] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
        return out


def _ranked(files, name: str):
    """The encoder of a rank file, None where there is none."""
    import base64
    import os

    import tiktoken

    if not os.path.exists(files.path(name)):
        return None
    with open(files.path(name), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(name, pat_str=files.PATTERN, mergeable_ranks=ranks, special_tokens={})


class PieceTokenizer(ChunkTokenizer):
    """A sentence-piece BPE model.  Texts are given with the space before them that the model itself would add."""

    def __init__(self, name: str = "piece_bpe_32k.model", **options):
        import public_tokenizers
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        self.size = self.model.get_piece_size()
        self.pieces = [self.model.id_to_piece(i) for i in range(self.size)]
        for i, p in enumerate(self.pieces):
            if self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i):
                continue
            raw = np.frombuffer(p.replace("▁", " ").encode(), np.uint8)
            inner = chunk_starts(raw, np.array([0, len(raw)]))
            if len(inner) > 1 or (raw == 10).any():
                raise ValueError(f"piece {p!r} goes on over a place where texts are cut")
        self.lead = self.model.encode("\n")  # the added space and the line end
        super().__init__(**options)

    def _chunk_ids(self, chunks: list[bytes]) -> list[list[int]]:
        # behind a line end, as the model would add a space to a chunk at the beginning
        n = len(self.lead)
        return [ids[n:] for ids in self.model.encode(["\n" + c.decode() for c in chunks], num_threads=1)]

    def token_bytes(self) -> list[bytes]:
        """The bytes of each id: its piece in UTF-8 with spaces for U+2581, a byte piece as its byte."""
        return [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(self.pieces)
        ]


_made: dict[tuple, ChunkTokenizer] = {}


def shared(kind: type[ChunkTokenizer], *args, **options) -> ChunkTokenizer:
    """One tokenizer per worker process: what it has learned serves all its later tasks."""
    key = (kind, args, tuple(sorted(options.items())))
    if key not in _made:
        _made[key] = kind(*args, **options)
    return _made[key]

"""Token ids of whole texts with the tokenizers library, each distinct word encoded once a worker.

The vocabulary splits texts at white space, so the ids of a text are the ids of its words, one after another. A word of
ASCII letters and trailing marks is further cut in two, and its letters compared in lower case, as the vocabulary's
normaliser and splitting rule do. Every other word goes through the tokenizer as it is. Tests compare with encoding whole texts.
"""

from __future__ import annotations

import numpy as np

from .arrays import IS_SPACE, SLICE_BYTES, Words, byte_values, memo, prefix_sums, range_hashes, slices
from .units import UnitCache

#: Marks that may follow a word of letters and then form a token sequence of their own.
TAIL_MARKS = b".,!?;:*%$&#|"
#: Fixed value: words of letters up to this one are one token sequence each, whatever case and normal form do to them.
LATIN_END = "\u012f"
#: Bytes of text encoded at once.
BATCH_BYTES = 8 << 20


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers import normalizers as N
        from tokenizers import pre_tokenizers as P

        self.full = Tokenizer.from_file(path)
        # the same vocabulary and merges for words of lower-case ASCII letters, which the other steps leave as they are
        self.lean = Tokenizer.from_file(path)
        self.lean.normalizer = N.Sequence([])
        self.lean.pre_tokenizer = P.WhitespaceSplit()
        size = self.full.get_vocab_size()
        self.bits = max(1, (size - 1).bit_length())
        vocabulary = self.full.get_vocab()
        self.ends = np.zeros(size, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.cache = UnitCache(np.uint16 if self.bits <= 16 else np.uint32)
        kind = np.zeros(256, np.uint8)  # 0 other, 1 letter, 2 mark
        kind[list(range(97, 123))] = 1
        kind[list(TAIL_MARKS)] = 2
        self.kind = kind

    @classmethod
    def kept(cls, path: str) -> Encoder:
        kept = memo()
        if ("bpe", path) not in kept:
            kept["bpe", path] = cls(path)
        return kept["bpe", path]

    def _units(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """data (letters in lower case), starts, ends and row of the units of some rows."""
        data = words.data
        if b"<|" not in data.tobytes():  # else a special token's string may lie in it, which is told by its case
            upper = (data >= 65) & (data <= 90)
            data = data + (upper.astype(np.uint8) << 5)
        kind = self.kind[data]
        if not len(words.starts):
            return data, words.starts, words.ends, words.row
        other = np.zeros(len(data) + 1, np.int32)
        np.cumsum((kind == 0) & ~IS_SPACE[data], out=other[1:])
        change = np.zeros(len(data), bool)
        np.not_equal(kind[1:], kind[:-1], out=change[1:])
        changes = np.flatnonzero(change)
        turns = np.zeros(len(data) + 1, np.int32)  # changes before each byte
        np.cumsum(change, out=turns[1:])
        after = turns[words.starts + 1]  # each word's first change after its first byte
        inside = turns[words.ends] - after
        cut = (inside == 1) & (other[words.ends] == other[words.starts]) & (kind[words.starts] == 1)
        at = changes[after[cut]]
        n = len(words.starts) + len(at)
        starts, ends, row = np.empty(n, np.int64), np.empty(n, np.int64), np.empty(n, np.int64)
        place = np.arange(len(words.starts)) + np.cumsum(cut) - cut
        starts[place], row[place] = words.starts, words.row
        ends[place] = words.ends
        ends[place[cut]] = at
        starts[place[cut] + 1], ends[place[cut] + 1], row[place[cut] + 1] = at, words.ends[cut], words.row[cut]
        return data, starts, ends, row

    def rows(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all rows and the number of ids of each."""
        flat, counts = [], []
        for i, j in slices(offsets, BATCH_BYTES):
            buffers, starts, ends, hashes, row, base = [], [], [], [], [], 0
            for k, m in slices(offsets[i : j + 1], SLICE_BYTES):
                words = Words(data, offsets, i + k, i + m)
                part, s, e, r = self._units(words)
                hashes.append(range_hashes(prefix_sums(byte_values()[part]), s, e))
                buffers.append(part)
                starts.append(s + base)
                ends.append(e + base)
                row.append(r + k)
                base += len(part)
            buffer = np.concatenate(buffers).tobytes()
            start, end = np.concatenate(starts), np.concatenate(ends)
            if len(start):
                slots = self.cache.slots(np.concatenate(hashes), lambda at, b=buffer, s=start, e=end: self._encode([b[x:y].decode() for x, y in zip(s[at].tolist(), e[at].tolist(), strict=True)]))
                ids, _ = self.cache.gather(slots)
                per_row = np.bincount(np.concatenate(row), weights=self.cache.length[slots], minlength=j - i).astype(np.int64)
            else:
                ids, per_row = np.zeros(0, self.cache.dtype), np.zeros(j - i, np.int64)
            flat.append(ids)
            counts.append(per_row)
        if not flat:
            return np.zeros(0, self.cache.dtype), np.zeros(0, np.int64)
        return np.concatenate(flat), np.concatenate(counts)

    def _encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        out: list = [None] * len(units)
        ways: tuple[list, list, list] = ([], [], [])
        for x, u in enumerate(units):
            ways[(0 if u.isascii() and u.islower() else 1 if max(u) <= LATIN_END else 2) if u.isalpha() else 2].append(x)
        for tokenizer, where in zip((self.lean, self.full), ways, strict=False):
            for k in range(0, len(where), 4096):
                some = where[k : k + 4096]
                ids = np.array(tokenizer.encode_batch_fast([" ".join([units[x] for x in some])], add_special_tokens=False)[0].ids, np.uint32)
                stops = (np.flatnonzero(self.ends[ids]) + 1).tolist()
                for x, i, j in zip(some, [0, *stops], stops, strict=False):
                    out[x] = ids[i:j]
        for k in range(0, len(ways[2]), 4096):
            some = ways[2][k : k + 4096]
            for x, found in zip(some, self.full.encode_batch_fast([units[y] for y in some], add_special_tokens=False), strict=True):
                out[x] = np.array(found.ids, np.uint32)
        lengths = np.array([len(x) for x in out], np.int64)
        return np.concatenate(out), lengths

"""Byte-level BPE ids of whole texts, each distinct pre-token encoded once per worker.

A byte-level BPE never merges across pre-tokens, so the ids of a text are those of
its pre-tokens in a row. The split is done on vectors of code points; the pieces go
through the tokenizers library and are remembered. They are found again by a hash and then compared letter by letter. Texts with code points
beyond the Latin blocks, or with a literal added token (``<|endoftext|>``), go to the library whole.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

from lethe.llm.common import span_hashes

_LATIN = 0x250
_BEYOND = re.compile("[\u0250-\U0010ffff]")
_LETTER, _NUMBER, _SPACE, _OTHER = 0, 1, 2, 3
#: Longer pieces are encoded in every slice they occur in.
LONGEST_KEPT = 64
#: Pieces remembered by a worker before it starts anew.
KEPT_PIECES = 1_000_000
#: And code points in them.
KEPT_CODES = 1 << 24
_AT_ONCE = 8192
_CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")  # fixed values of the split pattern


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    import unicodedata

    kinds = np.full(_LATIN, _OTHER, np.uint8)
    for code in range(_LATIN):
        kind = unicodedata.category(chr(code))[0]
        if kind in "LN":
            kinds[code] = _LETTER if kind == "L" else _NUMBER
        elif re.match(r"\s", chr(code)) and not 0x1C <= code <= 0x1F:
            kinds[code] = _SPACE
    return kinds


def split_points(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pre-tokens of several texts laid end to end (Latin code points only)."""
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = _classes()[codes]
    begins = np.zeros(n + 1, bool)
    begins[offsets] = True
    start = begins[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    # The last of some white space goes with what follows if it is a blank, else it stands alone.
    ends_text = begins[1:]
    last_space = np.zeros(n, bool)
    last_space[:-1] = (kind[:-1] == _SPACE) & (kind[1:] != _SPACE)
    last_space &= ~ends_text
    at = np.flatnonzero(last_space)
    start[at] = True
    start[at[codes[at] == 32] + 1] = False
    # Contractions, where a piece begins with the apostrophe.
    for i in np.flatnonzero((codes == 39) & start).tolist():
        stop = i + 1
        while stop < min(i + 3, n) and not begins[stop]:
            stop += 1
        tail = "".join(map(chr, codes[i + 1 : stop]))
        for ending in _CONTRACTIONS:
            if tail.startswith(ending):
                start[i + 1] = False
                if i + 1 + len(ending) < n:
                    start[i + 1 + len(ending)] = True
                break
    starts = np.flatnonzero(start)
    return starts, np.append(starts[1:], n)


class Encoder:
    """Ids of texts by the vocabulary file at ``path``, with remembered pieces."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.added = list(self.library.get_added_tokens_decoder().values())
        self._odd = re.compile("|".join([_BEYOND.pattern, *(re.escape(t.content) for t in self.added)]))
        self._reset()

    def _reset(self) -> None:
        self.keys, self.places = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.begin, self.ids = np.zeros(1, np.int64), np.zeros(0, np.int32)
        # The code points of each entry, to tell pieces that only share a hash.
        self.spelled, self.spelling = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def odd(self, text: str) -> bool:
        """Whether ``text`` has to go to the library whole."""
        return self._odd.search(text) is not None

    def _parted(self, texts: list[str | None]) -> tuple[list[str], list[str], list[int]]:
        """The texts, the same with empty ones for those that go to the library whole, and the places of these."""
        texts = [t or "" for t in texts]
        odd = [k for k, t in enumerate(texts) if self.odd(t)]
        gone = set(odd)
        return texts, ["" if k in gone else t for k, t in enumerate(texts)] if odd else texts, odd

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _add(self, pieces: list[str]) -> int:
        """Encode pieces and return the entry of the first; the others follow."""
        base, lengths, ids = len(self.begin) - 1, [], []
        for at in range(0, len(pieces), _AT_ONCE):  # what the library returns takes far more room than the ids
            found = self._whole(pieces[at : at + _AT_ONCE])
            lengths.append(np.fromiter(map(len, found), np.int64, len(found)))
            ids.append(np.fromiter((i for one in found for i in one), np.int32, int(lengths[-1].sum())))
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(np.concatenate(lengths))])
        self.ids = np.concatenate([self.ids, *ids])
        widths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self.spelled = np.concatenate([self.spelled, self.spelled[-1] + np.cumsum(widths)])
        self.spelling = np.concatenate([self.spelling, np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32)])
        return base

    def _strangers(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, entry: np.ndarray) -> np.ndarray:
        """Pieces that are spelled otherwise than their entry: equal hashes of different texts."""
        width = self.spelled[entry + 1] - self.spelled[entry]
        other = width != ends - starts
        # Pieces lie end to end; those of another length are left out of the comparison.
        there = np.repeat(np.where(other, 0, self.spelled[entry]) - starts, ends - starts) + np.arange(len(codes))
        wrong = self.spelling[np.minimum(there, len(self.spelling) - 1)] != codes if len(codes) else np.zeros(0, bool)
        other[np.searchsorted(starts, np.flatnonzero(wrong), side="right") - 1] = True
        return np.flatnonzero(other)

    def pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of Latin texts without added tokens: code points, offsets of texts, starts and ends of pieces, entry of each piece."""
        joined = "".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        offsets = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])
        starts, ends = split_points(codes, offsets)
        if len(self.begin) > KEPT_PIECES or len(self.spelling) > KEPT_CODES:
            self._reset()
        unique, first, inverse = np.unique(span_hashes(codes, starts, ends), return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, unique)
        entry = np.full(len(unique), -1, np.int64)
        if len(self.keys):
            near = np.minimum(at, len(self.keys) - 1)
            entry = np.where(self.keys[near] == unique, self.places[near], -1)
        missing = np.flatnonzero(entry < 0)
        if len(missing):
            low, high = starts[first[missing]], ends[first[missing]]
            base = self._add([joined[a:b] for a, b in zip(low.tolist(), high.tolist(), strict=True)])
            entry[missing] = base + np.arange(len(missing))
            kept = missing[high - low <= LONGEST_KEPT]
            self.keys, self.places = (np.insert(x, at[kept], y[kept]) for x, y in ((self.keys, unique), (self.places, entry)))
        entry = entry[inverse]
        strangers = self._strangers(codes, starts, ends, entry)
        if len(strangers):
            base = self._add([joined[a:b] for a, b in zip(starts[strangers].tolist(), ends[strangers].tolist(), strict=True)])
            entry[strangers] = base + np.arange(len(strangers))
        return codes, offsets, starts, ends, entry

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row and the number of ids of each text; null is empty."""
        texts, plain, odd = self._parted(texts)
        _, offsets, starts, _, entry = self.pieces(plain)
        width = self.begin[entry + 1] - self.begin[entry]
        total = np.concatenate([[0], np.cumsum(width)])
        from_entry = np.repeat(self.begin[entry] - total[:-1], width) + np.arange(total[-1])
        ids = self.ids[from_entry]
        bounds = total[np.searchsorted(starts, offsets)]
        counts = np.diff(bounds)
        if odd:
            parts, at = [], 0
            for k, found in zip(odd, self._whole([texts[k] for k in odd]), strict=True):
                parts += [ids[at : bounds[k]], np.array(found, np.int32)]
                at, counts[k] = bounds[k], len(found)
            ids = np.concatenate([*parts, ids[at:]])
        return ids, counts

    def counts(self, texts: list[str | None]) -> np.ndarray:
        """The number of ids of each text."""
        texts, plain, odd = self._parted(texts)
        _, offsets, starts, _, entry = self.pieces(plain)
        total = np.concatenate([[0], np.cumsum(self.begin[entry + 1] - self.begin[entry])])
        found = np.diff(total[np.searchsorted(starts, offsets)])
        for k, ids in zip(odd, self._whole([texts[k] for k in odd]) if odd else [], strict=True):
            found[k] = len(ids)
        return found


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each worker process and vocabulary."""
    return Encoder(path)


def default_vocabulary() -> str:
    """The path of the public byte-level vocabulary that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")

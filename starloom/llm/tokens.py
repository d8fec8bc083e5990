"""Token ids of whole texts by a given tokenizer, with the work on repeated pieces done once.

A text is cut where a cut provably changes no token, each distinct piece is
encoded by the library once per cache, and the ids are put together again.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa

from starloom.llm import words as W

_BYTES = np.arange(256)
#: Pieces end at these four characters only.
_PIECE = ~np.isin(_BYTES, np.frombuffer(b" \n\t\r", np.uint8))
#: Other white space that a tokenizer may know; texts with it are encoded whole.
_OTHER_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]")
#: First bytes of such characters in UTF-8.
_SUSPECT = np.isin(_BYTES, [0x0B, 0x0C, 0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3, 0xEF])
#: Pieces encoded per call.
_CALL = 4096


class PieceEncoder:
    """``spaces`` says what the tokenizer does with white space.

    "leading": byte-level patterns put a space before a word; a run of white
    space after another character always begins a new match, so a piece is
    such a run and the word behind it. "dropped": no match goes over white
    space and none is kept, so a piece is a word.

    The cache holds ``cache`` pieces by 64-bit hash and starts anew when full.
    """

    def __init__(self, path: str, spaces: str, cache: int = 2_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.leading, self.limit = spaces == "leading", cache
        special = [(t.content, i) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special]
        # A special token between two pieces keeps them apart within one call.
        self.mark, self.mark_id = special[0] if special else ("", -1)
        self._clear()

    def _clear(self) -> None:
        self.keys, self.at, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if self.mark:
            ids = self.whole(self.mark.encode().join(pieces).decode())
            cuts = np.flatnonzero(ids == self.mark_id)
            if len(cuts) == len(pieces) - 1:
                return ids[ids != self.mark_id], np.diff(np.concatenate([[-1], cuts, [len(ids)]])) - 1
        each = [self.whole(p.decode()) for p in pieces]  # a piece holds the mark itself
        return np.concatenate(each), np.array([len(x) for x in each])

    def _learn(self, keys: np.ndarray, pieces: list[bytes]) -> None:
        parts, counts = [], []
        for i in range(0, len(pieces), _CALL):
            ids, n = self._encode_pieces(pieces[i : i + _CALL])
            parts.append(ids), counts.append(n)
        ids, counts = np.concatenate(parts), np.concatenate(counts)
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.used], np.zeros(self.used // 2 + 2 * len(ids), np.uint32)])
        self.pool[self.used : self.used + len(ids)] = ids
        at = self.used + np.cumsum(counts) - counts
        self.used += len(ids)
        where = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, where, keys)
        self.at, self.counts = np.insert(self.at, where, at), np.insert(self.counts, where, counts)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and the number of each text."""
        data, offsets = W.text_bytes(column)
        rows = len(offsets) - 1
        words = W.find_words(data, offsets, _PIECE)
        starts, ends, docs = words.starts, words.ends, words.docs()
        if self.leading:
            # White space belongs to the word behind it, what is left at the end is a piece.
            begin = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
            begin[words.first[:-1][words.counts > 0]] = offsets[:-1][words.counts > 0]
            tail = np.concatenate([[0], ends])[words.first[1:]]
            tail = np.where(words.counts > 0, tail, offsets[:-1])
            rest = np.flatnonzero(tail < offsets[1:])
            place = words.first[1:][rest]
            starts, ends = np.insert(begin, place, tail[rest]), np.insert(ends, place, offsets[1:][rest])
            docs = np.insert(docs, place, rest)
        suspect = np.unique(np.searchsorted(offsets, np.flatnonzero(_SUSPECT[data]), "right") - 1)
        whole = [d for d in suspect.tolist() if _OTHER_SPACE.search(column[d].as_py())]
        if whole:
            keep = ~np.isin(docs, whole)
            starts, ends, docs = starts[keep], ends[keep], docs[keep]
        if len(self.keys) > self.limit:
            self._clear()
        keys, one, which = np.unique(W.span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        if len(self.keys):
            known = self.keys[np.minimum(at, len(self.keys) - 1)] == keys
        if not known.all():
            new, raw = one[~known], data.tobytes()
            self._learn(keys[~known], [raw[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())])
            at = np.searchsorted(self.keys, keys)
        at = at[which.ravel()]
        counts = self.counts[at]
        ids = self.pool[W.ranges(self.at[at], counts)]
        totals = np.bincount(docs, counts, minlength=rows).astype(np.int64)
        for d in whole:
            own = self.whole(column[d].as_py())
            ids = np.insert(ids, int(totals[:d].sum()), own)
            totals[d] = len(own)
        return ids, totals


@lru_cache(maxsize=4)
def encoder(path: str, spaces: str) -> PieceEncoder:
    """One per worker process and vocabulary."""
    return PieceEncoder(path, spaces)

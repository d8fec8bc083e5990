"""Token counts of whole texts, huge ones by overlapping chunks.

A huge text is encoded in chunks that overlap. Where both encodings of an
overlap begin a match of the tokenizer's pattern at the same place, all that
follows is the same for both, so the counts are spliced there. An overlap
without such a place is widened until it has one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from starloom.llm import words as W
from starloom.llm.tokens import PieceEncoder, encoder


@dataclass(frozen=True)
class Settings:
    """Texts of more than ``chunk`` characters are encoded in chunks of that size.

    ``margin`` characters at the end of a chunk are not trusted: there a match,
    its lookahead or a special token may be cut off.
    """

    chunk: int = 1 << 16
    overlap: int = 256
    margin: int = 32
    limit: int = 512


def _matches(coder: PieceEncoder, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Places where a match of the pattern or a special token begins, and the tokens before each."""
    encoding = coder.tokenizer.encode(text, add_special_tokens=False)
    starts = np.array([a for a, _ in encoding.offsets], np.int64)
    ends = np.array([b for _, b in encoding.offsets], np.int64)
    parts = np.array([-1 if w is None else w for w in encoding.word_ids], np.int64)
    if not len(starts):
        return starts, starts
    new = np.ones(len(starts), bool)
    # A special token restarts the numbers of the matches; its neighbours differ from it or it has none.
    new[1:] = (parts[1:] != parts[:-1]) | (parts[1:] < 0)
    # A place counts only if no token reaches over it.
    new[1:] &= np.maximum.accumulate(ends)[:-1] <= starts[1:]
    at = np.flatnonzero(new)
    return starts[at], at


def count_huge(coder: PieceEncoder, text: str, s: Settings) -> int:
    """Tokens of a text of any length, with one chunk in memory."""
    total, begin, skip = 0, 0, 0
    size, overlap = s.chunk, s.overlap
    while True:
        end = begin + size
        places, before = _matches(coder, text[begin:end])
        tokens_here = len(coder.whole(text[begin:end]))
        if end >= len(text):
            return total + tokens_here - skip
        splice = None
        while splice is None:
            start = max(begin, end - overlap)
            right, right_before = _matches(coder, text[start : end + overlap])
            common, i, j = np.intersect1d(places + begin, right + start, return_indices=True)
            # Sure for the left chunk; later than where the last splice was.
            sure = np.flatnonzero((common <= end - s.margin) & (before[i] >= skip) & (common > max(start, begin)))
            if len(sure):
                splice = int(common[sure[-1]]), int(before[i[sure[-1]]])
            elif start > begin:
                overlap *= 2
            else:
                break
        if splice is None:  # no place in the whole chunk: a longer one is needed
            size *= 2
            continue
        place, tokens = splice
        total += tokens - skip
        # The next chunk begins where both agree: its tokens are the text's from there on.
        begin, skip, size, overlap = place, 0, s.chunk, s.overlap


def count(column: pa.Array, path: str, spaces: str, s: Settings) -> list[pa.Array]:
    coder = encoder(path, spaces)
    texts = [t or "" for t in column.to_pylist()]
    _, offsets = W.text_bytes(column)
    _, counts = coder.encode(pa.array([t if len(t) <= s.chunk else "" for t in texts], pa.string()))
    for i, t in enumerate(texts):
        if len(t) > s.chunk:
            counts[i] = count_huge(coder, t, s)
    return [pa.array(np.diff(offsets)), pa.array(counts), pa.array(counts > s.limit)]


FIELDS = [
    T.StructField("n_bytes", T.LongType(), False),
    T.StructField("n_tokens", T.LongType(), False),
    T.StructField("over_limit", T.BooleanType(), False),
]


def token_counts(docs: DataFrame, path: str, spaces: str = "leading", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Adds the UTF-8 size and the number of tokens to each row, without a shuffle.

    Null and empty texts have none. Special strings inside a text count as the
    tokenizer's default has it. ``path`` is the vocabulary file, which every
    executor must have. Columns named like a result are replaced.
    """
    return W.map_texts(docs, text, FIELDS, lambda rows: count(rows.column(text), path, spaces, settings))

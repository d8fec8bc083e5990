"""Quality rules on repetition: characters inside repeated n-grams and lines.

Every text is judged whole, in its own row, without a shuffle. Sequences of
words are compared by 64-bit rolling hashes that are sorted per chunk of rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from starloom.llm import words as W

_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_LETTER_START = (np.arange(256) & 0xC0) != 0x80
_LINE_END = np.arange(256) != 0x0A


@dataclass(frozen=True)
class Rules:
    """Limits of the verdict.

    ``repeated`` gives, for each n, the largest share of a text's word
    characters that may lie in n-grams found twice or more in the text;
    ``lines`` the largest share that may lie in lines equal to an earlier line;
    ``symbols`` the largest number of symbols per word.
    """

    min_words: int = 50
    repeat_words: float = 0.5
    repeated: tuple[tuple[int, float], ...] = tuple((n, 0.40) for n in range(5, 11))
    lines: float = 0.30
    symbols: float = 0.10


FIELDS = [T.StructField(n, T.LongType(), False) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] + [
    T.StructField("base_failed", T.BooleanType(), False),
    T.StructField("dup_line_chars", T.LongType(), False),
    T.StructField("dup_ngram_chars", T.ArrayType(T.LongType()), False),
    T.StructField("kept", T.BooleanType(), False),
]


def measure(column: pa.Array, rules: Rules) -> list[pa.Array]:
    data, offsets = W.text_bytes(column)
    words = W.find_words(data, offsets)
    hashes, docs = words.hashes(), words.docs()
    letters = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_LETTER_START[data], out=letters[1:])
    chars = letters[words.ends] - letters[words.starts]
    n_words, word_chars = words.counts, W.per_text(chars, words.first)
    symbols = W.per_text(_SYMBOL[data], offsets)
    salt = W.mix(np.arange(len(offsets) - 1, dtype=np.uint64) + np.uint64(1))

    def repeats(n: int) -> np.ndarray:
        at = W.windows(words, n)
        often, _ = W.twins(W.sequence_hashes(hashes, n)[at] ^ salt[docs[at]])
        return W.covered(len(hashes), at[often], n)

    triples = W.per_text(repeats(3), words.first)
    grams = np.array([W.per_text(chars * repeats(n), words.first) for n, _ in rules.repeated]).reshape(len(rules.repeated), len(n_words))

    # A line is compared from its first byte to its last, white space included.
    lines = W.find_words(data, offsets, _LINE_END)
    at_word = np.searchsorted(words.starts, lines.starts)
    to_word = np.searchsorted(words.starts, lines.ends)
    real = to_word > at_word
    line_docs = lines.docs()
    later = np.zeros(len(real), bool)
    later[real] = W.twins((lines.hashes() ^ salt[line_docs])[real])[1]
    running = np.zeros(len(chars) + 1, np.int64)
    np.cumsum(chars, out=running[1:])
    dup_lines = W.per_text(later, lines.first)
    line_chars = W.per_text((running[to_word] - running[at_word]) * later, lines.first)

    failed = (n_words < rules.min_words) | (triples > rules.repeat_words * n_words)
    bad = (line_chars > rules.lines * word_chars) | (symbols > rules.symbols * n_words)
    for row, (_, most) in zip(grams, rules.repeated, strict=True):
        bad |= row > most * word_chars
    counts = np.full(len(n_words), len(rules.repeated))
    return [
        *map(pa.array, (n_words, word_chars, symbols, dup_lines, triples, failed, line_chars)),
        W.lists(np.ascontiguousarray(grams.T).ravel(), counts),
        pa.array(~(failed | bad)),
    ]


def quality_rules(docs: DataFrame, text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """Adds the measures and the verdict ``kept`` to every row.

    A null text has no words and fails, as does an empty one. Equal rows get
    equal results. Columns named like a result are replaced.
    """
    return W.map_texts(docs, text, FIELDS, lambda rows: measure(rows.column(text), rules))

"""Sizes and boundaries of texts in tokens of a public byte-level BPE tokenizer."""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import col

#: Where the vocabulary file is on every node; a parameter of each operator.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that splits text before merges, without its branch
#: \s+(?!\S); Tokenizer.parts makes up for that.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"""
#: Fixed value: the characters that \s means there (Unicode White_Space).
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


class Tokenizer:
    """Encodes as the whole pattern would, faster.

    The branch \\s+(?!\\S) keeps the last blank of a run for what follows it. If the
    text is cut before the last blank of each run that goes on to a non-blank, then
    within a part a run of two or more ends the part, and a single blank is taken by
    the same branches as before. So parts can be encoded one by one without
    look-ahead, which lets the matcher run as an automaton.
    """

    def __init__(self, vocabulary: str):
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("springfloor", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for b, i in ranks.items():
            self.lengths[i] = len(b)
        self._cut = re.compile(rf"(?<=[{SPACE}])(?=[{SPACE}][^{SPACE}])")
        self.short = functools.lru_cache(100_000)(self._count)

    def parts(self, text: str) -> list[str]:
        return self._cut.split(text)

    def _count(self, text: str) -> int:
        encode = self.encoding.encode_ordinary
        return sum(len(encode(p)) for p in self.parts(text))

    def count(self, text: str) -> int:
        """Number of tokens."""
        return self._count(text)

    def ends(self, text: str) -> np.ndarray:
        """Byte offset of the end of each token."""
        ids: list[int] = []
        for p in self.parts(text):
            ids += self.encoding.encode_ordinary(p)
        return np.cumsum(self.lengths[np.array(ids, dtype=np.int64)])


@functools.lru_cache(4)
def tokenizer(vocabulary: str) -> Tokenizer:
    """The tokenizer of this process; loaded once per Python worker."""
    return Tokenizer(vocabulary)


def with_sizes(docs: DataFrame, key: str, text: str, keep: tuple[str, ...] = (), vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, keep..., n_tokens); null texts have none (null), empty ones 0."""
    narrow = docs.select(col(key).alias(key), *[col(c).alias(c) for c in keep], col(text).alias("__text"))

    def sizes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = tokenizer(vocabulary)
        for b in batches:
            n = pd.array([None if x is None else t.count(x) for x in b["__text"]], dtype="Int32")
            yield b.drop(columns="__text").assign(n_tokens=n)

    schema = narrow.drop("__text").withColumn("n_tokens", F.lit(None).cast("int")).schema
    return narrow.mapInPandas(sizes, schema)

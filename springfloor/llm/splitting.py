"""Splitting oversized items at natural boundaries.

Method: every token boundary of a text gets a strength. A sparse table answers
range maxima over (strength, place): each cut is the strongest boundary in the
window of permissible lengths, of equals the rightmost; the next piece starts the
overlap before the cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ..runtime import col
from . import tokens

#: Strengths of boundaries; a place within a character is none.
WITHIN, BETWEEN, WORD, CLAUSE, SENTENCE, LINE, PARAGRAPH = -1, 0, 1, 2, 3, 4, 5
#: A piece is at least this part of the capacity, unless it is the last.
LEAST_FILL = 0.5
_SENTENCE_CJK = (b"\xe3\x80\x82", b"\xef\xbc\x81", b"\xef\xbc\x9f")
_CLAUSE_CJK = (b"\xe3\x80\x81", b"\xef\xbc\x8c", b"\xef\xbc\x9b", b"\xef\xbc\x9a")


def _is(a: np.ndarray, chars: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(chars)] = True
    return table[a]


class Text:
    """A text with its tokens, characters and boundary strengths."""

    def __init__(self, text: str, t: tokens.Tokenizer, ends: np.ndarray | None = None):
        self.t = t
        self.bytes = text.encode("utf-8")
        self.at = np.concatenate([[0], t.ends(text) if ends is None else ends])
        self.n = len(self.at) - 1
        b = np.frombuffer(self.bytes, dtype=np.uint8)
        #: characters before each byte
        self.chars = np.concatenate([[0], np.cumsum((b & 0xC0) != 0x80)])
        pad = np.concatenate([np.full(4, 32, np.uint8), b, np.full(3, 32, np.uint8)])
        p = self.at + 4  # pad[p] is the byte after the boundary
        before, before2, before3, after, after2 = pad[p - 1], pad[p - 2], pad[p - 3], pad[p], pad[p + 1]
        blank = lambda a: _is(a, b" \t\n\r\x0b\x0c")
        s = np.zeros(self.n + 1, dtype=np.int64)
        s[blank(after) | blank(before)] = WORD
        gap = blank(after) | (p - 4 == len(b))
        cjk = lambda marks: np.any([(before3 == m[0]) & (before2 == m[1]) & (before == m[2]) for m in marks], axis=0)
        s[_is(before, b",;:)]") & gap | cjk(_CLAUSE_CJK)] = CLAUSE
        closing = _is(before, b"\"')]")
        mark = np.where(closing, before2, before)
        ahead = np.where(_is(after, b"\n\r"), 10, after2)
        starts = ~_is(ahead, b"abcdefghijklmnopqrstuvwxyz0123456789,;:)")
        # an initial or an abbreviation of two letters ends no sentence
        short = (mark == 46) & ~closing & (blank(before3) | blank(pad[p - 4]) | (before3 == 46)) & ~_is(before2, b"0123456789")
        s[_is(mark, b"!?") & gap & starts | (mark == 46) & gap & starts & ~short | cjk(_SENTENCE_CJK)] = SENTENCE
        line = _is(before, b"\n\r") & ~((before == 13) & (after == 10))
        s[line] = LINE
        s[line & ((before2 == 10) | (before2 == 13) & (before == 10) & _is(before3, b"\n\r"))] = PARAGRAPH
        s[(after & 0xC0) == 0x80] = WITHIN
        self.strength = s
        #: boundaries at which a new word begins for the tokenizer, whatever stands before
        new = (after == 32) & ~_is(after2, b" \t\n\r\x0b\x0c") & (after2 < 0x80) & ~blank(before) & (before < 0x80)
        self.new = np.flatnonzero(new)
        self.keys = s * (1 << 40) + np.arange(self.n + 1)
        self.levels = [self.keys]

    def table(self, width: int) -> list[np.ndarray]:
        """The sparse table: maxima of all windows of each power of two up to ``width``; built
        once a text, further levels when a wider window asks for them."""
        while 2 << (len(self.levels) - 1) <= min(width, self.n + 1):
            w = 1 << (len(self.levels) - 1)
            self.levels.append(np.maximum(self.levels[-1][:-w], self.levels[-1][w:]))
        return self.levels

    def strongest(self, lo: int, hi: int, levels: list[np.ndarray]) -> int:
        """Place of the strongest boundary in [lo, hi], the rightmost of equals: two windows
        of the greatest power of two that fits cover the range."""
        k = (hi - lo + 1).bit_length() - 1
        return int(max(levels[k][lo], levels[k][hi - (1 << k) + 1]) & ((1 << 40) - 1))

    def text(self, a: int, b: int) -> str:
        return self.bytes[self.at[a] : self.at[b]].decode("utf-8")

    def size(self, a: int, b: int) -> int:
        """Tokens of the piece by itself, which may differ at its ends from the whole text's.

        Only what comes before its first new word, and blanks at its end, can be
        encoded in another way; the rest is counted in place.
        """
        head, first = 0, a
        if a:
            k = int(np.searchsorted(self.new, a))
            if k < len(self.new) and self.new[k] < b:
                first = int(self.new[k])
                head = self.t.short(self.text(a, first)) if first > a else 0
            else:
                return self.t.count(self.text(a, b))
        end = self.bytes[self.at[b] - 1]
        if b == self.n or end < 0x80 and end not in b" \t\n\r\x0b\x0c" and (self.bytes[self.at[b]] in b" \t\n\r\x0b\x0c"):
            return head + b - first
        k = int(np.searchsorted(self.new, b)) - 1
        last = int(self.new[k]) if k >= 0 and self.new[k] >= first else first
        return head + last - first + self.t.short(self.text(last, b))


def cut(x: Text, capacity: int, overlap: int, least: int, natural: bool = True) -> list[tuple[int, int, int]]:
    """(first token, end token, size) of the pieces of a text, each of a size up to
    ``capacity``, and all but the last of at least ``least`` tokens where a character
    boundary allows. Unless ``natural``, pieces are as long as they can be."""
    if not 0 <= overlap < least <= capacity:
        raise ValueError("it must hold that 0 <= overlap < least <= capacity")
    if x.n <= capacity:
        return [(0, x.n, x.n)] if x.n else []
    levels = x.table(capacity - least + 1) if natural else []
    pieces, a = [], 0
    while True:
        hi = a + capacity
        while True:
            if hi >= x.n:
                b = x.n
            else:
                lo = min(a + least, hi)
                b = x.strongest(lo, hi, levels) if natural else hi
                while x.strength[b] == WITHIN and b > a + overlap + 1:
                    b -= 1
                while x.strength[b] == WITHIN:
                    b += 1
            size = x.size(a, b)
            if size <= capacity or b <= a + overlap + 1:
                break
            hi = min(b, hi) - max(1, size - capacity)
        pieces.append((a, b, size))
        if b == x.n:
            return pieces
        a2 = b - overlap
        while x.strength[a2] == WITHIN and a2 > a + 1:
            a2 -= 1
        a = a2 if x.strength[a2] != WITHIN else b


def split(docs: DataFrame, key: str, text: str, jobs: list[tuple[int, int]], vocabulary: str = tokens.VOCABULARY) -> DataFrame:
    """Pieces of the texts longer than a job's capacity, for each (capacity, overlap).

    Returns (key, capacity_tokens, overlap_tokens, piece_no, start_char, end_char,
    n_tokens, piece): pieces in order, each of at most capacity tokens when encoded
    by itself. Neighbours share the text of overlap tokens, and up to three more
    where that would begin within a character; without overlap the pieces joined are
    the text. start and end count code points. Texts within the capacity, empty and
    null texts give no rows; repeated rows give theirs each. One text is cut by one
    task, in time linear in its length (a logarithmic factor for the table).
    """
    narrow = docs.select(col(key).alias("id"), col(text).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = tokens.tokenizer(vocabulary)
        rows: list[tuple] = []
        held = 0
        smallest = min((c for c, _ in jobs), default=0)
        for batch in batches:
            for i, s in zip(batch["id"], batch["text"]):
                if s is None or len(s) * 4 <= smallest:
                    continue
                ends = t.ends(s)
                if len(ends) <= smallest:  # most texts: no boundaries are needed
                    continue
                x = Text(s, t, ends)
                for capacity, overlap in jobs:
                    if x.n <= capacity:
                        continue
                    least = max(overlap + 1, int(capacity * LEAST_FILL))
                    for k, (a, b, n) in enumerate(cut(x, capacity, overlap, least)):
                        piece = x.text(a, b)
                        held += len(piece)
                        rows.append((i, capacity, overlap, k, int(x.chars[x.at[a]]), int(x.chars[x.at[b]]), n, piece))
                if held > 1 << 22:
                    yield pd.DataFrame(rows, columns=names)
                    rows, held = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=names)

    names = ["id", "capacity_tokens", "overlap_tokens", "piece_no", "start_char", "end_char", "n_tokens", "piece"]
    out = narrow.mapInPandas(run, f"id {kind}, capacity_tokens int, overlap_tokens int, piece_no int, start_char bigint, end_char bigint, n_tokens int, piece string")
    return out.withColumnRenamed("id", key)

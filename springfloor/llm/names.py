"""Names as JVM expressions: words, nicknames, and whether two words may be one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ACCENTED = "àáâãäåāăąçćčďèéêëēėęěğìíîïīįıłñńňòóôõöøōőřśšşťùúûüūůűųýÿžźżđß"
_PLAIN = "aaaaaaaaacccdeeeeeeeegiiiiiiilnnnoooooooorssstuuuuuuuuyyzzzds"
#: Words up to this length are looked up by their deletions, longer ones by pieces.
LONG = 40


def words(name: Column) -> Column:
    """Lower-case words without accents and punctuation; hyphens part words, apostrophes
    don't. A null gives null, a name without letters an empty array."""
    x = F.translate(F.lower(name), _ACCENTED, _PLAIN)
    x = F.regexp_replace(x, r"['’`]", "")
    return F.filter(F.split(F.regexp_replace(x, r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")


def edits(a: Column, b: Column) -> Column:
    """Levenshtein distance, but a swap of two letters costs one."""
    lev = F.levenshtein(a, b)
    return F.when((lev == 2) & (F.length(a) == F.length(b)) & (F.array_sort(F.split(a, "")) == F.array_sort(F.split(b, ""))), 1).otherwise(lev)


def near(a: Column, b: Column) -> Column:
    """Spelled alike: at most one edit from three letters on, two from six on."""
    n = F.least(F.length(a), F.length(b))
    return (a == b) | (edits(a, b) <= F.when(n >= 6, 2).when(n >= 3, 1).otherwise(0))


def left_out(w: Column) -> Column:
    """w with one character left out, in every way."""
    return F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.concat(F.substr(w, F.lit(1), i - 1), F.substr(w, i + 1)))


def near_keys(w: Column) -> Column:
    """Keys of a word of three letters or more; two near words always share one.

    What is left after up to one deletion, or two from six letters on; for swaps the
    letters in order. As deletions grow with the square of the length, words of more
    than LONG letters are cut in three instead, one piece of which two edits leave
    whole (moved by up to two letters); those two letters shorter have both kinds.
    """
    one, bag = left_out(w), F.concat(F.lit("~"), F.array_join(F.array_sort(F.split(w, "")), ""))
    short = F.concat(F.array(w, bag), one)
    cuts = []
    for size in [F.length(w) + n for n in range(-2, 3)]:
        for i in range(3):
            start, stop = F.floor(size * i / 3).cast("int"), F.floor(size * (i + 1) / 3).cast("int")
            cuts += [F.concat_ws("|", size, F.lit(i), F.substr(w, start + 1 + move, stop - start)) for move in (range(-2, 3) if i else range(3))]
    keys = F.when(F.length(w) < 6, short).when(F.length(w) <= LONG, F.array_distinct(F.concat(F.array(w), one, F.flatten(F.transform(one, left_out))))).otherwise(F.array().cast("array<string>"))
    return F.when(F.length(w) >= LONG - 1, F.concat(keys, F.array(*cuts))).otherwise(keys)


def initial(a: Column, b: Column) -> Column:
    """One of them is a single letter, with which the other starts."""
    return ((F.length(a) == 1) | (F.length(b) == 1)) & (F.substring(a, 1, 1) == F.substring(b, 1, 1))

"""Mapping free-entered values to a canonical list.

Method: prefix-filter set-similarity join. Tokens are ordered by global rarity;
two records are compared only if rare prefixes of their token sets meet, lengths
allow the threshold and the positions in the prefixes leave enough overlap. The
Jaccard similarity of the survivors is verified exactly, and the best entry kept.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import broadcast_if_small, col, materialize

UNMATCHED = "unmatched"
#: Words that count as missing.
MISSING = ("nan", "N/A", "None")
_ROMAN = {"i": "1", "ii": "2", "iii": "3", "iv": "4", "v": "5", "vi": "6", "vii": "7", "viii": "8", "ix": "9", "x": "10"}


@dataclass(frozen=True)
class Vocabulary:
    """What a field's writers do to its words.

    words: word to word; noise: words without meaning here; numbered: words whose
    next word may be a roman numeral; forms: further spellings of an entry, written
    as an entry's normal words would be.
    """

    words: dict[str, str] = field(default_factory=dict)
    noise: tuple[str, ...] = ()
    numbered: tuple[str, ...] = ()


_PUNCTUATION = re.compile(r"[.'’]")
_EDGE = re.compile(r"(?<=[a-z])(?=[0-9])|(?<=[0-9])(?=[a-z])")
_OTHER = re.compile(r"[^\w]+|_")


def normal_words(value: str | None, vocabulary: Vocabulary) -> list[str]:
    """Words of a value: lower case, accents and punctuation off, letters and digits
    apart, numerals in digits without leading zeros, synonyms and noise applied, a word
    said twice in a row said once. If only noise is left, the noise stays."""
    if not value:
        return []
    x = "".join(c for c in unicodedata.normalize("NFKD", value.lower()) if not unicodedata.combining(c))
    x = _EDGE.sub(" ", _PUNCTUATION.sub("", re.sub(r"(\d)\.0\b", r"\1", x)))
    words = []
    for w in _OTHER.sub(" ", x).split():
        w = re.sub("^0+(?=[0-9])", "", w)
        for v in vocabulary.words.get(w, w).split():
            if not words or words[-1] != v:
                words.append(v)
    words = [_ROMAN.get(w, w) if i and words[i - 1] in vocabulary.numbered else w for i, w in enumerate(words)]
    return [w for w in words if w not in vocabulary.noise] or words


def grams(text: str) -> list[str]:
    """The token set of a text: its characters, numbered by occurrence, and its padded
    pairs of characters. Linear in its length."""
    padded = f"^{text}$"
    seen: dict[str, int] = {}
    out = {padded[i : i + 2] for i in range(len(padded) - 1)}
    for c in text:
        seen[c] = seen.get(c, 0) + 1
        out.add(f"#{c}{seen[c]}")
    return sorted(out)


def similarity_join(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """(l, r, jaccard) of all pairs with Jaccard of at least ``threshold``, exactly.

    left and right: (id, tokens array). Ids that repeat on a side are one record
    each; empty or null token sets join with nothing. Sides may have any size: only
    rare prefixes are shuffled, one row per prefix token.
    """
    both = left.select(F.lit(0).alias("side"), "id", "tokens").unionByName(right.select(F.lit(1).alias("side"), "id", "tokens"))
    both = both.withColumn("tokens", F.array_distinct("tokens")).filter(F.size("tokens") > 0)
    each = both.select("side", "id", F.explode("tokens").alias("token"))
    frequency = each.groupBy("token").agg(F.count(F.lit(1)).alias("f"))
    ordered = each.join(frequency, "token").groupBy("side", "id").agg(F.transform(F.array_sort(F.collect_set(F.struct("f", "token"))), lambda x: x.token).alias("tokens"))
    ordered = materialize(ordered)
    n = F.size("tokens")
    prefix = ordered.select("side", "id", "tokens", n.alias("n"), F.posexplode(F.slice("tokens", 1, n - F.ceil(n * F.lit(threshold) - 1e-9).cast("int") + 1)).alias("pos", "token"))
    x = prefix.filter("side = 0").select(F.col("id").alias("l"), F.col("n").alias("ln"), F.col("pos").alias("lp"), "token", F.col("tokens").alias("lt"))
    y = prefix.filter("side = 1").select(F.col("id").alias("r"), F.col("n").alias("rn"), F.col("pos").alias("rp"), "token", F.col("tokens").alias("rt"))
    t = F.lit(threshold)
    needed = F.ceil(t / (1 + t) * (F.col("ln") + F.col("rn")) - 1e-9)
    pairs = x.join(y, "token").filter((F.col("rn") >= F.ceil(t * F.col("ln") - 1e-9)) & (F.col("ln") >= F.ceil(t * F.col("rn") - 1e-9)))
    # a pair that shares several prefix tokens is seen at the first of them only if its bound holds there
    pairs = pairs.filter(F.least(F.col("ln") - F.col("lp"), F.col("rn") - F.col("rp")) + F.least("lp", "rp") >= needed)
    common = F.size(F.array_intersect("lt", "rt"))
    pairs = pairs.select("l", "r", (common / (F.col("ln") + F.col("rn") - common)).alias("jaccard")).filter(F.col("jaccard") >= threshold - 1e-12)
    return pairs.distinct()


def _normalised(df: DataFrame, keep: list[str], column: str, vocabularies: dict[str, Vocabulary]) -> DataFrame:
    """(keep..., text, numbers, tokens) for the words of ``column`` by the vocabulary of
    ``field``; tokens are marked with the field.

    In Python, as it is applied to distinct values only and would be a very large
    expression otherwise.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            words = [normal_words(v, vocabularies[f]) for f, v in zip(b["field"], b[column])]
            texts = ["".join(w) for w in words]
            tokens = [[f"{f}\x1f{t}" for t in grams(x)] for f, x in zip(b["field"], texts)]
            yield b[keep].assign(text=texts, numbers=[" ".join(x for x in w if x.isdigit()) for w in words], tokens=tokens)

    schema = df.select(*keep).withColumns({"text": F.lit(""), "numbers": F.lit(""), "tokens": F.array(F.lit(""))}).schema
    return df.mapInPandas(run, schema).filter("text != ''")


def map_values(values: DataFrame, entries: DataFrame, vocabularies: dict[str, Vocabulary], threshold: float = 0.5) -> DataFrame:
    """(field, value, canonical): the entry meant by each distinct value, or ``unmatched``.

    values: (field, value); entries: (field, canonical, form, exact), any number of
    forms an entry; an exact form counts only if equal. A value is compared whole,
    then without what follows a bracket, comma or spaced dash. A candidate must have
    the same numbers, and, after the similarity join, be equal, or within one edit
    (two from ten characters on; a swap of neighbours is one) of a form of at least
    four characters, or have the same characters in another order. The whole value
    wins over the shortened one, then the higher similarity, then the fewer edits,
    then the shorter and first entry. Values without a letter or digit are unmatched;
    nulls give no row.
    """
    v = materialize(values.select("field", "value").filter("value is not null").distinct())
    short = F.regexp_extract("value", r"^(.*?\S)\s*(?:[(\[,]|\s-\s)", 1)
    cuts = v.select("field", "value", F.explode(F.array(F.struct(F.lit(0).alias("cut"), F.col("value").alias("x")), F.struct(F.lit(1).alias("cut"), short.alias("x")))).alias("s")).select("field", "value", "s.cut", "s.x")
    texts = materialize(_normalised(cuts, ["field", "value", "cut"], "x", vocabularies))
    forms = _normalised(entries.select("field", "canonical", "form", "exact"), ["field", "canonical", "exact"], "form", vocabularies)
    forms = materialize(forms.groupBy("field", "canonical", F.col("text").alias("form"), F.col("numbers").alias("form_numbers")).agg(F.bool_and("exact").alias("exact"), F.first("tokens").alias("tokens")))
    id_ = lambda c: F.concat_ws("\x1f", "field", c)
    side = lambda df, c: df.groupBy(id_(c).alias("id")).agg(F.first("tokens").alias("tokens"))
    pairs = materialize(similarity_join(side(texts, "text"), side(forms, "form"), threshold))
    found = texts.select("field", "value", "cut", "text", "numbers", id_("text").alias("l")).join(pairs, "l")
    found = found.join(forms.select("canonical", "form", "form_numbers", "exact", id_("form").alias("r")), "r").filter("numbers = form_numbers")
    lev = F.levenshtein("text", "form")
    sorted_ = lambda c: F.array_sort(F.split(F.col(c), ""))
    found = found.withColumn("lev", lev).withColumn("same", sorted_("text") == sorted_("form"))
    found = found.withColumn("edits", F.when(F.col("same") & (F.col("lev") == 2), 1).otherwise(F.col("lev")))
    size = F.greatest(F.length("text"), F.length("form"))
    moved = F.col("same") & (F.length("text") >= 8) & (F.col("jaccard") >= 0.75)
    good = (F.col("lev") == 0) | ~F.col("exact") & ((F.length("form") >= 4) & (F.col("edits") <= F.when(size >= 10, 2).otherwise(1)) | moved)
    best = found.filter(good).groupBy("field", "value").agg(F.min_by("canonical", F.struct("cut", (-F.col("jaccard")).alias("j"), "edits", F.length("canonical").alias("n"), "canonical")).alias("canonical"))
    return v.join(best, ["field", "value"], "left").select("field", "value", F.coalesce("canonical", F.lit(UNMATCHED)).alias("canonical"))


def map_columns(rows: DataFrame, key: str, fields: dict[str, tuple[DataFrame, DataFrame, Vocabulary]]) -> DataFrame:
    """(key, field, canonical) for each value that is neither missing nor itself canonical.

    fields: column to (canonical values, forms, vocabulary). Values are mapped once
    each; rows then meet the mapping, a broadcast if its size allows.
    """
    pick = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), col(f).alias("value")) for f in fields])).alias("c")
    cells = rows.select(col(key).alias(key), pick).select(key, "c.field", "c.value").filter(F.col("value").isNotNull() & (F.trim("value") != "") & ~F.trim("value").isin(*MISSING))
    union = lambda dfs: reduce(DataFrame.unionByName, dfs)
    own = materialize(union([c.select(F.lit(f).alias("field"), F.col("canonical").alias("value")) for f, (c, _, _) in fields.items()]).distinct())
    cells = cells.join(broadcast_if_small(own), ["field", "value"], "left_anti")
    entries = union([e.select(F.lit(f).alias("field"), "canonical", "form", "exact") for f, (_, e, _) in fields.items()])
    mapping = materialize(map_values(cells.groupBy("field", "value").agg(F.count(F.lit(1)).alias("n")), entries, {f: v for f, (_, _, v) in fields.items()}))
    return cells.join(broadcast_if_small(mapping), ["field", "value"]).select(key, "field", "canonical")

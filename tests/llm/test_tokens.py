import base64
import random

import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from springfloor.llm import mixing, packing, splitting, tokens

T = tokens.tokenizer(tokens.VOCABULARY)
WHOLE = tokens.PATTERN[: -len(r"\s+")] + r"\s+(?!\S)|\s+"


@pytest.fixture(scope="module")
def plain():
    with open(tokens.VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("plain", pat_str=WHOLE, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


ODD = ["", " ", "\n\n x", "a　　b  c\n\n\nd \x1c\x1d e\x85\x85f\t\tg   ", "don't  'stuff's  x", "\U0001f600" * 400, "x" * 3000, "床の演技は" * 300, " " * 2000, "a\r\n\r\nb. C\n" * 400, "'s" * 600, "<|endoftext|> end"]
LONG = st.lists(st.sampled_from(["Roe ", "scored ", "9.45", ". ", "\n", "\n\n", "  ", "床", "é", "\U0001f600", "Wexostaport", ", ", "'s", "\t", "\r\n"]), max_size=400).map("".join)


def check(plain, s, capacity, overlap, natural=True):
    x = splitting.Text(s, T)
    assert x.n == T.count(s) == len(plain(s))
    least = max(overlap + 1, capacity // 2) if natural else 1
    pieces = splitting.cut(x, capacity, overlap, least, natural)
    if not s:
        assert pieces == []
        return
    assert pieces[0][0] == 0 and pieces[-1][1] == x.n
    for (a, b, n), (a2, b2, _) in zip(pieces, pieces[1:]):
        assert a < a2 <= b < b2
        assert b - a2 >= min(overlap, b - a - 1) or a2 == b
    for a, b, n in pieces:
        assert n == len(plain(x.text(a, b))) <= capacity
        assert a == 0 or x.strength[a] >= 0


@pytest.mark.parametrize("s", ODD)
@pytest.mark.parametrize(("capacity", "overlap"), [(16, 0), (64, 8), (256, 32)])
def test_odd_texts(plain, s, capacity, overlap):
    check(plain, s, capacity, overlap)
    check(plain, s, capacity, 0, natural=False)


@settings(max_examples=150, deadline=None)
@given(LONG, st.sampled_from([(12, 0), (20, 5), (50, 10)]))
def test_any_text(plain, s, job):
    check(plain, s, *job)


def test_cut_is_the_strongest_rightmost():
    s = "One two three.\n\nFour five six. Seven eight nine ten. Eleven twelve, thirteen fourteen fifteen."
    x = splitting.Text(s, T)
    for capacity in range(8, 20):
        for (a, b, _), _next in zip(splitting.cut(x, capacity, 0, capacity // 2), range(99)):
            if b == x.n:
                continue
            window = x.strength[a + capacity // 2 : a + capacity + 1]
            assert x.strength[b] == window.max() and b == a + capacity // 2 + max(i for i, v in enumerate(window) if v == window.max())


def test_abbreviations_end_no_sentence():
    s = "See the note by Dr. Roe on p. 48. Then M. Roe left. Next"
    x = splitting.Text(s, T)
    ends = [x.text(0, i)[-6:] for i in range(1, x.n) if x.strength[i] == splitting.SENTENCE]
    assert ends == ["p. 48.", " left."] or ends == ["Dr."[-6:], "p. 48.", " left."]


def test_split_operator(spark):
    docs = spark.createDataFrame([(1, "word " * 900, 5), (1, "word " * 900, 5), (2, None, 5), (3, "", 5), (4, "short", 5), (None, "long " * 300, 5)], "doc_id bigint, text string, piece int")
    rows = splitting.split(docs, "doc_id", "text", [(256, 32), (512, 0)]).collect()
    assert {r.doc_id for r in rows} == {1, None}
    whole = sorted((r for r in rows if r.doc_id == 1 and r.capacity_tokens == 512), key=lambda r: r.piece_no)
    assert "".join(r.piece for r in whole[::2]) == "word " * 900 and max(r.n_tokens for r in rows) <= 512
    assert splitting.split(docs.limit(0), "doc_id", "text", [(256, 32)]).count() == 0


def brute_ss(sizes, capacity):
    """Sum of squares by trying every bin."""
    bins = []
    for s in sizes:
        def total(gaps):
            return sum(gaps.count(g) ** 2 for g in set(gaps) if g)
        options = []
        for g in sorted(set(bins) | {capacity}):
            if g >= s and (g in bins or g == capacity):
                new = list(bins)
                if g in bins:
                    new[new.index(g)] = g - s
                else:
                    new.append(g - s)
                options.append((total(new), new, g))
        bins = min(options, key=lambda o: (o[0], o[2] == capacity, o[2]))[1]
    return bins


def test_sum_of_squares_against_brute_force():
    rng = random.Random(1)
    for _ in range(60):
        c = rng.randint(3, 12)
        sizes = [rng.randint(1, c) for _ in range(rng.randint(1, 25))]
        where, n = packing.sum_of_squares(sizes, c)
        load = [sum(s for s, w in zip(sizes, where) if w == b) for b in range(n)]
        assert max(load) <= c and min(load) > 0
        assert sorted(c - x for x in load) == sorted(brute_ss(sizes, c))


def test_pack(spark):
    docs = spark.createDataFrame([(1, "word " * 900, 1), (2, None, 1), (3, "", 1), (4, "short", 1), (4, "short", 1)], "doc_id bigint, text string, bin_id int")
    packed = packing.pack(packing.token_items(docs, "doc_id", "text", [64, 512]), "doc_id")
    rows = packed.collect()
    for c in (64, 512):
        load = {}
        for r in rows:
            if r.capacity_tokens == c:
                load[r.bin_id] = load.get(r.bin_id, 0) + r.n_tokens
        assert max(load.values()) <= c
        spans = sorted((r.start_char, r.end_char) for r in rows if r.doc_id == 1 and r.capacity_tokens == c)
        assert spans[0][0] == 0 and spans[-1][1] == 4500 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert sum(r.doc_id == 4 for r in rows) == 4 and sum(r.doc_id == 3 for r in rows) == 2 and not any(r.doc_id == 2 for r in rows)
    assert {r.capacity_tokens: r.items for r in packing.fill_report(packed).collect()}[512] == sum(r.capacity_tokens == 512 for r in rows)
    empty = packing.pack(packing.token_items(docs.limit(0), "doc_id", "text", [64]), "doc_id")
    assert empty.count() == 0


def test_mix(spark):
    rng = random.Random(2)
    docs = [(i, s, n) for i, (s, n) in enumerate([("a", rng.randint(1, 50)) for _ in range(3000)] + [("b", rng.randint(1, 500)) for _ in range(200)] + [(None, 5), ("z", 5), ("a", None), ("a", 0)])]
    sized = spark.createDataFrame(docs, "doc_id bigint, source string, n_tokens int")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.4, 3), ("c", 0.1, 2)], "source string, target_share double, max_repeats int")
    rated = mixing.rates(sized, "source", targets)
    rows = mixing.mix(sized, "doc_id", "source", rated).collect()
    by = {d[0]: d for d in docs}
    assert len({r.doc_id for r in rows}) == len(rows) and {by[r.doc_id][1] for r in rows} == {"a", "b"}
    assert max(r.copies for r in rows if r.source == "a") == 1 and max(r.copies for r in rows if r.source == "b") <= 3
    rate = {r.source: r for r in rated.collect()}
    for s in "ab":
        expected = rate[s].rate * rate[s].source_docs
        assert abs(sum(r.copies for r in rows if r.source == s) - expected) <= 1
    share = {r.source: r for r in mixing.share_report(mixing.mix(sized, "doc_id", "source", rated), rated).collect()}
    assert abs(share["a"].actual_share / share["b"].actual_share - 0.5 / 0.4) < 0.05 and share["c"].tokens == 0
    assert mixing.mix(sized.limit(0), "doc_id", "source", mixing.rates(sized.limit(0), "source", targets)).count() == 0


def test_mix_bucketed_prefix_sums(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 50)
    sized = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"), (F.col("id") % 7).cast("int").alias("n_tokens"))
    targets = spark.createDataFrame([("a", 1.0, 5)], "source string, target_share double, max_repeats int")
    rated = mixing.rates(sized, "source", targets, budget=0.37 * 2997)
    n = mixing.mix(sized, "doc_id", "source", rated).agg(F.sum("copies")).first()[0]
    assert abs(n - rated.first().rate * 1000) <= 1


def test_sizes(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "two words", "x")], "doc_id bigint, text string, n_tokens string")
    assert [(r.doc_id, r.n_tokens) for r in tokens.with_sizes(docs, "doc_id", "text").orderBy("doc_id").collect()] == [(1, None), (2, 0), (3, 2)]

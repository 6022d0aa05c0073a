"""Queries of the problems tagged llm, and their SQL twins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..runtime import table
from . import domains, linkage, mapping, mixing, names, packing, splitting, survivors, tokens


def _mapped_fields(spark: SparkSession, d: str) -> dict:
    levels, provinces = table(spark, d, "ref_levels"), table(spark, d, "ref_provinces")
    return {
        "level": (levels.select(F.col("level_name").alias("canonical")), domains.level_forms(levels), domains.LEVEL_WORDS),
        "province": (provinces.select(F.col("province_code").alias("canonical")), domains.province_forms(provinces), domains.PROVINCE_WORDS),
    }


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return mapping.map_columns(table(spark, d, "results_v2"), "result_id", _mapped_fields(spark, d))


_APPARATUS = ("vt", "ub", "bb", "fx", "aa")
GOLD_FIELDS = ["athlete_name", "comp_year", "meet_date", "meet_name", "level", "age", "club", *[f"{p}_{x}" for p in _APPARATUS for x in ("score", "d", "rank")]]
_APPEARANCE = survivors.Appearance(
    "gold_id", "athlete_name", "meet_name", "meet_date", tuple(f"{p}_score" for p in _APPARATUS), tuple(f"{p}_{x}" for p in _APPARATUS for x in ("d", "rank"))
)


def _survivors(spark: SparkSession, d: str) -> DataFrame:
    gold = table(spark, d, "gold_results_wag")
    return survivors.survivors(gold, survivors.duplicate_groups(gold, _APPEARANCE), "gold_id", "updated_at", GOLD_FIELDS, "vt_score")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _survivors(spark, d).select("group_id", "best_id", F.col("vt_score_id").alias("vt_id"))


def p3_survivors(spark: SparkSession, d: str) -> DataFrame:
    return _survivors(spark, d).drop("best_id", "vt_score_id")


def _entities(spark: SparkSession, d: str) -> list[tuple[str, DataFrame, DataFrame]]:
    """(entity, records, links between classes of records) of people and clubs."""
    people = linkage.person_records(table(spark, d, "persons"), "person_id", "full_name", "dob", "gender")
    clubs = linkage.club_records(table(spark, d, "clubs"), "club_id", "name", tuple(sorted(domains.PROVINCE_NAMES)))
    return [("person", people, linkage.name_links(people, domains.NICKNAMES)), ("club", clubs, linkage.name_links(clubs, {}, False))]


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [linkage.same_entities(r, links).select(F.lit(e).alias("entity"), "id_a", "id_b") for e, r, links in _entities(spark, d)])


def p2_entities(spark: SparkSession, d: str) -> DataFrame:
    """Each record with the entity it belongs to and the links of its class: the membership
    from which p2_found's pairs are made."""
    return reduce(DataFrame.unionByName, [linkage.entities(r, links).select(F.lit(e).alias("entity"), "id", F.col("entity").alias("entity_id"), "links") for e, r, links in _entities(spark, d)])


def p2_same_words(spark: SparkSession, d: str) -> DataFrame:
    """The pairs of people found whose names are the same words in any order, born on one day."""
    p = table(spark, d, "persons").select("person_id", F.array_sort(names.words(F.col("full_name"))).alias("w"), F.trim("dob").alias("born"), "gender").filter(F.col("born").rlike(r"^\d{4}-\d{2}-\d{2}$"))
    found = p2_found(spark, d).filter("entity = 'person'").join(p.alias("a"), F.col("id_a") == F.col("a.person_id")).join(p.alias("b"), F.col("id_b") == F.col("b.person_id"))
    return found.filter("a.w = b.w and a.born = b.born").select("id_a", "id_b")


def _grams(values: DataFrame, value: str) -> DataFrame:
    padded = F.concat(F.lit("^"), F.lower(F.trim(value)), F.lit("$"))
    return values.select(F.col(value).alias("id"), F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(padded) - 1), lambda i: F.substr(padded, i, F.lit(2)))).alias("tokens"))


def p4_similar(spark: SparkSession, d: str) -> DataFrame:
    """All pairs of typed levels and listed levels that share half of their pairs of letters: the
    similarity join by itself."""
    typed = table(spark, d, "results_v2").filter("trim(level) != ''").select("level").distinct()
    listed = table(spark, d, "ref_levels").select("level_name").distinct()
    return mapping.similarity_join(_grams(typed, "level"), _grams(listed, "level_name"), 0.5).select(F.col("l").alias("typed"), F.col("r").alias("listed"), F.round("jaccard", 6).alias("jaccard"))


def p3_currency(spark: SparkSession, d: str) -> DataFrame:
    """How well learned precedence orders the third of the rows (by a hash) whose timestamp is
    withheld, against the timestamps."""
    gold = table(spark, d, "gold_results_wag")
    hidden = F.pmod(F.xxhash64("gold_id"), F.lit(3)) == 0
    return survivors.currency_report(gold, survivors.duplicate_groups(gold, _APPEARANCE), "gold_id", "updated_at", GOLD_FIELDS, hidden)


def _plain_groups(gold: DataFrame) -> DataFrame:
    """Groups that need no similarity: equal name, date and meet."""
    same = ["athlete_name", "meet_date", "meet_name"]
    g = gold.filter(" and ".join(f"{c} is not null" for c in same)).select("gold_id", *same)
    least = g.groupBy(*same).agg(F.min("gold_id").alias("group_id"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return g.join(least, same).select(F.col("gold_id").alias("id"), "group_id")


def p3_precedence(spark: SparkSession, d: str) -> DataFrame:
    """Which value is learned to follow which, over groups of equal name, date and meet."""
    gold = table(spark, d, "gold_results_wag")
    x = gold.join(_plain_groups(gold).withColumnRenamed("id", "gold_id"), "gold_id")
    return survivors.learned_precedence(x, "group_id", "updated_at", GOLD_FIELDS, least=1)


def p3_plain(spark: SparkSession, d: str) -> DataFrame:
    """The survivors of groups of equal name, date and meet, field by field."""
    gold = table(spark, d, "gold_results_wag")
    out = survivors.survivors(gold, _plain_groups(gold), "gold_id", "updated_at", GOLD_FIELDS, "vt_score")
    return out.select("group_id", "best_id", F.col("vt_score_id").alias("vt_id"), *GOLD_FIELDS)


def _budgets(spark: SparkSession, d: str, job: str) -> list[tuple[int, int]]:
    """A fixed, short table of parameters."""
    rows = table(spark, d, "token_budgets").filter(F.col("job") == job).select("capacity_tokens", "overlap_tokens").distinct().collect()
    return sorted((r.capacity_tokens, r.overlap_tokens) for r in rows)


def _packed(spark: SparkSession, d: str) -> DataFrame:
    items = packing.token_items(table(spark, d, "documents"), "doc_id", "text", [c for c, _ in _budgets(spark, d, "pack")])
    return packing.pack(items, "doc_id")


def p7_packed(spark: SparkSession, d: str) -> DataFrame:
    return _packed(spark, d)


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(_packed(spark, d))


def _mixed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    targets = table(spark, d, "mix_targets")
    docs = table(spark, d, "documents").join(F.broadcast(targets.select("source")), "source", "left_semi")  # a row per target
    sized = mixing.sized_once(tokens.with_sizes(docs, "doc_id", "text", ("source",)))
    rated = mixing.sized_once(mixing.rates(sized, "source", targets))
    return mixing.mix(sized, "doc_id", "source", rated), rated


def p8_mixed(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d)[0]


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.share_report(*_mixed(spark, d))


def p9_pieces(spark: SparkSession, d: str) -> DataFrame:
    return splitting.split(table(spark, d, "documents"), "doc_id", "text", _budgets(spark, d, "split"))


def p7_checks(spark: SparkSession, d: str) -> DataFrame:
    """Per capacity: documents packed, bins that hold too much, texts that were cut though they
    fit, and characters missing of texts that were cut."""
    items = _packed(spark, d)
    size = items.groupBy("capacity_tokens", "bin_id").agg(F.sum("n_tokens").alias("t"))
    over = size.filter("t > capacity_tokens").groupBy("capacity_tokens").agg(F.count(F.lit(1)).alias("overfull"))
    docs = items.groupBy("capacity_tokens", "doc_id").agg(F.count(F.lit(1)).alias("k"), F.sum("n_tokens").alias("t"), F.sum(F.col("end_char") - F.col("start_char")).alias("chars"))
    whole = table(spark, d, "documents").filter("text is not null").groupBy("doc_id").agg(F.max(F.length("text")).alias("n"))
    one = docs.join(whole, "doc_id").groupBy("capacity_tokens").agg(F.count(F.lit(1)).alias("documents"), F.count_if(F.expr("k > 1 and t <= capacity_tokens")).alias("cut"), F.sum(F.col("n") - F.col("chars")).alias("lost"))
    return one.join(over, "capacity_tokens", "left").select("capacity_tokens", "documents", F.coalesce("overfull", F.lit(0)).alias("overfull"), "cut", "lost")


def p8_checks(spark: SparkSession, d: str) -> DataFrame:
    """Per source: documents used more often than allowed, documents that the source doesn't
    have, and whether its copies are those that its rate asks for, to within one."""
    mixed, rated = _mixed(spark, d)
    mixed = mixing.sized_once(mixed)
    own = table(spark, d, "documents").select("doc_id", F.col("source").alias("own"))
    used = mixed.join(own, "doc_id").join(F.broadcast(table(spark, d, "mix_targets")), "source")  # a row per target
    bad = used.groupBy("source").agg(F.count_if(F.expr("copies > max_repeats")).alias("over"), F.count_if(F.expr("own != source")).alias("foreign_docs"))
    asked = rated.select("source", (F.col("rate") * F.col("source_docs")).alias("asked"))
    even = mixing.share_report(mixed, rated).join(asked, "source").select("source", (F.abs(F.col("copies") - F.col("asked")) <= 1).alias("even"))
    return bad.join(even, "source")


def p9_rejoined(spark: SparkSession, d: str) -> DataFrame:
    """The hash of each document put together again from its pieces, overlaps taken off, for each
    job; a document that was not cut stands for itself."""
    pieces = p9_pieces(spark, d).select("doc_id", "capacity_tokens", "piece_no", "start_char", "end_char", "piece")
    before = F.coalesce(F.lag("end_char").over(W.partitionBy("doc_id", "capacity_tokens").orderBy("piece_no")), F.lit(0))
    new = pieces.withColumn("new", F.substr("piece", (before - F.col("start_char") + 1).cast("int")))
    whole = new.groupBy("doc_id", "capacity_tokens").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece_no", "new"))), lambda x: x["new"]), "").alias("again"))
    jobs = F.explode(F.array(*[F.lit(c) for c, _ in _budgets(spark, d, "split")])).alias("capacity_tokens")
    docs = table(spark, d, "documents").filter("text is not null").select("doc_id", "text", jobs)
    return docs.join(whole, ["doc_id", "capacity_tokens"], "left").select("doc_id", "capacity_tokens", F.md5(F.coalesce("again", "text")).alias("hash"))


QUERIES = {
    f.__name__: f
    for f in (
        p2_found, p2_entities, p2_same_words, p3_found, p3_survivors, p3_currency, p3_precedence, p3_plain, p4_found, p4_similar, p7_packed, p7_fill, p7_checks, p8_mixed, p8_shares, p8_checks, p9_pieces, p9_rejoined,
    )
}

_WORDS = "list_sort(list_filter(string_split(trim(regexp_replace(regexp_replace(strip_accents(lower(full_name)), '[''’`]', '', 'g'), '[^a-z0-9]+', ' ', 'g')), ' '), lambda x: x != ''))"
_PLAIN = "(select *, min(gold_id) over g as group_id, count(*) over g as k from gold_results_wag where athlete_name is not null and meet_date is not null and meet_name is not null window g as (partition by athlete_name, meet_date, meet_name))"
_FILLED = lambda c: f"coalesce(trim({c}::varchar) != '' and trim({c}::varchar) not in ('nan', 'N/A', 'None'), false)"
_NUMERIC = "regexp_full_match(replace(trim(vt_score), ',', '.'), '[0-9]+([.][0-9]+)?')"
_BEST = lambda c, ok: f"first({c} order by updated_at desc, gold_id) filter ({ok})"
_STEP = " union all ".join(f"select '{c}' as field, {c}::varchar as v, lead({c}::varchar) over w as u, lead(gold_id) over w as g from x window w as (partition by group_id order by updated_at, {', '.join(f + ' nulls first' for f in GOLD_FIELDS)})" for c in GOLD_FIELDS)
_TOKENS = lambda c: f"list_distinct(list_transform(range(1, length(lower(trim({c}))) + 2), lambda i: substr('^' || lower(trim({c})) || '$', i, 2)))"
SQL: dict[str, str] = {
    "p2_same_words": f"""with p as (select person_id, {_WORDS} as w, trim(dob) as born, gender from persons where regexp_full_match(trim(dob), '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}'))
      select a.person_id as id_a, b.person_id as id_b from p a join p b on a.w = b.w and a.born = b.born and a.person_id < b.person_id where coalesce(a.gender = b.gender, true)""",
    "p3_precedence": f"""with x as (select * from {_PLAIN} where k > 1 and updated_at is not null), s as (select field, v, u from ({_STEP}) where g is not null and v is not null and u is not null and v != u),
      b as (select field, v as earlier, u as later, 1 as n from s union all select field, u, v, -1 from s) select field, earlier, later, sum(n)::bigint as net from b group by 1, 2, 3 having sum(n) >= 1""",
    "p3_plain": f"""select group_id, first(gold_id order by {" + ".join(f"({_FILLED(c)})::int" for c in GOLD_FIELDS)} desc, updated_at desc, gold_id) as best_id, first(gold_id order by updated_at desc, gold_id) filter ({_NUMERIC}) as vt_id,
      {", ".join(f"{_BEST(c, _FILLED(c) + (f' and {_NUMERIC}' if c == 'vt_score' else ''))} as {c}" for c in GOLD_FIELDS)} from {_PLAIN} where k > 1 group by 1""",
    "p4_similar": f"""with t as (select distinct level as typed, {_TOKENS("level")} as a from results_v2 where trim(level) != ''), l as (select distinct level_name as listed, {_TOKENS("level_name")} as b from ref_levels where level_name is not null),
      j as (select typed, listed, len(list_intersect(a, b)) as c, len(a) + len(b) as n from t, l) select typed, listed, round(c / (n - c), 6) as jaccard from j where c / (n - c) >= 0.5 - 1e-12""",
    "p7_checks": "select capacity_tokens, (select count(distinct doc_id) from documents where text is not null) as documents, 0 as overfull, 0 as cut, 0 as lost from (select distinct capacity_tokens from token_budgets where job = 'pack')",
    "p8_checks": "select source, 0 as over, 0 as foreign_docs, true as even from mix_targets where source in (select source from documents)",
    "p9_rejoined": "select doc_id, capacity_tokens, md5(text) as hash from documents, (select distinct capacity_tokens from token_budgets where job = 'split') where text is not null",
}

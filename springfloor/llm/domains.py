"""What is known of the words in this domain: levels, provinces, given names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import small_table
from .mapping import Vocabulary

#: How writers put the words of level names.
LEVEL_WORDS = Vocabulary(
    words={
        "l": "level", "lv": "level", "lvl": "level", "lev": "level", "niveau": "level", "niv": "level", "ccp": "level", "levels": "level",
        "p": "provincial", "b": "provincial", "prov": "provincial", "e": "elite", "elt": "elite", "el": "elite",
        "j": "junior", "jr": "junior", "jun": "junior", "sr": "senior", "sen": "senior", "nov": "novice", "asp": "aspire", "plat": "platinum", "nat": "national", "natl": "national", "ng": "next gen", "nextgen": "next gen",
        "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9", "ten": "10",
    },
    noise=("mag", "wag", "xcel", "hp", "x", "cat", "category"),
    numbered=("level", "provincial", "elite"),
)
#: How writers put the words of provinces and states.
PROVINCE_WORDS = Vocabulary(words={"and": "", "st": "saint"}, noise=("team", "canada", "can", "usa", "us", "ca", "province", "de", "du", "of", "prov", "state", "the"))
#: Further names of provinces and states.
PROVINCE_NAMES = {
    "AB": ("alta",), "BC": ("colombie britannique", "brit columbia"), "MB": ("man",), "ME": ("maine",), "MI": ("mich",), "MN": ("minn",),
    "NB": ("nouveau brunswick", "n brunswick"), "NL": ("nfld", "newfoundland", "labrador", "terre neuve", "terre neuve et labrador", "nf"), "NS": ("nouvelle ecosse", "n scotia"), "NT": ("nwt", "northwest territory", "n w territories", "territoires du nord ouest"),
    "NY": ("new york state", "n york"), "ON": ("ont",), "PE": ("pei", "ile du prince edouard", "p e island"), "QC": ("pq", "que", "qu", "qb"), "SK": ("sask",), "VT": ("verm",), "WA": ("wash", "washington state"), "YT": ("yk", "yuk", "yukon territory", "territoire du yukon"), "NU": ("nvt",), "OH": (),
}
#: Short forms of given names that share too little with the long one.
NICKNAMES = {
    "abigail": ("abby", "gail"), "alexander": ("alex", "sasha", "xander", "lex"), "alexandra": ("alex", "sasha", "lexi", "sandra"), "andrew": ("andy", "drew"), "annabelle": ("annie", "anna", "belle"), "anthony": ("tony",), "augustus": ("gus",),
    "beatrix": ("bea", "trixie"), "benjamin": ("ben", "benny", "benji"), "cassandra": ("cass", "cassie", "sandra"), "charles": ("charlie", "chuck"), "charlotte": ("charlie", "lottie", "char"), "christopher": ("chris", "kit", "topher"), "daniel": ("dan", "danny"), "desmond": ("des",), "dominic": ("dom", "nic"),
    "edward": ("ed", "eddie", "ted", "teddy", "ned"), "eleanor": ("ellie", "nell", "nora", "nellie", "lena"), "elizabeth": ("liz", "beth", "betty", "eliza", "lizzie", "libby", "betsy", "ellie"), "emily": ("em", "emmy"), "evangeline": ("evie", "eva", "angie"), "frederick": ("fred", "freddie", "rick", "freddy"),
    "gabriel": ("gabe",), "gabriella": ("gabby", "ella", "bella"), "genevieve": ("gen", "evie", "viv", "gigi", "genny", "jenny"), "gregory": ("greg",), "isabella": ("bella", "izzy", "isa", "belle"), "jacqueline": ("jackie", "jacqui"), "james": ("jim", "jimmy", "jamie"), "john": ("jack", "johnny"), "jonathan": ("jon", "john", "jonny", "nathan"), "joseph": ("joe", "joey"), "josephine": ("josie", "jo", "joey", "fina"),
    "katherine": ("kate", "katie", "kathy", "kat", "kit", "kitty"), "lawrence": ("larry", "laurie"), "leonard": ("leo", "len", "lenny"), "madeleine": ("maddie", "maddy", "lena"), "magnus": ("mags",), "margaret": ("maggie", "meg", "peggy", "greta", "daisy", "marge"), "matthew": ("matt", "matty"), "maximilian": ("max",), "michael": ("mike", "mick", "mickey"), "nathaniel": ("nate", "nat", "nathan"), "nicholas": ("nick", "nico", "nicky"), "olivia": ("liv", "livvy", "ollie"), "patrick": ("pat", "paddy"), "penelope": ("penny", "nell"), "philippa": ("pippa", "pip"), "quentin": ("quinn",),
    "raphael": ("rafe", "raf"), "rafael": ("rafa", "rafe"), "raymond": ("ray",), "rebecca": ("becca", "becky", "bec"), "richard": ("rick", "dick", "richie"), "robert": ("rob", "bob", "bobby", "robbie", "bert"), "samantha": ("sam", "sammy"), "samuel": ("sam", "sammy"), "sebastian": ("seb", "bas", "bastian"), "stephanie": ("steph",), "stephen": ("steve",), "theodora": ("thea", "dora", "teddy"), "theodore": ("theo", "ted", "teddy"), "thomas": ("tom", "tommy"), "timothy": ("tim",), "veronica": ("ronnie", "vera", "roni"), "victoria": ("vicky", "tori", "vic"), "vincent": ("vince", "vinny"), "william": ("will", "bill", "billy", "liam", "willy"), "xavier": ("xav",), "zachary": ("zach", "zack"),
}


def _shortened(names: DataFrame) -> DataFrame:
    """(canonical, form, exact) of names cut off after four letters or more: of each cut
    that starts several names, only if the shortest starts all of them."""
    n = names.filter(~F.col("name").rlike("[^ \\p{L}]"))
    cuts = n.select("canonical", "name", F.explode(F.sequence(F.lit(4), F.greatest(F.length("name") - 1, F.lit(4)))).alias("k"))
    cuts = cuts.select("canonical", "name", F.substring(F.col("name"), F.lit(1), F.col("k")).alias("form")).filter("form != name")
    g = cuts.groupBy("form").agg(F.min_by("name", F.length("name")).alias("least"), F.min_by("canonical", F.length("name")).alias("canonical"), F.collect_set("name").alias("all"))
    return g.filter(F.forall("all", lambda x: F.startswith(x, F.col("least")))).select("canonical", "form", F.lit(True).alias("exact"))


def level_forms(ref_levels: DataFrame) -> DataFrame:
    """(canonical, form, exact) of the levels: the names, initials of three words or more, a
    bare number for a level that is the word and a number, names cut short."""
    names = ref_levels.select(F.col("level_name").alias("canonical")).filter("canonical is not null").distinct()
    words = F.split("canonical", " ")
    initials = F.array_join(F.transform(words, lambda w: F.substring(w, 1, 1)), "")
    more = [F.col("canonical"), F.when((F.size(words) >= 3) & ~F.col("canonical").rlike("[0-9]"), initials), F.when(F.col("canonical").rlike("^Level [0-9]+$"), F.regexp_extract("canonical", "([0-9]+)$", 1))]
    own = names.select("canonical", F.explode(F.array_compact(F.array(*more))).alias("form"), F.lit(False).alias("exact"))
    return own.unionByName(_shortened(names.withColumn("name", F.col("canonical"))))


def province_forms(ref_provinces: DataFrame) -> DataFrame:
    """(canonical, form, exact) of the provinces: codes, names, both together, further
    names, names cut short."""
    p = ref_provinces.select(F.col("province_code").alias("canonical"), F.col("province_name").alias("name")).filter("canonical is not null").distinct()
    known = small_table(ref_provinces.sparkSession, [(c, x, False) for c, xs in PROVINCE_NAMES.items() for x in xs], "canonical string, form string, exact boolean")
    own = p.select("canonical", F.explode(F.array_compact(F.array("canonical", "name", F.concat_ws(" ", "name", "canonical")))).alias("form"), F.lit(False).alias("exact"))
    return own.unionByName(known.join(p.select("canonical"), "canonical", "left_semi")).unionByName(_shortened(p.filter("name is not null")))

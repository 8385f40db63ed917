"""Who made a book, and when it appeared, from the lines of its front pages.

Lines are rows (book, page, line_no, text).  Each line gives evidence by itself or with its
neighbours; evidence of one person is found by a canonical key, whose block is the last name
and the first initial, and is weighed over all pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigrove.functions.text import ascii_letters, squeeze, title_case

#: Front pages that are read (fixed value).
FRONT = 20
#: Openings of lines that name contributors, by role (fixed values).
ROLES = {"translator": r"translated(?: from .+?)? by", "introduction": r"with an introduction by", "foreword": r"foreword by", "editor": r"(?:edited by|editor)"}
#: First words that no name has, and words that end one (fixed values).
NO_NAME = "of than or otherwise being beyond the and in on to from by".split()
NAME_ENDS = ("Corrected", "Edition", "Translated", "Press", "University")
#: How lines tell a year, and how much such a line counts (fixed values).
YEARS = (
    (100, r"(?:corrected edition|first paperback edition printing|routledge classics)\D+(\d{4})"),
    (95, r"(?:first published in english|first american edition)\D+(\d{4})"),
    (90, r"(?:first published)\D+(\d{4})"),
    (80, r"copyright[^0-9]*(\d{4})(?:[^0-9]+(\d{4}))?(?:[^0-9]+(\d{4}))?"),
    (70, r"originally published[^0-9]*(\d{4})"),
)
#: A publisher's name, up to the word that shows it (fixed value).
PUBLISHER = r"(?i)(.+?(?:University Press|Routledge|Press|Publishers?|Editions? [A-Z][A-Za-z]+|Academic Publishers(?: B\.V\.)?))"
#: What a line's evidence weighs: a role or byline, a catalogue entry, a name below "by", a name by itself.
NAMED, CATALOGUED, BELOW, ALONE = 5, 4, 4, 2

_TOKEN = "[A-ZÀ-ÖØ-Þ][A-Za-zÀ-ÖØ-öø-ÿ'’.-]+"
_PERSON = rf"^{_TOKEN}(\s+{_TOKEN}){{1,4}}$"
_CATALOGUE = rf"^({_TOKEN}),\s*({_TOKEN}(?:\s+{_TOKEN}){{0,3}})\.?$"
_BYLINE = rf"^(?i:by|written by)\s+({_TOKEN}(?:\s+{_TOKEN}){{1,4}})\b"


def person(text: Column) -> Column:
    """A text as a person's name: capitals in title case, no marks at its ends, no full stops."""
    trimmed = F.regexp_replace(squeeze(text), r"^[ .;,]+|[ .;,]+$", "")
    return squeeze(F.regexp_replace(title_case(trimmed), r"\.(?=\s|$)", ""))


def is_person(name: Column) -> Column:
    """Whether a name of `person` is two to five capitalised words, and doesn't begin like a phrase."""
    return name.rlike(_PERSON) & ~F.lower(F.substring_index(name, " ", 1)).isin(NO_NAME)


def people(text: Column) -> Column:
    """The names of a list such as "Anna Miller, Tom Baker and Eve Smith"."""
    parts = F.split(squeeze(text), r"(?i)\s*(?:,| and | & )\s*")
    return F.filter(F.transform(parts, person), is_person)


def person_key(name: Column) -> Column:
    """Lower-case letters of a name without accents, words parted by single spaces."""
    return F.trim(F.regexp_replace(F.lower(ascii_letters(name)), "[^a-z]+", " "))


def role_of(line: Column) -> Column:
    """struct(role, names) of a line that opens with a role, or null."""
    flat = squeeze(line)
    out = F.lit(None)
    for role, opening in reversed(ROLES.items()):
        pattern = rf"(?i)^{opening}\s+(.+)$"
        out = F.when(flat.rlike(pattern), F.struct(F.lit(role).alias("role"), F.regexp_extract(flat, pattern, 1).alias("names"))).otherwise(out)
    return out


def byline(line: Column) -> Column:
    """The author of a line such as "By Anna Miller", up to a word that no name has; null if fewer than two words are left."""
    def upto_end(words: Column) -> Column:
        ends = F.array_position(F.transform(words, lambda w: w.isin(*NAME_ENDS)), True)
        return F.when(ends > 0, F.slice(words, F.lit(1), (ends - 1).cast("int"))).otherwise(words)

    # the words are bound to a lambda's variable, so the name is made once
    kept = F.transform(F.array(F.split(person(F.regexp_extract(squeeze(line), _BYLINE, 1)), " ")), upto_end)
    named = F.get(F.transform(kept, lambda words: F.when(F.size(words) >= 2, F.array_join(words, " "))), F.lit(0))
    return F.when(squeeze(line).rlike(_BYLINE), named)


def evidence(lines: DataFrame) -> DataFrame:
    """(book, page, line_no, name, role, weight, source): each mention of a person in the front pages.

    Roles and bylines stand in a line.  Below a line "by" or "translated by" the next line is the
    name; a role's line that ends in "and" has another name below it.  A name that stands alone,
    with other lines below it, is an author's.
    """
    flat = lines.filter(F.col("page") <= FRONT).withColumn("text", squeeze(F.coalesce("text", F.lit("")))).filter("text <> ''")
    by = Window.partitionBy("book", "page").orderBy("line_no")
    rows = flat.withColumns({"said": role_of(F.col("text")), "name": person(F.col("text")), "key": F.regexp_replace(F.lower("text"), "[^a-z0-9]+", "")})
    rows = rows.withColumns({"last_said": F.lag("said").over(by), "last_text": F.lag("text").over(by), "last_key": F.lag("key").over(by), "next_text": F.lead("text").over(by)})
    below = F.when(F.col("last_key") == "by", "author").when(F.col("last_key") == "translatedby", "translator")
    more = F.when(F.col("last_said").isNotNull() & F.lower("last_text").rlike(r"\band$"), F.col("last_said.role"))
    catalogued = F.col("text").rlike(_CATALOGUE) & ~((F.col("text") == F.upper("text")) & (F.col("text") != F.lower("text")))
    entry = person(F.concat_ws(" ", F.regexp_extract("text", _CATALOGUE, 2), F.regexp_extract("text", _CATALOGUE, 1)))
    alone = F.col("next_text").isNotNull() & F.col("last_said").isNull() & ~F.coalesce(F.lower("last_text").rlike("and$"), F.lit(False))
    mention = lambda name, role, weight: F.array(F.struct(name.alias("name"), F.lit(role).alias("role") if isinstance(role, str) else role.alias("role"), F.lit(weight).alias("weight")))
    named = people(F.regexp_replace(F.col("said.names"), r"(?i)\band\s*$", ""))
    rows = rows.withColumn("written", byline(F.col("text")))
    written = F.col("written")
    found = (
        F.when(F.col("said").isNotNull(), F.transform(named, lambda n: F.struct(n.alias("name"), F.col("said.role").alias("role"), F.lit(NAMED).alias("weight"))))
        .when(below.isNotNull() & is_person(F.col("name")), mention(F.col("name"), below, BELOW))
        .when(more.isNotNull() & is_person(F.col("name")), mention(F.col("name"), more, NAMED))
        .when(written.isNotNull(), mention(written, "author", NAMED))
        .when(catalogued, mention(entry, "author", CATALOGUED))
        .when(is_person(F.col("name")) & alone, mention(F.col("name"), "author", ALONE))
    )
    return rows.select("book", "page", "line_no", F.col("text").alias("source"), F.explode(found).alias("x")).select("book", "page", "line_no", "x.name", "x.role", "x.weight", "source")


def contributors(mentions: DataFrame) -> DataFrame:
    """(book, person, name, roles, weight, mentions, first_page, rank) of the people that the evidence names.

    Mentions with one canonical key are one person.  So are a short form of a name, such as
    "J Miller", and the only longer name of its block (last name and first initial) that it
    abbreviates; with several it stays apart.  Weights add up over pages, the same role of a
    person counts once on a page.  The name shown is the one with most evidence, then the
    longest.  Ranks go by weight, then by the first page, then by the key.
    """
    keyed = mentions.withColumn("key", person_key(F.col("name"))).filter("key <> ''")
    counted = keyed.groupBy("book", "key", "name", "role", "page").agg(F.max("weight").alias("weight"))
    # keys of the same book, last name and first initial meet in one window, so mentions are never joined with themselves
    rows = counted.withColumn("words", F.split("key", " "))
    rows = rows.withColumns({"last": F.element_at("words", -1), "initial": F.substring(F.get("words", F.lit(0)), 1, 1)})
    rows = rows.withColumn("block", F.collect_set("key").over(Window.partitionBy("book", "last", "initial")))
    n = F.size("words")

    def abbreviates(key: Column) -> Column:
        """Of each word but the last, one opens with the other."""
        other = F.split(key, " ")
        alike = F.zip_with(F.slice("words", F.lit(1), n - 1), F.slice(other, F.lit(1), n - 1), lambda a, b: (F.length(a) == 1) & F.startswith(b, a) | (a == b))
        return (key != F.col("key")) & (n <= F.size(other)) & F.forall(alike, lambda x: F.coalesce(x, F.lit(False)))

    short = (n > 1) & F.exists("words", lambda a: F.length(a) == 1)
    rows = rows.withColumn("longer", F.when(short, F.filter("block", abbreviates)))
    rows = rows.withColumn("person", F.when(F.size("longer") == 1, F.get("longer", F.lit(0))).otherwise(F.col("key")))
    once = Window.partitionBy("book", "person", "role", "page").orderBy(F.desc("weight"))
    rows = rows.withColumns({"shown": F.sum("weight").over(Window.partitionBy("book", "person", "name")), "first": F.row_number().over(once) == 1})
    out = rows.groupBy("book", "person").agg(
        F.sort_array(F.collect_set("role")).alias("roles"), F.sum(F.when(F.col("first"), F.col("weight"))).alias("weight"), F.count_if("first").alias("mentions"), F.min("page").alias("first_page"),
        F.max_by("name", F.struct("shown", F.length("name"), "name")).alias("name"),
    )
    return out.withColumn("rank", F.row_number().over(Window.partitionBy("book").orderBy(F.desc("weight"), "first_page", "person")))


def year_of(text: Column) -> Column:
    """struct(year, priority) that a line tells, or null.

    The first pattern that fits a line counts; of several years of a line the latest, but where
    a book was published before, the first.
    """
    low = F.lower(squeeze(text))
    out = F.lit(None)
    for priority, pattern in reversed(YEARS):
        groups = [F.nullif(F.regexp_extract(low, pattern, g), F.lit("")) for g in range(1, pattern.count(r"(\d") + 1)]
        years = F.array_compact(F.array(*(g.cast("int") for g in groups)))
        year = F.array_max(years) if priority >= 80 else F.get(years, F.lit(0))
        out = F.when(low.rlike(pattern), F.struct(year.alias("year"), F.lit(priority).alias("priority"))).otherwise(out)
    return out


def year_candidates(lines: DataFrame) -> DataFrame:
    """(book, page, line_no, year, priority, rank): years of `year_of` in the lines of the front pages, the likeliest first."""
    found = lines.filter(F.col("page") <= FRONT).select("book", "page", "line_no", year_of(F.col("text")).alias("x")).filter("x IS NOT NULL").select("book", "page", "line_no", "x.year", "x.priority")
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("book").orderBy(F.desc("priority"), F.desc("year"), "page", "line_no")))


def publisher_of(text: Column) -> Column:
    """The publisher that a line names, or null or nothing."""
    flat = F.regexp_replace(squeeze(text), "(?i)^published by ", "")
    tail = F.regexp_replace(F.regexp_extract(flat, "(?i)^.* by (.+)$", 1), r"^[ ,;.]+|[ ,;.]+$", "")
    by = (tail != "") & ~tail.rlike("[0-9]")
    inside = F.regexp_extract(F.when(by, tail).otherwise(flat), PUBLISHER, 1)
    return title_case(F.when(inside != "", F.regexp_replace(inside, r"^[ ,;.]+|[ ,;.]+$", "")).when(by, tail))


def publisher_candidates(lines: DataFrame) -> DataFrame:
    """(book, page, line_no, publisher, rank): publishers that lines of the front pages name, the earliest page first, then the longest name."""
    found = lines.filter(F.col("page") <= FRONT).select("book", "page", "line_no", publisher_of(F.col("text")).alias("publisher")).filter("publisher <> ''")
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("book").orderBy("page", F.desc(F.length("publisher")), "line_no")))


def citations(lines: DataFrame) -> DataFrame:
    """(book, author, publisher, year, citation) of books: the best candidate of each; the citation is null where one lacks."""
    authors = contributors(evidence(lines)).filter(F.array_contains("roles", "author"))
    first = authors.groupBy(F.col("book").alias("of_book")).agg(F.min_by("name", "rank").alias("author"))
    # the first of `publisher_candidates` and `year_candidates`, in one pass over the lines
    front = F.col("page") <= FRONT
    told = lines.select("book", "page", "line_no", F.when(front, publisher_of(F.col("text"))).alias("publisher"), F.when(front, year_of(F.col("text"))).alias("y"))
    earliest = F.when(F.col("publisher") != "", F.struct("page", (-F.length("publisher")).alias("longest"), "line_no"))
    likeliest = F.when(F.col("y").isNotNull(), F.struct((-F.col("y.priority")).alias("priority"), (-F.col("y.year")).alias("latest"), "page", "line_no"))
    books = told.groupBy("book").agg(F.min_by("publisher", earliest).alias("publisher"), F.min_by("y.year", likeliest).alias("year"))
    out = books.join(first, F.col("book").eqNullSafe(F.col("of_book")), "left").select("book", "author", "publisher", "year")
    whole = F.col("author").isNotNull() & F.col("publisher").isNotNull() & F.col("year").isNotNull()
    return out.withColumn("citation", F.when(whole, F.concat("author", F.lit(". "), "publisher", F.lit(", "), F.col("year").cast("string"), F.lit("."))))

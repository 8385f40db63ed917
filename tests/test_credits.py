"""Contributors, years and publishers of books from literal front pages."""

import pytest
from pyspark.sql import functions as F

from lexigrove.operators import credits as K

SCHEMA = "book string, page int, line_no int, text string"


def front(spark, *pages, book="b"):
    return spark.createDataFrame([(book, p, i, t) for p, lines in enumerate(pages, 1) for i, t in enumerate(lines)], SCHEMA)


@pytest.mark.parametrize(
    "text, name, found",
    [
        ("ANNA B. MILLER", "Anna B Miller", False), ("Anna Berta Miller", "Anna Berta Miller", True), (" Émile  Zöld;", "Émile Zöld", True), ("Anna", "Anna", False), ("The Miller", "The Miller", False),
        ("Anna of Mill", "Anna of Mill", False), ("D'Arcy O’Neil-Smith", "D'Arcy O’Neil-Smith", True), ("", "", False),
    ],
)
def test_person(spark, text, name, found):
    df = spark.createDataFrame([(text,)], "t string").select(K.person(F.col("t")).alias("n"))
    assert tuple(df.select("n", K.is_person(F.col("n"))).first()) == (name, found)


def mentions(spark, *pages):
    return sorted((r.name, r.role, r.weight) for r in K.evidence(front(spark, *pages)).collect())


def test_evidence(spark):
    page = ["THE RIVER BOOK", "ANNA MILLER", "Translated from the Old Tongue by Tom Baker and Eve Smith", "With an Introduction by Ida Stone and", "Ole Berg", "some lines of text"]
    found = mentions(spark, page)
    assert ("Anna Miller", "author", 2) in found and ("Tom Baker", "translator", 5) in found and ("Eve Smith", "translator", 5) in found
    assert ("Ida Stone", "introduction", 5) in found and ("Ole Berg", "introduction", 5) in found and not [m for m in found if m[0] == "The River Book"]
    assert mentions(spark, ["by", "Anna Miller"], ["Translated by", "Tom Baker"]) == [("Anna Miller", "author", 4), ("Tom Baker", "translator", 4)]
    assert mentions(spark, ["By Anna Miller University Press"], ["Miller, Anna Berta."], ["MILLER, ANNA"], ["by the river"]) == [("Anna Berta Miller", "author", 4), ("Anna Miller", "author", 5)]
    assert mentions(spark, *[["x"]] * 20, ["By Anna Miller"]) == []


def test_people_are_resolved(spark):
    pages = [
        ["Anna Miller", "The River Book"], ["By Anna Miller"], ["Miller, Anna."], ["Edited by A. Miller"], ["Foreword by Anna MILLER"], ["By Tom Baker"], ["By Tom Smith"], ["Edited by T. Smith and T. Baker and Tim Smith"], ["By Zoë Àgh"], ["By Zoe Agh"],
    ]
    found = {r.person: (r.name, r.roles, r.weight, r.first_page, r.rank) for r in K.contributors(K.evidence(front(spark, *pages))).collect()}
    assert found["anna miller"] == ("Anna Miller", ["author", "foreword"], 2 + 5 + 4 + 5, 1, 1)
    assert found["zoe agh"][2] == 10 and "tom baker" in found and "tom smith" in found and "tim smith" in found


def test_short_names_join_the_only_long_one(spark):
    rows = [("b", 1, 0, n, "author", 5, "") for n in ("J Miller", "John Miller", "J B Stone", "Jane Berta Stone", "Jan Berg", "Jon Berg", "J Berg", "J Mill", "Ann Lee")]
    df = spark.createDataFrame(rows, "book string, page int, line_no int, name string, role string, weight int, source string")
    found = {r.person: r.name for r in K.contributors(df).collect()}
    assert found == {"john miller": "John Miller", "jane berta stone": "Jane Berta Stone", "jan berg": "Jan Berg", "jon berg": "Jon Berg", "j berg": "J Berg", "j mill": "J Mill", "ann lee": "Ann Lee"}


def test_roles_count_once_on_a_page(spark):
    rows = [("b", p, i, "Anna Miller", role, 5, "") for p, i, role in ((1, 0, "author"), (1, 1, "author"), (1, 2, "editor"), (2, 0, "author"))] + [(None, 3, 0, "Anna Miller", "author", 2, "")]
    df = spark.createDataFrame(rows, "book string, page int, line_no int, name string, role string, weight int, source string")
    found = {r.book: (r.weight, r.mentions, r.roles, r.first_page) for r in K.contributors(df).collect()}
    assert found == {"b": (15, 3, ["author", "editor"], 1), None: (2, 1, ["author"], 3)}


def test_years(spark):
    lines = ["Copyright 1988, 1992, 1990", "First published 1985", "Originally published 1970 and 1999", "First published in English 1987 by", "Routledge Classics edition 1984", "no year 1999", "Corrected edition", None]
    got = [(r.year, r.priority) for r in K.year_candidates(front(spark, lines)).orderBy("rank").collect()]
    assert got == [(1984, 100), (1987, 95), (1985, 90), (1992, 80), (1970, 70)]


def test_publishers(spark):
    pages = [["a line"], ["Published by North Shore University Press, Hill Town", "Old Mill Press"], ["RIVER PUBLISHERS 1988", "Printed by Some House"]]
    got = [(r.page, r.publisher) for r in K.publisher_candidates(front(spark, *pages)).orderBy("rank").collect()]
    assert got[0] == (2, "North Shore University Press") and (2, "Old Mill Press") in got and (3, "River Publishers") in got and (3, "Some House") in got


def test_citation(spark):
    lines = front(spark, ["THE RIVER BOOK", "By Anna Miller"], ["North Press", "Copyright 1988"]).unionByName(front(spark, ["By Tom Baker"], book="c"))
    got = {r.book: r.citation for r in K.citations(lines).collect()}
    assert got == {"b": "Anna Miller. North Press, 1988.", "c": None}
    assert K.citations(lines.limit(0)).collect() == []


def test_citations_read_the_lines_twice(spark):
    """Once for people, once for years and publishers; mentions never meet themselves in a join."""
    found = K.citations(front(spark, ["By Anna Miller", "North Press", "Copyright 1990"]))
    assert [(r.author, r.publisher, r.year) for r in found.collect()] == [("Anna Miller", "North Press", 1990)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 2 and plan.count("Join") == 1

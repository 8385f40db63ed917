import pytest
from pyspark.sql import functions as F

from lexigrove.operators import matching as M


def value(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize("text, zone, region, next_text, next_zone, next_region, distance, want", [
    ("The first of them agrees that the tale of", "center", "r10", "3a) C D 1871. Miller", "center", "r10", 0.0, "embedded-anchor-fragment"),
    ("What the river brings down-", "center", "r23", "3b)", "center", "r24", 1.1, "marker-only-next-anchor"),
    ("There was no more to hear of the rain", "right", "r1", "3b)", "center", "r2", 7.2, "cross-zone-next-anchor"),
    ("A complete sentence.", "center", "r1", "3b)", "center", "r2", 1.1, None),
    ("one two three four five six seven eight nine ten eleven twelve thirteen fourteen", "right", "r1", "3b)", "center", "r2", 7.2, None),
    ("It is far", "right", "r1", "3b)", "center", "r2", 18.5, None),
    ("It has none", "right", "r1", None, None, None, None, None),
])
def test_attachment(spark, text, zone, region, next_text, next_zone, next_region, distance, want):
    lit = lambda x, kind: F.lit(x).cast(kind)
    args = [lit(x, "string") for x in (text, zone, region, next_text, next_zone, next_region)]
    assert value(spark, M.attach_reason(*args, lit(distance, "double"))) == want


@pytest.mark.parametrize("line, variant, want", [
    ("c. Rivers", "C Rivers", "exact"), ("The Mill: and more", "The Mill", "inline_variant"), ("The Harvest Returns Early", "The Harvests Returns Again", "fuzzy_variant"),
    ("Gardening Weather", "Gardeners Weathered", "fuzzy_variant"), ("Something else here", "The Mill", None), ("", "The Mill", None), ("Bread, Salt, Honey (", "Bread, Salt, Honey", "exact"),
])
def test_headings(spark, line, variant, want):
    assert value(spark, M.heading_match(F.lit(line), F.lit(variant))) == want

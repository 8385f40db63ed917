"""Rules that tie fragments to anchors and lines to headings, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexigrove.functions.text import match_key, squeeze

#: Farthest distance and most words of a fragment that joins the next anchor (fixed values).
ATTACH_POINTS, ATTACH_WORDS = 18.0, 10
_WORD = "[A-Za-z][A-Za-z'’-]*"


def incomplete(text: Column) -> Column:
    """Whether a text stops in mid-sentence: no full stop, question or exclamation mark at its end."""
    flat = squeeze(text)
    return (flat != "") & ~flat.rlike("[.!?][\"”')\\]]?$")


def marker_only(text: Column) -> Column:
    """Whether an anchor line is its marker, such as "3b)", alone."""
    return F.trim(text).rlike(r"(?i)^([-*][ \t]*)?[0-9]+[a-z]\)[ \t]*$")


def attach_reason(text: Column, zone: Column, region: Column, next_text: Column, next_zone: Column, next_region: Column, distance: Column) -> Column:
    """Why a fragment belongs to the next anchor, or null: it lies near, is short and stops in mid-sentence."""
    short = F.regexp_count(squeeze(text), F.lit("[^ ]+")) <= ATTACH_WORDS
    return attach_verdict(next_text.isNotNull() & short & incomplete(text), zone, region, marker_only(next_text), next_zone, next_region, distance)


def attach_verdict(hangs: Column, zone: Column, region: Column, bare: Column, next_zone: Column, next_region: Column, distance: Column) -> Column:
    """`attach_reason` of a fragment that ``hangs`` (it is short, stops in mid-sentence and an anchor follows); ``bare`` says whether that anchor is its marker alone."""
    reason = F.when(region == next_region, "embedded-anchor-fragment").when(zone != next_zone, "cross-zone-next-anchor").when(bare, "marker-only-next-anchor")
    return F.when(hangs & distance.isNotNull() & (distance <= ATTACH_POINTS), reason)


def _same(left: Column, right: Column) -> Column:
    """Equal words, or such of five letters or more that open alike."""
    a, b = F.lower(left), F.lower(right)
    return (a == b) | ((F.length(a) >= 5) & (F.length(b) >= 5) & (F.substring(a, 1, 5) == F.substring(b, 1, 5)))


def heading_match(line: Column, variant: Column) -> Column:
    """How a line matches a heading's variant: "exact", "variant", "inline_variant", "fuzzy_variant" or null.

    Fuzzy: up to three leading words are alike and at most one word of the variant isn't; two
    words must both be alike.
    """
    return parts_match(heading_parts(line), heading_parts(variant))


def heading_parts(text: Column) -> Column:
    """struct(key, words, flat) of a line or variant, as `parts_match` compares them; a join finds them once for each side."""
    return F.struct(match_key(text).alias("key"), F.regexp_extract_all(text, F.lit(_WORD), F.lit(0)).alias("words"), F.lower(squeeze(text)).alias("flat"))


def parts_match(line: Column, variant: Column) -> Column:
    """`heading_match` of two sides of `heading_parts`."""
    own, other = line["words"], variant["words"]
    n = F.least(F.size(own), F.size(other))
    alike = F.zip_with(F.slice(own, 1, n), F.slice(other, 1, n), _same)
    similar = F.size(F.filter(alike, lambda x: x))
    leading = F.forall(F.slice(alike, 1, 3), lambda x: x)
    short = (n == 2) & (F.size(own) == F.size(other)) & (similar == n)
    long = (n >= 3) & leading & (similar >= F.greatest(F.lit(3), F.size(other) - 1))
    low, wanted = line["flat"], variant["flat"]
    rest = F.regexp_replace(F.substring(low, F.length(wanted) + 1, F.length(low)), "^[ .:;,!?)\\]}\"'’\\[-]+", "")
    return (
        F.when((line["key"] != "") & (line["key"] == variant["key"]), "exact")
        .when((wanted != "") & low.startswith(wanted) & (rest == ""), "variant")
        .when((wanted != "") & low.startswith(wanted), "inline_variant")
        .when((F.size(own) >= 2) & (F.size(other) >= 2) & (short | long), "fuzzy_variant")
    )

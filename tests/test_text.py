import pytest
from pyspark.sql import functions as F

from lexigrove.functions import text as X
from lexigrove.operators.projection import embedded_view


def value(spark, column, **cols):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()]).select(column).first()[0]


@pytest.mark.parametrize("token, want", [("running", "runn"), ("this", "thi"), ("studies", "study"), ("ties", "tie"), ("seemingly", "seem"), ("as", "as"), ("bus", "bus"), ("walked", "walk"), ("boxes", "box")])
def test_stem(spark, token, want):
    assert value(spark, X.stem(F.col("t")), t=token) == want


def test_terms(spark):
    assert value(spark, X.terms(F.col("t")), t="The Café's walls, and THIS x 42") == ["caf", "wall", "thi", "42"]
    assert value(spark, X.terms(F.col("t")), t="") == []


def test_char_ngrams(spark):
    assert value(spark, X.char_ngrams(F.col("t")), t="A-b!") == [" a ", "a b", " b ", " a b", "a b ", " a b "]
    assert value(spark, X.char_ngrams(F.col("t")), t="?!") == []
    assert value(spark, X.char_ngrams(F.col("t")), t="a") == [" a "]


def test_keys(spark):
    assert value(spark, X.slug(F.col("t")), t=" The Écho, of 2! ") == "the-echo-of-2"
    assert value(spark, X.slug(F.col("t")), t="??") == "item"
    assert value(spark, X.slug(F.col("t")), t="Éﬁn²  Übergröße") == "efin2-ubergroe"
    assert value(spark, X.match_key(F.col("t")), t="ﬁne Ｗｉｄｅ é²") == "finewide2"
    assert value(spark, X.squeeze(F.col("t")), t="\u00a0a\u2003\x85b\x1fc \u3000") == "a b c"
    assert value(spark, X.match_key(F.col("t")), t="b. Language") == "blanguage"
    assert value(spark, X.title_case(F.col("t")), t="THE ORDER OF  THINGS AS THEY ARE BY NIGHT") == "The Order of Things as They Are By Night"
    assert value(spark, X.title_case(F.col("t")), t=" the ORDER of  things") == "the ORDER of things"
    assert value(spark, X.title_case(F.col("t")), t="12 34") == "12 34"


def test_repeated_words(spark):
    assert value(spark, X.repeated_words(F.col("t")), t="the The the the a a They\nthey, other there also also") == ["the", "the", "they", "also"]
    assert value(spark, X.repeated_words(F.col("t")), t="you you, bathe the theme") == []


def test_joins(spark):
    assert value(spark, X.join_lines(F.lit("regard-"), F.lit("ing it"))) == "regarding it"
    assert value(spark, X.join_lines(F.lit("Anglo-"), F.lit("Saxon"))) == "Anglo- Saxon"


@pytest.mark.parametrize("n, roman", [(1, "i"), (4, "iv"), (9, "ix"), (14, "xiv"), (49, "xlix"), (1994, "mcmxciv"), (3999, "mmmcmxcix")])
def test_roman(spark, n, roman):
    assert value(spark, X.roman_numeral(F.lit(n))) == roman
    assert value(spark, X.roman_value(F.lit(roman))) == n


def test_not_roman(spark):
    assert value(spark, X.roman_value(F.lit("iiii"))) is None and value(spark, X.roman_value(F.lit(""))) is None


def test_markdown(spark):
    text = "<!-- c -->\n- item\n\nContext: x\n_Source page 3_\n  kept\nSource pages: 1"
    assert value(spark, X.retrieval_text(F.col("t")), t=text) == "item\n\n  kept"


def test_html(spark):
    html = "<html><title> A <b>b</b></title><script>var t='</p>';</script><p>one<br/>two</p></html>"
    assert value(spark, X.html_text(F.col("t")), t=html) == "A b one two"
    assert value(spark, X.html_field(F.col("t"), "title"), t=html) == "A b"


def test_nfkc(spark):
    assert value(spark, X.nfkc(F.col("t")), t="ﬁne Ⅳ") == "fine IV"


def test_views(spark):
    t = [F.lit(x) for x in ("A Title", None, "section")]
    body, short, long = "Words of the body. " * 120, "A gloss at the margin. " * 20, "Side matter. " * 60
    assert value(spark, embedded_view("body", *t, F.lit(body), F.lit(short))) == body.strip()
    title, kind, text, side = value(spark, embedded_view("contextual", *t, F.lit(body), F.lit(short))).split("\n\n")
    assert (title, kind) == ("A Title", "section") and 1580 < len(text) <= 1600 and text.endswith("body.") or text.endswith("the")
    assert side.startswith("Supplement: A gloss") and len(side) <= 12 + 180
    assert "Supplement" not in value(spark, embedded_view("contextual", *t, F.lit(body), F.lit(long)))
    assert len(value(spark, embedded_view("contextual", *t, F.lit(body), F.lit(long), normalised=False)).split("Supplement: ")[1]) <= 400
    assert value(spark, embedded_view("contextual", *t, F.lit(None), F.lit("x"))) == "A Title\n\nsection"
    with pytest.raises(ValueError):
        embedded_view("other", *t, F.lit("a"), F.lit("b"))

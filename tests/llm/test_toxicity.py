import math
import random
import zlib

import numpy as np
import pytest
from helpers import edge_docs, empty_docs

from lexigrove.llm import toxicity as X
from lexigrove.llm.queries import op8_toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
    return row[-1]


LEXICON = X.Lexicon({"idiot": 1.0, "worthless": 1.0, "scum": 1.0}, {"boco": 0.5})


@pytest.mark.parametrize("word", ["idiot", "idiit", "idot", "iddiot", "idi0t", "1diot", "idat", "worthles", "wrthles", "warthlass", "worth", "scum", "scam", "bocoes", "bocaes", "xidiotx", "diot", "idio", "ordhless", "wurthlezz"])
def test_automaton_equals_plain_distance(word):
    plain = word.translate(X._LEET)
    near = {w for w in LEXICON.words if word == w or distance(plain, w) <= X.allowed(len(w))}
    found = LEXICON.search(word)
    assert (found[0] if found else None) in (near or ({"boco"} if word.startswith("boco") else {None}))
    assert found is None or found[2] == (word not in LEXICON.words and not word.startswith("boco"))


def test_context():
    plain = X.mass(LEXICON, "what an idiot there")
    assert X.mass(LEXICON, 'he printed "what an idiot" there') == pytest.approx(plain * X.QUOTED)
    assert X.mass(LEXICON, "they said idiot there") == pytest.approx(plain * X.REPORTED)
    assert X.mass(LEXICON, "you idiot there") == pytest.approx(plain * X.ADDRESSED)
    assert X.mass(LEXICON, "what an idi0t there") == pytest.approx(plain * X.MISSPELLED)
    assert X.mass(LEXICON, "clean") == X.mass(LEXICON, None) == 0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in op8_toxicity(spark, folder).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for d, r in got.items())
    held = [(labels[d], got[d].predicted) for d in labels if got[d].held_out]
    hit = sum(a == b == 1 for a, b in held)
    assert hit >= 0.6 * sum(a for a, _ in held) and hit >= 0.9 * sum(b for _, b in held)


def test_edges(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(i, None, int(i == 9)) for i in range(11)] + [(None, None, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    got = X.toxicity_report(docs, labels).collect()
    assert len(got) == docs.count() and all(r.score is not None for r in got)
    assert X.toxicity_report(empty_docs(spark), labels).count() == 0
    assert {r.score for r in X.toxicity_report(docs, labels.limit(0)).collect()} == {0.0}
    assert X.drop_toxic(docs, labels.limit(0)).columns == docs.columns


def test_learning_ignores_held_out_labels(spark):
    docs = spark.createDataFrame([(i, f"plain text {'grubby' if i % 2 else 'nice'} number") for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    flipped = labels.select("doc_id", ((1 - labels.toxic) * (X.split_of(labels.doc_id) == 2).cast("int") + labels.toxic * (X.split_of(labels.doc_id) != 2).cast("int")).alias("toxic"))
    a, b = (sorted((r.doc_id, r.score) for r in X.toxicity_report(docs, x).collect()) for x in (labels, flipped))
    assert a == b and {i % 2 for i, s in a if s >= 0.3} == {1}


def test_learning_needs_no_share_of_all_toxic_rows(spark):
    slurs = [f"q{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}rk" for i in range(2500)]
    toxic = [f"row {i} plain " + " ".join(slurs[i * 50 % 2500 :][:50]) for i in range(600)]
    toxic = [t + " zub raregrub" * (i < 10) + " luckyword" * (i < 3) for i, t in enumerate(toxic)]
    rows = [(t, 1) for t in toxic] + [(f"row {i} plain and nice", 0) for i in range(600, 4600)]
    lexicon = X.learn_lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    assert [w for w in [*slurs, "zub", "raregrub"] if not lexicon.search(w)] == []
    assert [w for w in ("row", "plain", "luckyword") if lexicon.search(w)] == []


def test_near_words_of_a_large_lexicon():
    pick = random.Random(7)
    make = lambda n: "".join(pick.choice("abc") for _ in range(n))
    entries = {make(pick.randrange(3, 12)): 1.0 for _ in range(60)}
    lexicon = X.Lexicon(entries, {})
    for word in [make(pick.randrange(1, 14)) for _ in range(3000)]:
        assert bool(lexicon.search(word)) == any(distance(word, w) <= X.allowed(len(w)) for w in entries), word


def test_digits_for_letters():
    assert LEXICON.search("5cum") == ("scum", 1.0, True) and LEXICON.search("b0coes") == ("boco", 0.5, True)
    assert X.Lexicon({"sie": 1.0}, {}).search("513") is None
    assert X.Lexicon({"scum": 1.0}, {}, ["5cum"]).search("5cum") is None


def test_misspelled_words_under_a_stem(spark):
    forms = ["grubby"] * 8 + ["grubbier"] * 8 + ["grubbish"] * 3 + [f"grubb{c}" for c in "aeou"]
    rows = [(f"row {f} plain", 1) for f in forms * 2] + [(f"row {i} plain", 0) for i in range(600)]
    lexicon = X.learn_lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    assert "grub" in lexicon.stems
    for word in ("grubbies", "6rubby", "9rubby", "grvbby", "gruubby", "grvbbier", "grvbbish", "9rubbish"):
        assert lexicon.search(word), word
    assert lexicon.search("gr8bby")[2] and not lexicon.search("grubber")[2]
    assert lexicon.search("plain") is None


def test_words_of_copies_are_met_as_they_are_only(spark):
    long = " ".join(f"wor{chr(97 + i % 26)}{chr(97 + i // 26)}xy" for i in range(60))
    rows = [(f"{long} end{i % 2}", 1) for i in range(40)] + [(f"some {chr(97 + i % 26)}{chr(97 + i // 26)} grubby place", 1) for i in range(40)]
    rows += [(f"row {i} plain and nice", 0) for i in range(600)]
    lexicon = X.learn_lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    assert lexicon.search("grvbby") and lexicon.search("grubby") and not lexicon.search("plain")
    assert not [w for w in long.split() if lexicon.search(f"{w}q")] and not lexicon.stems


def test_scores_equal_a_plain_search(spark):
    folder = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    rows, _ = X.training_rows(docs.unionByName(docs.withColumn("doc_id", docs.doc_id + 10**6)), labels.unionByName(labels.withColumn("doc_id", labels.doc_id + 10**6)))
    lexicon = X.Lexicon({"idiot": 1.0, "worthless": 0.9, "scum": 0.8, "pathetic": 0.7}, {"loweis": 0.6, "vequ": 0.5}, ["pathetics"])
    half = X.learn_half(rows, lexicon)

    def entry(word):
        if word in lexicon.words:
            return word, lexicon.words[word], 1.0
        if stem := next((s for s in lexicon.stems if word.startswith(s)), None):
            return stem, lexicon.stems[stem], 1.0
        if word in lexicon.ordinary or word.isdigit():
            return None
        plain = word.translate(X._LEET) if any(c in "0123456789" for c in word) else word
        if plain not in lexicon.words and (stem := next((s for s in lexicon.stems if plain.startswith(s)), None)):
            return stem, lexicon.stems[stem], X.MISSPELLED
        near = sorted((distance(plain, w), w) for w in lexicon.words if distance(plain, w) <= X.allowed(len(w)))
        return (near[0][1], lexicon.words[near[0][1]], X.MISSPELLED) if near else None

    texts = [r.text or "" for r in docs.collect()][:60] + ["1d1ot! worthles, “scum” 5cum pathetlc loweisx v3quo", "you idiot"]
    for text, hits in zip(texts, lexicon.hits_of(texts)):
        words = [(m.group().translate(X._FOLD), m.start(), m.end()) for m in X.WORD.finditer(text)]
        plain = []
        for i, (w, a, b) in enumerate(words):
            if found := entry(w):
                near = {x[0] for x in words[max(0, i - 4) : i] + words[i + 1 : i + 5]}
                factor = X.QUOTED if X.quoted(text, a, b) else X.REPORTED if near & X.REPORTS else X.ADDRESSED if near & X.ADDRESSES else 1.0
                plain.append((found[0], pytest.approx(found[1] * found[2] * factor)))
        assert hits == plain
    assert half > 0


def test_clashing_columns_stay(spark):
    docs = spark.createDataFrame([(1, "an idiot", 5, 6, 7), (2, "fine", 8, 9, 10)], "doc_id long, text string, toxicity_score int, toxicity_hits int, __score int")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    assert sorted(map(tuple, X.drop_toxic(docs, labels).collect())) == [(1, "an idiot", 5, 6, 7), (2, "fine", 8, 9, 10)]


def test_chances_are_exact():
    n_bad, n_good = 9, 55
    pairs = [(b, g) for b in range(10) for g in range(0, 56, 5) if b + g]
    exact = [sum(math.comb(n_bad, x) * math.comb(n_good, b + g - x) for x in range(b, min(n_bad, b + g) + 1) if b + g - x <= n_good) / math.comb(64, b + g) for b, g in pairs]
    got = X.chances(np.array([b for b, _ in pairs]), np.array([g for _, g in pairs]), n_bad, n_good)
    for (b, g), want, found in zip(pairs, exact, got, strict=True):
        assert found == pytest.approx(want, rel=1e-9) if b * n_good > g * n_bad else found == 1


def test_bar_on_plain_terms():
    """The bar of counted chances is that of all terms, one by one."""
    pick = random.Random(3)
    for _ in range(200):
        chance = [10 ** -pick.uniform(0, 6) for _ in range(pick.randrange(1, 12))]
        times = [pick.randrange(1, 30) for _ in chance]
        terms = sorted(c for c, n in zip(chance, times, strict=True) for _ in range(n))
        certain = [c for c in terms if c * len(terms) <= 0.05]
        others = terms[len(certain) :]
        admitted = certain + [c for k, c in enumerate(others, 1) if c <= 0.05 * k / len(others)]
        assert X.bar(np.array(chance), np.array(times)) == pytest.approx(max(admitted, default=-1.0))


def test_lexicon_equals_plain_counting(spark):
    """Words and stems of sf0.001's training rows, counted and tested in plain Python."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{n}.parquet") for n in ("documents", "labels"))
    rows, _ = X.training_rows(docs, labels)
    held = [({t for w in X.distinct_words(r.text) for t in X._terms(w)}, r.toxic) for r in rows.collect()]
    n_bad = sum(t for _, t in held)
    counts = {w: (sum(t for d, t in held if w in d), sum(not t for d, t in held if w in d)) for w in set().union(*(d for d, t in held if t))}
    want = set()
    for k in (0, *X.STEM_LENGTHS):
        own = [w for w in counts if (len(w) - 1 if w.endswith("*") else 0) == k]
        chance = X.chances(np.array([counts[w][0] for w in own]), np.array([counts[w][1] for w in own]), n_bad, len(held) - n_bad)
        most = X.bar(chance, np.ones(len(own), int))
        want |= {w for w, c in zip(own, chance, strict=True) if c <= most and counts[w][0] >= X.LEAST_COUNT and counts[w][1] == 0}
    lexicon = X.learn_lexicon(rows)
    assert len(want) >= 4 and {w for w in want if not lexicon.search(w.rstrip("*"))} == set()
    assert {*lexicon.stems} <= {w[:-1] for w in want}
    clean = set().union(*({w for w in d if not w.endswith("*")} for d, t in held if not t))
    assert not [w for w in clean if lexicon.search(w)]

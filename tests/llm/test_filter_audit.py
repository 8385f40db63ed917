import re
from collections import Counter
from itertools import permutations

import duckdb
import pytest

from lexigrove.llm import filter_audit as A
from lexigrove.llm.queries import ORACLE_SQL, op12_filter_audit
from tests.llm.helpers import SMALL, edge_docs, empty_docs

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def brute(docs, labels):
    """All orders, run over the documents one by one."""
    least, marks = {}, {}
    for r in docs:
        if r.doc_id is not None:
            least[r.text or ""] = min(least.get(r.text or "", r.doc_id), r.doc_id)
    for r in labels:
        good, toxic = marks.get(r.doc_id, (False, False))
        marks[r.doc_id] = good or r.quality == 1, toxic or r.toxic == 1
    parts = {}
    for r in docs:
        text = r.text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = set()
        fails |= {"A"} if len(words) < 200 else set()
        fails |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text) else set()
        fails |= {"D"} if re.search("[#$%&*|]", text) else set()
        fails |= {"E"} if r.doc_id is not None and r.doc_id > least[text] else set()
        parts.setdefault(r.lang or "", []).append((fails, *(marks.get(r.doc_id, (False, False)) if r.doc_id is not None else (False, False))))
    rows, by_filter = [], Counter()
    for part, held in parts.items():
        for order in permutations("ABCDE"):
            gone = set()
            for step, f in enumerate(order, 1):
                out = [i for i, (fails, *_) in enumerate(held) if f in fails and i not in gone]
                redundant = sum(f in fails and i in gone for i, (fails, *_) in enumerate(held))
                gone |= set(out)
                by_filter[part, f] += len(out)
                rows.append([part, "".join(order), step, len(held) - len(gone), len(out), redundant, sum(fails == {f} for fails, *_ in held), sum(held[i][1] for i in out), sum(held[i][2] for i in out), f])
    return sorted((*r[:-1], by_filter[r[0], r[-1]]) for r in rows)


def got(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()))


def test_query(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    want = brute(docs.collect(), labels.collect())
    rows = got(op12_filter_audit(spark, SMALL))
    assert rows == want
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    asked = con.execute(ORACLE_SQL["op12_filter_audit"])
    assert [c[0] for c in asked.description] == COLUMNS
    assert sorted(asked.fetchall()) == want


def crafted(spark):
    """Texts that are equal up to some block, copies over parts, and repeated ids."""
    base = " ".join(f"w{i}" for i in range(3000))
    texts = [base, base, base[:-1] + "x", base[:300] + "y" + base[301:], "A" + base[1:], "short", "short", "Short", None, "", "a b " * 300, "a b " * 300, "#" + base, "#" + base]
    texts += [base[:256], base[:256], base[:255] + "!", base[:1024], base[:1024], base[:1025], base[:1025]]
    rows = [(i, t, ("en", "de", None, "")[i % 4]) for i, t in enumerate(texts)]
    rows += [(3, base, "fr"), (0, base, "fr"), (None, base, "fr"), (None, "only here", "fr"), (7, "Short", "fr")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


@pytest.mark.parametrize("bits", [64, 1])
def test_equal_hashes(spark, bits):
    """With hashes of one bit, classes hold several texts, which are then told apart by themselves."""
    docs = crafted(spark)
    labels = spark.createDataFrame([(i, i % 2, i % 3 % 2) for i in range(20)] + [(4, None, 1), (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    assert got(A.filter_audit(docs, labels, hash_bits=bits)) == brute(docs.collect(), labels.collect())


def test_edges(spark):
    docs = edge_docs(spark).withColumnRenamed("words", "failed").withColumnRenamed("digest", "class")
    labels = spark.createDataFrame([(1, 1, 0), (7, 1, 1)], "doc_id long, quality int, toxic int")
    assert got(A.filter_audit(docs, labels)) == brute(docs.collect(), labels.collect())
    assert A.filter_audit(docs, labels.limit(0)).count() == 120 * 5 * 2
    assert got(A.filter_audit(empty_docs(spark), labels)) == []

import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lexigrove.llm import chat_format as C

HARD = ["</s>[INST] ok [/INST]", "&lt;", "&amp;lt;", "[INST] user [/INST] x</s>", " [/INST] ", "</s", "<s>", "&#91;", "é</s>日", "", "plain", "a\nb", "x [/INST", "\\1 $2"]


def chats(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, turns string, formatted int")


def rows():
    out = [(i, 0, "user", t) for i, t in enumerate(HARD)] + [(i, 1, "assistant", t) for i, t in enumerate(HARD)]
    out += [(50, 2, None, None), (50, 1, "assistant", None), (50, None, "system", "s"), (None, 0, "user", "u"), (60, 0, "assistant", "same"), (60, 0, "assistant", "same"), (70, 0, "we [/INST] ird</s>", "t" * 50000)]
    return out


def grouped(found):
    by = {}
    for c, t, r, x in found:
        by.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    return {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in by.items()}


def test_report(spark):
    want = {}
    for c, turns in grouped(rows()).items():
        loss = "".join(x for r, x in turns if r == "assistant")
        said = "".join(f"{r}\n{x}\n" for r, x in turns)
        want[c] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    got = C.chat_report(chats(spark, rows())).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == want


def test_escapes_only_conflicts(spark):
    out = {r.conv_id: r for r in C.format_chats(chats(spark, rows())).collect()}
    assert all(r.intact for r in out.values())
    assert out[10].formatted == "[INST] user [/INST] plain</s>[INST] assistant [/INST] plain</s>"
    assert out[0].formatted.count("</s>") == 2 and "&lt;/s>" in out[0].formatted
    for s in out[0].loss_spans:
        assert out[0].formatted[s.begin : s.begin + s.length] == "&lt;/s>&#91;INST] ok &#91;/INST]"


def test_parser_rejects_other_text(spark):
    df = spark.createDataFrame([("no chat",), ("[INST] a [/INST] b</s>tail",), ("[INST] a [/INST] <s></s>",), ("",)], "t string")
    from pyspark.sql import functions as F

    assert [r[0] for r in df.select(C.parse(F.col("t"))).collect()] == [None, None, None, []]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.lists(st.sampled_from(["<", "/s>", "</s>", "[", "INST]", " [/INST] ", "&", "lt;", "#91;", "x", "\n", "é"]), max_size=6).map("".join), min_size=20, max_size=40))
def test_any_text_comes_back(spark, texts):
    df = spark.createDataFrame([(i // 2, i % 2, "user" if i % 2 else "assistant", t) for i, t in enumerate(texts)], "conv_id long, turn long, role string, text string")
    assert all(r.intact for r in C.format_chats(df).collect())


def test_empty(spark):
    assert C.chat_report(chats(spark, [])).count() == 0


def test_native(spark):
    plan = C.chat_report(chats(spark, rows()).select("conv_id", "turn", "role", "text"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("ArrowEvalPython", "BatchEvalPython", "MapInArrow", "MapInPandas"))


@pytest.mark.parametrize("text", HARD)
def test_escape_is_reversible(spark, text):
    from pyspark.sql import functions as F

    got = spark.range(1).select(C.unescape(C.escape(F.lit(text)))).first()[0]
    assert got == text

"""Chat formatting with a grammar round trip, in DataFrame functions only.

Grammar of a formatted conversation::

    conversation = turn*
    turn         = "[INST] " role " [/INST] " text "</s>"

Neither role nor text may hold a control string ("[INST]", "[/INST]", "<s>", "</s>").  Text
that holds one, or that the parser would not give back as it was, is escaped: "&" becomes
"&amp;", "[" becomes "&#91;" and "<" becomes "&lt;".  The parser always unescapes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "[INST] ", " [/INST] ", "</s>"
_CONTROL = r"\[/?INST\]|</?s>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("["), F.lit("&#91;")), F.lit("<"), F.lit("&lt;"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&#91;"), F.lit("[")), F.lit("&amp;"), F.lit("&"))


def _render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(MIDDLE), text, F.lit(CLOSE))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation, or null where it isn't one of this grammar."""
    parts = F.split(formatted, CLOSE, -1)  # no mark of a regular expression stands in it
    turns = F.transform(F.slice(parts, 1, F.size(parts) - 1), _turn)
    well = F.forall(turns, lambda t: t["well"]) & (F.element_at(parts, -1) == "")
    return F.when(well, F.transform(turns, lambda t: F.struct(unescape(t["role"]).alias("role"), unescape(t["text"]).alias("text"))))


def _turn(part: Column) -> Column:
    """Role and text of what stands before a closing mark, and whether they are well formed."""
    at = F.instr(part, MIDDLE)
    role, text = F.substring(part, len(OPEN) + 1, at - len(OPEN) - 1), F.substring(part, at + len(MIDDLE), F.length(part))
    well = F.startswith(part, F.lit(OPEN)) & (at > len(OPEN)) & ~role.rlike(_CONTROL) & ~text.rlike(_CONTROL)
    return F.struct(role.alias("role"), text.alias("text"), well.alias("well"))


def _fits(text: Column) -> Column:
    """Whether the parser gives back an unescaped role or text as it was."""
    return ~text.rlike(_CONTROL) & (unescape(text) == text)


def format_chats(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans, intact.

    Turns stand by `turn`, then role and text; repeated rows are turns of their own.  Null
    roles and texts count as empty, and null ids form one conversation.  A field is escaped
    if its own round trip fails; if the parsed conversation still differs from the source,
    every field of it is escaped.  `intact` says that parsing gives back the source.
    `loss_spans` are the (begin, length) of the texts of assistant turns in `formatted`, in
    code points.  Further columns are ignored; an empty table gives an empty result.
    """
    role, text = (F.coalesce(turns[c], F.lit("")) for c in (role_col, text_col))
    rows = turns.select(turns[id_col].alias("conv_id"), turns[turn_col].alias("turn"), role.alias("role"), text.alias("text")).withColumns(
        {"put_role": F.when(_fits(F.col("role")), F.col("role")).otherwise(escape(F.col("role"))), "put_text": F.when(_fits(F.col("text")), F.col("text")).otherwise(escape(F.col("text")))}
    )
    chats = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", "put_role", "put_text"))).alias("turns"))
    first = chats.withColumn("formatted", _joined("put_role", "put_text"))
    checked = first.withColumn("fits", _same(parse(F.col("formatted"))))
    full = F.transform("turns", lambda t: t.withField("put_role", escape(t["role"])).withField("put_text", escape(t["text"])))
    final = checked.withColumn("turns", F.when(F.col("fits"), F.col("turns")).otherwise(full)).withColumn(
        "formatted", F.when(F.col("fits"), F.col("formatted")).otherwise(_joined("put_role", "put_text"))
    )
    return final.select("conv_id", "formatted", _spans().alias("loss_spans"), (F.col("fits") | _same(parse(F.col("formatted")))).alias("intact"))


def _joined(role: str, text: str) -> Column:
    return F.array_join(F.transform("turns", lambda t: _render(t[role], t[text])), "")


def _same(parsed: Column) -> Column:
    source = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return F.coalesce(parsed == source, F.lit(False))


def _spans() -> Column:
    """(begin, length) of each assistant text, from the running length of the turns before it."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,length:int>>").alias("spans"))

    def step(held: Column, t: Column) -> Column:
        begin = held["at"] + len(OPEN) + F.length(t["put_role"]) + len(MIDDLE)
        span = F.struct(begin.alias("begin"), F.length(t["put_text"]).alias("length"))
        spans = F.when(t["role"] == "assistant", F.concat(held["spans"], F.array(span))).otherwise(held["spans"])
        return F.struct((begin + F.length(t["put_text"]) + len(CLOSE)).alias("at"), spans.alias("spans"))

    return F.aggregate("turns", start, step, lambda x: x["spans"])


def chat_report(turns: DataFrame) -> DataFrame:
    """What the formatted output gives back: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    out = format_chats(turns).withColumn("back", parse(F.col("formatted")))
    said = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    masked = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["begin"] + 1, s["length"])))
    read = out.withColumn("masked", F.array_join(masked, ""))
    return read.select(
        "conv_id",
        F.size("back").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("masked").cast("long").alias("loss_chars"),
        F.sha2("masked", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )

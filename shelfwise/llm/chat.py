"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example of its own: all preceding turns are
context and only that reply is trainable.  Turns after the last reply (or a
conversation without one) become a final example without a target, so that the
output holds every turn.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` for a turn.  Inside texts and
roles a ``<``, any backslashes and a ``|`` get one more backslash after the
``<``, so no text can hold a marker and ``unescape`` takes exactly one away.
In roles ``%`` and the line feed are percent-encoded as well, for the line feed
ends the role.

Defined cases: a null text or role is an empty one; equal turn numbers are
ordered by role, then text; null turns come first; rows with a null
conversation id form one conversation; repeated rows are repeated turns.  An
example is one text, so its conversation is one row while it is expanded; the
examples of a conversation are generated one after another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The turn markers.
START, END = "<|im_start|>", "<|im_end|>\n"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<\\$1|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)\|", r"<$1|")


def escape_role(c: Column) -> Column:
    return F.replace(F.replace(escape(c), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def unescape_role(c: Column) -> Column:
    return unescape(F.replace(F.replace(c, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%")))


def format_examples(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                    text_col: str = "text", target_role: str = "assistant") -> DataFrame:
    """(conv_id, example, text, loss_start, loss_chars): one row for each target turn and one for what is left.

    ``loss_start`` counts code points from 0; both loss columns are null in an
    example without a target.
    """
    t = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                     F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    t = t.select("conv_id", F.struct(
        "turn", "role", F.col("text").alias("raw"), F.concat(head, body, F.lit(END)).alias("seg"),
        F.length(head).alias("head"), F.length(body).alias("body"),
        (F.col("role") == target_role).alias("target")).alias("x"))
    c = t.groupBy("conv_id").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    marks = F.transform("xs", lambda x, i: F.struct((i + 1).alias("k"), x["target"].alias("t"), x["head"].alias("h"), x["body"].alias("b")))
    cuts = F.filter(marks, lambda m: m["t"] | (m["k"] == F.size("xs")))
    e = c.select("conv_id", F.transform("xs", lambda x: x["seg"]).alias("segs"), cuts.alias("cuts"))
    e = e.select("conv_id", "segs", F.posexplode("cuts").alias("example", "c"))
    e = e.select("conv_id", "example", F.array_join(F.slice("segs", F.lit(1), F.col("c.k")), "").alias("text"), "c.t", "c.b")
    start = F.length("text") - F.col("b") - len(END)
    return e.select("conv_id", "example", "text", F.when(F.col("t"), start).alias("loss_start"),
                    F.when(F.col("t"), F.col("b")).alias("loss_chars"))


def target_text(text: str = "text", start: str = "loss_start", chars: str = "loss_chars") -> Column:
    """The trainable text of an example, unescaped; null without a target."""
    return unescape(F.substring(F.col(text), F.col(start) + 1, F.col(chars)))


def parse_turns(text: Column) -> Column:
    """array<struct<role, text>> read back from a formatted text."""
    parts = F.split(text, r"<\|im_start\|>", -1)
    parts = F.slice(parts, F.lit(2), F.size(parts))
    return F.transform(parts, lambda p: F.struct(
        unescape_role(F.substring_index(p, "\n", 1)).alias("role"),
        unescape(F.substring(p, F.locate("\n", p) + 1,
                             F.length(p) - F.locate("\n", p) - len(END))).alias("text")))


def digests(examples: DataFrame) -> DataFrame:
    """Per conversation what its examples hold, read back from them.

    The longest example holds every turn; each target is taken once, in order.
    """
    x = examples.select("conv_id", F.struct("example", "text").alias("last"), F.length("text").alias("chars"),
                        F.struct("example", target_text().alias("t")).alias("loss"))
    g = x.groupBy("conv_id").agg(F.max("last").alias("last"), F.sum("chars").alias("formatted_chars"),
                                 F.sort_array(F.collect_list("loss")).alias("loss"))
    g = g.select("conv_id", "formatted_chars", parse_turns(F.col("last.text")).alias("turns"),
                 F.array_join(F.transform("loss", lambda l: F.coalesce(l["t"], F.lit(""))), "").alias("loss"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return g.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
                    F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                    F.col("formatted_chars").cast("long").alias("formatted_chars"))

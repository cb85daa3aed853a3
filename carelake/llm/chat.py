r"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: the formatted text of all turns up
to and including it, of which only the reply is trainable.  If turns follow the last
assistant turn (or there is none), one more example without a loss span holds the
whole conversation, so that the output keeps every turn.

Template of a turn:  ``### <role>\n<text></turn>\n``.  Texts and roles are escaped so
that no control string can occur in them, and exactly reversibly: a backslash becomes
``\b``, ``#`` becomes ``\h``, ``<`` becomes ``\l`` and, in roles, a newline ``\n``.

Cases: a null role or text counts as empty; turns sort by (turn, role, text), null
turns first, and repeated rows are turns of their own; rows with a null conversation id
form one conversation; an empty table gives no rows; other columns are ignored.
The examples of one conversation are quadratic in its turns; that is the method.  They
are cut from one formatted string after the explode, so a task holds one at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import col

OPEN, CLOSE = "### ", "</turn>\n"
TRAINED_ROLE = "assistant"


def escape(c: Column) -> Column:
    for raw, code in (("\\", "\\b"), ("#", "\\h"), ("<", "\\l")):
        c = F.replace(c, F.lit(raw), F.lit(code))
    return c


def unescape(c: Column) -> Column:
    for raw, code in (("<", "\\l"), ("#", "\\h"), ("\\", "\\b")):
        c = F.replace(c, F.lit(code), F.lit(raw))
    return c


def escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("\\n"))


def unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("\\n"), F.lit("\n")))


def prefix_target_examples(rows: DataFrame, conv: str = "conv_id", turn: str = "turn",
                           role: str = "role", text: str = "text") -> DataFrame:
    """One row per example: conv_id, example (from 0), n_examples, text, loss.

    ``loss`` is an array of spans {start, end} in code points of ``text``.
    """
    src = rows.select(col(conv).alias("conv_id"),
                      F.struct(col(turn).alias("turn"),
                               F.coalesce(col(role).cast("string"), F.lit("")).alias("role"),
                               F.coalesce(col(text).cast("string"), F.lit("")).alias("text")).alias("m"))
    convs = src.groupBy("conv_id").agg(F.array_sort(F.collect_list("m")).alias("turns"))
    parts = convs.select(
        "conv_id",
        F.transform("turns", lambda m: m["role"] == TRAINED_ROLE).alias("trained"),
        F.transform("turns", lambda m: F.concat(F.lit(OPEN), escape_role(m["role"]), F.lit("\n"))).alias("heads"),
        F.transform("turns", lambda m: F.concat(F.lit(OPEN), escape_role(m["role"]), F.lit("\n"),
                                                escape(m["text"]), F.lit(CLOSE))).alias("parts"))
    sized = parts.select(
        "conv_id", "trained",
        F.transform("heads", F.length).alias("head_len"),
        F.transform("parts", F.length).alias("part_len"),
        F.concat_ws("", "parts").alias("full"))
    targets = sized.withColumn(
        "at", F.filter(F.sequence(F.lit(1), F.size("trained")),
                       lambda i: F.element_at("trained", i) | (i == F.size("trained"))))
    each = targets.select("conv_id", "full", "trained", "head_len", "part_len",
                          F.size("at").alias("n_examples"), F.posexplode("at").alias("example", "i"))
    end = F.aggregate(F.slice("part_len", F.lit(1), F.col("i")), F.lit(0), lambda a, x: a + x)
    cut = each.select(
        "conv_id", "example", "n_examples",
        F.col("full").substr(F.lit(1), end).alias("text"), end.alias("stop"),
        F.element_at("part_len", F.col("i")).alias("len"),
        F.element_at("head_len", F.col("i")).alias("head"),
        F.element_at("trained", F.col("i")).alias("is_target"))
    span = F.array(F.struct((F.col("stop") - F.col("len") + F.col("head")).alias("start"),
                            (F.col("stop") - len(CLOSE)).alias("end")))
    return cut.select("conv_id", "example", "n_examples", "text",
                      F.when(F.col("is_target"), span).otherwise(F.slice(span, 1, 0)).alias("loss"))


def parse_turns(text: Column) -> Column:
    """The turns of a formatted text, unescaped: array of {role, text}."""
    pieces = F.split(text, CLOSE)
    return F.transform(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        lambda p: F.struct(
            unescape_role(F.substring_index(p.substr(F.lit(len(OPEN) + 1), F.length(p)), "\n", 1)).alias("role"),
            unescape(p.substr(F.instr(p, "\n") + 1, F.length(p))).alias("text")))


def read_back(examples: DataFrame) -> DataFrame:
    """What the formatted output holds, per conversation."""
    last = F.col("example") == F.col("n_examples") - 1
    turns = parse_turns(F.when(last, F.col("text")))
    seen = examples.select(
        "conv_id", "example", F.length("text").cast("long").alias("chars"), turns.alias("turns"),
        F.concat_ws("", F.transform("loss", lambda s: unescape(
            F.col("text").substr(s["start"] + 1, s["end"] - s["start"])))).alias("reply"))
    digested = seen.select(
        "conv_id", "example", "chars", "reply",
        F.size("turns").cast("long").alias("n"),
        F.sha2(F.concat_ws("", F.transform("turns", lambda t: F.concat(
            t["role"], F.lit("\n"), t["text"], F.lit("\n")))), 256).alias("sha"),
        F.col("turns").isNotNull().alias("is_last"))
    per = digested.groupBy("conv_id").agg(
        F.max(F.when(F.col("is_last"), F.struct("n", "sha"))).alias("whole"),
        F.array_sort(F.collect_list(F.struct("example", "reply"))).alias("replies"),
        F.sum("chars").alias("formatted_chars"))
    loss = F.concat_ws("", F.col("replies.reply"))
    return per.select("conv_id", F.col("whole.n").alias("n_turns"), F.col("whole.sha").alias("turns_sha256"),
                      F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                      "formatted_chars")

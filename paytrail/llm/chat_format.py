r"""Chat formatting checked by a grammar round trip, with built-in functions only.

Grammar of the rendered text::

    conversation := turn*
    turn         := "### " name ": " body " </turn>" LF
    body         := any text in which every control string has a backslash before it
    control      := "### " | "</turn>"

A source text conflicts when the parser, reading it rendered as it is, doesn't
give it back; a body with a control string that has no backslash is none to the parser.  Such a text is escaped: each control string, with the backslashes
right before it, gets one more backslash, which the parser takes away.  The
rendered turn is parsed again and compared with the source, until identical; a
turn that still differed would stop the job.

Known roles are written with a capital (``### Assistant: ``); other role names
are written after ``=`` with ``%``, ``:``, ``#``, ``<`` and line ends as %XX.

Defined results: null role and null text are empty.  Turns are ordered by turn
(null first), then role, then text, so repeated rows stay and their order is
fixed.  Rows with a null conv_id form one conversation.  Columns beyond conv_id,
turn, role and text are not read.

The loss mask names the characters to learn from: for each turn of the trained role, its place in
the conversation, and where its body begins and ends within the turn's own text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROLES = ("user", "assistant", "system", "tool")
#: The role whose texts are learned.
TRAINED = "assistant"
CLOSE = "</turn>"
CONTROL = r"(### |</turn>)"
BARE_CONTROL = r"(?<!\\)" + CONTROL
#: What a role name may not hold as it is, and how it is written.
ROLE_ESCAPES = (("%", "%25"), (":", "%3A"), ("#", "%23"), ("<", "%3C"), ("\n", "%0A"), ("\r", "%0D"))


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"(\\*)" + CONTROL, r"\\$1$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\*)" + CONTROL, "$1$2")


def role_name(role: Column) -> Column:
    other = role
    for raw, written in ROLE_ESCAPES:
        other = F.replace(other, F.lit(raw), F.lit(written))
    return F.when(role.isin(*ROLES), F.initcap(role)).otherwise(F.concat(F.lit("="), other))


def role_of(name: Column) -> Column:
    other = F.substring(name, 2, 1 << 30)
    for raw, written in reversed(ROLE_ESCAPES):
        other = F.replace(other, F.lit(written), F.lit(raw))
    return F.when(F.startswith(name, F.lit("=")), other).otherwise(F.lower(name))


def render(role: Column, body: Column) -> Column:
    return F.concat(F.lit("### "), role_name(role), F.lit(": "), body, F.lit(f" {CLOSE}\n"))


def turns_of(rendered: Column) -> Column:
    """The texts of a conversation's turns, without what closes them."""
    pieces = F.split(rendered, r"(?<!\\)" + CLOSE + "\n")
    return F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))


def parse(rendered: Column) -> Column:
    """array<struct<role, text>> of a rendered conversation; text is null for a body that the grammar doesn't allow."""
    pieces = turns_of(rendered)
    name_ends = lambda p: F.locate(": ", p)
    body = lambda p: F.substring(p, name_ends(p) + 2, F.length(p) - name_ends(p) - 2)
    return F.transform(
        pieces,
        lambda p: F.struct(
            role_of(F.substring(p, F.lit(5), name_ends(p) - 5)).alias("role"),
            F.when(~F.rlike(body(p), F.lit(BARE_CONTROL)), unescape(body(p))).alias("text"),
        ),
    )


def _same(rendered: Column, role: Column, text: Column) -> Column:
    turns = parse(rendered)
    return F.coalesce((F.size(turns) == 1) & (turns[0]["role"] == role) & (turns[0]["text"] == text), F.lit(False))


def render_turns(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and rendered, whose parse is exactly (role, text)."""
    clean = rows.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    plain = clean.withColumn("rendered", render(F.col("role"), F.col("text")))
    checked = plain.withColumn("conflict", ~_same(F.col("rendered"), F.col("role"), F.col("text")))
    escaped = checked.withColumn("rendered", F.when(F.col("conflict"), render(F.col("role"), escape(F.col("text")))).otherwise(F.col("rendered")))
    stop = F.raise_error(F.lit("a turn does not survive the round trip")).cast("string")
    again = F.when(~F.col("conflict") | _same(F.col("rendered"), F.col("role"), F.col("text")), F.col("rendered")).otherwise(stop)
    return escaped.withColumn("rendered", again)


def format_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_mask (array of turn, start, end) and n_source_turns; turns of a conversation in order."""
    turns = render_turns(rows)
    held = F.sort_array(F.collect_list(F.struct("turn", "role", "text", "rendered")))
    head = lambda t: F.length(role_name(t["role"])) + len("### : ")
    tail = len(f" {CLOSE}\n")
    span = lambda t, i: F.struct(i.alias("turn"), head(t).alias("start"), (F.length(t["rendered"]) - tail).alias("end"), t["role"].alias("role"))
    mask = F.transform(F.filter(F.transform("_turns", span), lambda s: s["role"] == TRAINED), lambda s: F.struct(s["turn"].alias("turn"), s["start"].alias("start"), s["end"].alias("end")))
    return turns.groupBy("conv_id").agg(held.alias("_turns")).select(
        "conv_id", mask.alias("loss_mask"), F.array_join(F.transform("_turns", lambda t: t["rendered"]), "").alias("formatted"), F.size("_turns").alias("n_source_turns")
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Digest columns of each formatted conversation, from its text and its loss mask alone."""
    parsed = formatted.withColumn("_parsed", parse(F.col("formatted")))
    flat = F.array_join(F.transform("_parsed", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    parsed = parsed.withColumn("_own", turns_of(F.col("formatted")))
    covered = lambda m: F.substring(F.get("_own", m["turn"]), m["start"] + 1, m["end"] - m["start"])
    loss = F.array_join(F.transform("loss_mask", lambda m: unescape(covered(m))), "")
    return parsed.withColumns({"_flat": flat, "_loss": loss}).select(
        "conv_id",
        F.size("_parsed").cast("long").alias("n_turns"),
        F.sha2("_flat", 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        (F.size("_parsed") == F.col("n_source_turns")).alias("all_turns_back"),
    )

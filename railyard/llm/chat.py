r"""Chat formatting with typed content parts (operator 8).

A turn's content is a list of parts: text, image, audio or document. A visitor
(one CASE per part type) flattens them in order: text is escaped, any other part
becomes a placeholder ``<|image|>`` and so on, and its reference, place and
expanded token count are recorded as an attachment. A conversation becomes a list of
segments whose concatenation is the formatted example; every segment says whether it
counts in the loss (assistant texts do).

    <|im_start|>role\n text <|im_end|>\n

Control strings inside texts cannot be taken for marks: a backslash is doubled,
then ``<|`` becomes ``<\|``. In a mark "<" is followed by "|" itself; in an escaped
text never. A single backslash between "<" and "|" arises from the escape only, as
a text's own are doubled, so unescaping is exact.

Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
PART = "struct<type:string,text:string,ref:string,tokens:bigint>"
#: Tokens a placeholder expands to where the part does not say.
TOKENS = {"image": 256, "audio": 128, "document": 512}


def escape(text) -> F.Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text) -> F.Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role) -> F.Column:
    """As escape(); a line break, which would end the role, becomes ``<\\n>``."""
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\n>"))


def unescape_role(role) -> F.Column:
    return unescape(F.replace(role, F.lit("<\\n>"), F.lit("\n")))


def text_part(text) -> F.Column:
    """A content list of one text part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"),
                            F.lit(None).cast("bigint").alias("tokens")))


def _visit(part) -> F.Column:
    """A part's output: escaped text or placeholder. Unknown types and null parts are texts."""
    out = escape(F.coalesce(part["text"], F.lit("")))
    for kind in TOKENS:
        out = F.when(part["type"] == kind, F.lit(f"<|{kind}|>")).otherwise(out)
    return F.coalesce(out, F.lit(""))


def _attachment(turn, place) -> F.Column:
    def one(part, i):
        tokens = F.coalesce(part["tokens"], F.lit(0))
        for kind, n in TOKENS.items():
            tokens = F.when(part["type"] == kind, F.coalesce(part["tokens"], F.lit(n))).otherwise(tokens)
        return F.struct(place.alias("turn"), i.alias("part"), part["type"].alias("type"), part["ref"].alias("ref"),
                        tokens.cast("bigint").alias("tokens"))
    return F.filter(F.transform(turn["content"], one), lambda a: a["type"].isin(*TOKENS))


def format_chats(rows: DataFrame) -> DataFrame:
    """One row per conversation from rows of conv_id, turn, role, content (a list of parts).

    Columns: conv_id, n_turns, segments (list of text, loss), formatted (their
    concatenation), attachments (turn, part, type, ref, tokens; in order).

    Turns are ordered by turn (nulls first), then role, then content. Null roles
    and null contents count as empty; repeated turns stay; rows without conv_id
    form one conversation. Other columns are ignored. An empty table gives an
    empty result. A conversation is one training example and so one row.
    """
    turn = F.struct("turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col("content").cast(f"array<{PART}>"), F.array().cast(f"array<{PART}>")).alias("content"))
    conv = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def segments(t):
        body = F.array_join(F.transform(t["content"], _visit), "")
        seg = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        return F.array(seg(F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n")), F.lit(False)),
                       seg(body, t["role"] == "assistant"), seg(F.lit(END + "\n"), F.lit(False)))

    out = conv.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"),
                      F.flatten(F.transform("turns", segments)).alias("segments"),
                      F.flatten(F.transform("turns", lambda t, i: _attachment(t, i))).alias("attachments"))
    return out.select("conv_id", "n_turns", "segments",
                      F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "attachments")


def read_turns(formatted) -> F.Column:
    """The turns (role, text) of a formatted example whose parts are texts."""
    blocks = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda b, i: i > 0)  # nothing stands before the first mark

    def turn(b):
        b = F.regexp_replace(b, r"<\|im_end\|>\n\z", "")
        return F.struct(unescape_role(F.substring_index(b, "\n", 1)).alias("role"),
                        unescape(F.regexp_replace(b, r"\A[^\n]*\n", "")).alias("text"))
    return F.transform(blocks, turn)


def digests(formatted: DataFrame) -> DataFrame:
    """What the query returns of formatted conversations, read back from the examples."""
    back = formatted.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"),
                            F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "").alias("loss"))
    line = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(line.cast("binary"), 256).alias("turns_sha256"),
                       F.char_length("loss").cast("bigint").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("bigint").alias("formatted_chars"))

"""Conversations as training text with a loss mask, in DataFrame expressions only.

The turns of a conversation are collected as structs and sorted, adjacent turns of one role become
one block, and the blocks are concatenated:

    <|im_start|>role<|im_sep|>text<|im_next|>text of the next turn, same role<|im_end|>\\n

Control strings inside roles and texts (this template's and other widely used ones) get a backslash
behind their first character, or one more if they have some, so that no control string of the
template can come from a text and ``parse`` finds the original turns. The loss mask lists for
each block part, in order, whether it is learnt; learnt are the texts of assistants, nothing else.

Defined results: a null text or role is empty; turns with equal numbers are ordered by role and
text, null turn numbers come first; repeated rows are turns of their own; rows without a
conversation id form one conversation; an empty table gives no rows; extra columns are left
out. A conversation is one row of the output, so it must fit a row (2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template's control strings.
START, SEPARATOR, NEXT, END = "<|im_start|>", "<|im_sep|>", "<|im_next|>", "<|im_end|>"
LEARNT_ROLE = "assistant"

# What follows the first character of a control string.
_TAILS = r"\|[a-z_]{1,20}\|>|s>|/s>|<SYS>>|</SYS>>|/?INST\]"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)(?={_TAILS})", r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)(?={_TAILS})", "$1$2")


def format_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``formatted`` and ``learnt`` (one boolean per turn: is its text under the loss
    mask) from rows of ``conv_id``, ``turn``, ``role`` and ``text``."""
    empty = F.lit("")
    collected = turns.select(
        "conv_id", "turn",
        F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"),
    ).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    )
    # A neighbour of the same role belongs to the same block.
    shifted = collected.select(
        "conv_id", "turns",
        F.transform("turns", lambda t: t.role).alias("roles"),
    ).select(
        "conv_id", "turns",
        F.concat(F.array(F.lit(None).cast("string")), F.slice("roles", 1, F.size("roles") - 1)).alias("before"),
        F.concat(F.slice("roles", 2, F.size("roles") - 1), F.array(F.lit(None).cast("string"))).alias("after"),
    )
    pieces = F.transform(
        F.arrays_zip("turns", "before", "after"),
        lambda z: F.concat(
            F.when(z.before.eqNullSafe(z.turns.role), F.lit(NEXT)).otherwise(
                F.concat(F.lit(START), escape(z.turns.role), F.lit(SEPARATOR))
            ),
            escape(z.turns.text),
            F.when(z.after.eqNullSafe(z.turns.role), empty).otherwise(F.lit(END + "\n")),
        ),
    )
    return shifted.select(
        "conv_id",
        F.array_join(pieces, "").alias("formatted"),
        F.transform("turns", lambda t: t.role == LEARNT_ROLE).alias("learnt"),
    )


def parse(formatted: DataFrame) -> DataFrame:
    """Read ``format_conversations`` back: ``conv_id``, ``formatted`` and ``turns``, an array of
    ``role``, ``text`` and ``learnt`` in order."""
    literal = lambda s: "\\Q" + s + "\\E"
    blocks = F.filter(F.split("formatted", literal(END + "\n")), lambda b: b != "")
    halves = F.transform(
        blocks, lambda b: F.split(F.substr(b, F.lit(len(START) + 1)), literal(SEPARATOR), 2)
    )
    turns = F.flatten(F.transform(
        halves,
        lambda h: F.transform(
            F.split(h[1], literal(NEXT)),
            lambda text: F.struct(unescape(h[0]).alias("role"), unescape(text).alias("text")),
        ),
    ))
    return formatted.select("conv_id", "formatted", "learnt", turns.alias("read")).select(
        "conv_id", "formatted",
        F.transform(
            F.arrays_zip("read", "learnt"),
            lambda z: F.struct(z.read.role.alias("role"), z.read.text.alias("text"), z.learnt.alias("learnt")),
        ).alias("turns"),
    )


ORACLE = r"""
WITH added AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL
    SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), shown AS (
    SELECT *, regexp_replace(text, '([<\[])(\\*)(\|[a-z_]{1,20}\|>|s>|/s>|<SYS>>|</SYS>>|/?INST\])', '\1\\\2\3', 'g') AS escaped,
           coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) = role, false) AS goes_on
    FROM added
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(escaped) + CASE WHEN goes_on THEN 11 ELSE 33 + length(role) END)::BIGINT AS formatted_chars,
       sum(CASE WHEN goes_on THEN 0 ELSE 1 END)::BIGINT AS n_blocks
FROM shown GROUP BY conv_id
"""

"""Operator 7, chat formatting from a declarative template.

A finite-state machine runs over the roles of a conversation in turn order and
says whether the order is valid; the template turns each turn into segments
(mark and role, text, end mark) with a loss flag each.  Control strings inside
texts and roles get a backslash after their first character (one more where
there are some already), which is undone when the output is read.

Everything is a DataFrame expression over one row per conversation, which is
the training sample itself: the rows of a conversation meet in the task that
writes it.

Defined cases: null text or role is the empty string; turns are ordered by
turn (null first), then role, then text, so ties and repeated rows have one
order and all stay; a null conv_id is a conversation of its own; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TEMPLATE = {
    "open": "<|im_start|>", "split": "<|im_sep|>", "close": "<|im_end|>",
    "loss": ("assistant",),
    "control": ("<s>", "</s>", "[INST]", "[/INST]", "<|endoftext|>"),
    "start": "start",
    "moves": {("start", "system"): "primed", ("start", "user"): "asked", ("primed", "user"): "asked",
              ("asked", "assistant"): "answered", ("answered", "user"): "asked"},
    "accept": ("answered",),
}


def _controls(template: dict) -> str:
    """First characters and the rests of all control strings, as a pattern's two groups."""
    strings = [template["open"], template["split"], template["close"], *template["control"]]
    firsts = "".join("\\" + c for c in sorted({s[0] for s in strings}))
    rests = "|".join(re.sub(r"([^A-Za-z0-9])", r"\\\1", s[1:]) for s in strings)
    return rf"([{firsts}])%s(\\*(?:{rests}))"


def escaped(text: Column, template: dict = TEMPLATE) -> Column:
    return F.regexp_replace(text, _controls(template) % "", r"$1\\$2")


def unescaped(text: Column, template: dict = TEMPLATE) -> Column:
    return F.regexp_replace(text, _controls(template) % r"\\", "$1$2")


def _state(roles: Column, template: dict) -> Column:
    moves = F.create_map(*[F.lit(x) for (state, role), to in template["moves"].items() for x in (f"{state}>{role}", to)])
    step = lambda state, role: F.coalesce(F.try_element_at(moves, F.concat(state, F.lit(">"), role)), F.lit("broken"))
    return F.aggregate(roles, F.lit(template["start"]), step)


def format_conversations(turns: DataFrame, template: dict = TEMPLATE, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, state, valid, segments (array of text and loss) and the formatted string."""
    told = turns.select(F.col(id_col).alias("conv_id"), F.struct(
        F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).alias("t"))
    whole = told.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    mark = lambda text: F.struct(text.alias("text"), F.lit(False).alias("loss"))
    of_turn = lambda t: F.array(
        mark(F.concat(F.lit(template["open"]), escaped(t["role"], template), F.lit(template["split"]))),
        F.struct(escaped(t["text"], template).alias("text"), t["role"].isin(*template["loss"]).alias("loss")),
        mark(F.lit(template["close"])))
    return whole.select(
        "conv_id", _state(F.col("turns")["role"], template).alias("state"), F.flatten(F.transform("turns", of_turn)).alias("segments")
    ).select("conv_id", "state", F.col("state").isin(*template["accept"]).alias("valid"), "segments", F.array_join(F.col("segments")["text"], "").alias("formatted"))


def read_turns(formatted: Column, template: dict = TEMPLATE) -> Column:
    """Array of (role, text), parsed from a formatted string."""
    parts = F.split(formatted, re.sub(r"([^A-Za-z0-9])", r"\\\1", template["open"]))
    body = lambda p: F.substring_index(p, template["close"], 1)
    return F.transform(F.slice(parts, F.lit(2), F.size(parts) - 1), lambda p: F.struct(
        unescaped(F.substring_index(body(p), template["split"], 1), template).alias("role"),
        unescaped(F.substring_index(body(p), template["split"], -1), template).alias("text")))


def read_loss(segments: Column, template: dict = TEMPLATE) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"], template)), "")

"""Chat formatting: a state machine over roles and a declarative template.

A conversation's rows are put in order of their turn (then role and text, so ties are
settled) and become segments of text, each with a flag that says whether training counts
its loss. The template gives what stands before and after each role's text. Control
strings inside texts and roles are escaped by a backslash after their first character, and
backslashes are doubled, so formatted text can be read back exactly.

The machine starts in ``start``; a role without a transition from the state reached makes
the conversation invalid and names the first such turn. Every conversation is formatted,
valid or not. Null text and null role count as empty, a null conversation id is a
conversation of its own, repeated rows are turns of their own, an empty table gives no
rows, extra columns are ignored. A conversation is one training example and is put
together in one row.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Marks and allowed turn orders; ``{role}`` in a mark is the turn's role."""

    before: str = "<|turn|>{role}\n"
    after: str = "<|end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    controls: tuple[str, ...] = (
        "<|turn|>", "<|end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
        "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>",
    )
    transitions: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "system",
            ("start", "user"): "user",
            ("system", "user"): "user",
            ("user", "assistant"): "assistant",
            ("assistant", "user"): "user",
        }
    )
    final: tuple[str, ...] = ("assistant",)


def escape(text: Column, template: Template) -> Column:
    """Backslashes doubled, and one put into each control string; those cannot overlap."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in template.controls:
        out = F.replace(out, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}"))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_conversations(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """Per conversation: ``segments`` (text, loss), ``valid``, ``bad_turn`` (from 0), ``final_state``."""
    t = template or Template()
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    gathered = (
        turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    )
    table = F.create_map(*(F.lit(x) for (a, b), c in t.transitions.items() for x in (f"{a}\n{b}", c)))

    def step(state: Column, turn: Column) -> Column:
        reached = table[F.concat_ws("\n", state["at"], turn["role"])]
        stopped = state["bad"].isNotNull() | reached.isNull()
        return F.struct(
            F.when(stopped, state["at"]).otherwise(reached).alias("at"),
            (state["seen"] + 1).alias("seen"),
            F.when(state["bad"].isNull() & reached.isNull(), state["seen"]).otherwise(state["bad"]).alias("bad"),
        )

    first = F.struct(F.lit("start").alias("at"), F.lit(0).alias("seen"), F.lit(None).cast("int").alias("bad"))
    ended = F.aggregate("turns", first, step)

    def marks(mark: str, role: Column) -> Column:
        return F.replace(F.lit(mark), F.lit("{role}"), escape(role, t))

    def segments(turn: Column):
        learnt = turn["role"].isin(*t.loss_roles)
        return F.array(
            F.struct(marks(t.before, turn["role"]).alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(turn["text"], t).alias("text"), learnt.alias("loss")),
            F.struct(marks(t.after, turn["role"]).alias("text"), F.lit(False).alias("loss")),
        )

    return (
        gathered.withColumn("ended", ended)
        .select(
            "conv_id",
            F.flatten(F.transform("turns", segments)).alias("segments"),
            (F.col("ended.bad").isNull() & F.col("ended.at").isin(*t.final)).alias("valid"),
            F.col("ended.bad").alias("bad_turn"),
            F.col("ended.at").alias("final_state"),
        )
    )


def read_back(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """``formatted`` text, its ``turns`` (role, text) parsed from it, and ``loss_text``, unescaped.

    Needs a template whose ``before`` starts with a control string and ends its role with
    a line break; escaped text cannot hold either mark.
    """
    t = template or Template()
    start, sep = t.before.split("{role}")
    whole = formatted.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))
    parts = F.slice(F.split("formatted", re.escape(start), -1), 2, F.greatest(F.lit(1), F.size("segments")))

    def turn(part: Column) -> Column:
        cut = F.instr(part, F.lit(sep))
        body = F.substring(part, cut + len(sep), F.length(part) - cut - len(sep) - len(t.after) + 1)
        return F.struct(
            unescape(F.substring(part, F.lit(1), cut - 1)).alias("role"), unescape(body).alias("text")
        )

    learnt = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))
    return whole.withColumn("turns", F.transform(parts, turn)).withColumn("loss_text", F.array_join(learnt, ""))

"""Chat formatting: a finite-state machine over roles checks the order of turns; a template turns them into segments with loss flags.

Everything is DataFrame expressions. A conversation is formatted in parts, each the turns of a range of turn numbers, so that a
very long one is spread over tasks. A part cannot know in which state it begins, so the machine is run over it from every state at
once; parts of one conversation are then composed up a tree, and their first states handed down again.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.shared import stored

#: The state after a turn that is out of order; nothing leads out of it.
OUT_OF_ORDER = "out_of_order"
_GUARD = "<|"


@dataclass(frozen=True)
class Template:
    """How a turn is written, which roles are trained on, and which role may follow in which state.

    Every control string starts with ``<|``; texts and roles never hold ``<|`` once they are escaped.
    """

    opening: str = "<|im_start|>"
    after_role: str = "\n"
    closing: str = "<|im_end|>\n"
    trained: tuple[str, ...] = ("assistant",)
    start: str = "start"
    accepting: tuple[str, ...] = ("answered",)
    transitions: Mapping[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "instructed",
            ("start", "user"): "asked",
            ("instructed", "user"): "asked",
            ("asked", "assistant"): "answered",
            ("answered", "user"): "asked",
        }
    )

    def __post_init__(self) -> None:
        if not (self.opening.startswith(_GUARD) and self.closing.startswith(_GUARD) and self.after_role == "\n"):
            raise ValueError(f"control strings start with {_GUARD}, and a line feed ends the role")

    @property
    def states(self) -> list[str]:
        named = [self.start, *(s for s, _ in self.transitions), *self.transitions.values(), *self.accepting]
        return [*dict.fromkeys(named), OUT_OF_ORDER]

    @property
    def roles(self) -> list[str]:
        return list(dict.fromkeys(role for _, role in self.transitions))


def escaped(text: Column) -> Column:
    """A text without ``<|``: one more backslash stands between a ``<``, any backslashes and a ``|``."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escaped_role(role: Column) -> Column:
    """A role is escaped as a text is, and holds no line feed."""
    return escaped(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescaped_role(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def _step(template: Template, state: Column, role: Column) -> Column:
    """The number of the state that follows."""
    numbers = {s: i for i, s in enumerate(template.states)}
    to = [F.when((state == numbers[s]) & (role == r), F.lit(numbers[t])) for (s, r), t in template.transitions.items()]
    return F.coalesce(*to, F.lit(numbers[OUT_OF_ORDER]))


def _from_every_state(template: Template) -> Column:
    """No turn yet: each state leads to itself, nothing is out of order."""
    here = [F.struct(F.lit(i).alias("state"), F.lit(None).cast("bigint").alias("bad")) for i in range(len(template.states))]
    return F.struct(F.lit(0).cast("bigint").alias("n"), F.array(*here).alias("ends"))


def _run(template: Template, turns: Column) -> Column:
    """What the turns do to every state: how many they are, and for each state where it ends and the first turn out of order."""
    bad = len(template.states) - 1

    def turn(acc: Column, t: Column) -> Column:
        def end(e: Column) -> Column:
            to = _step(template, e["state"], t["role"])
            return F.struct(to.alias("state"), F.coalesce(e["bad"], F.when((to == bad) & (e["state"] != bad), acc["n"])).alias("bad"))

        return F.struct((acc["n"] + 1).alias("n"), F.transform(acc["ends"], end).alias("ends"))

    return F.aggregate(turns, _from_every_state(template), turn)


def _then(first: Column, second: Column) -> Column:
    """Two runs, one after the other."""

    def end(e: Column) -> Column:
        on = F.get(second["ends"], e["state"])
        return F.struct(on["state"].alias("state"), F.coalesce(e["bad"], first["n"] + on["bad"]).alias("bad"))

    return F.struct((first["n"] + second["n"]).alias("n"), F.transform(first["ends"], end).alias("ends"))


def _segments(template: Template, turns: Column) -> Column:
    """The text under the loss mask is a segment of its own; what surrounds it is not trained on."""

    def turn(t: Column) -> Column:
        before = F.concat(F.lit(template.opening), escaped_role(t["role"]), F.lit(template.after_role))
        inside, after = escaped(t["text"]), F.lit(template.closing)
        plain = lambda c: F.struct(c.alias("text"), F.lit(False).alias("loss"))
        learnt = F.array(plain(before), F.struct(inside.alias("text"), F.lit(True).alias("loss")), plain(after))
        trained = reduce(or_, [t["role"] == r for r in template.trained], F.lit(False))
        return F.when(trained, learnt).otherwise(F.array(plain(F.concat(before, inside, after))))

    return F.flatten(F.transform(turns, turn))


def _entries(parts: DataFrame, template: Template, fan_in: int) -> DataFrame:
    """For every part of the conversations that have several: what came before it, and the number of the last part.

    Parts are composed in groups of ``fan_in``, groups in groups again; no group of rows is larger than that.
    """
    several = parts.filter("part > 0").select(F.col("conv_id").alias("several")).distinct()
    mine = parts.join(several, F.col("conv_id").eqNullSafe(F.col("several")), "left_semi")
    level = stored(mine.select("conv_id", F.col("part").alias("node"), "run"))
    levels, most = [], level.agg(F.max("node")).first()[0] or 0
    while True:
        held = level.withColumn("up", F.expr(f"node div {fan_in}")).groupBy("conv_id", "up")
        children = held.agg(F.sort_array(F.collect_list(F.struct("node", "run"))).alias("children"))
        composed = F.aggregate("children", _from_every_state(template), lambda acc, c: _then(acc, c["run"]))
        levels.append(stored(children.withColumn("run", composed)))
        level, most = levels[-1].select("conv_id", F.col("up").alias("node"), "run"), most // fan_in
        if not most:
            break
    nothing = _from_every_state(template)
    entered = levels[-1].select("conv_id", F.col("up").alias("node"), nothing.alias("before"), F.lit(True).alias("at_end"))
    for children in reversed(levels):
        joined = children.join(
            entered.withColumnRenamed("conv_id", "their_id"), F.col("conv_id").eqNullSafe(F.col("their_id")) & (F.col("up") == F.col("node"))
        )
        start = F.struct(F.col("before").alias("acc"), F.expr("cast(array() as array<struct<node: bigint, before: struct<n: bigint, ends: array<struct<state: int, bad: bigint>>>>>)").alias("out"))

        def child(acc: Column, c: Column) -> Column:
            given = F.array(F.struct(c["node"].alias("node"), acc["acc"].alias("before")))
            return F.struct(_then(acc["acc"], c["run"]).alias("acc"), F.concat(acc["out"], given).alias("out"))

        listed = joined.select("conv_id", "at_end", F.aggregate("children", start, child)["out"].alias("given"))
        last = F.element_at("given", -1)["node"]
        each = listed.select("conv_id", "at_end", last.alias("last"), F.explode("given").alias("g"))
        entered = each.select("conv_id", "g.node", "g.before", (F.col("at_end") & (F.col("g.node") == F.col("last"))).alias("at_end"))
    return stored(entered)


def formatted(conversations: DataFrame, template: Template | None = None, turns_per_part: int = 1024, fan_in: int = 256) -> DataFrame:
    """Every conversation as segments with loss flags, one row a part:
    ``conv_id, part, is_last, first_turn, n_turns, state, bad_turn, valid, segments``.

    ``conversations`` holds conv_id, turn, role, text; rows go by turn, a null turn first, then by role and text, so a repeated row is a turn
    of its own. A null text or role is empty; rows without conv_id are one conversation. Other columns are not read. No rows give no rows. The text of
    a part is its segments put together; the loss is on the texts of the template's trained roles, whatever the order of turns.

    ``state`` is the machine's state after the part, ``bad_turn`` the place (from 0 in the conversation) of the first turn out of order so far,
    ``valid`` whether there is none and, in the last part, whether the conversation may end there. ``first_turn`` counts the turns of earlier parts.

    A part holds the turns numbered ``turns_per_part * part`` and on; turns below 0 are in part 0. Only one part is in one place at a time;
    rows that repeat one turn number stay together.
    """
    template = template or Template()
    part = F.greatest(F.coalesce(F.expr(f"turn div {turns_per_part}"), F.lit(0)), F.lit(0)).cast("bigint")
    turn = F.struct(F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    gathered = conversations.select("conv_id", part.alias("part"), turn.alias("t")).groupBy("conv_id", "part")
    turns = gathered.agg(F.sort_array(F.collect_list("t")).alias("turns"))
    # Written before it is read back: the runs of parts are needed before the states are known.
    parts = stored(turns.select("conv_id", "part", _run(template, F.col("turns")).alias("run"), _segments(template, F.col("turns")).alias("segments")), "zstd")
    if parts.filter("part > 0").isEmpty():
        placed = parts.withColumns({"before": _from_every_state(template), "is_last": F.lit(True)})
    else:
        found = _entries(parts, template, fan_in).toDF("their_id", "their_part", "before", "at_end")
        same = F.col("conv_id").eqNullSafe(F.col("their_id")) & (F.col("part") == F.col("their_part"))
        known = parts.join(found, same, "left").drop("their_id", "their_part")
        placed = known.withColumns({"before": F.coalesce("before", _from_every_state(template)), "is_last": F.coalesce("at_end", F.lit(True))})
    states = F.array(*[F.lit(s) for s in template.states])
    end = F.get(_then(F.col("before"), F.col("run"))["ends"], F.lit(template.states.index(template.start)))
    return (
        placed.withColumn("end", end)
        .withColumn("state", F.get(states, F.col("end.state")))
        .withColumn("valid", F.col("end.bad").isNull() & (~F.col("is_last") | F.col("state").isin(*template.accepting)))
        .select(
            "conv_id", "part", "is_last", F.col("before.n").alias("first_turn"), F.col("run.n").alias("n_turns"),
            "state", F.col("end.bad").alias("bad_turn"), "valid", "segments",
        )
    )


def read_back(parts: DataFrame, template: Template | None = None) -> DataFrame:
    """What the text of each part says: ``conv_id, part, is_last, formatted, turns, loss`` with turns as role and text, and the text under
    the loss mask, both as they were before they were escaped."""
    template = template or Template()
    whole = parts.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))
    blocks = F.split("formatted", re.escape(template.opening), -1)
    blocks = F.slice(blocks, F.lit(2), F.greatest(F.size(blocks) - 1, F.lit(0)))
    marks = len(template.after_role) + len(template.closing)

    def turn(block: Column) -> Column:
        role = F.substring_index(block, template.after_role, 1)
        text = block.substr(F.length(role) + len(template.after_role) + 1, F.length(block) - F.length(role) - marks)
        return F.struct(unescaped_role(role).alias("role"), unescaped(text).alias("text"))

    learnt = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"]))
    return whole.select("conv_id", "part", "is_last", "formatted", F.transform(blocks, turn).alias("turns"), F.array_join(learnt, "").alias("loss"))


def digests(parts: DataFrame, template: Template | None = None) -> DataFrame:
    """Per conversation, read back from its text: ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.

    A hash needs the whole of what it is taken of: a conversation of over 2 GB of text has no digest in one row and stops the job.
    """
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    back = read_back(parts, template).select(
        "conv_id", "part", "is_last", F.size("turns").cast("bigint").alias("n_turns"), said.alias("said"), "loss",
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )

    def digest(df: DataFrame) -> DataFrame:
        return df.select(
            "conv_id", "n_turns", F.sha2("said", 256).alias("turns_sha256"), F.length("loss").cast("bigint").alias("loss_chars"),
            F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
        )

    several = stored(parts.filter("part > 0 OR NOT is_last").select(F.col("conv_id").alias("several")).distinct())
    if several.isEmpty():
        return digest(back)
    same = F.col("conv_id").eqNullSafe(F.col("several"))
    gathered = back.join(several, same, "left_semi").groupBy("conv_id").agg(
        F.sum("n_turns").alias("n_turns"),
        F.sum("formatted_chars").alias("formatted_chars"),
        F.sort_array(F.collect_list(F.struct("part", "said", "loss"))).alias("found"),
    )
    joined = gathered.withColumns({c: F.array_join(F.col(f"found.{c}"), "") for c in ("said", "loss")})
    return digest(back.join(several, same, "left_anti")).unionByName(digest(joined))

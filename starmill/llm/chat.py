"""Chat formatting: conversations to marked text with a loss mask, and back.

Everything is built-in expressions. A conversation is one row once its turns
are gathered, since its digest and its formatted text are one value each.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESCAPE = "\\"


@dataclass(frozen=True)
class ChatTemplate:
    """Control strings, the roles under the loss, and the states of the turn checker.

    A turn is written ``start role middle text end``. A control string has at
    least two characters, no backslash, and its first character occurs nowhere
    else in a control string, so that none can begin in a text and end in a
    marker.
    """

    start: str = "<|turn|>"
    middle: str = "<|text|>"
    end: str = "<|end|>\n"
    trained: tuple[str, ...] = ("assistant",)
    initial: str = "begin"
    #: (state, role) -> state; whatever is not listed is a fault, and the state stays.
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("begin", "system"): "told",
            ("begin", "user"): "asked",
            ("told", "user"): "asked",
            ("asked", "assistant"): "answered",
            ("answered", "user"): "asked",
        }
    )
    final: tuple[str, ...] = ("answered",)

    def __post_init__(self):
        marks = self.controls
        heads = {m[0] for m in marks}
        if any(len(m) < 2 or ESCAPE in m or heads & set(m[1:]) for m in marks):
            raise ValueError("control strings need two characters, no backslash, and first characters of their own")

    @property
    def controls(self) -> tuple[str, ...]:
        return self.start, self.middle, self.end.rstrip("\n")


def _quoted(text: str) -> str:
    return "".join(c if c.isalnum() or c == "\n" else "\\" + c for c in text)


def escape(text: Column, template: ChatTemplate) -> Column:
    """Doubles backslashes and puts one after the first character of every control string."""
    anywhere = "|".join(_quoted(m[1:]) for m in template.controls)
    heads = "|".join(sorted({_quoted(m[0]) for m in template.controls}))
    return F.regexp_replace(F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2)), f"({heads})(?=(?:{anywhere}))", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _next_state(state: Column, role: Column, template: ChatTemplate) -> Column:
    moved = F.lit(None).cast("string")
    for (before, by), after in template.moves.items():
        moved = F.when((state == before) & (role == by), F.lit(after)).otherwise(moved)
    return moved


def check_turns(roles: Column, template: ChatTemplate) -> Column:
    """Runs the state machine over an array of roles: struct(state, faults, first_fault)."""
    begin = F.struct(F.lit(template.initial).alias("state"), F.lit(0).cast("long").alias("faults"), F.lit(None).cast("long").alias("first_fault"), F.lit(0).cast("long").alias("at"))

    def step(seen: Column, role: Column) -> Column:
        after = _next_state(seen["state"], role, template)
        wrong = after.isNull()
        return F.struct(
            F.coalesce(after, seen["state"]).alias("state"),
            (seen["faults"] + wrong.cast("long")).alias("faults"),
            F.coalesce(seen["first_fault"], F.when(wrong, seen["at"])).alias("first_fault"),
            (seen["at"] + 1).alias("at"),
        )

    return F.aggregate(roles, begin, step)


def format_chats(turns: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """One row per conversation: conv_id, n_turns, segments (text, loss), formatted, valid, faults, first_fault.

    Turns are taken in the order of (turn, role, text). Null texts and roles
    count as empty; a null turn comes first; turns with a null conversation
    form one conversation; repeated rows are turns of their own. ``valid`` says
    whether the machine took every role and ended in a final state; faulty
    conversations are formatted all the same. No rows give no rows; other
    columns are left out.
    """
    template = template or ChatTemplate()
    turns = turns.select(
        "conv_id",
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            F.coalesce(F.col("role"), F.lit("")).alias("role"),
            F.coalesce(F.col("text"), F.lit("")).alias("text"),
        ).alias("said"),
    )
    chats = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("said"))

    def segments(said: Column) -> Column:
        piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        no = F.lit(False)
        return F.array(
            piece(F.concat(F.lit(template.start), escape(said["role"], template), F.lit(template.middle)), no),
            piece(escape(said["text"], template), said["role"].isin(*template.trained)),
            piece(F.lit(template.end), no),
        )

    checked = check_turns(F.col("said.role"), template)
    chats = chats.select("conv_id", F.size("said").cast("long").alias("n_turns"), F.flatten(F.transform("said", segments)).alias("segments"), checked.alias("machine"))
    return chats.select(
        "conv_id",
        "n_turns",
        "segments",
        F.array_join("segments.text", "").alias("formatted"),
        ((F.col("machine.faults") == 0) & F.col("machine.state").isin(*template.final)).alias("valid"),
        F.col("machine.faults").alias("faults"),
        F.col("machine.first_fault").alias("first_fault"),
    )


def read_chats(chats: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """Adds ``turns`` (role, text), read from ``formatted`` alone, and ``loss_text``, read from the loss mask."""
    template = template or ChatTemplate()
    parts = F.split("formatted", _quoted(template.start), -1)
    parts = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))

    def turn(part: Column) -> Column:
        role = F.substring_index(part, template.middle, 1)
        body = F.substr(part, F.length(role) + F.lit(len(template.middle) + 1))
        body = F.substr(body, F.lit(1), F.length(body) - F.lit(len(template.end)))
        return F.struct(unescape(role).alias("role"), unescape(body).alias("text"))

    lost = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))
    return chats.withColumn("turns", F.transform(parts, turn)).withColumn("loss_text", F.array_join(lost, ""))


def chat_digests(chats: DataFrame) -> DataFrame:
    """Digest columns of what :func:`read_chats` gives."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )

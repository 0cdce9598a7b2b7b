"""Chat formatting: turns by a declarative template, with a loss flag for every segment.

A finite-state machine over the roles walks through a conversation. Each step looks up the
role's marks in the template and emits segments, pieces of the formatted text with their
loss flags; a role that the state does not allow is noted as the first break and formatted
all the same, so no turn is lost. Control strings inside texts and roles are broken up by
an escape sign after their first character, and escape signs are doubled, so that reading
the output back gives exactly what went in.

Cases: NULL texts and roles are empty; unknown roles get the template's general marks.
Turns are ordered by turn, role and text, NULL first; repeated rows are turns each. A row
without conv_id belongs to no other and is a conversation of its own. An empty table gives no
rows; further columns do not matter.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowspark.llm.common import ship

START = "start"


@dataclass(frozen=True)
class Template:
    """Marks around roles and texts, control strings, loss and the allowed turn orders."""

    turn: str = "<|turn|>"
    text: str = "<|text|>"
    end: str = "<|end|>"
    escape: str = "\\"
    controls: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>")
    loss_roles: frozenset[str] = frozenset({"assistant"})
    #: state -> role -> next state; a state is the role before.
    order: dict[str, dict[str, str]] = field(
        default_factory=lambda: {
            START: {"system": "system", "user": "user"},
            "system": {"user": "user"},
            "user": {"assistant": "assistant"},
            "assistant": {"user": "user", "tool": "tool"},
            "tool": {"assistant": "assistant"},
        }
    )
    final: frozenset[str] = frozenset({"assistant"})

    def controls_of(self) -> re.Pattern:
        every = {*self.controls, self.turn, self.text, self.end}
        longest_first = sorted(every, key=lambda c: (-len(c), c))
        return re.compile("|".join(map(re.escape, [self.escape, *longest_first])))


@dataclass
class Formatted:
    segments: list[tuple[str, bool]]
    broken_at: int | None
    complete: bool


class Formatter:
    def __init__(self, template: Template) -> None:
        self.template = template
        self._controls = template.controls_of()
        marks = (template.turn, template.text, template.end)
        self._turn = re.compile("(.*?)".join(map(re.escape, marks)), re.DOTALL)
        self._escaped = re.compile(re.escape(template.escape) + "(.)", re.DOTALL)

    def escape(self, text: str) -> str:
        """``text`` without any control string; ``unescape`` gives it back."""
        sign = self.template.escape

        def broken(match: re.Match) -> str:
            found = match[0]
            return sign + sign if found == sign else found[0] + sign + self.escape(found[1:])

        return self._controls.sub(broken, text)

    def unescape(self, text: str) -> str:
        return self._escaped.sub(r"\1", text)

    def format(self, turns: Sequence[tuple[str, str]]) -> Formatted:
        """The segments of a conversation and where its order breaks, if it does."""
        template, state = self.template, START
        segments: list[tuple[str, bool]] = []
        broken_at = None
        for i, (role, text) in enumerate(turns):
            after = template.order.get(state, {}).get(role)
            if after is None:
                broken_at = i if broken_at is None else broken_at
                after = role
            segments.append((f"{template.turn}{self.escape(role)}{template.text}", False))
            segments.append((self.escape(text), role in template.loss_roles))
            segments.append((template.end, False))
            state = after
        return Formatted(segments, broken_at, state in template.final)

    def read_back(self, formatted: str) -> list[tuple[str, str]]:
        """The (role, text) turns of a formatted conversation."""
        turns, place = [], 0
        while place < len(formatted):
            match = self._turn.match(formatted, place)
            if match is None:
                raise ValueError(f"no turn at {place}")
            turns.append((self.unescape(match[1]), self.unescape(match[2])))
            place = match.end()
        return turns


def conversations_of(rows: DataFrame) -> DataFrame:
    """conv_id and its ordered turns; a conversation is one value, as its output is."""
    turn = F.struct(
        rows["turn"].alias("turn"),
        F.coalesce(rows["role"], F.lit("")).alias("role"),
        F.coalesce(rows["text"], F.lit("")).alias("text"),
    )
    # However many rows have no id, no task gets them all.
    alone = F.when(rows["conv_id"].isNull(), F.monotonically_increasing_id())
    placed = rows.select(rows["conv_id"], alone.alias("_alone"), turn.alias("_turn"))
    grouped = placed.groupBy("conv_id", "_alone").agg(
        F.sort_array(F.collect_list("_turn")).alias("turns")
    )
    return grouped.drop("_alone")


SEGMENTS = pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))


def format_turns(turns: Column, template: Template) -> Column:
    """Struct of segments, broken_at (turn from 0, NULL if in order) and complete."""

    @F.arrow_udf("struct<segments:array<struct<text:string,loss:boolean>>,broken_at:int,complete:boolean>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        formatter = Formatter(template)
        for batch in batches:
            made = [
                formatter.format([(t["role"], t["text"]) for t in turns])
                for turns in batch.to_pylist()
            ]
            yield pa.StructArray.from_arrays(
                [
                    pa.array(
                        [[{"text": t, "loss": flag} for t, flag in m.segments] for m in made],
                        SEGMENTS,
                    ),
                    pa.array([m.broken_at for m in made], pa.int32()),
                    pa.array([m.complete for m in made], pa.bool_()),
                ],
                ["segments", "broken_at", "complete"],
            )

    return run(turns)


def format_conversations(rows: DataFrame, template: Template | None = None) -> DataFrame:
    """conv_id, segments, broken_at and complete of every conversation."""
    ship(rows.sparkSession)
    made = format_turns(F.col("turns"), template or Template())
    return conversations_of(rows).select("conv_id", made.alias("made")).select("conv_id", "made.*")


def digests(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """What the formatted conversations say, read back from their segments."""
    template = template or Template()
    fields = [
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]

    @F.arrow_udf(
        "struct<n_turns:long,turns_sha256:string,loss_chars:long,loss_sha256:string,formatted_chars:long>"
    )
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        formatter = Formatter(template)
        for batch in batches:
            out = []
            for segments in batch.to_pylist():
                whole = "".join(s["text"] for s in segments)
                turns = formatter.read_back(whole)
                loss = "".join(formatter.unescape(s["text"]) for s in segments if s["loss"])
                body = "".join(f"{role}\n{text}\n" for role, text in turns)
                out.append(
                    {
                        "n_turns": len(turns),
                        "turns_sha256": hashlib.sha256(body.encode()).hexdigest(),
                        "loss_chars": len(loss),
                        "loss_sha256": hashlib.sha256(loss.encode()).hexdigest(),
                        "formatted_chars": len(whole),
                    }
                )
            yield pa.array(out, pa.struct(fields))

    return formatted.select(
        "conv_id",
        read("segments").alias("d"),
        F.col("broken_at").isNull().alias("in_order"),
        "complete",
    ).select("conv_id", "d.*", "in_order", "complete")

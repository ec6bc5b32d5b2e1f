"""Chat formatting: a finite-state machine over roles, and a declarative template.

The machine reads the turns of a conversation in order, says for each turn whether its role may come there,
and emits the text segments of the template with a loss flag each. Control strings of the template that occur
in a text are broken up by an escape mark, so the formatted text can be read back exactly.

Cases: a null text is empty; a null role is written as an empty role; unknown roles use the template's frame for
other roles; turns that come out of order are formatted like any other and flagged ``valid = false``; repeated rows
are turns of their own; ties of turn are ordered by role and text; a null conv_id is one conversation; an empty
table gives no rows; extra columns are ignored. A conversation of any length is streamed, never held.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import frame_of, map_frames, staged, table

ESCAPE = "\\"


@dataclass(frozen=True)
class Template:
    """What stands before and after the text of each role, which roles may follow which, and whose text carries loss.

    Each frame begins with a control string of its own, so a reader knows the role from it."""

    frames: dict = field(default_factory=lambda: {"system": ("<<SYS>>\n", "\n<</SYS>>\n\n"), "user": ("<s>[INST] ", " [/INST]"), "assistant": ("[ANS] ", " </s>\n")})
    other: tuple = ("[ROLE] ", " [TEXT] ", " [/ROLE]\n")
    control: tuple = ("<<SYS>>", "<</SYS>>", "<s>", "</s>", "[INST]", "[/INST]", "[ANS]", "[ROLE]", "[TEXT]", "[/ROLE]")
    follows: dict = field(default_factory=lambda: {"": {"system", "user"}, "system": {"user"}, "user": {"assistant"}, "assistant": {"user"}})
    loss: frozenset = frozenset({"assistant"})

    def __post_init__(self):
        for a in self.control:
            if ESCAPE in a or len(a) < 2:
                raise ValueError(f"{a!r} can't be a control string")
            for b in self.control:
                if any(a.endswith(b[:k]) for k in range(1, len(b))):
                    raise ValueError(f"{a!r} and {b!r} overlap: an escaped text could still hold one")

    def escape(self, text: str) -> str:
        """Marks are doubled, and a mark after the first character breaks each control string."""
        text = text.replace(ESCAPE, ESCAPE * 2)
        return self._control.sub(lambda m: m[0][0] + ESCAPE + m[0][1:], text)

    def unescape(self, text: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", text)

    @property
    def _control(self):
        return re.compile("|".join(sorted(map(re.escape, self.control), key=len, reverse=True)))

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """(text, loss flag) pieces of one turn; joined they are the formatted turn."""
        if role in self.frames:
            before, after = self.frames[role]
            return [(before, False), (self.escape(text), role in self.loss), (after, False)]
        a, b, c = self.other
        return [(a + self.escape(role) + b, False), (self.escape(text), role in self.loss), (c, False)]

    def parse(self, turn: str) -> tuple[str, str]:
        """(role, text) of a formatted turn."""
        for role, (before, after) in self.frames.items():
            if turn.startswith(before):
                return role, self.unescape(turn[len(before) : len(turn) - len(after)])
        a, b, c = self.other
        role, _, text = turn[len(a) : len(turn) - len(c)].partition(b)
        return self.unescape(role), self.unescape(text)


def in_order(rows: DataFrame) -> DataFrame:
    """Whole conversations in one task each, turns in order; sorting spills to disk."""
    return rows.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _ids(column: pd.Series) -> list:
    return [None if c is pd.NA or c is None or c != c else c for c in column.tolist()]


def format_conversations(rows: DataFrame, template: Template | None = None) -> DataFrame:
    """(conv_id, seq, valid, segments): one row per turn, its text pieces with their loss flags, in order of the turns."""
    t = template or Template()
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches):
        conv, seq, state = None, -1, ""
        for pdf in batches:
            out = []
            for c, role, text in zip(_ids(pdf["conv_id"]), pdf["role"], pdf["text"], strict=True):
                if seq < 0 or c != conv:
                    conv, seq, state = c, -1, ""
                seq += 1
                role = role or ""
                valid = role in t.follows.get(state, ())
                state = role
                out.append((c, seq, valid, [{"text": s, "loss": f} for s, f in t.segments(role, text or "")]))
            yield frame_of(out, ["conv_id", "seq", "valid", "segments"])

    return map_frames(in_order(rows), run, f"conv_id {kind}, seq long, valid boolean, segments array<struct<text: string, loss: boolean>>")


def read_back(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """Digests of each conversation, from a table of formatted turns: roles and texts are parsed from the formatted text."""
    t = template or Template()
    kind = formatted.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]

    def run(batches):
        held = None
        closed = lambda h: (h[0], h[1], h[2].hexdigest(), h[3], h[4].hexdigest(), h[5], h[6])
        for pdf in batches:
            out = []
            for c, seq, valid, segments in zip(_ids(pdf["conv_id"]), pdf["seq"], pdf["valid"], pdf["segments"], strict=True):
                if seq == 0:
                    if held:
                        out.append(closed(held))
                    held = [c, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, True]
                turn = "".join(s["text"] for s in segments)
                role, text = t.parse(turn)
                held[1] += 1
                held[2].update(f"{role}\n{text}\n".encode())
                for s in segments:
                    if s["loss"]:
                        plain = t.unescape(s["text"])
                        held[3] += len(plain)
                        held[4].update(plain.encode())
                held[5] += len(turn)
                held[6] &= bool(valid)
            if out:
                yield frame_of(out, names)
        if held:
            yield frame_of([closed(held)], names)

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "seq")
    return map_frames(ordered, run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean")


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One shuffle of the turns and formatting behind it into a table; that table is read, put in order and parsed."""
    probe = spark.createDataFrame([(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return read_back(staged(format_conversations(rows.unionByName(probe)), "formatted"))


SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
turns AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
    length(text) + len(regexp_extract_all(text, '\\')) + len(regexp_extract_all(text, '<<SYS>>|<</SYS>>|<s>|</s>|\[INST\]|\[/INST\]|\[ANS\]|\[ROLE\]|\[TEXT\]|\[/ROLE\]'))
      + CASE role WHEN 'system' THEN 19 WHEN 'user' THEN 18 WHEN 'assistant' THEN 12
        ELSE 24 + length(role) + len(regexp_extract_all(role, '\\')) + len(regexp_extract_all(role, '<<SYS>>|<</SYS>>|<s>|</s>|\[INST\]|\[/INST\]|\[ANS\]|\[ROLE\]|\[TEXT\]|\[/ROLE\]')) END AS chars
  FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars,
  bool_and(CASE WHEN before IS NULL THEN role IN ('system', 'user') WHEN before IN ('system', 'assistant') THEN role = 'user' WHEN before = 'user' THEN role = 'assistant' ELSE false END) AS valid
FROM turns GROUP BY conv_id
"""

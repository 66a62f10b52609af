"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) turns to a string. The
prefixes of a conversation are rendered one after the other; where a rendering
begins with the one before, the rest is the new turn's span. Where it does not,
the template rewrites history, and the turn is marked. Inside a span the text is
found by rendering the turn once more with a marker for its text.

Conversations are streamed. Every prefix is rendered from the first turn, so a
task holds one conversation. For a template declared to look no further back than
``window`` turns, a turn is rendered after those before it only, and that many are held.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

START, END, BREAK = "<|im_start|>", "<|im_end|>", "<|nl|>"
# Stands for a turn's text in a probe; plain letters, so no template escapes it.
MARKER = "QzProbeTextzQ"

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    r"""One more backslash inside each ``<|``, ``<\|``, ...: no control string is left."""
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def chatml(turns: list[Turn]) -> str:
    """Marked turns; control strings inside roles and texts are escaped."""
    return "".join(
        f"{START}{escape(role).replace(chr(10), BREAK)}\n{escape(text)}{END}\n" for role, text in turns
    )


def read_turn(span: str) -> Turn:
    """The turn a span of ``chatml`` was made from."""
    if not (span.startswith(START) and span.endswith(f"{END}\n")):
        raise ValueError(f"not one turn: {span[:80]!r}")
    role, _, text = span[len(START) : -len(END) - 1].partition("\n")
    return unescape(role.replace(BREAK, "\n")), unescape(text)


def _common(a: str, b: str) -> int:
    """Length of the common beginning."""
    if b.startswith(a):
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle - 1)
    return low


def render_turns(turns: Iterable[Turn], template: Template, window: int | None = None) -> Iterator[dict]:
    """One record per turn: span, start, text_start, text_end (offsets in the formatted text), rewrites.

    Of a turn that rewrites history the span is what follows the part left alone,
    and offsets count in the new rendering.
    """
    held: list[Turn] = []
    before, skipped = "", 0  # what the template puts in front belongs to the first turn
    for role, text in turns:
        if window is not None and len(held) > window:
            held = held[-window:]
            shorter = template(held)
            skipped += len(before) - len(shorter)
            before = shorter
        after = template([*held, (role, text)])
        same = _common(before, after)
        record = {"span": after[same:], "start": skipped + same, "text_start": None, "text_end": None, "rewrites": same < len(before)}
        head, found, tail = template([*held, (role, MARKER)]).partition(MARKER)
        if found and after.startswith(head) and after.endswith(tail) and same <= len(head) <= len(after) - len(tail):
            record["text_start"] = skipped + len(head)
            record["text_end"] = skipped + len(after) - len(tail)
        yield record
        held.append((role, text))
        before = after


SPANS = (
    "turn_index long, role string, span string, start long, text_start long, text_end long, in_loss boolean, rewrites boolean"
)


def format_chats(
    chats: DataFrame,
    template: Template = chatml,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    loss_roles: tuple[str, ...] = ("assistant",),
    window: int | None = None,
) -> DataFrame:
    """One row per turn, those of a conversation together and in order: ``id_col`` and ``SPANS``.

    The spans of a conversation, one after the other, are its formatted text, if no turn rewrites.
    [text_start, text_end) is the turn's text in it, null if the template does
    not show the text in one piece; it is under the loss mask if in_loss. A null
    role or text counts as empty; a null turn number comes first; equal turn
    numbers are ordered by role and text, repeated rows count each; rows with a
    null conversation are one conversation. An empty table gives no rows. Other
    columns are not read.
    """
    kind = chats.schema[id_col].dataType.simpleString()
    rows = chats.select(
        F.col(id_col).alias("id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    rows = rows.repartition("id").sortWithinPartitions("id", "turn", "role", "text").select("id", "role", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, feed, index = None, None, 0
        for batch in batches:
            out = []
            for key, role, text in batch.itertuples(index=False):
                key = None if pd.isna(key) else key
                if feed is None or key != current:
                    current, feed, index = key, _Feed(template, window), 0
                made = feed.send((role, text))
                inside = role in loss_roles and made["text_start"] is not None
                out.append((key, index, role, *list(made.values())[:4], inside, made["rewrites"]))
                index += 1
            frame = pd.DataFrame(out, columns=["id", *(c.split()[0] for c in SPANS.split(", "))], dtype=object)
            yield frame

    return rows.mapInPandas(run, f"id {kind}, {SPANS}").withColumnRenamed("id", id_col)


class _Feed:
    """Pushes turns into ``render_turns`` one at a time."""

    def __init__(self, template: Template, window: int | None):
        self._next: list[Turn] = []
        self._records = render_turns(iter(self._next.pop, None), template, window)

    def send(self, turn: Turn) -> dict:
        self._next.append(turn)
        return next(self._records)


def digest_chats(spans: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """One row per conversation, read back from the spans of ``chatml`` as they stream by."""
    kind = spans.schema[id_col].dataType.simpleString()
    columns = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    rows = spans.select(F.col(id_col).alias("id"), "turn_index", "span", "start", "text_start", "text_end", "in_loss")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["id", *(c.split()[0] for c in columns.split(", "))]
        key, state = None, None

        def row():
            turns, loss = state["turns"].hexdigest(), state["loss"].hexdigest()
            return key, state["n"], turns, state["loss_chars"], loss, state["chars"]

        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                if r.turn_index == 0:
                    if state is not None:
                        out.append(row())
                    key = None if pd.isna(r.id) else r.id
                    state = {"n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0}
                role, text = read_turn(r.span)
                state["n"] += 1
                state["turns"].update(f"{role}\n{text}\n".encode())
                state["chars"] += len(r.span)
                if r.in_loss:
                    own = unescape(r.span[int(r.text_start - r.start) : int(r.text_end - r.start)])
                    state["loss"].update(own.encode())
                    state["loss_chars"] += len(own)
            if out:
                yield pd.DataFrame(out, columns=names)
        if state is not None:
            yield pd.DataFrame([row()], columns=names)

    return rows.mapInPandas(run, f"id {kind}, {columns}").withColumnRenamed("id", id_col)

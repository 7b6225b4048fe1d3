"""Chat formatting in budgeted windows.

Every turn is rendered as ``<s>role[INST]text[/INST]</s>``; control strings in
roles and texts are escaped reversibly.  Prefix sums of turn tokens cut a
conversation into turn-aligned windows: each repeats the system turn and a
limited history of the turns before it, and only the assistant texts that are
new in a window are under its loss mask.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate, groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# the template's control strings (fixed values)
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
_control = re.compile(r"([<\[])(\\*)(/?s>|/?INST\])")
_escaped = re.compile(r"([<\[])\\(\\*)(/?s>|/?INST\])")
_turn = re.compile(r"<s>(.*?)\[INST\](.*?)\[/INST\]</s>", re.DOTALL)

WINDOWS = (
    "conv_id long, window long, text string, loss_spans array<struct<start:long,end:long>>, "
    "n_repeated long, n_new long, tokens long"
)
DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, n_windows long"
)


def escape(text: str) -> str:
    """Put one more backslash behind the first character of each control string."""
    return _control.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _escaped.sub(r"\1\2\3", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and where its (escaped) text starts and ends."""
    head = f"<s>{escape(role)}[INST]"
    body = escape(text)
    return f"{head}{body}[/INST]</s>", len(head), len(head) + len(body)


def turn_tokens(role: str, text: str) -> int:
    """Token estimate of a rendered turn: four UTF-8 bytes a token, four control strings."""
    return 4 + (len(role.encode()) + len(text.encode()) + 3) // 4


def windows_of(
    turns: Iterator[tuple[str, str]], budget: int, history_turns: int, history_tokens: int
) -> Iterator[tuple[list[tuple[str, str]], int, int]]:
    """(turns, number repeated, tokens) of each window of a conversation, as a stream.

    ``held`` has the turns from the oldest that history may need to the newest
    read, and ``sums`` the prefix sums of their tokens, which tell how far back
    the history and how far on the window reaches.  No more than a window, its
    history and one turn are held at a time.
    """
    source = iter(turns)
    held: list[tuple[str, str]] = []
    system: list[tuple[str, str]] = []
    first = next(source, None)
    if first is None:
        return
    if first[0] == "system":
        system = [first]
    else:
        held = [first]
    base = sum(turn_tokens(*t) for t in system)
    sums = list(accumulate((turn_tokens(*t) for t in held), initial=0))
    new, seen, ended = 0, False, False  # held[new:] is not yet in a window
    while True:
        while not ended and (new == len(held) or base + sums[-1] - sums[new] <= budget):
            turn = next(source, None)
            if turn is None:
                ended = True
            else:
                held.append(turn)
                sums.append(sums[-1] + turn_tokens(*turn))
        if new == len(held):
            if system and not seen:
                yield system, 0, base
            return
        room = min(history_tokens, budget - base - (sums[new + 1] - sums[new]))
        oldest = max(new - history_turns, 0, bisect_left(sums, sums[new] - max(room, 0), 0, new + 1))
        last = max(new + 1, bisect_right(sums, sums[oldest] + budget - base) - 1)
        repeated = new - oldest + (len(system) if seen else 0)
        yield [*system, *held[oldest:last]], repeated, base + sums[last] - sums[oldest]
        seen = True
        drop = max(0, last - history_turns)
        held, new = held[drop:], last - drop
        sums = list(accumulate((turn_tokens(*t) for t in held), initial=0))


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    """Record batches of at most ``size`` rows."""
    part: list[tuple] = []
    for row in rows:
        part.append(row)
        if len(part) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)
            part = []
    if part:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for i in range(0, batch.num_rows, 1024):
            part = batch.slice(i, 1024)
            yield from zip(*(column.to_pylist() for column in part.columns), strict=True)


_span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_windows = pa.schema(
    [("conv_id", pa.int64()), ("window", pa.int64()), ("text", pa.string()), ("loss_spans", _span)]
    + [(name, pa.int64()) for name in ("n_repeated", "n_new", "tokens")]
)
_digests = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64())]
    + [("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_windows", pa.int64())]
)


def format_conversations(
    conversations: DataFrame,
    *,
    budget: int = 2048,
    history_turns: int = 2,
    history_tokens: int = 512,
    target_role: str = "assistant",
) -> DataFrame:
    """Windows of formatted text with the spans (code points) under the loss mask.

    Takes ``conv_id, turn, role, text``; one row per window: ``conv_id, window,
    text, loss_spans, n_repeated, n_new, tokens``.  A leading system turn opens
    every window.  A turn is never cut: one over the budget has a window of its
    own (with the system turn).  Each target text is under the mask of the one
    window where it is new.

    A conversation's rows meet in one task, sorted, and stream through it; the
    task holds one window at a time, so a conversation may be of any length.
    Rows are ordered by turn, then role and text, so ties and repeated rows
    have one order; repeated rows are turns of their own.  Null turns come
    first, a null role or text is empty, rows with null conv_id are one
    conversation.  Other columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def windows() -> Iterator[tuple]:
            for conv, rows in groupby(_rows(batches), key=lambda row: row[0]):
                turns = ((role, text) for _, role, text in rows)
                for number, (shown, repeated, tokens) in enumerate(
                    windows_of(turns, budget, history_turns, history_tokens)
                ):
                    parts, spans, at = [], [], 0
                    for i, (role, text) in enumerate(shown):
                        part, start, end = render(role, text)
                        if i >= repeated and role == target_role:
                            spans.append({"start": at + start, "end": at + end})
                        parts.append(part)
                        at += len(part)
                    yield conv, number, "".join(parts), spans, repeated, len(shown) - repeated, tokens

        yield from _batches(windows(), _windows, 256)

    c = conversations
    rows = c.select(
        c["conv_id"].cast("long").alias("conv_id"),
        c["turn"].cast("long").alias("turn"),
        F.coalesce(c["role"].cast("string"), F.lit("")).alias("role"),
        F.coalesce(c["text"].cast("string"), F.lit("")).alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, WINDOWS)


def parse_window(text: str) -> list[tuple[str, str]]:
    """Roles and texts read back from a formatted window."""
    return [(unescape(role), unescape(body)) for role, body in _turn.findall(text)]


def window_digests(windows: DataFrame) -> DataFrame:
    """Per conversation, what the windows say when read back.

    Takes the rows of ``format_conversations`` as they come: a conversation's
    windows follow each other in one partition.  Hashes are fed window by
    window.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def digests() -> Iterator[tuple]:
            for conv, rows in groupby(_rows(batches), key=lambda row: row[0]):
                said, loss = hashlib.sha256(), hashlib.sha256()
                turns = loss_chars = chars = count = 0
                for _, _, text, spans, repeated, _, _ in rows:
                    for role, body in parse_window(text)[repeated:]:
                        said.update(f"{role}\n{body}\n".encode())
                        turns += 1
                    for span in spans:
                        target = unescape(text[span["start"] : span["end"]])
                        loss.update(target.encode())
                        loss_chars += len(target)
                    chars += len(text)
                    count += 1
                yield conv, turns, said.hexdigest(), loss_chars, loss.hexdigest(), chars, count

        yield from _batches(digests(), _digests, 4096)

    return windows.mapInArrow(run, DIGESTS)

"""Chat formatting by event-sourced reconstruction.

A conversation log is a table of events. Logs are partitioned by conversation,
sorted by sequence and folded as a stream into final messages, which are rendered with
a template whose control strings cannot occur in an escaped text:

``append``      a whole message at a turn, behind any that stand there already
``message``     a whole message at a turn (a later one replaces it and its deltas)
``delta``       more text for a turn's message, appended in order
``edit``        the turn's text is replaced
``regenerate``  the turn's text is dropped and all later turns with it; deltas or a message follow

Template: ``<s>`` opens a conversation and ``</s>`` closes it; a message is
``[ROLE]`` role ``[TEXT]`` text ``[/TEXT]``. In roles and texts every ``~`` becomes ``~~`` and
every ``<`` or ``[`` is preceded by ``~``, so no control string is left (each has one of
these two characters first) and the inverse is unique.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<s>", "</s>"
ROLE, TEXT, END = "[ROLE]", "[TEXT]", "[/TEXT]"
_ESCAPE = re.compile(r"[~<\[]")
_UNESCAPE = re.compile(r"~(.)", re.S)
_MESSAGE = re.compile(r"\[ROLE\]((?:[^~<\[]|~.)*+)\[TEXT\]((?:[^~<\[]|~.)*+)\[/TEXT\]", re.S)


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "~" + m[0], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: m[1], text)


def render(messages: list[tuple[str, str]], learned: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """(formatted conversation, spans of the loss mask: the texts of the role ``learned``)."""
    out, spans, at = [OPEN], [], len(OPEN)
    for role, text in messages:
        head, body = ROLE + escape(role) + TEXT, escape(text)
        if role == learned:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END]
        at += len(head) + len(body) + len(END)
    out.append(CLOSE)
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The messages of a formatted conversation."""
    if not (formatted.startswith(OPEN) and formatted.endswith(CLOSE)):
        raise ValueError("not a formatted conversation")
    at, end, out = len(OPEN), len(formatted) - len(CLOSE), []
    while at < end:
        m = _MESSAGE.match(formatted, at, end)
        if not m:
            raise ValueError(f"malformed message at {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


class Fold:
    """The messages of one conversation while its events come in order."""

    def __init__(self):
        # (turn, number at that turn): [role, [pieces of text]]; the other events work on number 0
        self.turns: dict[tuple[int, int], list] = {}
        self.numbers: dict[int, int] = {}

    def add(self, kind: str, turn: int, role: str, text: str) -> None:
        if kind == "append":
            number = self.numbers.get(turn, 0)
            self.turns[turn, number] = [role, [text]]
            self.numbers[turn] = number + 1
            return
        own = self.turns.get((turn, 0))
        if kind == "message" or own is None:
            if kind == "regenerate":
                text = ""
                self._drop_after(turn)
            self.turns[turn, 0] = [role, [text]]
            self.numbers[turn] = max(1, self.numbers.get(turn, 0))
        elif kind == "delta":
            own[1].append(text)
        elif kind == "edit":
            own[1] = [text]
        elif kind == "regenerate":
            own[1] = []
            self._drop_after(turn)
        else:
            raise ValueError(f"unknown event {kind!r}")

    def _drop_after(self, turn: int) -> None:
        for t in [t for t in self.turns if t[0] > turn]:
            del self.turns[t]
            self.numbers.pop(t[0], None)

    def messages(self) -> list[tuple[str, str]]:
        return [(role, "".join(text)) for _, (role, text) in sorted(self.turns.items())]


def format_log(events: DataFrame, learned: str = "assistant") -> DataFrame:
    """Per conversation: conv_id, formatted, n_turns, loss_spans ([start, end) in characters).

    ``events``: conv_id, seq, event, turn, role, text; more columns are ignored. Events apply in the order of
    seq; ties in that of turn, event, role and text, so the result does not depend on
    partitions. A null text or role is empty, a null turn is turn -1, a null event a message, a null
    conv_id a conversation of its own. A repeated message row changes nothing; a repeated delta is
    a second delta. An empty log gives no row. A conversation's events pass through as a stream; only
    its final messages, which its row has to hold anyway, are in memory.
    """
    src = events.select(
        "conv_id", "seq", F.coalesce("turn", F.lit(-1)).cast("long").alias("turn"),
        F.coalesce("event", F.lit("message")).alias("event"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    n = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = src.repartition(n, "conv_id").sortWithinPartitions("conv_id", "seq", "turn", "event", "role", "text")
    kind = src.schema["conv_id"].dataType.simpleString()
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, fold, rows, held, key_type = None, None, [], 0, None

        def flush():
            ids, texts, turns, spans = zip(*rows)
            return pa.RecordBatch.from_arrays([
                pa.array(ids, key_type), pa.array(texts, pa.string()), pa.array(turns, pa.int64()),
                pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], pa.list_(span))],
                ["conv_id", "formatted", "n_turns", "loss_spans"])

        def close():
            messages = fold.messages()
            formatted, spans = render(messages, learned)
            rows.append((current, formatted, len(messages), spans))
            return len(formatted)

        for batch in batches:
            key_type = batch.schema.field(0).type
            for conv, _, turn, event, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if fold is None or conv != current:
                    if fold is not None:
                        held += close()
                        if held > 1 << 23:
                            yield flush()
                            rows, held = [], 0
                    current, fold = conv, Fold()
                fold.add(event, turn, role, text)
        if fold is not None:
            close()
            yield flush()

    return ordered.mapInArrow(
        run, f"conv_id {kind}, formatted string, n_turns bigint, loss_spans array<struct<start:int,end:int>>")


def read_back(rows: DataFrame, learned: str = "assistant") -> DataFrame:
    """conv_id, turns (array of role, text), loss (texts under the mask, unescaped) and formatted_chars of formatted rows."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts, spans = b.column(0), b.column(1).to_pylist(), b.column(2).to_pylist()
            yield pa.RecordBatch.from_arrays([
                ids,
                pa.array([[{"role": r, "text": t} for r, t in parse(x)] for x in texts],
                         pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))),
                pa.array([[unescape(x[s["start"]:s["end"]]) for s in own] for x, own in zip(texts, spans)], pa.list_(pa.string())),
                pa.array([len(x) for x in texts], pa.int64())], ["conv_id", "turns", "loss", "formatted_chars"])

    return rows.select("conv_id", "formatted", "loss_spans").mapInArrow(
        run, f"conv_id {kind}, turns array<struct<role:string,text:string>>, loss array<string>, formatted_chars bigint")

"""Chat formatting with a grammar round trip.

    conversation = turn*          turn = opener text "</s>"          text: no control string
    opener = "[INST] " (user) | "[/INST] " (assistant) | "<<SYS>> " (system)
           | "<<ROLE" code-points-in-hex ">> " (any other role) | "<<NONE>> " (null)

A text is first rendered as it is. The rendered turn is parsed again and compared
with its source; if anything differs, control strings inside the text are
escaped (a backslash after their first character; strings that look escaped
already get one more) and the comparison is made again. Escaping is undone by
taking one backslash away, so it is reversible for every text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import ship, slices, utf8

# The control strings of the format.
OPENERS = {"user": "[INST] ", "assistant": "[/INST] ", "system": "<<SYS>> ", None: "<<NONE>> "}
END = "</s>"
_ROLES = {v: k for k, v in OPENERS.items()}
_OPENER = re.compile(r"\[/?INST\] |<<(?:SYS|NONE)>> |<<ROLE((?: [0-9a-f]+)*)>> ")
# A control string, with any number of backslashes after its first character.
_CONTROL = re.compile(r"([<\[])(\\*)(?=s>|/s>|/?INST\]|</?SYS>>|<NONE>>|<ROLE(?: [0-9a-f]+)*>>)")
_BARE = re.compile(r"[<\[](?:s>|/s>|/?INST\]|</?SYS>>|<NONE>>|<ROLE(?: [0-9a-f]+)*>>)")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(?=s>|/s>|/?INST\]|</?SYS>>|<NONE>>|<ROLE(?: [0-9a-f]+)*>>)")


def opener(role: str | None) -> str:
    return OPENERS[role] if role in OPENERS else "<<ROLE" + "".join(f" {ord(c):x}" for c in role) + ">> "


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


class Parser:
    """Reads a rendered conversation piece by piece; holds no more than the turn at hand."""

    def __init__(self):
        self.rest = ""

    def feed(self, piece: str) -> Iterator[tuple[str | None, str, str]]:
        """(role, raw text, unescaped text) of each turn that ends in what came so far."""
        self.rest += piece
        at = 0
        while (end := self.rest.find(END, at)) >= 0:
            head = _OPENER.match(self.rest, at)
            if not head:
                raise ValueError("a turn does not begin with an opener")
            role = (_ROLES[head[0]] if head[0] in _ROLES
                    else "".join(chr(int(c, 16)) for c in head[1].split()))
            raw = self.rest[head.end():end]
            if _BARE.search(raw):
                raise ValueError("a control string inside a text")
            yield role, raw, unescape(raw)
            at = end + len(END)
        self.rest = self.rest[at:]

    def close(self) -> None:
        if self.rest:
            raise ValueError("the last turn does not end")


def parse(rendered: str) -> list[tuple[str | None, str]]:
    p = Parser()
    turns = [(role, text) for role, _, text in p.feed(rendered)]
    p.close()
    return turns


def render(role: str | None, text: str) -> tuple[str, int, int]:
    """A rendered turn and the span of its text, escaped only if it must be."""
    start = opener(role)
    for body in (text, escape(text)):
        out = start + body + END
        try:
            if parse(out) == [(role, text)]:
                return out, len(start), len(start) + len(body)
        except ValueError:
            pass
    raise ValueError("a turn does not survive the round trip")


def format_turns(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """(conv, turn, role, source, rendered, loss_start, loss_end) of every row.

    A conversation is its rendered turns one after the other, in the order of
    turn, role and text (nulls first); its loss mask covers the span of each
    assistant text, given in characters of its rendered turn (null for others).
    A null text is empty; null conversations are one conversation; repeated rows
    are turns of their own; other columns are left aside.
    """
    def run(batches):
        for rows in slices(batches):
            out = [render(r, utf8(t)) for r, t in zip(rows["role"], rows["source"], strict=True)]
            loss = [o[1:] if r == "assistant" else (None, None) for r, o in zip(rows["role"], out, strict=True)]
            yield pa.RecordBatch.from_pydict(
                {"conv": pa.array(rows["conv"], pa.int64()), "turn": pa.array(rows["turn"], pa.int64()),
                 "role": pa.array(rows["role"], pa.string()), "source": pa.array(map(utf8, rows["source"]), pa.string()),
                 "rendered": pa.array([o[0] for o in out], pa.string()),
                 "loss_start": pa.array([x[0] for x in loss], pa.int64()),
                 "loss_end": pa.array([x[1] for x in loss], pa.int64())})

    ship(df.sparkSession)
    rows = df.select(F.col(conversation).cast("bigint").alias("conv"), F.col(turn).cast("bigint").alias("turn"),
                     F.col(role).cast("string").alias("role"), F.col(text).cast("string").cast("binary").alias("source"))
    return rows.mapInArrow(run, "conv bigint, turn bigint, role string, source string, rendered string, "
                                "loss_start bigint, loss_end bigint")


class _Digest:
    """What is read back from one conversation, turn by turn."""

    def __init__(self, conv):
        self.conv, self.parser, self.n, self.chars, self.loss_chars = conv, Parser(), 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, piece: str, start: int | None, end: int | None) -> None:
        self.chars += len(piece)
        for role, _, text in self.parser.feed(piece):
            self.n += 1
            self.turns.update(f"{role or ''}\n{text}\n".encode())
        if start is not None:
            masked = unescape(piece[start:end])
            self.loss_chars += len(masked)
            self.loss.update(masked.encode())

    def row(self) -> tuple:
        self.parser.close()
        return self.conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(turns: DataFrame) -> DataFrame:
    """(conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), parsed from the rendered turns.

    Conversations are streamed through sorted partitions: a task holds one turn
    and the running digests, however long the conversation is.
    """
    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def batch(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.string() if "sha" in n else pa.int64())
             for n, c in zip(names, zip(*rows, strict=True), strict=True)], names)

    def run(batches):
        now, done = None, []
        for rows in slices(batches):
            for conv, piece, a, b in zip(rows["conv"], rows["rendered"], rows["loss_start"], rows["loss_end"], strict=True):
                if now is None or now.conv != conv:
                    if now:
                        done.append(now.row())
                    now = _Digest(conv)
                now.add(piece, a, b)
            if len(done) >= 1000:
                yield batch(done)
                done = []
        if now:
            yield batch([*done, now.row()])

    ship(turns.sparkSession)
    return (turns.repartition("conv").sortWithinPartitions("conv", "turn", "role", "source")
                 .select("conv", "rendered", "loss_start", "loss_end")
                 .mapInArrow(run, "conv bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                                  "loss_sha256 string, formatted_chars bigint"))

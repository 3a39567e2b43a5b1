"""Chat formatting with a prefix tree.

Conversations are range-partitioned by their path (the digests of their turns)
and id.  That order is the depth-first order of the tree of turns, so a task
streams its rows and holds the current path only: a conversation keeps what it
shares with the one before and appends the rest.  Shared turns are emitted
once in a pack, as one segment of its text; every segment carries the position
of its first character on the path from the root and the intervals of the
pack's text that it attends to, its ancestors', where neighbours are one
interval.  A pack ends when it holds ``pack_chars`` characters or
``pack_members`` conversations; the next one emits the path again, as a pack
has to be read alone.  A long conversation is never cut, and any number of
equal ones spreads over packs and tasks.

A turn reads ``<|im_start|>role\\ntext<|im_end|>\\n``.  Inside roles and texts
every ``<|`` gets a backslash between its two characters, and every ``<\\|`` one
more, so no text holds a control string and taking one backslash out gives it back.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlens.llm.common import partitions
from ticketlens.llm.turns import DIGEST, in_order, path_of, turns_of

#: The control strings and the role whose texts are learnt.
START, END = "<|im_start|>", "<|im_end|>"
LEARNT = "assistant"
PACK_CHARS = 1 << 16
PACK_MEMBERS = 1 << 12
#: Characters of packs given to Spark at once.
_BATCH_CHARS = 1 << 22

_INTERVALS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_SEGMENT = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("position", pa.int64()), ("attends", _INTERVALS), ("loss", _INTERVALS)])
_MEMBER = pa.struct([("conv_id", pa.int64()), ("segment", pa.int64())])
_PACKS = pa.schema([("text", pa.string()), ("segments", pa.list_(_SEGMENT)), ("members", pa.list_(_MEMBER))])
_I = "array<struct<start:long,end:long>>"
_PACK_COLUMNS = f"text string, segments array<struct<start:long,end:long,position:long,attends:{_I},loss:{_I}>>, members array<struct<conv_id:long,segment:long>>"
_READ = pa.schema(
    [("conv_id", pa.int64()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("loss", pa.string()), ("formatted_chars", pa.int64())]
)
_READ_COLUMNS = "conv_id long, roles array<string>, texts array<string>, loss string, formatted_chars long"

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<(\\*)\\\|")


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role is one line: its line ends are escaped too."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and where its text starts and ends."""
    head, body = f"{START}{escape_role(role)}\n", escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) of every turn; ValueError if the text is no sequence of turns."""
    out, at = [], 0
    while at < len(formatted):
        line, stop = formatted.find("\n", at), formatted.find(f"{END}\n", at)
        if not formatted.startswith(START, at) or not at < line < stop:
            raise ValueError("not a sequence of formatted turns")
        out.append((unescape_role(formatted[at + len(START) : line]), unescape(formatted[line + 1 : stop])))
        at = stop + len(END) + 1
    return out


class _Packer:
    """One pack at a time; ``path`` is the current path as (digest, turn, segment number or None)."""

    def __init__(self, pack_chars: int, pack_members: int) -> None:
        self.pack_chars, self.pack_members = pack_chars, pack_members
        self._new()

    def _new(self) -> None:
        self.text, self.chars, self.segments, self.members = [], 0, [], []
        self.path: list[tuple[bytes, int]] = []

    def full(self) -> bool:
        return self.chars >= self.pack_chars or len(self.members) >= self.pack_members

    def take(self) -> dict:
        out = {"text": "".join(self.text), "segments": self.segments, "members": self.members}
        self._new()
        return out

    def add(self, conv_id: int | None, digests: list[bytes], roles: list[str], texts: list[str]) -> None:
        same = 0
        for (digest, _), d in zip(self.path, digests, strict=False):
            if digest != d:
                break
            same += 1
        del self.path[same:]
        for d, role, text in zip(digests[same:], roles[same:], texts[same:], strict=True):
            self._emit(d, role, text)
        self.members.append({"conv_id": conv_id, "segment": self.path[-1][1] if self.path else -1})

    def _emit(self, digest: bytes, role: str, text: str) -> None:
        piece, a, b = format_turn(role, text)
        at, attends, position = self.chars, [], 0
        if self.path:
            up = self.segments[self.path[-1][1]]
            attends, position = list(up["attends"]), up["position"] + up["end"] - up["start"]
            own = {"start": up["start"], "end": up["end"]}
            if attends and attends[-1]["end"] == own["start"]:
                own["start"] = attends.pop()["start"]
            attends.append(own)
        loss = [{"start": at + a, "end": at + b}] if role == LEARNT and b > a else []
        self.path.append((digest, len(self.segments)))
        self.segments.append({"start": at, "end": at + len(piece), "position": position, "attends": attends, "loss": loss})
        self.text.append(piece)
        self.chars += len(piece)


def _packer(pack_chars: int, pack_members: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, done, chars = _Packer(pack_chars, pack_members), [], 0
        for batch in batches:
            paths, ids, roles, texts = batch.columns
            for k in range(batch.num_rows):  # row by row: a batch of long conversations is not copied as a whole
                path = paths[k].as_py()
                packer.add(ids[k].as_py(), [path[i : i + DIGEST] for i in range(0, len(path), DIGEST)], roles[k].as_py(), texts[k].as_py())
                if packer.full():
                    chars += packer.chars
                    done.append(packer.take())
                    if chars >= _BATCH_CHARS:
                        yield pa.RecordBatch.from_pylist(done, schema=_PACKS)
                        done, chars = [], 0
        if packer.members:
            done.append(packer.take())
        yield pa.RecordBatch.from_pylist(done, schema=_PACKS)

    return run


def pack(conversations: DataFrame, pack_chars: int = PACK_CHARS, pack_members: int = PACK_MEMBERS) -> DataFrame:
    """One row per pack: ``text``, ``segments`` (start, end, position, attends, loss) and ``members``.

    Intervals are code points of the pack's text, ends exclusive; ``position`` is
    that of the segment's first character, the others follow; a character attends
    to the ``attends`` intervals and to its own segment up to itself; ``loss``
    holds the learnt part, an assistant turn's escaped text.  A member names the
    segment of its last turn.

    Turns are ordered by number, a null one first and equal ones by digest, so
    repeated rows are turns of their own; a null role or text is empty; rows
    without a conv_id are one conversation whose id is null.  Columns other than
    conv_id, turn, role and text are not read.  One conversation is one task's
    work.  An empty table gives no pack.
    """
    spark = conversations.sparkSession
    grouped = turns_of(conversations).groupBy("conv_id").agg(in_order("role", "text").alias("turns"))
    rows = grouped.select(
        path_of(F.col("turns")).alias("path"), "conv_id", F.transform("turns", lambda t: t["role"]).alias("roles"), F.transform("turns", lambda t: t["text"]).alias("texts")
    )
    dealt = rows.repartitionByRange(partitions(spark), "path", "conv_id").sortWithinPartitions("path", "conv_id")
    return dealt.mapInArrow(_packer(pack_chars, pack_members), _PACK_COLUMNS)


def _chain(text: str, segment: dict) -> str:
    return "".join([*(text[i["start"] : i["end"]] for i in segment["attends"]), text[segment["start"] : segment["end"]]])


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, segments, members = batch.columns
        for k in range(batch.num_rows):
            text, parts, of = texts[k].as_py(), segments[k].as_py(), members[k].as_py()
            yield from _read_pack(text, parts, of)


def _read_pack(text: str, parts: list[dict], members: list[dict]) -> Iterator[pa.RecordBatch]:
    masked = [i for p in parts for i in p["loss"]]
    out, chars, last = [], 0, None
    for m in members:
        if last is None or last[0] != m["segment"]:  # equal conversations follow one another
            segment = parts[m["segment"]]
            within = [*segment["attends"], {"start": segment["start"], "end": segment["end"]}]
            formatted = _chain(text, segment)
            turns = parse_turns(formatted)
            learnt = [text[i["start"] : i["end"]] for w in within for i in _inside(masked, w)]
            row = {"roles": [r for r, _ in turns], "texts": [t for _, t in turns], "loss": "".join(map(unescape, learnt)), "formatted_chars": len(formatted)}
            last = (m["segment"], row)
        out.append({"conv_id": m["conv_id"], **last[1]})
        chars += last[1]["formatted_chars"]
        if chars >= _BATCH_CHARS:
            yield pa.RecordBatch.from_pylist(out, schema=_READ)
            out, chars = [], 0
    yield pa.RecordBatch.from_pylist(out, schema=_READ)


def _inside(intervals: list[dict], within: dict) -> list[dict]:
    """Those of the ascending disjoint intervals that lie in the other one."""
    first = bisect_left(intervals, within["start"], key=lambda i: i["start"])
    stop = bisect_left(intervals, within["end"], key=lambda i: i["start"])
    return intervals[first:stop]


def read_back(packs: DataFrame) -> DataFrame:
    """conv_id, roles, texts, loss (all text under the loss mask, unescaped) and formatted_chars of every member.

    A conversation is put together from the intervals its last segment attends to.
    """
    return packs.select("text", "segments", "members").mapInArrow(_reader, _READ_COLUMNS)

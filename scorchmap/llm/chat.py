"""Chat formatting by columnar byte assembly.

A turn becomes ``<s>`` role ``[INST]`` text ``</s>``. Inside roles and texts, a control string gets a backslash after its
first character (one more than it has), which is taken out on reading, so that any string survives. For a batch of turns the
lengths of all segments, their cumulative offsets and the scatter indices are computed in numpy, and headers and contents
are copied into one preallocated buffer that becomes the Arrow column.

Rows are dealt by conversation and sorted by turn, then role and text. A conversation is given out as parts of bounded size,
in order, so none is ever held whole. Null role and text count as empty, a null turn comes first, rows with a null conv_id
form a conversation of their own, repeated rows are repeated turns, and an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encoding import as_batch
from .textops import by_bytes, ranges, text_bytes

START, MIDDLE, END = b"<s>", b"[INST]", b"</s>"
#: What is escaped: the strings above and the closing one of the same family.
_CONTROL = re.compile(rb"[<\[]\\*(?:/?INST\]|/?s>)")
_ESCAPED = re.compile(r"([<\[])\\(\\*(?:/?INST\]|/?s>))")

_PARTS = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("text", pa.string()), ("loss_start", pa.list_(pa.int64())), ("loss_end", pa.list_(pa.int64()))])
_READ = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _escape_points(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Positions before which a backslash goes."""
    hits = [(m.start(), m.end()) for m in _CONTROL.finditer(buf.tobytes())]
    if not hits:
        return np.zeros(0, np.int64)
    a, b = np.array(hits).T
    row = np.searchsorted(at, a, "right") - 1
    return a[b <= at[row + 1]] + 1


def assemble(roles: pa.Array, texts: pa.Array, loss_role: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all turns in one buffer, each turn's offset (one more at the end), content starts and ends, and which bear loss."""
    n = len(roles)
    fields = [text_bytes(roles), text_bytes(texts)]
    marks = [_escape_points(*f) for f in fields]
    sizes = [np.diff(at) + np.diff(np.searchsorted(m, at)) for (_, at), m in zip(fields, marks, strict=True)]
    lengths = np.empty((n, 5), np.int64)
    lengths[:, 0], lengths[:, 1], lengths[:, 2], lengths[:, 3], lengths[:, 4] = len(START), sizes[0], len(MIDDLE), sizes[1], len(END)
    ends = np.cumsum(lengths.ravel()).reshape(n, 5)
    begins = ends - lengths
    out = np.empty(int(ends[-1, -1]) if n else 0, np.uint8)
    for k, fixed in ((0, START), (2, MIDDLE), (4, END)):
        out[(begins[:, k, None] + np.arange(len(fixed))).ravel()] = np.tile(np.frombuffer(fixed, np.uint8), n)
    for k, (buf, at), points in zip((1, 3), fields, marks, strict=True):
        # where each byte goes: its segment's begin, its place in the segment, and the backslashes before it in the segment
        before = np.searchsorted(points, at[:-1])
        target = ranges(begins[:, k], np.diff(at))
        shift = np.zeros(len(buf) + 1, np.int64)
        np.add.at(shift, points, 1)
        target += np.cumsum(shift[:-1]) - np.repeat(before, np.diff(at))
        out[target] = buf
        out[target[points] - 1] = ord("\\")
    loss = roles.fill_null("").to_numpy(zero_copy_only=False) == loss_role
    return out, np.append(begins[:, 0], len(out)), begins[:, 3], ends[:, 3], loss


def _keys(column: pa.Array) -> np.ndarray:
    """Where a new conversation starts, as a mask over rows; the first row is always one."""
    x, null = column.fill_null(0).to_numpy(zero_copy_only=False), column.is_null().to_numpy(zero_copy_only=False)
    return np.concatenate([[True], (x[1:] != x[:-1]) | (null[1:] != null[:-1])])


def format_conversations(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """Parts of formatted conversations: conv_id, part (0, 1, ..), text, and byte spans of the text under the loss mask.

    The parts of a conversation, joined, are its formatted text; they come in order in one partition.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, part = object(), 0
        for batch in by_bytes(batches):
            out, at, begin, end, loss = assemble(batch.column(1), batch.column(2), loss_role)
            new = np.flatnonzero(_keys(batch.column(0)))
            bound = np.append(new, batch.num_rows)
            ids = batch.column(0).take(pa.array(new)).to_pylist()
            number = [part + 1 if i == 0 and k == last else 0 for i, k in enumerate(ids)]
            last, part = ids[-1], number[-1]
            cut = at[bound].astype(np.int32)
            text = pa.StringArray.from_buffers(len(new), pa.py_buffer(cut.tobytes()), pa.py_buffer(out))
            spans = [[(x[a:b][loss[a:b]] - at[a]).tolist() for a, b in zip(bound, bound[1:], strict=False)] for x in (begin, end)]
            yield as_batch({"conv_id": ids, "part": number, "text": text, "loss_start": spans[0], "loss_end": spans[1]}, _PARTS)

    rows = turns.select("conv_id", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), "turn")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").drop("turn")
    return rows.mapInArrow(run, "conv_id long, part long, text string, loss_start array<long>, loss_end array<long>")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def parse(text: str) -> list[tuple[str, str]]:
    """The turns (role, text) of a formatted text."""
    out = []
    for turn in text.split(END.decode())[:-1]:
        role, _, content = turn.removeprefix(START.decode()).partition(MIDDLE.decode())
        out.append((unescape(role), unescape(content)))
    return out


def read_conversations(parts: DataFrame) -> DataFrame:
    """Counts and digests of formatted conversations, read from format_conversations()' own rows, one row for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: list | None = None

        def row(x: list) -> pa.RecordBatch:
            return as_batch({"conv_id": [x[0]], "n_turns": [x[1]], "turns_sha256": [x[2].hexdigest()], "loss_chars": [x[3]], "loss_sha256": [x[4].hexdigest()], "formatted_chars": [x[5]]}, _READ)

        for batch in batches:
            for r in batch.to_pylist():
                if r["part"] == 0:
                    if now:
                        yield row(now)
                    now = [r["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                turns, data = parse(r["text"]), r["text"].encode()
                now[1] += len(turns)
                for role, text in turns:
                    now[2].update(f"{role}\n{text}\n".encode())
                for a, b in zip(r["loss_start"], r["loss_end"], strict=True):
                    said = unescape(data[a:b].decode())
                    now[3] += len(said)
                    now[4].update(said.encode())
                now[5] += len(r["text"])
        if now:
            yield row(now)

    return parts.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")

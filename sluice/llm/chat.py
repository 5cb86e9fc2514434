"""Chat formatting by columnar byte assembly."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A turn is ``### role: text</turn>\n``.
OPEN, COLON, CLOSE = "### ", ": ", "</turn>\n"
#: Bytes assembled at once, unless one conversation has more.
BLOCK = 8 << 20
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): (.*?)</turn>\n", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(texts: pa.Array, role: bool = False) -> pa.Array:
    """Double each backslash and put one inside each control string.

    No control string is left, and dropping one backslash of each pair of it and
    the character behind it gives the text back. Roles have their colons escaped.
    """
    steps = [("\\", "\\\\"), ("### ", "#\\## "), ("</turn>", "<\\/turn>")] + ([(":", "\\:")] if role else [])
    for old, new in steps:
        texts = pc.replace_substring(texts, old, new)
    return texts


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn, read back from a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return turns


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without nulls, and each value's length."""
    column = column.cast(pa.large_string()) if column.type != pa.large_string() else column
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(column) else np.empty(0, np.uint8)
    return data, np.diff(offsets)


def _put(out: np.ndarray, data: np.ndarray, lengths: np.ndarray, at: np.ndarray) -> None:
    """Scatter values that lie one behind the other in ``data`` to where each begins in ``out``."""
    if len(data) > BLOCK:  # an index per byte would be large: copy value by value
        start = 0
        for n, to in zip(lengths.tolist(), at.tolist()):
            out[to : to + n] = data[start : start + n]
            start += n
        return
    shift = at - (np.cumsum(lengths) - lengths)
    out[np.arange(len(data)) + np.repeat(shift, lengths)] = data


def assemble(first: np.ndarray, roles: pa.Array, texts: pa.Array, trained: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Formatted conversations, and the byte spans [start, end) in each that carry loss.

    ``first``: the row of each conversation's first turn. ``trained``: which rows
    carry loss. All segments' lengths are laid out as a rows x 5 matrix whose running
    sum is where each segment begins in one buffer; headers and texts are scattered
    into it, and the buffer becomes the Arrow column as it is.
    """
    n = len(texts)
    role_data, role_len = _bytes(escape(roles, role=True))
    text_data, text_len = _bytes(escape(texts))
    lengths = np.empty((n, 5), np.int64)
    lengths[:, 0], lengths[:, 1], lengths[:, 2], lengths[:, 3], lengths[:, 4] = len(OPEN), role_len, len(COLON), text_len, len(CLOSE)
    ends = np.cumsum(lengths.ravel())
    begin = (ends - lengths.ravel()).reshape(n, 5)
    total = int(ends[-1]) if n else 0
    out = np.empty(total, np.uint8)
    for k, fixed in ((0, OPEN), (2, COLON), (4, CLOSE)):
        x = np.frombuffer(fixed.encode(), np.uint8)
        out[begin[:, k, None] + np.arange(len(x))] = x
    _put(out, role_data, role_len, begin[:, 1])
    _put(out, text_data, text_len, begin[:, 3])
    bounds = np.append(begin[first, 0], total)
    formatted = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(out))
    rows = np.flatnonzero(trained)
    conv = np.searchsorted(first, rows, side="right") - 1
    start = begin[rows, 3] - bounds[conv]
    spans = pa.StructArray.from_arrays([pa.array(start, pa.int64()), pa.array(start + text_len[rows], pa.int64())], ["start", "end"])
    span_offsets = np.append(np.searchsorted(conv, np.arange(len(first))), len(rows))
    return formatted, pa.ListArray.from_arrays(pa.array(span_offsets, pa.int32()), spans)


def format_chats(turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",), conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: (conv_id, n_turns, formatted, loss_spans).

    Rows are put in order by turn (nulls first), then role and text, so ties come in
    a fixed order and repeated rows stay as further turns. A null text or role is
    the empty one; rows with a null conversation are one conversation. ``loss_spans``
    are byte spans of ``formatted`` that hold the escaped texts of ``loss_roles``. An
    empty table gives an empty result. Only the four columns are read. A worker
    holds a batch of whole conversations; one conversation is one value, so it must
    fit in memory.
    """
    name = lambda c: F.col(f"`{c}`")
    own = turns.select(name(conv_col).cast("long").alias("conv_id"), name(turn_col).cast("long").alias("turn"), F.coalesce(name(role_col), F.lit("")).alias("role"), F.coalesce(name(text_col), F.lit("")).alias("text"))
    loss = pa.array(list(loss_roles))

    def block(t: pa.Table, first: np.ndarray) -> pa.RecordBatch:
        t = t.combine_chunks()
        role, text = (t.column(c).chunk(0) if t.num_rows else pa.array([], pa.string()) for c in ("role", "text"))
        formatted, spans = assemble(first, role, text, pc.is_in(role, value_set=loss).to_numpy(zero_copy_only=False))
        ids, counts = t.column("conv_id").take(pa.array(first)), np.diff(np.append(first, t.num_rows))
        return pa.RecordBatch.from_arrays([ids.combine_chunks() if ids.num_chunks != 1 else ids.chunk(0), pa.array(counts, pa.int64()), formatted.cast(pa.string()), spans], ["conv_id", "n_turns", "formatted", "loss_spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def flush(last: bool):
            nonlocal held, size
            t = pa.Table.from_batches(held)
            ids = pc.fill_null(t.column("conv_id"), 0).to_numpy()
            null = t.column("conv_id").is_null().to_numpy()
            new = np.append(True, (ids[1:] != ids[:-1]) | (null[1:] != null[:-1]))
            first = np.flatnonzero(new)
            if not last:  # the last conversation may go on
                stop = int(first[-1])
                held = t.slice(stop).to_batches()
                size = sum(b.nbytes for b in held)
                t, first = t.slice(0, stop), first[:-1]
            if len(first):
                yield block(t, first)

        for b in batches:
            if b.num_rows:
                held.append(b)
                size += b.nbytes
                if size > BLOCK // 2:
                    yield from flush(False)
        if held:
            yield from flush(True)

    ordered = own.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(run, "conv_id long, n_turns long, formatted string, loss_spans array<struct<start: long, end: long>>")

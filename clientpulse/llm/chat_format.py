"""Chat formatting by columnar byte assembly.

A batch of turns becomes formatted text in one pass: segment lengths (header, content, footer per turn), their
cumulative offsets, and scatter indices that copy whole header and content buffers into one preallocated buffer,
which is the data buffer of the Arrow strings returned. No string is built per turn.

The template marks each turn with control strings:

    user       [INST] text [/INST]
    assistant  <s>text</s>
    system     [SYS] text [/SYS]
    any other  [ROLE name] text [/ROLE]      name percent-encoded; a null role is an empty name

A control string inside a text gets one more backslash after its bracket, also where it has some already, so that
taking one away restores the text exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARKS = {"user": ("[INST] ", " [/INST]"), "assistant": ("<s>", "</s>"), "system": ("[SYS] ", " [/SYS]")}
_TAIL = r"/?(?:INST\]|SYS\]|ROLE[\] ]|s>)"
_ESCAPE = re.compile(rf"([\[<])(\\*)(?={_TAIL})")
_UNESCAPE = re.compile(rf"([\[<])\\(\\*)(?={_TAIL})")
_NEEDS_ESCAPE = rf"[\[<]\\*{_TAIL}"
_TURN = re.compile(r"\[INST\] (.*?) \[/INST\]|<s>(.*?)</s>|\[SYS\] (.*?) \[/SYS\]|\[ROLE ([^\]]*)\] (.*?) \[/ROLE\]", re.S)
#: Bytes copied by one scatter, and characters in one returned text unless a single turn is longer.
SCATTER_BYTES = 1 << 24
CHUNK_CHARS = 1 << 22
LOSS_ROLE = "assistant"


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


def marks(role: str | None) -> tuple[str, str]:
    return MARKS.get(role) or (f"[ROLE {quote(role or '', safe='')}] ", " [/ROLE]")


def read_turns(text: str) -> Iterator[tuple[str, str]]:
    """(role, unescaped text) of each turn of a formatted text; anything else in it is an error."""
    at = 0
    for found in _TURN.finditer(text):
        if found.start() != at:
            raise ValueError(f"no turn at {at}")
        at = found.end()
        user, assistant, system, name, other = found.groups()
        for role, content in (("user", user), ("assistant", assistant), ("system", system)):
            if content is not None:
                yield role, unescape(content)
                break
        else:
            yield unquote(name), unescape(other)
    if at != len(text):
        raise ValueError(f"no turn at {at}")


def _bytes_of(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The data bytes and the offsets (from 0) of an array without nulls."""
    strings = strings.cast(pa.large_string())
    offsets = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset:strings.offset + len(strings) + 1]
    data = strings.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def _scatter(out: np.ndarray, to: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
    """Copy segment k of ``data`` to ``out`` at ``to[k]``, blocks of segments at a time."""
    at = 0
    while at < len(to):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SCATTER_BYTES, side="right")) - 1)
        size = np.diff(offsets[at:end + 1])
        if end == at + 1:  # one long text is one slice
            out[to[at]:to[at] + size[0]] = data[offsets[at]:offsets[end]]
        else:
            source = data[offsets[at]:offsets[end]]
            out[np.arange(len(source)) + np.repeat(to[at:end] - (offsets[at:end] - offsets[at]), size)] = source
        at = end


def assemble(role: pa.Array, text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All turns formatted one after the other.

    Gives the bytes, the byte offset of each turn (and the end), the byte range of each content, and which turns
    are under the loss mask.
    """
    text = pc.fill_null(text.cast(pa.large_string()), "")
    if pc.any(odd := pc.match_substring_regex(text, _NEEDS_ESCAPE)).as_py():
        text = pc.replace_with_mask(text, odd, pa.array([escape(t.as_py()) for t in text.filter(odd)], pa.large_string()))
    kinds = pc.fill_null(role.cast(pa.string()), "").dictionary_encode()
    kind = kinds.indices.to_numpy()
    pairs = [marks(k) for k in kinds.dictionary.to_pylist()]
    head, foot = (pa.array([p[side] for p in pairs], pa.large_string()).take(pa.array(kind)) for side in (0, 1))
    parts = [_bytes_of(p) for p in (head, text, foot)]
    lengths = np.stack([np.diff(offsets) for _, offsets in parts], axis=1)
    ends = np.cumsum(lengths.reshape(-1)).reshape(-1, 3)
    starts = ends - lengths
    out = np.empty(int(ends[-1, 2]) if len(ends) else 0, np.uint8)
    for side, (data, offsets) in enumerate(parts):
        _scatter(out, starts[:, side], data, offsets)
    loss = np.array([k == LOSS_ROLE for k in kinds.dictionary.to_pylist()], bool)[kind]
    return out, np.append(starts[:, 0], len(out)), starts[:, 1], ends[:, 1], loss


def format_conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text", chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """(conv_id, chunk, n_turns, text, loss): conversations formatted in turn order.

    ``loss`` lists the spans of ``text`` (code points, end excluded) that a model is trained on: the escaped contents
    of assistant turns, empty ones too. A conversation is one row (chunk 0) unless it is longer than ``chunk_chars``
    or is met at the border of an Arrow batch; then it is several, in order of ``chunk``, cut between turns and
    adjacent in one partition. So memory is bounded by a batch, however long a conversation is.

    A null text is an empty text; rows without conv_id are one conversation; ties and repeated rows of a turn are
    kept, ordered by role, then text, and rows without a turn come first. An empty table gives no rows; other columns
    are not read.
    """
    slim = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"),
                        F.col(text).alias("text"))
    dealt = slim.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    shape = T.StructType([T.StructField("conv_id", slim.schema["conv_id"].dataType),
                          T.StructField("chunk", T.LongType()), T.StructField("n_turns", T.LongType()),
                          T.StructField("text", T.StringType()), T.StructField("loss", T.ArrayType(span))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, chunk = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0)
            out, offsets, low, high, loss = assemble(batch.column(2), batch.column(3))
            chars = np.concatenate(([0], np.cumsum((out & 0xC0) != 0x80)))
            key = ids.dictionary_encode(null_encoding="encode").indices.to_numpy()
            new = np.append(True, key[1:] != key[:-1])
            # Cut at each new conversation, and before the turn that would make a text too long.
            firsts = [0]
            for t in range(1, len(new)):
                if new[t] or chars[offsets[t + 1]] - chars[offsets[firsts[-1]]] > chunk_chars:
                    firsts.append(t)
            cuts = np.array(firsts + [len(new)])
            numbers = []
            for first in firsts:
                here = (ids[first].as_py(),)
                chunk = chunk + 1 if not (first and new[first]) and here == last else 0
                last = here
                numbers.append(chunk)
            base = np.repeat(chars[offsets[cuts[:-1]]], np.diff(cuts))
            spans = pa.StructArray.from_arrays([pa.array((chars[low] - base)[loss].astype(np.int32)),
                                                pa.array((chars[high] - base)[loss].astype(np.int32))],
                                               names=["start", "end"])
            spans = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum(loss)))[cuts].astype(np.int32)), spans)
            texts = pa.Array.from_buffers(pa.large_string(), len(firsts), [
                None, pa.py_buffer(np.ascontiguousarray(offsets[cuts], np.int64)), pa.py_buffer(out)])
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(cuts[:-1])), pa.array(numbers, pa.int64()), pa.array(np.diff(cuts)),
                 texts.cast(pa.string()), spans], names=shape.names)

    return dealt.mapInArrow(run, shape)

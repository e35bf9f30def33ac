"""Digests of formatted conversations, read back from the formatted text alone."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from clientpulse.llm.chat_format import read_turns, unescape


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation the number of turns, a hash of its turns, and length and hash of the text under the loss mask.

    ``formatted`` must come straight from ``format_conversations``: the chunks of a conversation follow each other in
    one partition, and are hashed as they pass.
    """
    shape = T.StructType([T.StructField("conv_id", formatted.schema["conv_id"].dataType)]
                         + [T.StructField(n, T.StringType() if n.endswith("256") else T.LongType()) for n in
                            ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if row["chunk"] == 0:
                    if state:
                        done.append(state)
                    state = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in read_turns(row["text"]):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                for span in row["loss"]:
                    text = unescape(row["text"][span["start"]:span["end"]])
                    state[3] += len(text)
                    state[4].update(text.encode())
                state[5] += len(row["text"])
            id_type = batch.schema.field(0).type
            if done:
                yield _batch(done, shape.names, id_type)
        if state:
            yield _batch([state], shape.names, id_type)

    return formatted.mapInArrow(run, shape)


def _batch(states: list[list], names: list[str], id_type: pa.DataType) -> pa.RecordBatch:
    ids, turns, all_hash, loss, loss_hash, chars = zip(*states)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, id_type), pa.array(turns, pa.int64()), pa.array([h.hexdigest() for h in all_hash]),
         pa.array(loss, pa.int64()), pa.array([h.hexdigest() for h in loss_hash]), pa.array(chars, pa.int64())], names)

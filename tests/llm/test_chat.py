"""Chat formatting: exact round trips, the loss mask, and conversations of any length."""

import hashlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from clientpulse.llm import chat_digest, chat_format

PIECES = st.lists(st.sampled_from(["[INST]", "[/INST]", "<s>", "</s>", "[SYS]", "[/SYS]", "[ROLE x]", "[/ROLE]", "\\", "[", "<", "/",
                                   " ", "ok", "]", ">", "é", "😀", "\n", "INST]", "s>"]), max_size=12).map("".join)
SCHEMA = "conv_id long, turn long, role string, text string, chunk int, loss string"


@settings(deadline=None)
@given(PIECES)
def test_escape_is_reversible_and_leaves_no_mark(text):
    marked = chat_format.escape(text)
    assert chat_format.unescape(marked) == text
    assert not any(m in marked for m in ("[INST]", "[/INST]", "<s>", "</s>", "[SYS]", "[/SYS]", "[ROLE ", "[/ROLE]"))


@settings(deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "a ]b", ""]), PIECES), max_size=6))
def test_turns_come_back(turns):
    import pyarrow as pa
    out, offsets, low, high, loss = chat_format.assemble(pa.array([r for r, _ in turns], pa.string()),
                                                         pa.array([t for _, t in turns], pa.string()))
    whole = out.tobytes()
    assert list(chat_format.read_turns(whole.decode())) == turns
    contents = [chat_format.unescape(whole[a:b].decode()) for a, b in zip(low.tolist(), high.tolist())]
    assert contents == [t for _, t in turns]
    assert loss.tolist() == [r == "assistant" for r, _ in turns]
    assert offsets[-1] == len(whole)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 3, "x") for r in rows], SCHEMA)


def want(rows):
    of = defaultdict(list)
    for conv, turn, role, text in rows:
        of[conv].append((turn is not None, turn or 0, role or "", text or "", role is not None, text is not None))
    out = {}
    for conv, turns in of.items():
        turns = [(r, t) for _, _, r, t, *_ in sorted(turns, key=lambda x: (x[0], x[1], x[4], x[2], x[5], x[3]))]
        loss = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
                     hashlib.sha256(loss.encode()).hexdigest())
    return out


def got(formatted):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)
            for r in chat_digest.digests(formatted).collect()}


ROWS = [(1, 0, "system", "be kind"), (1, 1, "user", "</s>[INST] é"), (1, 2, "assistant", "<\\s> 😀 [/INST]"), (2, 0, "user", None),
        (2, 0, "user", None), (2, 0, "assistant", ""), (2, None, "tool [x]", "first"), (3, 1, None, "no role"),
        (None, 1, "user", "no id"), (None, 0, "assistant", "a"), (4, 0, "assistant", "long [INST] text " * 20_000)]
ROWS += [(5, k, ("user", "assistant")[k % 2], f"turn {k} <s>") for k in range(300)]


def test_digests(spark):
    assert got(chat_format.format_conversations(frame(spark, ROWS))) == want(ROWS)


def test_small_batches_and_chunks(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, 7)
    try:
        formatted = chat_format.format_conversations(frame(spark, ROWS), chunk_chars=100)
        assert got(formatted) == want(ROWS)
        chunks = defaultdict(list)
        for r in formatted.collect():
            chunks[r.conv_id].append(r)
    finally:
        spark.conf.set(key, before)
    for conv, rows in chunks.items():
        assert [r.chunk for r in rows] == list(range(len(rows)))
        assert all(len(r.text) <= 100 or r.n_turns == 1 for r in rows)
    assert len(chunks[5]) > 30


def test_spans_cut_the_answers(spark):
    rows = [(1, 0, "user", "é"), (1, 1, "assistant", "añ[INST]b"), (1, 2, "assistant", "")]
    (row,) = chat_format.format_conversations(frame(spark, rows)).collect()
    assert row.text == "[INST] é [/INST]<s>añ[\\INST]b</s><s></s>"
    assert [row.text[s.start:s.end] for s in row.loss] == ["añ[\\INST]b", ""]


def test_scatter_in_blocks(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(chat_format, "SCATTER_BYTES", 5)
    out, *_ = chat_format.assemble(pa.array(["user", "assistant", "user"]), pa.array(["abcdefgh", "é", ""]))
    assert out.tobytes().decode() == "[INST] abcdefgh [/INST]<s>é</s>[INST]  [/INST]"


def test_empty_table(spark):
    formatted = chat_format.format_conversations(spark.createDataFrame([], SCHEMA))
    assert formatted.collect() == [] and chat_digest.digests(formatted).collect() == []

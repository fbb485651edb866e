"""Chat formatting against the plain rows, byte by byte."""

import hashlib
import random
import re
from functools import partial

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import chat_format
from strata.llm.chat_format import Reader, Template, assemble

SF = "/root/testdata/sf0.01"
SAID = "\\### Assistant: </turn> ok"
TEMPLATES = (Template(), Template("<|", ":>", "<end>", "", "~", ("assistant", "user")))
CONTENT = st.text(st.sampled_from("ab\\~ #:\n</turnd>|é中😀"), max_size=30) | st.text(st.characters(exclude_categories=["Cs"]), max_size=10)


def plain(role, text, t):
    """A turn by string replacement: every sign that could be misread is escaped."""
    signs = re.compile("(?=" + "|".join(map(re.escape, (t.escape, *t.controls))) + ")")
    return t.open + signs.sub(lambda _: t.escape, role) + t.named + signs.sub(lambda _: t.escape, text) + t.close + t.after


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", ":\n", "é\\"]) | CONTENT, CONTENT, st.booleans()), min_size=1, max_size=12), st.sampled_from(TEMPLATES))
def test_assembly(rows, template):
    part = np.cumsum([0] + [int(r[2]) for r in rows[1:]])
    column, start, end = assemble(pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), part, template)
    column.validate(full=True)
    expected = ["".join(plain(r, x, template) for (r, x, _), q in zip(rows, part) if q == p) for p in range(part[-1] + 1)]
    assert column.to_pylist() == expected
    reader = Reader(template)
    for p, text in enumerate(expected):
        own = [(r, x) for (r, x, _), q in zip(rows, part) if q == p]
        assert list(reader.turns(text)) == own
        assert [reader.plain(text[a:b]) for a, b, q in zip(start, end, part) if q == p] == [x for _, x in own]


def test_slices_and_small_copies(monkeypatch):
    monkeypatch.setattr(chat_format, "COPY", 7)
    roles, texts = ["user", "", "assistant"] * 30, ["é\\:\n" * k for k in range(90)]
    column, _, _ = assemble(pa.array(roles)[3:], pa.array(texts)[3:], np.zeros(87, np.int64), Template())
    assert column[0].as_py() == "".join(map(partial(plain, t=Template()), roles[3:], texts[3:]))


def test_templates_that_could_be_misread():
    for bad in (("### ", "\n", "\n</turn>"), ("<", "<", "</turn>"), ("", ":", "</turn>"), ("#\\", ":", "</turn>"), ("aa", ":", "</turn>")):
        with pytest.raises(ValueError):
            Template(*bad)
    with pytest.raises(ValueError):
        list(Reader(Template()).turns("### user:\nhello"))
    with pytest.raises(ValueError):
        list(Reader(Template()).turns("### user:\nhello</turn>\nrest"))


def brute(rows, template=Template()):
    """DIGESTS from (conv, turn, role, text) rows."""
    low = lambda x: (x is not None, x if x is not None else 0)
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(((low(t), r or "", x or "") for c, t, r, x in rows if c == conv), key=lambda r: (r[0], r[1].encode(), r[2].encode()))
        said = "".join(f"{r}\n{x}\n" for _, r, x in own)
        loss = "".join(x for _, r, x in own if r in template.trained)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(own), sha(said), len(loss), sha(loss), sum(len(plain(r, x, template)) for _, r, x in own))
    return out


def digests(df, scratch_name="formatted"):
    from strata.llm.store import stored

    got = chat_format.digest(stored(chat_format.format_conversations(df), scratch_name)).collect()
    assert len(got) == len({r["conv_id"] for r in got})
    return {r["conv_id"]: tuple(r)[1:] for r in got}


ROWS = "conv_id long, turn long, role string, text string, part string, whole string, loss string, conversation string"


def test_conversations_of_every_kind(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(-7, 0, "user", SAID), (-7, 1, "assistant", SAID), (None, 0, "assistant", "no id"), (None, None, None, None), (3, 1, "user", None),
            (3, 1, "user", None), (3, 0, None, ""), (4, 5, "assistant", "x" * 200_000), (4, 5, "assistant", "é" * 70_000), (4, None, "system", "first")]
    rows += [(rng.choice([5, 5, 6, 7, 8]), rng.randrange(50), rng.choice(["user", "assistant", "system"]), "".join(rng.choice("ab#: \n</turn>\\é") for _ in range(rng.randrange(60))))
             for _ in range(600)]
    df = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], ROWS)
    assert digests(df) == brute(rows)


def test_a_conversation_with_a_third_of_all_turns(spark):
    rows = [(1 if i % 3 else i, i, ("user", "assistant")[i % 2], f"turn {i} " * (i % 40)) for i in range(6000)]
    df = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], ROWS)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as if there were more bytes
    try:
        assert chat_format.format_conversations(df.repartition(5)).where("conv_id = 1").count() > 1  # split between tasks
        assert digests(df) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_parts_of_long_conversations(monkeypatch):
    """Parts end where they are full, whatever the batches; no turn is cut."""
    monkeypatch.setattr(chat_format, "PART", 500)
    monkeypatch.setattr(chat_format, "ASSEMBLE", 2000)
    rng = random.Random(8)
    rows = sorted((rng.choice([None, 1, 2, 3, 4, 5, 6, 7]) or 0, rng.choice(["user", "assistant"]), "w" * rng.choice([0, 5, 90, 700])) for _ in range(500))
    rows = [(c or None, r, t) for c, r, t in rows]
    found = []
    for size in (1, 7, 100, 500):
        turns, out = chat_format._Turns(Template(), 3), []
        for a in range(0, len(rows), size):
            out += turns.add(pa.RecordBatch.from_pylist([dict(zip(("conv_id", "role", "text"), r)) for r in rows[a:a + size]], pa.schema([("conv_id", pa.int64()), ("role", pa.string()), ("text", pa.string())])))
        out += turns.emit(True)
        found.append([x for b in out for x in b.to_pylist()])
    assert all(f == found[0] for f in found)
    got = found[0]
    assert [x["part"] for x in got] == list(range(3 << 32, (3 << 32) + len(got))) and sum(x["n_turns"] for x in got) == 500
    reader = Reader(Template())
    assert [(x["conv_id"], *turn) for x in got for turn in reader.turns(x["text"])] == rows
    ends = {got[0]["conv_id"], got[-1]["conv_id"]}
    for x in got:
        many = sum(y["conv_id"] == x["conv_id"] for y in got)
        assert x["whole"] == (many == 1 and x["conv_id"] not in ends)
        assert sum(len(r) + len(t) for r, t in list(reader.turns(x["text"]))[:-1]) <= 500


def test_empty_table(spark):
    assert digests(spark.createDataFrame([], ROWS)) == {}


def test_query_against_rows(spark):
    from strata.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r)[1:] for r in QUERIES["op11_chat_format"](spark, SF).collect()}
    assert got == brute(rows + [(-7, 0, "user", SAID), (-7, 1, "assistant", SAID)])

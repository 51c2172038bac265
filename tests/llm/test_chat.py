import hashlib
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tideline.llm import chat

TEXT = st.lists(st.sampled_from([*chat.CONTROLS, "\\", "<", ">", "[", "]", "|", "\n", "a", "é", "😀", "<|im_", "/INST"])).map("".join)
LOG = "conv_id long, message long, copy int, seq long, kind string, role string, text string, n_turns string"
ROWS = "conv_id long, turn long, role string, text string"


@given(st.lists(st.tuples(TEXT, TEXT)))
def test_template_round_trip(turns):
    assert chat.parse("".join("".join(chat.turn(r, t)) for r, t in turns)) == turns


def sha(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def figures(conversations):
    """What must be read back of {conv_id: [(role, text), ...]}."""
    out = []
    for conv, turns in conversations.items():
        loss = [t for r, t in turns if r == "assistant"]
        formatted = sum(len("".join(chat.turn(r, t))) for r, t in turns)
        digest = sha(f"{r}\n{t}\n" for r, t in turns)
        out.append((conv, len(turns), digest, len("".join(loss)), sha(loss), formatted))
    return sorted(out, key=str)


def read(spark, log):
    return sorted(map(tuple, chat.read_back(chat.render_log(log)).collect()), key=str)


def test_events_fold_in_sequence(spark):
    events = [
        (1, 0, 0, 0, "delta", "user", "Hel"),
        (1, 0, 0, 1, "delta", None, "lo"),
        (1, 1, 0, 2, "delta", "assistant", "first try"),
        (1, 1, 0, 3, "regenerate", None, None),
        (1, 1, 0, 4, "delta", None, "second "),
        (1, 1, 0, 7, "delta", None, "try"),
        (1, 0, 0, 5, "edit", None, "Hello there"),
        (1, 0, 0, 6, "delta", None, "!"),
        (1, 2, 0, 8, "delta", "user", "gone"),
        (1, 2, 0, 9, "delete", None, None),
        (1, 3, 0, 10, "delta", "user", "gone"),
        (1, 3, 0, 11, "delete", None, None),
        (1, 3, 0, 12, "edit", None, "back"),
        (None, None, 0, None, "edit", None, None),
        (2, 0, 0, 0, "delta", "user", "x"),
        (2, 0, 0, 1, "delete", None, None),
    ]
    expected = figures({1: [("user", "Hello there!"), ("assistant", "second try"), ("user", "back")], None: [("", "")]})
    for seed in range(3):
        random.Random(seed).shuffle(events)
        log = spark.createDataFrame([(*e, "x") for e in events], LOG).repartition(3)
        assert read(spark, log) == expected
    with pytest.raises(Exception, match="unknown kind"):
        read(spark, spark.createDataFrame([(1, 0, 0, 0, "?", None, None, "x")], LOG))


def test_long_conversations_come_in_parts(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 50)
    monkeypatch.setattr(chat, "PART", 300)
    rng = random.Random(1)
    texts = ["</s>[INST] ok [/INST]", "", "\\", "plain words " * 40, None]
    rows = [(c, t, rng.choice(["user", "assistant", "system\n<s>", None]), rng.choice(texts)) for c in (1, 2) for t in range(120)]
    rows += [(3, None, "user", "b"), (3, None, "user", "a"), (3, 4, "user", "a"), (3, 4, "user", "a"), (None, 0, "assistant", "z")]
    parts = chat.render_log(chat.log_of(spark.createDataFrame(rows, ROWS)))
    assert parts.where("conv_id = 1").count() > 10 and parts.where("conv_id = 1").select("block").distinct().count() == 3
    assert max(len(r.formatted) for r in parts.collect()) < 300 + 600
    done = {}
    for c, t, r, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        done.setdefault(c, []).append((r or "", x or ""))
    assert sorted(map(tuple, chat.read_back(parts).collect()), key=str) == figures(done)
    for r in parts.collect():
        trained = [t for role, t in chat.parse(r.formatted) if role == "assistant"]
        assert [chat.unescape(r.formatted[s.start : s.end]) for s in r.loss] == trained


def test_nothing(spark):
    assert chat.read_back(chat.render_log(chat.log_of(spark.createDataFrame([], ROWS)))).collect() == []
    long = "word " * 200_000
    assert read(spark, chat.log_of(spark.createDataFrame([(1, 1, "assistant", long)], ROWS))) == figures({1: [("assistant", long)]})

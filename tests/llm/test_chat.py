import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm.chat import escape, format_turns, parse, read_back, render, unescape

PARTS = st.lists(st.sampled_from(["[INST]", "[/INST]", " [/INST]", "</s>", " </s>", "<s>", "[SYS]", " [/SYS]", "[ROLE x] ",
                                  " [/ROLE]", "\\", "\\[", "[", "]", "<", " ", "\n", "ok", "é"]), max_size=12).map("".join)
ROLES = st.one_of(st.sampled_from(["user", "assistant", "system", "tool", "", "a] b", "\\"]), PARTS)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(ROLES, PARTS), max_size=6))
def test_round_trip(turns):
    whole = "".join(render(r, t)[0] for r, t in turns)
    assert [x[:2] for x in parse(whole)] == turns


@settings(max_examples=200, deadline=None)
@given(PARTS, st.integers(1, 2))
def test_escape_is_reversible(text, level):
    assert unescape(escape(text, level)) == text


def test_texts_without_conflict_stay_as_they_are():
    assert render("user", "plain \\n [1] <b>")[0] == "[INST] plain \\n [1] <b> [/INST]"
    with pytest.raises(ValueError):
        list(parse("[INST] no end"))


def digest(turns):
    return hashlib.sha256("".join(f"{r or ''}\n{t or ''}\n" for r, t in turns).encode()).hexdigest()


def test_read_back(frame):
    said = "</s>[INST] ok [/INST]"
    convs = {-1: [("user", said), ("assistant", said)], 1: [("system", None), ("user", ""), ("assistant", "a </s> b")],
             2: [(None, "x"), ("tool", "[/ROLE]")], 3: [("assistant", "é" * 3), ("assistant", "y")]}
    rows = [(c, i, r, t, "extra") for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    df = frame(rows, "conv_id long, turn long, role string, text string, rendered string").repartition(3)
    got = {r.conv_id: r for r in read_back(format_turns(df)).collect()}
    for c, turns in convs.items():
        loss = "".join(t or "" for r, t in turns if r == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(turns), digest(turns))
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[c].formatted_chars == sum(len(render(r or "", t or "")[0]) for r, t in turns)
    assert len(got) == 4


def test_ties_repeats_long_and_empty(frame):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(None, None, "user", "a"), (None, None, "user", "a"), (7, 0, "user", "x" * 300000)] + [(8, i, "user", "t") for i in range(3000)]
    got = {r.conv_id: r for r in read_back(format_turns(frame(rows, schema))).collect()}
    assert got[None].n_turns == 2 and got[7].formatted_chars == 300015 and got[8].n_turns == 3000
    assert read_back(format_turns(frame([], schema))).count() == 0


def test_ties_are_ordered_by_the_text_itself(frame):
    texts = ["a A", "a", "[/INST] b", "[a", "\\[", "é", "", "a </s>"]
    rows = [(c, 0, role, t) for c in range(4) for role in ("assistant", "user") for t in texts[c:] + texts[:c]]
    got = read_back(format_turns(frame(rows, "conv_id long, turn long, role string, text string").repartition(5))).collect()
    want = [(role, t) for role in ("assistant", "user") for t in sorted(texts, key=str.encode)]
    assert {r.turns_sha256 for r in got} == {digest(want)}
    assert {r.loss_sha256 for r in got} == {hashlib.sha256("".join(sorted(texts, key=str.encode)).encode()).hexdigest()}

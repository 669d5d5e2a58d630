"""The role machine's verdict and the loss spans of conversations in any order."""

import random

from tidewater.llm import chat

TURNS = "conv_id long, turn long, role string, text string, at string, head string"


def brute(roles):
    state, bad = "start", None
    for i, role in enumerate(roles):
        to = chat.CHATML.moves[state].get(role)
        if to is None and bad is None:
            bad = i
        state = to or state
    return bad is None and state in chat.CHATML.accepting, bad


def test_verdict_and_spans(spark):
    rng = random.Random(3)
    convs = {c: [rng.choice(["user", "assistant", "system", "tool"][: 2 + c % 3]) for _ in range(rng.randint(1, 7))] for c in range(120)}
    convs[500] = ["user", "assistant"] * 6000  # spans are found in one pass
    convs[501] = ["system", "user", "assistant"]
    rows = [(c, i, r, f"{r}-{i} \\ <|im_end|>", "x", "y") for c, roles in convs.items() for i, r in enumerate(roles)]
    got = chat.format_conversations(spark.createDataFrame(rows, TURNS)).collect()
    assert len(got) == len(convs)
    for r in got:
        roles = convs[r.conv_id]
        assert (r.valid, r.first_bad_turn) == brute(roles)
        texts = [r.formatted[s.start : s.end] for s in r.loss_spans]
        assert texts == [f"assistant-{i} \\\\ <\\|im_end|>" for i, x in enumerate(roles) if x == "assistant"]
        assert r.formatted.count("<|im_start|>") == len(roles) == r.formatted.count("<|im_end|>\n")

from __future__ import annotations

from factloom.llm import preference as p


def by_hand(c, r):
    n = 0
    while n < min(len(c), len(r)) and c[n] == r[n]:
        n += 1
    show = lambda t: "".join(f"<|im_start|>{a}\n{b}<|im_end|>\n" for a, b in t)

    def mask(t):
        out, at = [], 0
        for a, b in t:
            start = at + len("<|im_start|>") + len(a) + 1
            at = start + len(b) + len("<|im_end|>\n")
            if a == "assistant":
                out.append(f"{start}:{at}")
        return ",".join(out)

    return n, show(c[:n]), show(c[n:]), mask(c[n:]), show(r[n:]), mask(r[n:])


CASES = [
    ([("user", "hi"), ("assistant", "yes")], [("user", "hi"), ("assistant", "no")]),
    ([("system", "s"), ("user", "é日"), ("assistant", "a"), ("user", "q"), ("assistant", "long " * 20_000)], [("system", "s"), ("user", "é日"), ("assistant", "a"), ("user", "q")]),
    ([("user", "x")], [("user", "x")]), ([], [("assistant", "z")]), ([("user", "x")], []), ([("user", "")], [("assistant", "")]),
]


def test_pairs(spark):
    rows = [(i, c, r, "x") for i, (c, r) in enumerate(CASES)] + [(99, None, CASES[0][0], "x")]
    df = spark.createDataFrame(rows, "pair_id long, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>, prompt string")
    got = {r.pair_id: r for r in p.format_pairs(df).collect()}
    for i, c, r, _ in rows:
        g = got[i]
        rest = [side[g.n_prompt_turns :] for side in (c or [], r or [])]
        assert g.is_pair == all(any(a == "assistant" for a, _ in side) for side in rest)
        assert (g.n_prompt_turns, g.prompt, g.chosen, g.chosen_mask, g.rejected, g.rejected_mask) == by_hand(c or [], r or [])


def test_swapped_replies(spark):
    rows = [(0, 1, "assistant", "A0"), (0, 0, "user", "U0"), (1, 0, "user", "U1"), (1, 1, "assistant", "A1"), (1, 2, "user", "more"), (2, 0, "user", "alone"), (4, 0, None, None), (None, 0, "user", "n"), (5, 0, "user", "d"), (5, 0, "user", "d")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.pair_id: r for r in p.format_pairs(p.swapped_replies(df)).collect()}
    assert len(got) == 5  # a turn without a conversation takes no part
    assert {i for i, r in got.items() if r.is_pair} == {0, 1}
    assert got[0].n_prompt_turns == 1 and "U0" in got[0].prompt and "A0" in got[0].chosen and "A1" in got[0].rejected
    assert got[1].n_prompt_turns == 1 and "more" in got[1].chosen and "more" not in got[1].rejected and "A0" in got[1].rejected
    assert got[2].rejected == "" and got[5].chosen.count("d<") == 2
    assert p.format_pairs(p.swapped_replies(df.limit(0))).count() == 0


def test_native(spark):
    df = spark.createDataFrame([(0, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    plan = p.format_pairs(p.swapped_replies(df))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan

import random

from eventpulse.llm import chat as C

SCHEMA = "pair_id long, side string, turn int, role string, text string, prompt string"


def run(spark, rows):
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    got = C.format_preferences(frame).collect()
    assert len({r.pair_id for r in got}) == len(got)
    return {r.pair_id: r for r in got}


def test_prefix_completions_and_masks(spark):
    both = [(0, "system", "be kind"), (1, "user", "hi"), (2, "assistant", "hello")]
    rows = [(7, s, *t) for s in ("chosen", "rejected") for t in both]
    rows += [(7, "chosen", 3, "user", "more"), (7, "chosen", 4, "assistant", "good"), (7, "rejected", 3, "user", "more"), (7, "rejected", 4, "assistant", "bad <|end|>"), (7, "rejected", 5, "user", "ugh")]
    r = run(spark, rows)[7]
    assert (r.n_prompt_turns, r.n_chosen_turns, r.n_rejected_turns) == (4, 1, 2)
    assert r.prompt == "<|system|>\nbe kind<|end|>\n<|user|>\nhi<|end|>\n<|assistant|>\nhello<|end|>\n<|user|>\nmore<|end|>\n"
    part = lambda text, spans: [text[slice(*map(int, s.split(":")))] for s in spans.split(",") if s]
    assert r.chosen == "<|assistant|>\ngood<|end|>\n" and part(r.chosen, r.chosen_spans) == ["good<|end|>"]
    assert part(r.rejected, r.rejected_spans) == ["bad <\\|end|><|end|>"] and r.rejected.count(C.END) == 2


def test_defined_cases(spark):
    rows = [(1, "chosen", 0, None, None), (1, "chosen", 0, None, None), (2, "chosen", 0, "user", "x"), (2, "rejected", 0, "user", "x"), (2, "rejected", 0, "user", "x"), (None, "chosen", 0, "user", "x"), (3, "rejected", None, "user", "x"), (4, "chosen", 0, "user", "b"), (4, "chosen", 0, "user", "a"), (4, "rejected", 0, "user", "a"), (5, "chosen", 0, "user", "é" * 100_000)]
    got = run(spark, rows)
    assert set(got) == {1, 2, 4, 5}
    assert got[1].chosen == "<|unknown|>\n<|end|>\n" and got[1].n_rejected_turns == 0 and got[1].chosen_spans == ""
    assert (got[2].n_prompt_turns, got[2].chosen, got[2].rejected) == (1, "", "")
    assert got[4].n_prompt_turns == 1 and got[4].prompt == "<|user|>\na<|end|>\n" and got[4].chosen == got[4].rejected == "" and len(got[5].chosen) > 100_000
    assert run(spark, []) == {}


def plain(rows):
    """Pairs turn by turn, without Spark."""
    kept = {}
    for pair, side, turn, role, text in rows:
        if pair is not None and turn is not None:
            t = tuple((x if x is not None else d).replace("<|", "<\\|") for x, d in ((role, "unknown"), (text, "")))
            kept.setdefault(pair, {}).setdefault(side, {})
            kept[pair][side][turn] = min(t, kept[pair][side].get(turn, t))
    out = {}
    for pair, sides in kept.items():
        a, b = (sides.get(k, {}) for k in ("chosen", "rejected"))
        split = min((t for t in a.keys() | b.keys() if a.get(t) != b.get(t)), default=1 << 60)
        text = lambda x: f"<|{x[0]}|>\n{x[1]}<|end|>\n"
        out[pair] = ("".join(text(a[t]) for t in sorted(a) if t < split), *("".join(text(x[t]) for t in sorted(x) if t >= split) for x in (a, b)))
    return out


def test_as_the_plain_version_with_repeated_and_missing_turns(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(60), rng.choice(["chosen", "rejected"]), rng.choice([0, 1, 2, 3, 5, None]), rng.choice(["user", "user", "assistant", None]), rng.choice(["a", "a", "b", None, "<|end|>"])) for _ in range(900)]
    rows += [(100, s, t, "a", "b|>\nc") for s in ("chosen", "rejected") for t in range(2)] + [(101, "chosen", 0, "a", "b|>\nc"), (101, "rejected", 0, "a|>\nb", "c")]
    assert {k: (r.prompt, r.chosen, r.rejected) for k, r in run(spark, rows).items()} == plain(rows)


def test_a_long_conversation_is_one_row(spark):
    rows = [(1, s, t, "user" if t % 2 == 0 else "assistant", f"t{t}" if t < 2500 else f"{s}{t}") for s in ("chosen", "rejected") for t in range(5700)]
    r = run(spark, rows)[1]
    assert (r.n_prompt_turns, r.n_chosen_turns, r.n_rejected_turns) == (2500, 3200, 3200) and (r.prompt, r.chosen, r.rejected) == plain(rows)[1]
    assert all(r.chosen[slice(*map(int, s.split(":")))].endswith(C.END) for s in r.chosen_spans.split(",")) and len(r.chosen_spans.split(",")) == 1600

from orderloom.llm import preferences

from .support import clashing

TURNS = "conv_id long, turn long, role string, text string"
PAIRS = "id long, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>, prompt string"


def rendered(turns):
    return "".join(f"<|{r or ''}|>\n{(t or '').replace('<|', '< |')}<|end|>\n" for r, t in turns)


def learned(text, mask):
    return [text[int(a) : int(b)] for a, b in (s.split(":") for s in mask.split(",") if s)]


def test_prompt_completions_and_masks(spark):
    u, a, b = ("user", "hi"), ("assistant", "good <|end|> day 🙂"), ("assistant", "no")
    rows = [
        (1, [u, a], [u, b]), (2, [u, a, u, a], [u, a, u, b]), (3, [u], [u, a]), (4, [u, a], [u, a]), (5, None, [b]), (6, [], []),
        (7, [(None, None), a], [(None, None), b]), (8, [a, u], [b]), (9, [u] * 3000 + [a], [u] * 3000 + [b]),
    ]
    df = preferences.format_pairs(spark.createDataFrame([(i, c, r, "clash") for i, c, r in rows], PAIRS))
    got = {r["id"]: r for r in df.collect()}
    for i, chosen, rejected in rows:
        chosen, rejected = chosen or [], rejected or []
        n = 0
        while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
            n += 1
        r = got[i]
        assert (r["n_prompt_turns"], r["prompt"]) == (n, rendered(chosen[:n]))
        for side, turns in (("chosen", chosen), ("rejected", rejected)):
            assert r[f"{side}_text"] == rendered(turns[n:])
            assert learned(r[f"{side}_text"], r[f"{side}_mask"]) == [t.replace("<|", "< |") + "<|end|>" for role, t in turns[n:] if role == "assistant"]


def test_pairs_of_conversations(spark):
    rows = [
        (1, 0, "user", "q"), (1, 1, "assistant", "long answer"), (2, 0, "user", "q"), (2, 1, "assistant", "short"), (2, 1, "assistant", "short"),
        (3, 0, "user", "other"), (3, 1, "assistant", "one"), (3, 2, "user", "more"), (3, 3, "assistant", "two"), (3, 4, "user", "bye"),
        (4, 0, "user", "alone"), (5, 0, "assistant", "first"), (None, 0, "user", "lost"), (6, None, None, None), (6, 1, "assistant", "x"),
    ]
    got = {r["pair_id"]: r for r in preferences.format_conversations(clashing(spark.createDataFrame(rows, TURNS))).collect()}
    assert {i: (r["rejected_id"], r["kind"], r["n_prompt_turns"]) for i, r in got.items()} == {
        1: (2, "sibling", 1), 2: (2, "swapped", 1), 3: (3, "swapped", 3), 5: (5, "swapped", 0), 6: (6, "swapped", 1),
    }
    assert got[3]["chosen_text"] == rendered([("assistant", "two")]) and got[3]["rejected_text"] == rendered([("assistant", "one")])
    assert got[5]["rejected_text"] == rendered([("assistant", "")])
    assert preferences.format_conversations(spark.createDataFrame([], TURNS)).count() == 0


def test_an_opening_that_many_share(spark):
    rows = [(i, t, role, text) for i in range(95) for t, role, text in ((0, "user", "same"), (1, "assistant", f"a{i}"))]
    got = preferences.format_conversations(spark.createDataFrame(rows, TURNS)).collect()
    # Each meets the next one, whatever ranges the ids were cut into; the last one meets itself.
    assert sorted(tuple(sorted(r[:2])) for r in got) == [(i, min(i + 1, 94)) for i in range(95)]
    assert all(r["n_prompt_turns"] == 1 for r in got)


def test_an_opening_of_any_size_is_one_chain(spark):
    rows = spark.range(10_001).selectExpr("id as conv_id", "explode(array(0L, 1L)) as turn").selectExpr(
        "conv_id", "turn", "if(turn = 0, 'user', 'assistant') as role", "if(turn = 0, 'same', concat('a', conv_id)) as text"
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = preferences.pairs_of(preferences.conversations_as_turns(rows)).select("pair_id", "rejected_id", "kind").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    siblings = {tuple(sorted(r[:2])) for r in got if r["kind"] == "sibling"}
    assert siblings == {(i, i + 1) for i in range(10_000)}
    assert [r[:2] for r in got if r["kind"] == "swapped"] == [(10_000, 10_000)] and len(got) == 10_001

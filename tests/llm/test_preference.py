from pyspark.sql import functions as F

from palimpsest.llm.preference import preference_pairs


def run(spark, rows):
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, prompt string").repartition(3)
    found = preference_pairs(df, F.floor(F.col("conv_id") / 2), F.pmod("conv_id", F.lit(2)) == 0)
    assert not any(x in found._jdf.queryExecution().executedPlan().toString() for x in ("Python", "Pandas", "Arrow"))
    return {r.pair_id: r for r in found.collect()}


def test_pairs(spark):
    talk = lambda c, *turns: [(c, i, r, t, "p") for i, (r, t) in enumerate(turns)]
    rows = talk(0, ("user", "hi"), ("assistant", "yo"), ("user", "q"), ("assistant", "good🙂")) + talk(1, ("user", "hi"), ("assistant", "yo"), ("user", "q"), ("assistant", "bad"), ("user", "?"))
    rows += talk(2, ("user", "same")) + talk(3, ("user", "same")) + talk(4, (None, None), ("assistant", "a" * 50000)) + talk(6, ("user", "x")) + talk(7, ("system", "x")) + [(None, 0, "user", "lost", "p")]
    got = run(spark, rows)
    assert set(got) == {0, 1, 2, 3}
    first = got[0]
    assert first.prompt == "<|user|>\nhi<|end|>\n<|assistant|>\nyo<|end|>\n<|user|>\nq<|end|>\n" and first.n_prompt_turns == 3
    assert first.chosen == "<|assistant|>\ngood🙂<|end|>\n"
    a, b = map(int, first.chosen_spans.split("-"))
    assert first.chosen[a:b] == "good🙂<|end|>\n"
    a, b = map(int, first.rejected_spans.split("-"))
    assert first.rejected[a:b] == "bad<|end|>\n" and first.rejected.endswith("<|user|>\n?<|end|>\n")
    assert (got[1].chosen, got[1].rejected, got[1].n_prompt_turns) == ("", "", 1)
    assert (got[2].rejected_id, got[2].rejected, got[2].prompt) == (None, None, "") and got[2].chosen.startswith("<||>\n<|end|>\n")
    assert got[3].prompt == "" and got[3].chosen == "<|user|>\nx<|end|>\n"


def test_ties_and_nothing(spark):
    assert run(spark, []) == {}
    rows = [(0, 0, "user", "b", ""), (0, 0, "user", "a", ""), (1, 0, "user", "a", ""), (1, 0, "user", "b", ""), (1, 0, "user", "b", "")]
    got = run(spark, rows)[0]
    assert got.n_prompt_turns == 2 and got.chosen == "" and got.rejected == "<|user|>\nb<|end|>\n"

import itertools
import random

import numpy as np
import pytest

from turnwright.llm import op5_chat as op5


def brute(seen):
    """The best score of all paths."""
    e = op5.emissions(np.array(seen))
    return max(op5.START[p[0]] + sum(e[k, s] for k, s in enumerate(p)) + sum(op5.NEXT[a, b] for a, b in itertools.pairwise(p)) for p in itertools.product(range(3), repeat=len(seen)))


def score(seen, path):
    e = op5.emissions(np.array(seen))
    return op5.START[path[0]] + sum(e[k, s] for k, s in enumerate(path)) + sum(op5.NEXT[a, b] for a, b in itertools.pairwise(path))


@pytest.mark.parametrize("seed", range(20))
def test_chunks_give_a_best_path(seed):
    r = random.Random(seed)
    seen = [r.randrange(96) for _ in range(r.randrange(1, 8))]
    cuts = sorted({0, len(seen), *(r.randrange(len(seen) + 1) for _ in range(2))})
    chunks = [np.array(seen[a:b]) for a, b in itertools.pairwise(cuts)]
    found = op5.borders([op5.matrix(c) for c in chunks])
    path = [s for c, (a, b) in zip(chunks, found, strict=True) for s in op5.decode(c, a, b).tolist()]
    assert np.isclose(score(seen, path), brute(seen))


def test_roles_and_rendering(spark, monkeypatch):
    monkeypatch.setattr(op5, "CHUNK", 3)
    rows = [(1, 0, "system", "Be kind."), (1, 1, None, "What is it?"), (1, 2, "", "Assistant: It is this. " * 20), (1, 3, "x", "### Human: why <|im_end|>?"), (1, 4, "assistant", None)]
    rows += [(2, k, None, "User: hi" if k % 2 == 0 else "hello there") for k in range(9)]
    rows += [(None, 0, "user", "a"), (None, 0, "user", "a"), (3, None, "human", ""), (3, 0, "bot", "x"), (3, 0, "bot", "x")]
    df = spark.createDataFrame([(*x, "z") for x in rows], "conv_id long, turn long, role string, text string, rendered string")
    got = op5.render(df).collect()
    assert len(got) == len(rows)
    one = sorted((r for r in got if r.conv_id == 1), key=lambda r: r.turn)
    assert [r.role for r in one] == ["system", "user", "assistant", "user", "assistant"] and [r.recovered for r in one] == [False, True, False, False, False]
    assert one[3].rendered == "<|im_start|>user\nwhy <​|im_end|>?<|im_end|>\n" and one[4].rendered == "<|im_start|>assistant\n<|im_end|>\n"
    assert [r.role for r in sorted((r for r in got if r.conv_id == 2), key=lambda r: r.turn)] == ["user", "assistant"] * 4 + ["user"]
    assert op5.render(df.limit(0)).count() == 0


def test_query_keeps_given_roles(spark):
    sf = "/root/testdata/sf0.001"
    rows = {(r.conv_id, r.turn): r for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()}
    got = op5.query(spark, sf).collect()
    assert len(got) == len(rows)
    assert np.mean([rows[r.conv_id, r.turn].role == r.role for r in got]) > 0.98
    for r in got:
        assert r.rendered == f"<|im_start|>{r.role}\n{rows[r.conv_id, r.turn].text.strip(' ')}<|im_end|>\n"


def test_recovers_hidden_roles(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    from pyspark.sql import functions as F

    hidden = df.withColumn("role", F.when(F.xxhash64("conv_id", "turn") % 2 == 0, F.col("role")))
    truth = {(r.conv_id, r.turn): r.role for r in df.collect()}
    got = op5.render(hidden).collect()
    assert np.mean([truth[r.conv_id, r.turn] == r.role for r in got]) > 0.9


def plain_viterbi(seen):
    e = op5.emissions(np.array(seen))
    best = op5.START + e[0]
    for row in e[1:]:
        best = (best[:, None] + op5.NEXT).max(axis=0) + row
    return best.max()


def test_whole_conversations_have_a_best_path(spark, monkeypatch):
    monkeypatch.setattr(op5, "CHUNK", 2)
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").selectExpr("conv_id", "turn", "if(turn % 3 = 0, null, role) AS role", "text")
    seen = {(r.conv_id, r.turn): r.seen for r in op5.features(df).collect()}
    got = {(r.conv_id, r.turn): op5.ROLES.index(r.role) for r in op5.roles(df).collect()}
    assert got.keys() == seen.keys()
    for conv in {c for c, _ in seen}:
        turns = sorted(t for c, t in seen if c == conv)
        assert np.isclose(score([seen[conv, t] for t in turns], [got[conv, t] for t in turns]), plain_viterbi([seen[conv, t] for t in turns]))


def test_one_conversation_of_equal_turns_is_cut_anywhere(spark, monkeypatch):
    monkeypatch.setattr(op5, "CHUNK", 50)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    df = spark.range(3000).selectExpr("7L AS conv_id", "CAST(NULL AS BIGINT) AS turn", "'user' AS role", "'hi' AS text").repartition(4)
    placed = op5.sorted_turns(df)
    assert placed.select("range").distinct().count() > 1 and placed.groupBy("range", "chunk").count().agg({"count": "max"}).first()[0] <= 50
    got = [r.role for r in op5.roles(df).collect()]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    first = op5.features(df).first().seen
    whole = np.array([first] * 3000)
    path = op5.decode(whole, *op5.borders([op5.matrix(whole)])[0])
    assert np.isclose(score(whole, path), plain_viterbi(whole)) and [got.count(r) for r in op5.ROLES] == np.bincount(path, minlength=3).tolist()


def rendered(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return [(r.turn, r.part, r.role, r.rendered.removeprefix(f"<|im_start|>{r.role}\n").removesuffix("<|im_end|>\n")) for r in sorted(op5.render(df).collect(), key=lambda r: (r.conv_id, r.turn, r.part))]


def test_a_row_may_hold_a_transcript(spark):
    assert rendered(spark, [(1, 0, None, "User: hi\nAssistant: hello\nUser: joke")]) == [(0, 0, "user", "hi"), (0, 1, "assistant", "hello"), (0, 2, "user", "joke")]
    text = "System: Be kind.\n\n### Human: What is it?\nI ask\n\n  **AI**: It is\n    User: quoted\nso: it\nand\n[assistant] more"
    assert rendered(spark, [(1, 0, "", text), (1, 1, "user", "and then?")]) == [(0, 0, "system", "Be kind.\n"), (0, 1, "user", "What is it?\nI ask\n"), (0, 2, "assistant", "It is\n    User: quoted\nso: it\nand"), (0, 3, "assistant", "more"), (1, 0, "user", "and then?")]
    assert [r[2:] for r in rendered(spark, [(1, 0, None, "Q: why?\nA: so.\nQ: and then?\nA: no.")])] == [("user", "why?"), ("assistant", "so."), ("user", "and then?"), ("assistant", "no.")]
    assert [r[1:] for r in rendered(spark, [(1, 0, "assistant", "Steps\na: one\nquestion: two")])] == [(0, "assistant", "Steps\na: one\nquestion: two")]
    assert [r[2] for r in rendered(spark, [(1, 0, "user", "Assistant: is what I am called, and who are you?")])] == ["user"]  # the column is the stronger evidence


def test_a_long_transcript_in_one_row(spark, monkeypatch):
    monkeypatch.setattr(op5, "CHUNK", 64)
    text = "\n".join(f"{'User' if k % 2 == 0 else 'Bot'}: line {k}" for k in range(5000))
    got = rendered(spark, [(1, 0, None, text), (2, 0, "user", "x")])
    assert got[:-1] == [(0, k, "user" if k % 2 == 0 else "assistant", f"line {k}") for k in range(5000)]

import random

from turnwright.operators.evaluate import edits, with_next
from turnwright.plans import registry


def table_of_distances(a, b):
    row = list(range(len(b) + 1))
    for k, x in enumerate(a, 1):
        new = [k]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edits_equal_the_table_of_distances():
    r = random.Random(2)
    for _ in range(2000):
        a, b = ([r.choice("abcdef"[: r.randrange(1, 7)]) for _ in range(r.choice([0, 1, 3, 20, 70, 150]))] for _ in range(2))
        assert edits(a, b) == table_of_distances(a, b)


def test_word_error_rates_read_whole_texts(spark, tmp_path):
    same = " ".join(f"w{k}" for k in range(50))
    texts = [(1, "en", f"{same} a b c d"), (2, "en", f"{same} a x y"), (3, None, same)]
    spark.createDataFrame(texts, "doc_id long, lang string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.wer for r in registry.queries()["f41_word_error_rate"](spark, str(tmp_path)).collect()}
    assert got == {1: 3 / 54, 2: 3 / 53}
    [row] = registry.queries()["a16_macro_wer"](spark, str(tmp_path)).collect()
    assert row.lang == "en" and row.n == 2 and row.wer == round((3 / 54 + 3 / 53) / 2, 4)


def test_edits_of_texts_with_few_words_in_common():
    r = random.Random(3)
    for _ in range(1000):
        own = "abc", "dexyz"
        a, b = ([r.choice("m" if r.random() < 0.2 else words) for _ in range(r.choice([1, 2, 29, 31, 64, 90]))] for words in own)
        assert edits(a, b) == edits(b, a) == table_of_distances(a, b)


def test_blocks_go_to_several_tasks_a_core(spark):
    """However few bytes they have: what a pair costs is its words multiplied."""
    docs = spark.createDataFrame([(k, f"t{k}") for k in range(1000)], "doc_id long, text string")
    pairs = with_next(docs, "doc_id", "text", "after")
    assert pairs.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism
    assert {(r.doc_id, r.after) for r in pairs.collect()} == {(k, f"t{k + 1}") for k in range(999)}

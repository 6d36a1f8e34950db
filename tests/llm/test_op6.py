import random
import re

import pytest

from turnwright.llm import op6_join


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """(doc_id, n_shingles, component_id) of rows (doc_id, text), by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and rows[a][0] is not None and rows[b][0] is not None and 100 * both >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    low = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            low[find(k)] = min(low.get(find(k), doc), doc)
    return sorted(((d, len(sets[k]), low[find(k)] if d is not None else None) for k, (d, _) in enumerate(rows)), key=str)


def corpus(seed, n=120):
    r = random.Random(seed)
    line = " ".join(r.choice("abcdefgh") for _ in range(12))
    texts = []
    for _ in range(n):
        if texts and r.random() < 0.6:
            words = r.choice(texts).split()
            for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
                k = r.randrange(len(words) + 1)
                words[k : k + r.randrange(2)] = [r.choice("abcdefgh")] * r.randrange(2)
            texts.append(" ".join(words) or "z")
        else:
            own = " ".join(r.choice("abcdefghijklmnop") + str(r.randrange(4)) for _ in range(r.choice([1, 2, 4, 5, 6, 9, 14, 20, 40])))
            texts.append(own if r.random() < 0.7 else f"{own} {line}" if r.random() < 0.5 else f"{line} {own}")
    return [(k, t.upper() if r.random() < 0.1 else t) for k, t in enumerate(texts)]


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted((tuple(r) for r in op6_join.join(df).collect()), key=str)


@pytest.mark.parametrize("light", [0, 4, 8])
def test_any_boundary_finds_all_links(spark, light, monkeypatch):
    monkeypatch.setattr(op6_join, "boundary", lambda *a: light)
    rows = corpus(light)
    assert run(spark, rows) == brute(rows)


def test_blocks_nulls_and_repeats(spark, monkeypatch):
    for name, value in (("BLOCK", 30), ("LARGEST", 60), ("STAR", 3), ("STARS", 1)):
        monkeypatch.setattr(op6_join, name, value)
    monkeypatch.setattr(op6_join, "BUCKET", 500)
    monkeypatch.setattr(op6_join, "SEEN", 200)
    rows = corpus(7, 100) + [(1000, None), (1001, ""), (1002, " \n"), (None, "a b c"), (3, "a b c"), (1003, "a b c"), (1003, "a b c"), (1004, " ".join(map(str, range(60_000))))]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("stars, block", [(0, 40), (1, 40), (2, 1 << 20), (0, 1 << 20)])
def test_copies_that_only_their_source_links(spark, stars, block, monkeypatch):
    """Each copy is like the source, and few are like another copy, so a hub of the group finds few links by itself."""
    for name, value in (("STARS", stars), ("BLOCK", block)):
        monkeypatch.setattr(op6_join, name, value)
    r = random.Random(5)
    rows = []
    for g in range(3):
        source = [f"{g}{r.choice('abcdefgh')}{k}" for k in range(90 + 20 * g)]
        for k in range(25):
            words = list(source)
            for at in r.sample(range(len(words)), 0 if k == 11 else 2):
                words[at] = f"x{g}{k}{at}"
            rows.append((100 * g + k, " ".join(words)))
    want = brute(rows)
    assert max(sum(c == d for *_, c in want) for d, *_ in rows) >= 10
    assert run(spark, rows) == want


def test_thue_morse_words(spark):
    word = "a"
    for _ in range(11):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, f"{word} a b c d"), (2, f"{other} a b c d"), (3, f"{other} a b c d")]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_dedup_keeps_one_of_each_group(spark):
    rows = corpus(3, 60)
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, component_id string")
    kept = op6_join.dedup(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, n, c in brute(rows)})


def test_costs():
    assert op6_join.overlap(5) == 4 and op6_join.subset_sizes(4) == [4] and op6_join.subset_sizes(10) == [8, 9, 10]
    assert op6_join.boundary({5: 100, 50: 10}, 1.0) == 12 or op6_join.boundary({5: 100, 50: 10}, 1.0) >= 0
    assert op6_join.boundary({8: 1000}, 500.0) >= 8 > op6_join.boundary({8: 1000}, 0.01)


def test_query_on_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in op6_join.query(spark, sf).collect()), key=str) == brute(rows)


def test_parts_of_a_survey_add_up(spark):
    """What one pass sends at once, several passes send one after the other; they find the same."""
    df = spark.createDataFrame([(d, t) for d, t in corpus(7, 100)], "doc_id long, text string").repartition(3)

    def lone(parts: int) -> dict:
        found: dict = {}
        for k in range(parts):
            for r in op6_join.survey(df, 6, k, parts).where("kind = 0").collect():
                found[r.key] = found.get(r.key, 0) + r.lone
        return found

    whole = lone(1)
    assert any(whole.values()) and whole == lone(3)


def test_only_one_document_of_a_class_puts_out_keys(spark, monkeypatch):
    seen, before = [], op6_join.signatures
    monkeypatch.setattr(op6_join, "signatures", lambda docs, *a: seen.append(docs.count()) or before(docs, *a))
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(k, text) for k in range(50)] + [(50, text + " more"), (51, "quite another text of a few words")]
    assert run(spark, rows) == brute(rows)
    assert seen == [2]


def test_marks_tell_most_of_what_goes(spark, monkeypatch):
    """Where nearly all documents go, their texts aren't shuffled to find out."""
    df = spark.createDataFrame([(k, f"text {k}") for k in range(400)] + [(None, "x")], "doc_id long, text string")
    stay, gone = df.where("doc_id % 10 = 0").select("doc_id"), df.where("doc_id % 10 > 0").select("doc_id")
    rows = op6_join.told(df, gone, stay).collect()
    assert sum(r["__stays"] is None for r in rows) < 5
    for bits in (op6_join.ALIVE, 1 << 8):
        monkeypatch.setattr(op6_join, "ALIVE", bits)
        for r in op6_join.told(df, gone, stay).collect():
            assert r["__stays"] in (None, r.doc_id is None or r.doc_id % 10 == 0)

import random
import re
from collections import Counter

import numpy as np

from turnwright.llm import op2_decontaminate as op2


def plain(text):
    return re.sub(r"[^\w\x20\x09-\x0D]|_", "", (text or "").lower()).split()


def grams(w):
    size = min(5, len(w))
    return Counter(tuple(w[k : k + size]) for k in range(len(w) - size + 1)) if w else Counter()


def brute(docs, items):
    """(doc_id, item_id, similarity) over all windows of all documents."""
    out = set()
    read = [(i, plain(x), grams(plain(x))) for i, x in items]
    for d, t in docs:
        w = plain(t)
        known = {size: {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} for size in range(1, 6)}
        for i, q, b in read:
            best = (0, 1)
            if not q or known[min(5, len(q))].isdisjoint(b):
                continue
            for k in range(len(w) - len(q) + 1) if q else ():
                a = grams(w[k : k + len(q)])
                pair = (sum((a & b).values()), sum((a | b).values()))
                if pair[0] * best[1] > best[0] * pair[1]:
                    best = pair
            if 100 * best[0] >= 80 * best[1]:
                out.add((d, i, best[0] / best[1]))
    return out


def run(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id, r.similarity) for r in op2.find_leaks(d, b).collect()}


def test_equals_brute_force(spark, monkeypatch):
    r = random.Random(3)
    words = [f"w{k}" for k in range(30)]
    items = [(k, " ".join(r.choice(words) for _ in range(r.choice([1, 3, 5, 12, 30])))) for k in range(25)]
    items += [(100, None), (101, ""), (102, items[0][1]), (103, "a a a a a a a a a a")]
    docs = []
    for k in range(60):
        parts = [" ".join(r.choice(words) for _ in range(r.randrange(30)))]
        for _ in range(r.randrange(3)):
            x = r.choice(items)[1] or ""
            w = x.split()
            if w and r.random() < 0.6:
                w[r.randrange(len(w))] = "changed"
            parts += ["“" + " ".join(w).upper() + "!!”", " ".join(r.choice(words) for _ in range(r.randrange(9)))]
        docs.append((k, r.choice([" ", "\n"]).join(parts)))
    docs += [(200, None), (201, ""), (202, docs[0][1]), (202, docs[0][1]), (203, "a " * 50), (204, "x y " * 100_000)]
    expected = brute(docs[:-1], items)
    assert len(expected) > 30
    assert run(spark, docs, items) == expected
    monkeypatch.setattr(op2, "ITEM_WORDS", 50)
    assert run(spark, docs, items) == expected


def test_empty_tables_and_clean(spark):
    assert run(spark, [], [(1, "a b")]) == set() and run(spark, [(1, "a b")], []) == set()
    docs = spark.createDataFrame([(1, "so this is the question of all questions then", "x"), (2, "nothing", "x"), (None, None, "x")], "doc_id long, text string, item_id string")
    items = spark.createDataFrame([(5, "this is the question of all questions")], "item_id long, text string")
    assert sorted(str(r.doc_id) for r in op2.clean(docs, items).collect()) == ["2", "None"]


def test_blocks_meet_all_pairs_in_the_radius():
    r = np.random.default_rng(0)
    a = r.integers(0, 1 << 63, (200, op2.BITS // 64), dtype=np.uint64)
    bits = np.unpackbits(a.view(np.uint8), axis=1, bitorder="little")
    for row in bits:
        row[r.permutation(op2.BITS)[: op2.RADIUS]] ^= 1
    b = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
    assert (np.bitwise_count(a ^ b).sum(axis=1) == op2.RADIUS).all()
    assert all(not set(x).isdisjoint(y) for x, y in zip(op2.blocks(a).tolist(), op2.blocks(b).tolist(), strict=True))


def planted(seed, n):
    """Items, and for each a text that is 80 to 90 % like it, with its fingerprint's keys."""
    r = random.Random(seed)
    items, texts = [], []
    while len(items) < n:
        item = [f"w{r.randrange(5000)}" for _ in range(r.choice([30, 60, 120]))]
        text = list(item)
        for k in r.sample(range(len(text)), r.choice([1, 1, 2, 3])):
            text[k] = f"x{r.randrange(5000)}"
        a, b = grams(item), grams(text)
        if 0.8 <= sum((a & b).values()) / sum((a | b).values()) <= 0.9:
            items.append(" ".join(item))
            texts.append(" ".join(text))
    return items, texts


def test_index_finds_similar_items_and_meets_few_others():
    items, texts = planted(1, 1500)
    found = op2.Items.of(list(range(len(items))), items)
    recall, met, possible = 0, 0, 0
    for k, t in enumerate(texts):
        w = op2.words(op2.plain(op2.pa.array([t])))
        value, weight, owner = op2.bags([np.sort(op2.shingles(w.hash))])
        near = found.met(op2.blocks(op2.fingerprints(value, weight, owner, 1))[0], len(t.split()))
        recall += k in near
        met += len(near) - (k in near)
        possible += int((found.length == len(t.split())).sum()) - 1
    print(f"recall {recall / len(texts):.5f}, met {met / possible:.4f}")
    assert recall >= 0.999 * len(texts) and met <= 0.05 * possible


def test_many_blocks_of_items(spark, monkeypatch):
    items, texts = planted(2, 120)
    docs = [(k, f"before it {t} and after") for k, t in enumerate(texts)] + [(1000 + k, f"clean text {k} of its own kind") for k in range(50)]
    monkeypatch.setattr(op2, "ITEM_WORDS", 1000)
    got = run(spark, docs, list(enumerate(items)))
    assert {(d, i) for d, i, _ in got} == {(k, k) for k in range(120)}


def test_query_on_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert {(r.doc_id, r.item_id, r.similarity) for r in op2.query(spark, sf).collect()} == brute(docs, items)


def test_texts_shorter_than_items(spark):
    r = random.Random(5)
    items = [(k, " ".join(f"v{r.randrange(40)}" for _ in range(r.choice([5, 6, 9, 12, 60])))) for k in range(20)] + [(50, "a a a a a a a a a a"), (51, "b c")]
    docs, expected = [], set()
    for k in range(400):
        w = r.choice(items)[1].split()
        w = w[r.randrange(2) : max(2, len(w) - r.randrange(-1, 8))]
        if r.random() < 0.2:
            w[r.randrange(len(w))] = "changed"
        docs.append((k, " ".join(w)))
    docs += [(500, " ".join(items[-3][1].split()[:3])), (501, "a a a a a a a a a"), (502, "b"), (503, "")]
    for d, t in docs:
        for i, q in items:
            if len(plain(t)) < len(plain(q)) and grams(plain(t)):
                a, b = grams(plain(t)), grams(plain(q))
                common, total = sum((a & b).values()), sum((a | b).values())
                if 100 * common >= 80 * total:
                    expected.add((d, i, common / total))
    assert len(expected) > 30 and any(d == 501 for d, _, _ in expected)
    assert run(spark, docs, items) == expected | brute(docs, items)
    item = " ".join(f"x{k}" for k in range(60))
    d = spark.createDataFrame([(1, " ".join(item.split()[:55]))], "doc_id long, text string")
    [leak] = op2.find_leaks(d, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert (leak.first_word, leak.n_words, leak.similarity) == (0, 55, 51 / 56)


def test_clean_heeds_items_without_id(spark):
    docs = spark.createDataFrame([(1, "this is the question of all questions"), (2, "nothing of the kind is said here")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "this is the question of all questions")], "item_id long, text string")
    assert [r.doc_id for r in op2.clean(docs, items).collect()] == [2] and op2.find_leaks(docs, items).count() == 0


def test_a_long_text_of_one_opening_that_many_items_share():
    """100 items of different lengths begin alike; a text holds the opening tens of thousands of times, and one item."""
    import resource
    import time

    opening = "which of the following is"
    items = [f"{opening} " + " ".join(f"w{k}_{j}" for j in range(10 + k)) for k in range(100)]
    words_of = op2.Items.of(list(range(100)), items)
    text = " ".join(f"{opening} x{k}" for k in range(60_000)) + " " + items[40]
    import pyarrow as pa

    from turnwright.llm.words import ngrams, words

    hashes = words(op2.plain(pa.array([text]))).hash
    known = np.isin(ngrams(hashes, op2.SIZE), words_of.known)
    before, began = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.perf_counter()
    found = list(op2.leaks(hashes, words_of, {op2.SIZE: np.flatnonzero(known)}))
    assert [f[0] for f in found] == [40] and found[0][1] == 6 * 60_000
    assert time.perf_counter() - began < 20 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 500_000

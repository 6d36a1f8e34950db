import hashlib
import random
from collections import Counter

import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from turnwright.llm import op13_align as op13
from turnwright.llm.op1_bpe import byte_characters

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
BACK = {c: b for b, c in byte_characters().items()}
ODD = "aB1 '\n\t\r\x0b\x0c\x1c\x85 　▁é中😀_.,;s|<>endoftext0x4"


def tokens(text):
    """(id, start, end) of both sides, told by the libraries on the whole text."""
    sides = []
    for ids, spell in ((A.encode(" " + text, add_special_tokens=False).ids, lambda i: bytes(BACK[c] for c in A.id_to_token(i))), (B.encode(text), lambda i: bytes([int(B.id_to_piece(i)[3:-1], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode())):
        out, at = [], 0
        for i in ids:
            out.append((i, at, at + len(spell(i))))
            at = out[-1][2]
        sides.append((out, b"".join(map(spell, ids)) == (" " + text).encode()))
    return (sides[0][0], sides[1][0]) if text and sides[0][1] and sides[1][1] else ([], [])


def brute(rows):
    docs = [(d, *tokens(t or "")) for d, t in rows]
    links = [[(b, a) for a, s, e in x for b, p, q in y if s < q and p < e] for _, x, y in docs]
    count = Counter(k for own in links for k in own)
    most = {}
    for (b, _), n in count.items():
        most[b] = max(most.get(b, 0), n)
    out = []
    for (d, x, y), own in zip(docs, links, strict=True):
        ends = sorted({e for *_, e in x} & {e for *_, e in y})
        text = ";".join("|".join(",".join(str(i) for i, _, e in side if lo < e <= hi) for side in (x, y)) for lo, hi in zip([0, *ends], ends, strict=False))
        out.append((d, len(x), len(y), len(ends), len(own), sum(count[k] == most[k[0]] for k in own), sum(count[k] for k in own), hashlib.sha256(text.encode()).hexdigest() if x else ""))
    return sorted(out, key=str)


def run(spark, rows, parts=3):
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, b string, rid int").repartition(parts)
    return sorted(map(tuple, op13.align(df).collect()), key=str)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(ODD, max_size=40), st.text(max_size=20)), min_size=1, max_size=6))
def test_texts_alone(texts):
    import pyarrow as pa

    numbers, digests, pairs = op13.aligner(op13.SIDE_A, op13.SIDE_B).align(pa.array(texts, pa.string()))
    for t, n, digest, (keys, often) in zip(texts, numbers.tolist(), digests, pairs, strict=True):
        [want] = brute([(0, t)])
        assert (*n, digest) == (*want[1:5], want[7]), t
        x, y = tokens(t or "")
        assert dict(zip(keys.tolist(), often.tolist(), strict=True)) == Counter(b << 32 | a for a, s, e in x for b, p, q in y if s < q and p < e)


def corpus(seed, n):
    r = random.Random(seed)
    words = ["the", "thhe", "naïve", "中文", "😀", "x_y", "a.b", "12", "1234567", "<|endoftext|>", "<s>", "it's", "Größe", "▁"]
    return [(k, r.choice([" ", "\n", "  ", "\r\n"]).join(r.choice(words[: r.choice([3, 13, 14])]) for _ in range(r.randrange(60)))) for k in range(n)]


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(op13, "POSTINGS", 5)
    rows = corpus(1, 80)
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    hot = "the " * 3000
    rows = [(1, None), (2, ""), (3, " "), (3, " "), (4, "one"), (None, "one two"), (5, "a▁b"), (6, hot), (6, hot), (7, "\n"), (8, "x\0y")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_long_texts(spark):
    long = " ".join(f"word{k % 5000} thing" for k in range(400_000))
    blob = "ab" * 500_000
    got = {r[0]: r for r in run(spark, [(1, long), (2, blob), (3, None)])}
    for k, t in ((1, long), (2, blob)):
        assert got[k][1:3] == (len(A.encode(" " + t, add_special_tokens=False).ids), len(B.encode(t)))


def test_small_cache_gives_the_same(spark, monkeypatch):
    rows = corpus(2, 40)
    monkeypatch.setattr(op13, "CACHED_CUTS", 10)
    monkeypatch.setattr(op13, "PIECE", 64)
    assert run(spark, rows) == brute(rows)

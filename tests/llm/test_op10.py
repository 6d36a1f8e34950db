import math
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa

from turnwright.llm import op10_language as op10

PIECES = op10.vocabulary(op10.VOCABULARY)
KNOWN = {t: k for k, t in enumerate(PIECES.pieces)}


def all_ways(data, p):
    """Segmentations of data: their probability in all, and each piece's expected uses, one by one."""
    if not data:
        return [(1.0, [])]
    out = []
    for k in range(1, len(data) + 1):
        if data[:k] in KNOWN:
            out += [(p[KNOWN[data[:k]]] * q, [KNOWN[data[:k]], *used]) for q, used in all_ways(data[k:], p)]
    return out


def scored(texts, p):
    lattice = op10.Lattice(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]), PIECES)
    with np.errstate(divide="ignore"):
        each = lattice.log_likelihood(p[:, None], np.log(p[:, None]))[:, 0]
    return lattice, np.bincount(lattice.owner, each, len(texts))


def one_by_one(data, p):
    """The probability of all segmentations and each piece's expected uses, as exact fractions, whatever the length."""
    ahead, behind = [Fraction(0)] * (len(data) + 1), [Fraction(0)] * (len(data) + 1)
    ahead[0] = behind[-1] = Fraction(1)
    spans = [(a, b, KNOWN[data[a:b]]) for a in range(len(data)) for b in range(a + 1, len(data) + 1) if data[a:b] in KNOWN]
    for a, b, k in sorted(spans, key=lambda x: x[1]):
        ahead[b] += ahead[a] * p[k]
    for a, b, k in sorted(spans, key=lambda x: -x[0]):
        behind[a] += behind[b] * p[k]
    use = {}
    for a, b, k in spans:
        use[k] = use.get(k, 0.0) + float(ahead[a] * p[k] * behind[b] / ahead[-1])
    return ahead[-1], use


def test_sums_over_all_segmentations():
    p = np.append(np.random.default_rng(0).random(len(KNOWN)), 0)
    texts = [b" there", b" \xc3\xa9t\xc3\xa9", b" a", b" thing,"]
    lattice, got = scored(texts, p)
    use = np.zeros(len(p))
    for t, g in zip(texts, got, strict=True):
        ways = all_ways(t, p)
        total = sum(q for q, _ in ways)
        assert np.isclose(g, np.log(total))
        for q, used in ways:
            np.add.at(use, used, 2 * q / total)
    assert np.allclose(lattice.expected(p[:, None], np.full(4, 2.0)), use)


def test_long_words_and_pieces():
    draw = np.random.default_rng(1)
    p = np.append(draw.integers(1, 1 << 20, len(KNOWN)) / float(1 << 40), 0)
    letters = "".join(chr(c) for c in draw.integers(97, 123, 200))
    texts = [f" {x}".encode() for x in (letters, "=" * 130, "Straßenbahnhaltestelle" * 5, "中文分词没有空格" * 8, "http://example.org/aaaa/bbbb?cccc=dddd&e", "été")]
    lattice, got = scored(texts, p)
    use = np.zeros(len(p))
    for t, g in zip(texts, got, strict=True):
        total, own = one_by_one(t, [Fraction(int(x * (1 << 40)), 1 << 40) for x in p[:-1]])
        assert np.isclose(g, math.log(total.numerator) - math.log(total.denominator))
        for k, n in own.items():
            use[k] += 3 * n
    assert np.allclose(lattice.expected(p[:, None], np.full(len(texts), 3.0)), use)
    assert max(len(PIECES.pieces[k]) for k in np.flatnonzero(use)) >= 64


def test_every_piece_is_found():
    data = [t for t in PIECES.pieces]
    assert len(data) == 50_256
    ends = np.cumsum([0, *map(len, data)])
    start, length, piece = PIECES.matches(np.frombuffer(b"".join(data), np.uint8), ends)
    whole = length == np.diff(ends)[np.searchsorted(ends, start, side="right") - 1]
    assert (piece[whole] == np.arange(len(data))).all()
    for a, n, k in zip(start[:500], length, piece):
        assert b"".join(data[:600])[a : a + n] == data[k]


def test_query_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in op10.query(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(rows)
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert {r.doc_id for r in held} == {d for d, r in got.items() if r.held_out}
    assert np.mean([got[r.doc_id].lang_pred == r.lang for r in held]) >= 0.97


def test_odd_rows(spark):
    rows = [(k, f"the cat {k} sat", "en", "x") for k in range(30)] + [(100 + k, f"der Hund {k} saß", "de", "x") for k in range(30)]
    odd = [(200, None, "en", "x"), (201, "", None, "x"), (202, "123 ...", "de", "x"), (None, "the cat", "en", "x"), (203, "the cat", None, "x"), (204, "saß " * 200_000, None, "x"), (205, "w" * 10_000, None, "x")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, score string")
    model = op10.learn(docs)
    got = {r.doc_id: r for r in op10.predict(docs, model).collect()}
    assert model.languages == ["de", "en"]
    assert [got[k].lang_pred for k in (200, 201, 202)] == ["und"] * 3
    assert got[203].lang_pred == got[None].lang_pred == "en" and got[204].lang_pred == "de" and got[205].lang_pred in ("de", "en")
    none = docs.where("lang = 'xx'")
    assert op10.predict(docs, op10.learn(none)).where("lang_pred = 'und'").count() == 67
    assert op10.predict(none, model).count() == 0


def test_sums_of_a_long_part_are_kept_in_a_ring():
    """One word of 300 KB: the last sums give what all of them do, and memory doesn't follow the word."""
    import tracemalloc

    pieces = op10.vocabulary(op10.VOCABULARY)
    text = "ab=" * 100_000
    data, ends, *_ = op10.strings(pa.array([text]))
    lattice = op10.Lattice(data, ends, pieces)
    log_p = np.log(np.full((lattice.none + 1, 3), 1e-4))
    for _, edges in lattice.long():
        tracemalloc.start()
        last = lattice.logs(edges, log_p)
        assert tracemalloc.get_traced_memory()[1] < 5_000_000
        tracemalloc.stop()
        assert np.allclose(last, lattice.logs(edges, log_p, whole=True)[-1])

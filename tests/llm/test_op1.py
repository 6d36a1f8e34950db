import base64
import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from turnwright.llm import op1_bpe

RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
OWN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ODD = "aB1 '\n\t\r\x0b\x1c\x1f\x85    　é́ñ中😀٣_.,s|<>endoftext"


def both(texts):
    codec = op1_bpe.encoder(op1_bpe.VOCABULARY)
    column = pa.array(texts, pa.string())
    ids, offsets = codec.encode(column)
    data, ends = codec.decode(ids.astype(np.int64), offsets)
    for k, t in enumerate(texts):
        assert ids[offsets[k] : offsets[k + 1]].tolist() == OWN.encode_ordinary(t or ""), t
        assert data[ends[k] : ends[k + 1]].tobytes() == (t or "").encode()
    starts, stops = codec.spans(column, ids, offsets)
    for k, t in enumerate(texts):
        for i in range(offsets[k], offsets[k + 1]):
            assert OWN.decode_single_token_bytes(int(ids[i])) in (t or "")[starts[i] : stops[i]].encode()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(ODD, max_size=40), st.text(max_size=20)), max_size=6))
def test_equals_the_rank_encoder(texts):
    both(texts)


def test_every_code_point():
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    step = 4000
    both([" a" + "b ".join(points[k : k + step]) for k in range(0, 0x30000, step)])


def test_query_columns_nulls_and_repeats(spark):
    texts = ["it's <|endoftext|> fine\n\n  now", None, "", "naïve 中文 😀", "it's <|endoftext|> fine\n\n  now", "x" * 3_000_000]
    rows = [(k, t, 7) for k, t in enumerate(texts)]
    df = op1_bpe.decode(op1_bpe.encode(spark.createDataFrame(rows, "doc_id long, text string, ids int"), spans=True))
    got = {r.doc_id: r for r in df.collect()}
    for k, t in enumerate(texts):
        assert bytes(got[k].decoded) == (t or "").encode() and len(got[k].ids) == len(got[k].starts) == len(got[k].ends)
    assert got[0].ids == got[4].ids == OWN.encode_ordinary(texts[0]) and got[1].ids == []
    assert op1_bpe.encode(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in op1_bpe.query(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = OWN.encode_ordinary(r.text or "")
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_thue_morse_words():
    word = "a"
    for k in range(12):
        word += word.translate(str.maketrans("ab", "ba"))
        if k >= 8:
            other = word.translate(str.maketrans("ab", "ba"))
            both([word, other, f"{word} {other} {word}"])


def test_equal_hashes_of_unequal_cuts(monkeypatch):
    monkeypatch.setattr(op1_bpe, "range_hashes", lambda buf, cuts: np.zeros(len(cuts) - 1, np.uint64))
    both(["one two six one", None, "six", "one two"])

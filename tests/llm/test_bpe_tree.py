"""Operator 6: ids equal the tokenizers library's, round trips are exact."""

import hashlib
import random

import pytest
from tokenizers import Tokenizer

import public_tokenizers
from pomelo.llm import bpe_tree as B
from pomelo.llm.common import prepare

SF_SMALL = "/root/testdata/sf0.001"
LIB = Tokenizer.from_file(public_tokenizers.path(B.VOCAB))
ONE = B.encoder(B.VOCAB)


def lib_ids(text):
    return LIB.encode(text, add_special_tokens=False).ids


def test_every_character_of_the_fast_range_splits_like_the_library():
    chars = [chr(c) for c in range(0x250)]
    for c in chars:
        for t in (f"a{c}b", f"a {c} 1{c}2", f"{c}{c}", f" {c}'s", f"!{c}?", f"\n{c}\n {c}  {c}x"):
            assert ONE.encode(t).tolist() == lib_ids(t), repr(t)
    rng = random.Random(5)
    for _ in range(3000):
        t = "".join(rng.choices(chars + list(" '\n\t") * 40, k=rng.randint(1, 40)))
        assert ONE.encode(t).tolist() == lib_ids(t), repr(t)


@pytest.mark.parametrize("alphabet", ["ab", "thes ", "ab \n", "aé漢 ", "'s !?", "0123 ", "漢字", " ", "\n ", "ing"])
def test_joins_at_any_seam_are_exact(alphabet):
    rng = random.Random(len(alphabet))
    for _ in range(120):
        t = "".join(rng.choices(alphabet, k=rng.randint(2, 1500)))
        k = rng.randint(1, len(t) - 1)
        assert ONE.join(ONE.parts(t[:k]), ONE.parts(t[k:])).ids.tolist() == lib_ids(t)
        assert ONE.encode(t).tolist() == lib_ids(t)


def test_long_unsplit_text():
    rng = random.Random(1)
    for t in ("a" * 5000, "".join(rng.choices("abcdefgh", k=20000)), " " * 3000 + "x", "ab" * 4000):
        assert ONE.encode(t).tolist() == lib_ids(t)


def test_operator_over_rows(spark):
    prepare(spark)
    rng = random.Random(3)
    texts = [None, "", " ", "plain text", "a <|endoftext|> b<|endoftext|>", "漢字 and words", "x" * 900,
             " ".join("".join(rng.choices("abcdeé ", k=9)) for _ in range(400)),
             "".join(rng.choices("ab", k=2500)), "seam<|endoftext|>" * 200]
    rows = [(i, t, "own", i) for i, t in enumerate(texts)] + [(8, texts[8], "own", 8), (None, texts[7], None, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded int")
    out = B.decode(B.encode(df, leaf_chars=100)).collect()
    got = sorted((r.doc_id is None, r.doc_id or 0, list(r.ids), r.decoded) for r in out)
    want = sorted((i is None, i or 0, lib_ids(t or ""), LIB.decode(lib_ids(t or ""), skip_special_tokens=False))
                  for i, t, *_ in rows)
    assert got == want


def test_query_matches_library_on_the_test_table(spark):
    from pomelo.llm.queries import QUERIES
    got = {r.doc_id: r for r in QUERIES["op6_bpe_tree"](spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = lib_ids(d.text or "")
        assert got[d.doc_id].n_tokens == len(ids)
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256(
            LIB.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert B.encode_decode_report(df).count() == 0

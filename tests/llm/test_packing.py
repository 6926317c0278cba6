"""Operator 8: ids and pieces as the library gives them, sequences gapless and few."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from pomelo.llm import packing as K
from pomelo.llm import word_bpe
from pomelo.llm.common import prepare

SF_SMALL = "/root/testdata/sf0.001"
LIB = Tokenizer.from_file(public_tokenizers.path(word_bpe.VOCAB))


def lib_ids(text):
    return LIB.encode(text, add_special_tokens=False).ids


def test_word_ids_match_the_library_for_every_character_of_the_fast_range():
    one, rng = word_bpe.encoder(word_bpe.VOCAB), random.Random(2)
    chars = [chr(c) for c in range(0x250)]
    for c in chars:
        for t in (f"a{c}b", f"A {c} 1{c}2", f"{c}{c}'S", f"!{c}?", f"'{c}"):
            assert one.encode(t).tolist() == lib_ids(t), repr(t)
    for _ in range(3000):
        t = "".join(rng.choices(chars + list(" 'stlv\n") * 40, k=rng.randint(0, 40)))
        assert one.encode(t).tolist() == lib_ids(t), repr(t)
    for t in ("été", "漢字 ok", "a<|endoftext|>B", "ΣΣ \U0001F600", "İx", "a\x1eb"):
        assert one.encode(t).tolist() == lib_ids(t)


def test_words_are_remembered_within_a_bound(monkeypatch):
    monkeypatch.setattr(word_bpe, "KNOWN", 50)
    one, rng = word_bpe.WordBpe(), random.Random(3)
    for _ in range(400):
        t = " ".join(rng.choice("the cat's Été 12,000 zqxv hyperparameters".split()) + rng.choice(["", "s", str(rng.randint(0, 999))])
                     for _ in range(rng.randint(0, 12)))
        assert one.encode(t).tolist() == lib_ids(t), repr(t)
        assert len(one.words) <= 50 + 60 and len(one.ends) == len(one.words) + 1
    long = "x" * 5000 + " a"
    assert one.encode(long).tolist() == lib_ids(long) == one.encode(long).tolist()
    assert one.encode("").tolist() == one.encode(" \t").tolist() == []


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for s in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= s]
        if fits:
            g = min(fits)
            gaps.remove(g)
            gaps.append(g - s)
        else:
            gaps.append(capacity - s)
    return len(gaps)


def test_places_are_gapless_and_few():
    rng = np.random.default_rng(4)
    for lengths in (rng.integers(1, 101, 400), rng.integers(20, 70, 300), np.full(50, 100), np.ones(7, int), np.zeros(0, int)):
        bins, offsets = K.place(lengths, 100)
        fill = defaultdict(list)
        for b, o, n in zip(bins, offsets, lengths):
            fill[b].append((o, n))
        for parts in fill.values():
            at = 0
            for o, n in sorted(parts):
                assert o == at
                at += n
            assert at <= 100
        few = best_fit_decreasing(lengths.tolist(), 100)
        assert len(fill) <= few * 1.03 + 1
        assert len(fill) >= -(-int(lengths.sum()) // 100)


def check_rows(rows, texts):
    """Rows against ids of the library; texts: list of (id, text)."""
    want = []
    for i, t in texts:
        ids = [*lib_ids(t or ""), 0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at:at + 2048]
            want.append((i, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(got, key=key) == sorted(want, key=key)
    fill = defaultdict(list)
    for r in rows:
        fill[r.sequence_id].append((r.offset, r.length))
    for parts in fill.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 2048
    total = sum(w[3] for w in want)
    assert len(fill) <= total / 2048 * 1.02 + 1
    return len(fill)


def test_query_on_the_test_table(spark):
    from pomelo.llm.queries import QUERIES
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    check_rows(QUERIES["op8_sum_of_squares_packing"](spark, SF_SMALL).collect(), [(d.doc_id, d.text) for d in docs])


def test_odd_rows_many_partitions_and_clashing_columns(spark):
    prepare(spark)
    texts = [(i, "word " * (i * 37 % 5000)) for i in range(60)] + [(3, "again"), (3, "again"), (None, None), (None, "x"), (7, "")]
    df = spark.createDataFrame([(i, t, 1, 2, "p") for i, t in texts],
                               "doc_id long, text string, length int, offset int, part string").repartition(9)
    check_rows(K.packed(df).collect(), texts)
    ids = K.pieces(df, with_ids=True).where("doc_id = 3 and length = 2").select("ids").first().ids
    assert ids == [*lib_ids("again"), 0]


def bins_of(rows, capacity):
    """Number of sequences; none has gaps or too much."""
    fill = defaultdict(list)
    for r in rows:
        fill[r.sequence_id].append((r.offset, r.length))
    for parts in fill.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= capacity
    return len(fill)


def test_pieces_stored_by_length_share_sequences(spark):
    prepare(spark)
    df = spark.range(12_000, numPartitions=5).selectExpr("id", "if(id < 6000, 1100L, 900L) AS length")
    rows = K.pack(df).collect()
    assert sorted(r.id for r in rows) == list(range(12_000))
    assert bins_of(rows, 2048) == 6000


def test_short_pieces_lose_no_sequence_per_shard(spark):
    prepare(spark)
    df = spark.range(60_000, numPartitions=3).selectExpr("id", "15 + id % 11 AS length")
    whole = K.place(15 + np.arange(60_000) % 11, 2048)[0].max() + 1
    assert bins_of(K.pack(df).collect(), 2048) <= whole
    assert bins_of(K.pack(df, 2048, 64 * 2048).collect(), 2048) <= whole + 1       # ten shards


def test_shards_are_packed_again_until_one_is_left(spark):
    prepare(spark)
    rng = np.random.default_rng(8)
    size = rng.integers(1, 101, 3000)
    df = spark.createDataFrame([(i, int(n)) for i, n in enumerate(size)], "id long, length long")
    rows = K.pack(df, 100, 1000).collect()          # 150 shards of ten sequences
    assert sorted((r.id, r.length) for r in rows) == list(enumerate(size.tolist()))
    assert bins_of(rows, 100) <= best_fit_decreasing(size.tolist(), 100) * 1.05


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert K.packed(df).count() == 0

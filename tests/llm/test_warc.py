"""Operator 13: records, salvage of damaged archives, and rows against brute force."""

import base64
import glob
import gzip
import hashlib
import os
import random

import pytest

from pomelo.llm import warc as W
from pomelo.llm.common import prepare, table

SF = "/root/testdata/sf0.01"
PAYLOADS = [b"", b"plain", b"a\r\n\r\nb", b"WARC/1.1\r\nquoted", W.MAGIC + b"not a member", bytes(range(256)) * 40, b"last"]


def plain(rows):
    largest = {}
    for page, html in rows:
        known = largest.get(html or "")
        largest[html or ""] = page if known is None else known if page is None else max(known, page)
    want = []
    for page, html in rows:
        data, last = (html or "").encode(), largest[html or ""]
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((page, len(data), digest, *(("response", None) if page == last else ("revisit", last))))
    return sorted(want, key=repr)


def archive(compressed):
    records = [W.page_record(i, f"http://h/{i}", p, None, False) for i, p in enumerate(PAYLOADS)]
    parts = [W.member(r) if compressed else r for r in records]
    return parts, W.END_MEMBER if compressed else b""


def read(data):
    """Payloads and gaps of an archive; records and gaps lie side by side and cover it."""
    payloads, gaps, at = [], [], 0
    for offset, length, what in W.salvage(data):
        assert offset == at or length == 0 or offset + length == at
        at = offset + length
        if isinstance(what, str):
            gaps.append((offset, length))
        else:
            payloads.append(what.payload())
    return payloads, gaps


@pytest.mark.parametrize("compressed", [True, False])
def test_whole_archive(compressed):
    parts, tail = archive(compressed)
    assert read(b"".join(parts) + tail) == (PAYLOADS, [])
    if compressed:
        assert gzip.decompress(b"".join(parts) + tail) == b"".join(archive(False)[0])


@pytest.mark.parametrize("compressed", [True, False])
def test_every_damaged_record_alone_is_lost(compressed):
    parts, tail = archive(compressed)
    rng = random.Random(5)
    for k, part in enumerate(parts):
        start = sum(map(len, parts[:k]))
        for _ in range(25):
            hurt = bytearray(part)
            # not gzip's ignored time and system fields; uncompressed headers have no check sum of their own
            at = rng.randrange(10 if compressed else hurt.index(W.END) + 4, len(hurt))
            hurt[at] ^= 1 << rng.randrange(8)
            payloads, gaps = read(b"".join(parts[:k]) + bytes(hurt) + b"".join(parts[k + 1:]) + tail)
            if gaps:
                assert payloads == PAYLOADS[:k] + PAYLOADS[k + 1:]
                assert (start, len(part)) in gaps
            else:                                                        # a bit of a header that no check covers
                assert payloads == PAYLOADS


@pytest.mark.parametrize("compressed", [True, False])
def test_foreign_bytes_between_records(compressed):
    parts, tail = archive(compressed)
    for junk in (b"\x00" * 9, W.MAGIC + b"oops", b"WARC/1.1\r\n", b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nab",
                 parts[3][:-3], parts[5][7:]):
        payloads, gaps = read(b"".join(parts[:3]) + junk + b"".join(parts[3:]) + tail)
        assert payloads == PAYLOADS
        assert gaps == [(sum(map(len, parts[:3])), len(junk))]
    assert read(b"junk" + b"".join(parts) + tail) == (PAYLOADS, [(0, 4)])


@pytest.mark.parametrize("compressed", [True, False])
def test_cut_off_archive(compressed):
    parts, tail = archive(compressed)
    whole = b"".join(parts)
    for cut in range(len(whole) - len(parts[-1]) + 1, len(whole)):
        payloads, gaps = read(whole[:cut])
        assert payloads == PAYLOADS[:-1]
        assert gaps[0] == (len(whole) - len(parts[-1]), cut - (len(whole) - len(parts[-1])))
    assert read(whole + tail) == (PAYLOADS, [])
    if compressed:
        assert read(whole) == (PAYLOADS, [(len(whole), 0)])
    assert list(W.salvage(b"")) == []


def test_wrong_digest_and_length():
    good = W.page_record(1, "http://h/1", b"some payload", None, False)
    for old, new in ((b"some payload", b"sume payload"), (b"WARC-Block-Digest: sha1:", b"WARC-Block-Digest: sha1:A"),
                     (b"\r\nContent-Length: 9", b"\r\nContent-Length: 8"), (b"WARC-Type: response", b"WARC-Tipe: response")):
        assert old in good
        with pytest.raises(W.Damaged):
            W.parse_record(good.replace(old, new), 0)
    folded = good.replace(b"WARC-Date: ", b"WARC-Date:\r\n ")
    assert W.parse_record(folded, 0).headers["warc-date"] == W.DATE
    odd = W.parse_record(W.page_record(1, "http://h/é \r\nX: y", b"", None, False), 0)
    assert odd.headers["warc-target-uri"] == "http://h/%C3%A9%20%0D%0AX:%20y" and "x" not in odd.headers


def test_query_against_brute_force(spark):
    from pomelo.llm.queries import QUERIES
    rows = [(r.page_id, r.html) for r in table(spark, SF, "pages").collect()]
    got = QUERIES["op13_warc_salvage"](spark, SF)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows)


def pages(spark):
    rows = [(k, f"http://h/{k}", f"<p>{k % 50}</p>" + "x" * (k % 7)) for k in range(300)]
    rows += [(1000 + k, None, "hot payload") for k in range(400)]
    rows += [(5, "u", None), (6, "u", ""), (None, "u", ""), (None, None, "alone"), (None, "v", "alone"), (7, "u", "é" * 100_000), (8, "u", "twice"), (8, "u", "twice")]
    df = spark.createDataFrame([(*r, 0, "k", 1) for r in rows], "page_id long, url string, html string, n long, key string, last int")
    return rows, df


def test_odd_and_hot_rows(spark):
    prepare(spark)
    rows, df = pages(spark)
    want = plain([(p, h) for p, _, h in rows])
    assert sorted(map(tuple, W.report(df, archive_bytes=2000).collect()), key=repr) == want
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:                                          # the shuffled join, as with many shared payloads
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert sorted(map(tuple, W.report(df.repartition(7), archive_bytes=2000).collect()), key=repr) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("compressed", [True, False])
def test_damaged_files_on_disk(spark, tmp_path, compressed):
    prepare(spark)
    rows, df = pages(spark)
    path = str(tmp_path / "w")
    W.write_archives(W.plan_records(df).repartition(3), path, compressed, archive_bytes=4000)
    files = sorted(glob.glob(path + "/part-*"))
    assert len(files) > 10
    sound = W.read_archives(spark, path).where("kind = 'record'").count()
    hurt = open(files[0], "rb").read()
    parts = [x for x in W.salvage(hurt) if x[1]]
    offset, length, _ = parts[2]
    damaged = bytearray(hurt)
    damaged[offset + length - 6] ^= 0x55             # in the block, or in the member's check sum
    (tmp_path / "hurt").mkdir()
    for k, name in enumerate(files):
        data = open(name, "rb").read()
        (tmp_path / "hurt" / f"{k}.warc").write_bytes(damaged if k == 0 else data[:-30] if k == 1 else data)
    got = W.read_archives(spark, str(tmp_path / "hurt"))
    assert got.where("kind = 'record'").count() == sound - 2
    gaps = {(os.path.basename(r.path), r.offset, r.length) for r in got.where("kind = 'gap'").collect()}
    assert ("0.warc", offset, length) in gaps and {g[0] for g in gaps} == {"0.warc", "1.warc"}


def test_empty_table(spark):
    prepare(spark)
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert W.report(df).count() == 0

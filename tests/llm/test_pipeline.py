"""The pipeline against its operators' brute-force forms, stage by stage."""

import zlib

import pytest

import corpus_pipeline as P
from pomelo.llm.common import prepare, table
from test_outlier_rules import plain_statistics
from test_packing import check_rows
from test_secret_dfa import plain_spans
from test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"


def written(spark, df, path):
    df.write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_stages_one_by_one(spark, tmp_path):
    docs = table(spark, SF, "documents")
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    columns = docs.columns
    before = docs
    for i, (name, stage) in enumerate(P.STAGES[:-1]):
        after = written(spark, stage(spark, before, SF), tmp_path / str(i))
        assert after.columns == columns
        old, new = {r.doc_id: r for r in before.collect()}, {r.doc_id: r for r in after.collect()}
        assert set(new) <= set(old) and len(new) == after.count()
        gone = set(old) - set(new)
        if name == "quality classifier":
            known = [d for d in old if d in labels and zlib.crc32(str(d).encode()) % 4 == 2]
            assert sum((d in new) == (labels[d] == 1) for d in known) >= 0.9 * len(known)
        elif name == "quality rules":
            assert all(not plain_statistics(new[d].text)[5] for d in new)
            assert all(labels.get(d) != 1 for d in gone if not plain_statistics(old[d].text)[5])
        elif name == "near-duplicates":
            ids = sorted(old)
            assert set(new) == set(plain_components([plain_fingerprint(old[d].text) for d in ids], ids))
        else:
            assert not gone
            for d in old:
                assert plain_spans(new[d].text) == []
                assert (new[d].text == old[d].text) == (plain_spans(old[d].text) == [])
                assert new[d].n_chars == len(new[d].text)
        before = after
    rows = written(spark, P.STAGES[-1][1](spark, before, SF), tmp_path / "last").collect()
    check_rows(rows, [(r.doc_id, r.text) for r in before.collect()])
    want = sorted((r.doc_id, r.piece, r.ids_crc32) for r in rows)
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in P.run(spark, SF).collect()) == want


@pytest.mark.parametrize("rows", [0, 40])
def test_odd_documents_and_extra_columns(spark, tmp_path, rows):
    prepare(spark)
    texts = ["", None, "x", "good words of a plain text " + " ".join(f"w{k}" for k in range(90))]
    data = [(i % 35, texts[i % 4], None, "s", 1, "fp", float(i)) for i in range(rows)] + [(None, texts[3], None, None, None, None, None)] * (rows > 0)
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, fp string, kept double")
    for i, (_, stage) in enumerate(P.STAGES):
        out = written(spark, stage(spark, docs, SF), tmp_path / f"{rows}-{i}")
        if i < len(P.STAGES) - 1:
            assert out.columns == docs.columns
            docs = out
    assert (out.count() > 0) == (docs.count() > 0)

import zlib

import numpy as np
import pytest
from conftest import SF_CHECK

import __spark_entry__ as E
import corpus_pipeline as P
from agroframe.llm import mixing, packing, toxicity
from agroframe.llm.tokens import byte_bpe, encoder
from test_neardup import brute


@pytest.fixture(scope="module")
def stages(spark):
    """Input and rows of every stage, each stage run on what its predecessor kept."""
    docs, out = spark.read.parquet(f"{SF_CHECK}/documents.parquet"), []
    columns = docs.columns
    for name, stage in P.STAGES:
        rows = stage(spark, docs, SF_CHECK).collect()
        out.append((name, docs, rows))
        if name != P.STAGES[-1][0]:
            docs = spark.createDataFrame(rows, docs.schema)
            assert docs.columns == columns
    return {name: (docs, rows) for name, docs, rows in out}


def test_toxic_documents_go(spark, stages):
    docs, rows = stages["toxicity"]
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    scores = toxicity.score(docs, toxicity.fit(toxicity.sample(docs, labels))).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in scores if not r.predicted}
    toxic = {r.doc_id for r in labels.where("toxic = 1").collect()}
    clean = {r.doc_id for r in labels.where("toxic = 0").collect()}
    kept = {r.doc_id for r in rows}
    assert len(toxic & kept) < 0.5 * len(toxic) and len(clean & kept) > 0.99 * len(clean)


def test_one_of_each_group_stays(stages):
    docs, rows = stages["near_dedup"]
    want = {d for d, _, c in brute([(r.doc_id, r.text) for r in docs.collect()], 5, 80) if d == c}
    assert {r.doc_id for r in rows} == want and len(rows) == len(want)


def test_mix_is_the_calibrated_draw(stages):
    docs, rows = stages["mixing"]
    assert {r.doc_id for r in rows} == {r.doc_id for r in mixing.mix(docs).collect() if r.sampled}
    assert 0 < len(rows) < docs.count()


def test_pieces_are_the_documents(stages):
    docs, rows = stages["packing"]
    plain, want = encoder(byte_bpe()).tokenizer, []
    for r in docs.collect():
        ids, at = plain.encode(r.text or "", add_special_tokens=False).ids + [1], 0
        for n in packing.piece_lengths(len(ids)):
            want.append((r.doc_id, at, n, zlib.crc32(np.array(ids[at:at + n], dtype="<u4").tobytes()), len(ids)))
            at += n
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == sorted(want)


def test_run_is_the_stages(spark, stages):
    got = E.queries()["pipeline"](spark, SF_CHECK).drop("sequence_id").collect()
    rows = [r for r in stages["packing"][1]]
    cols = [c for c in rows[0].asDict() if c != "sequence_id"]
    assert sorted(tuple(r[c] for c in cols) for r in got) == sorted(tuple(r[c] for c in cols) for r in rows)


@pytest.mark.parametrize("name,stage", P.STAGES)
def test_odd_documents(spark, name, stage):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (2, "a b", None, "s", 3), (2, "a b", None, "s", 3),
                                (3, "long " * 30000, "en", None, 1)], schema)
    stage(spark, df, "/root/testdata/sf0.001").collect()
    assert stage(spark, df.limit(0), "/root/testdata/sf0.001").count() == 0

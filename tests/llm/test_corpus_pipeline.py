import re

import corpus_pipeline
import pytest
from helpers import collected, frame, texts
from test_decontaminate import plain as plain_hits
from test_packing import check, plain_ids
from test_secret_scan import plain_base
from test_simhash import plain_components, plain_fingerprint

from ledgermart.llm import toxicity
from ledgermart.llm.common import read, written
from ledgermart.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


def test_thirteen_queries_are_registered():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert ORACLES.keys() <= QUERIES.keys()


def test_stages_one_after_another_equal_plain_python(spark):
    columns = read(spark, SMALL, "documents").columns
    docs = read(spark, SMALL, "documents")
    rows = dict(collected(docs, "doc_id", "text"))
    stages = dict(corpus_pipeline.STAGES)
    assert len(corpus_pipeline.STAGES) == 5

    model = toxicity.train(docs, read(spark, SMALL, "labels"), grade="toxic")
    kept = written(stages["ordinal_toxicity"](spark, docs, SMALL), "t1")
    rows = {i: t for i, t in rows.items() if not model.thresholds or model.at_least(t)[0] < 0.5}
    assert kept.columns == columns and dict(collected(kept, "doc_id", "text")) == rows

    kept = written(stages["simhash_dedup"](spark, kept, SMALL), "t2")
    firsts = {least for _, least in plain_components([(i, plain_fingerprint(t)) for i, t in rows.items()])}
    rows = {i: t for i, t in rows.items() if i in firsts}
    assert kept.columns == columns and dict(collected(kept, "doc_id", "text")) == rows

    items = collected(read(spark, SMALL, "benchmark"), "item_id", "text")
    kept = written(stages["decontamination"](spark, kept, SMALL), "t3")
    judged = {i: plain_hits(items, t) for i, t in rows.items()}
    after = dict(collected(kept, "doc_id", "text"))
    assert kept.columns == columns and after.keys() == {i for i, j in judged.items() if not j[4]}
    assert all(after[i] == rows[i] for i in after if judged[i][1] == 0)
    assert all(plain_hits(items, after[i])[0] <= judged[i][0] - judged[i][1] for i in after)

    kept = written(stages["entropy_secrets"](spark, kept, SMALL), "t4")
    clean = dict(collected(kept, "doc_id", "text"))
    assert kept.columns == columns and clean.keys() == after.keys()
    assert all(clean[i] == after[i] for i in after if not plain_base(after[i]) and "[entropy]" not in (clean[i] or ""))
    assert not any(plain_base(t) for t in clean.values())
    assert all(n == len(t) for t, n in collected(kept, "text", "n_chars"))

    rows = stages["complement_packing"](spark, kept, SMALL).collect()
    check(rows, {i: plain_ids(t) for i, t in clean.items()}, 2048)
    assert corpus_pipeline.run(spark, SMALL).count() == len(rows)


@pytest.mark.parametrize("rows", [None, []])
def test_stages_take_awkward_and_no_documents(spark, rows):
    docs = frame(spark, rows)
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, SMALL)
        if name != "complement_packing":
            assert found.schema == docs.schema
        if rows == []:
            assert found.count() == 0
        docs = written(found, "awkward") if name != "complement_packing" else found
    assert docs.count() >= 0


def test_more_columns_pass(spark):
    docs = texts(spark, [(1, "a b c"), (2, None)])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).columns == docs.columns

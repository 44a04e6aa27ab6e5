"""The corpus pipeline and each of its stages against plain versions."""

import numpy as np
import pytest
from brute import component_ids, contamination, fingerprint, personal

import corpus_pipeline
from hedonic.llm import packing, pii, quality, simhash, tokens
from hedonic.session import table

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def given(spark):
    """The documents with an empty and a null text and a repeated row."""
    docs = table(spark, SF, "documents")
    extra = spark.createDataFrame([(10_000, None, "en", "s", 0), (10_001, "", "en", "s", 0), (10_002, "", "en", "s", 0)],
                                  docs.schema)
    return docs.unionByName(extra).unionByName(docs.where("doc_id = 3")).cache()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_order_and_columns(spark, given):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "personal_data", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, given.limit(0), SF).columns == given.columns, name
        assert stage(spark, given.limit(0), SF).count() == 0
    assert STAGES["packing"](spark, given.limit(0), SF).count() == 0


def test_quality(spark, given):
    out = STAGES["quality"](spark, given, SF)
    scored = {r["doc_id"]: r["predicted"] for r in quality.classify(given, table(spark, SF, "labels")).collect()}
    assert rows(out) == rows(given.where(given.doc_id.isin([d for d, p in scored.items() if p])))


def test_near_duplicates(spark, given):
    out = STAGES["near_duplicates"](spark, given, SF)
    docs = given.collect()
    ids = component_ids([r["doc_id"] for r in docs], [fingerprint(r["text"], simhash.SHINGLE) for r in docs])
    assert out.columns == given.columns
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(set(ids))


def test_decontamination(spark, given):
    out = STAGES["decontamination"](spark, given, SF)
    docs = given.collect()
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    keep = [not c for *_, c in contamination([r["text"] for r in docs], items)]
    assert rows(out) == sorted((tuple(r) for r, k in zip(docs, keep, strict=True) if k), key=repr)


def test_personal_data(spark, given):
    out = {r["doc_id"]: r for r in STAGES["personal_data"](spark, given, SF).collect()}
    spans = {r["doc_id"]: [s for s in r["spans"] if s["kind"] == pii.FOUND]
             for r in pii.find_personal_data(given, keep=["doc_id"]).collect()}
    for r in given.collect():
        got, text = out[r["doc_id"]], r["text"]
        assert (got["lang"], got["source"]) == (r["lang"], r["source"])
        if text is None:
            assert got["text"] is None
            continue
        every = sorted([(s, i, e, k) for i, (k, v) in enumerate(personal(text).items()) for s, e in v]
                       + [(s["start"], 9, s["end"], s["kind"]) for s in spans[r["doc_id"]]])
        new, at = "", 0
        for s, _, e, k in every:
            if s >= at:
                new += text[at:s] + f"<{k.upper()}>"
            at = max(at, e)
        assert got["text"] == new + text[at:]


def test_run(spark):
    """What the stages keep, one after the other, is what is packed, each id in one piece."""
    docs = table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = stage(spark, docs, SF).cache()
        assert 0 < docs.count() <= before, name
    enc = tokens.encoder(tokens.default_path())
    want = {r["doc_id"]: [*enc.encode(r["text"]).tolist(), packing.END_OF_TEXT] for r in docs.collect()}
    got: dict = {}
    for r in sorted(corpus_pipeline.run(spark, SF).collect(), key=lambda r: (r["doc_id"], r["start"])):
        got.setdefault(r["doc_id"], []).extend(np.frombuffer(r["ids"], "<u4").tolist())
    assert got == want

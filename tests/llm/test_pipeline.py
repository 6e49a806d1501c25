"""The pipeline, stage by stage, against the brute-force versions of its operators."""

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from quire.llm import quality
from quire.llm.common import stage
from tests.llm.test_pii import all_spans, masked
from tests.llm.test_similar import kept
from tests.llm.test_text_ops import brute


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    state = sorted(map(tuple, docs.collect()))
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    for name, fn in corpus_pipeline.STAGES[:-1]:
        docs, _ = stage(fn(spark, docs, sf), name)
        assert docs.columns == columns
        got = sorted(map(tuple, docs.collect()))
        if name == "quality":
            want = [r for r, v in zip(state, quality.verdicts([r[1].encode() for r in state], quality.Bands()), strict=True) if v[6]]
        elif name == "near_dedup":
            least = set(kept([r[:2] for r in state]))
            want = [r for r in state if r[0] in least]
        elif name == "decontamination":
            want = [r for r in state if not brute(r[1], items)[2]]
        else:
            want = [(r[0], masked(r[1], [x[:3] for x in found] + terms), *r[2:]) for r, (found, terms) in zip(state, all_spans([r[1] for r in state]), strict=True)]
        assert got == want, name
        assert 0 < len(got) <= len(state)
        state = got
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    last = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, sf).collect()}
    assert last == {r[0]: t.encode(r[1], add_special_tokens=False).ids for r in state}


def test_odd_tables(spark, sf):
    frame = spark.createDataFrame([(None, None, 1), (None, "x", 2), (1, "", 3), (1, "word " * 60, 4), (1, "word " * 60, 4)], "doc_id long, text string, kept long")
    for docs in (frame, frame.limit(0)):
        for _, fn in corpus_pipeline.STAGES:
            docs, _ = stage(fn(spark, docs, sf), "odd")
        docs.count()

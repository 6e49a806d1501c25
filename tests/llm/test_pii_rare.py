"""Operator 10 on entities that stand in one document each."""

from quire.llm import pii


def test_rare_entities(spark):
    rows = [(i, f"please write to the owner rare{i}x at user{i}@host{i}.org or call in") for i in range(40)]
    rows += [(100 + i, "please write to the owner at shared@example.org or call in " + ("once" if not i else "")) for i in range(20)]
    rows += [(200 + i, "please write to the owner or call in at night") for i in range(300)]
    got = {r.doc_id: r.terms for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]).collect()}
    text = dict(rows)
    for i, terms in got.items():
        assert [text[i][t.start : t.end] for t in terms] == ([f"rare{i}x"] if i < 40 else []), i
    clean = {r.doc_id: r.text for r in pii.sanitize(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert clean[7] == "please write to the owner  at [EMAIL] or call in" and clean[200] == text[200]


def test_documents(spark, sf):
    assert sum(r.n_terms for r in pii.query(spark, sf).collect()) > 0

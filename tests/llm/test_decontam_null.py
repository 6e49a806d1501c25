"""Operator 6 on benchmark items without an id, which are left out as the docstring says."""

from quire.llm import decontam


def test_null_ids(spark):
    docs = spark.createDataFrame([(1, "x a b c d e f g h y"), (2, "p q r s t u v w"), (3, "nothing of these here")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, "a b c d e f g h"), (None, "b c d e f g h y"), ("7", "p q r s t u v w"), ("8", "a b c d e f g h")], "item_id string, text string")
    got = {r.doc_id: (r.items, [tuple(s) for s in r.spans]) for r in decontam.search(docs, bench).collect()}
    assert got == {1: (["8"], [(1, 9)]), 2: (["7"], [(0, 8)]), 3: ([], [])}
    assert [r.doc_id for r in decontam.clean(docs, bench.where("item_id is null"), least_items=1).collect()] == [1, 2, 3]

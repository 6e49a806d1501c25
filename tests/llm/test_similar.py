"""Near copies by shingles against comparing all pairs."""

import random

import corpus_pipeline
from quire.llm import similar


def plain(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def kept(rows):
    """Ids of the rows that stay, by comparing all pairs."""
    sets, part = [plain(t) for _, t in rows], list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) >= 0.8 * len(a | sets[j]) - 1e-9 and part[i] != part[j]:
                old, new = part[i], part[j]
                part = [new if p == old else p for p in part]
    return sorted(min(i for (i, _), p in zip(rows, part, strict=True) if p == q) for q in set(part))


def planted(rnd):
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    passage, rows = [word() for _ in range(30)], []
    for _ in range(12):
        base = [word() for _ in range(rnd.randrange(60, 200))] + passage
        for _ in range(10):
            copy = list(base)
            for _ in range(rnd.randrange(0, 7)):
                copy[rnd.randrange(len(copy))] = word()
            rows.append(" ".join(copy[: len(copy) - rnd.randrange(3)]))
    rnd.shuffle(rows)
    return list(enumerate([*rows, "one two", "One two", "x"]))


def test_near_copies(spark, sf, monkeypatch):
    rows = planted(random.Random(3))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = kept(rows)
    assert len(want) < len(rows) - 30
    for block, often in ((1024, 24), (3, 2)):
        monkeypatch.setattr(similar, "BLOCK", block)
        monkeypatch.setattr(similar, "OFTEN", often)
        assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, frame, sf).collect()) == want


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(r.doc_id for r in similar.one_each(docs).collect()) == kept(rows)


def test_odd_rows(spark):
    t = "one two three four five six seven"
    rows = [(3, t), (3, t), (None, t), (2, t.upper()), (9, None), (8, ""), (7, " \n"), (None, "alone here"), (6, "x"), (5, "x y"), (4, "é " * 20000)]
    frame = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, sid string")
    got = similar.one_each(frame)
    assert got.columns == frame.columns
    assert sorted((r.doc_id for r in got.collect()), key=str) == sorted([2, 7, None, 6, 5, 4], key=str)
    assert similar.one_each(frame.limit(0)).collect() == []


def test_clashing_names(spark, tmp_path):
    t = "one two three four five six seven"
    frame = spark.createDataFrame([(2, t, 5, 0, 0, 0), (1, t.upper(), 6, 0, 0, 0), (3, "x", 7, 0, 0, 0)], "doc_id long, text string, _row_file long, _ROW_NUMBER long, _metadata long, `a.b` long")
    frame.write.parquet(str(tmp_path / "t"))
    for d in (frame, spark.read.parquet(str(tmp_path / "t"))):
        out = similar.one_each(d)
        assert out.columns == d.columns and sorted(r[:3] for r in out.collect()) == [(1, t.upper(), 6), (3, "x", 7)]


def test_no_text_is_shuffled(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = similar.one_each(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan and "Join" not in plan


def test_pieces_of_a_stream():
    import numpy as np
    import pyarrow as pa

    rnd = random.Random(1)
    for _ in range(300):
        keys = sorted(rnd.choice("aabbbc") for _ in range(rnd.randrange(1, 30)))
        flat = [(ord(k), i) for i, k in enumerate(keys)]
        cuts = sorted({0, len(flat), *(rnd.randrange(len(flat)) for _ in range(3))})
        batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*flat[a:z])], ["key", "i"]) for a, z in zip(cuts, cuts[1:])]
        got = list(similar.groups_of(iter(batches), 1, 4))
        seen = sorted(int(i) for g, _ in got for i in g[1])
        assert seen == [i for k, i in flat if keys.count(chr(k)) > 1]
        for g, whole in got:
            n = keys.count(chr(int(g[0, 0])))
            assert np.all(g[0] == g[0, 0]) and whole == (n <= 4) and (not whole or g.shape[1] == n)


def test_codes_never_rule_out_a_link():
    import numpy as np

    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 7, 31, 32, 900, 5000):
        for drop in range(0, max(1, n // 4), max(1, n // 40)):
            a = np.unique(rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2))
            b = np.unique(np.concatenate([a[drop:], rng.integers(0, 1 << 63, drop, np.uint64)]))
            if similar.alike(a, b, 0.8):
                assert similar.perhaps(similar.code(a), similar.code(b), 0.8)
        c = np.unique(rng.integers(0, 1 << 63, n, np.uint64))
        assert n < 31 or not similar.perhaps(similar.code(a), similar.code(c), 0.8)

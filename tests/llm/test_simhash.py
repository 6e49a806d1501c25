"""Operator 9 against brute force."""

import random

import xxhash

from quire.llm import components, simhash


def plain(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for s in "\t\n\x0b\x0c\r":
        w = w.replace(s, " ")
    w = [x for x in w.split(" ") if x]
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hs) > len(hs))


def groups(rows):
    """(id, fingerprint, component) by comparing all pairs of distinct fingerprints."""
    fps = sorted({f for _, f in rows})
    up = {f: f for f in fps}

    def root(f):
        while up[f] != f:
            f = up[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                up[root(a)] = root(b)
    least = {}
    for i, f in rows:
        if i is not None:
            least[root(f)] = min(i, least.get(root(f), i))
    return sorted(((i, f"{f:016x}", least.get(root(f))) for i, f in rows), key=str)


def test_documents(spark, sf):
    rows = [(r.doc_id, plain(r.text)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted(map(tuple, simhash.query(spark, sf).collect()), key=str)
    assert got == groups(rows)
    assert any(r[0] != r[2] for r in got)


def cluster(rnd, n, width):
    base = rnd.getrandbits(64)
    spots = rnd.sample(range(64), width)
    return {base ^ sum(1 << s for s in rnd.sample(spots, rnd.randrange(width))) for _ in range(n)}


def test_links(spark, monkeypatch):
    rnd = random.Random(5)
    fps = set().union(*(cluster(rnd, 40, 7) for _ in range(6)), {rnd.getrandbits(64) for _ in range(100)})
    rows = list(enumerate(sorted(fps)))
    frame = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in rows], "doc_id long, fp long")
    for cap in (2048, 8):
        monkeypatch.setattr(simhash, "CAP", cap)
        labels, _ = simhash.labelled(frame, "doc_id")
        got = frame.join(labels, "fp").select("doc_id", "least").collect()
        assert sorted(map(tuple, got)) == sorted((i, c) for i, _, c in groups(rows))


def test_components(spark):
    rnd = random.Random(6)
    edges = [(i, i + 1) for i in range(0, 40)] + [(rnd.randrange(100, 200), rnd.randrange(100, 200)) for _ in range(60)] + [(300, i) for i in range(301, 330)] + [(-5, 7)]
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "u long, v long"))[0].collect()))
    up = {}
    for a, b in edges:
        up.setdefault(a, {a}), up.setdefault(b, {b})
        whole = up[a] | up[b]
        for x in whole:
            up[x] = whole
    assert got == {x: min(s) for x, s in up.items() if x != min(s)}


def test_odd_rows(spark):
    t = "one two three four five six seven"
    rows = [(3, t), (3, t), (None, t), (2, t.upper()), (9, None), (8, ""), (7, " \n"), (None, "alone here"), (6, "x"), (5, "x y"), (4, "é " * 20000)]
    frame = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, fp string")
    assert sorted(map(tuple, simhash.groups(frame).collect()), key=str) == groups([(i, plain(x)) for i, x in rows])
    assert simhash.groups(frame.limit(0)).collect() == []

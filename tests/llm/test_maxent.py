"""Operator 7: the base score by brute force, the model by held-out accuracy and by summing to one."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from quire.llm import maxent


def base(rows):
    toks = {n: [*maxent.words((t or "").encode()), maxent.END] for n, (_, t) in enumerate(rows)}
    out_of = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in rows]
    c = Counter(w for n in toks if not out_of[n] for w in toks[n])
    total, v = sum(c.values()), len(c)
    return [(i, out_of[n], len(toks[n]), sum(c[w] > 0 for w in toks[n]), total, sum(math.log10((c[w] + 0.5) / (total + 0.5 * (v + 1))) for w in toks[n])) for n, (i, _) in enumerate(rows)]


def close(got, want):
    for a, b in zip(sorted(got, key=lambda r: (str(r[:5]), r[5])), sorted(want, key=lambda r: (str(r[:5]), r[5])), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)


def test_documents(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = [tuple(r) for r in maxent.query(spark, sf).collect()]
    close([r[:6] for r in got], base(rows))
    held = [r for r in got if r[1]]
    print("held out", sum(r[5] for r in held), sum(r[6] for r in held))
    assert sum(r[6] for r in held) > sum(r[5] for r in held)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(maxent, "TOP", 5)
    rows = [(i, "the cat sat on the mat " * (i % 3) + f"w{i}") for i in range(40)] + [(None, "no id"), (50, None), (51, ""), (52, "a b"), (52, "a b"), (53, "long " * 30000)]
    frame = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, score string")
    got = [tuple(r) for r in maxent.score(frame).collect()]
    close([r[:6] for r in got], base(rows))
    assert all(r[6] < 0 for r in got)
    assert maxent.score(frame.limit(0)).collect() == []
    alone = [tuple(r) for r in maxent.score(frame.where("crc32(encode(cast(doc_id as string), 'utf-8')) % 5 = 1")).collect()]
    assert alone and all(r[1] and r[3] == r[4] == 0 for r in alone)


def test_sums_to_one(spark):
    rows = [(i, f"a b c a d{i % 7} e") for i in range(30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    counts = maxent.count_words(frame, "doc_id", "text").groupBy("w").sum("n").toDF("w", "n")
    staged, _ = maxent.stage(counts, "w")
    v, _, _ = maxent.vocabulary(staged)
    sums = np.bincount(v.classes[: len(v.ids)], 10**v.within, v.n_classes)
    assert np.allclose(sums[sums > 0], 1)
    assert np.allclose(maxent.softmax(maxent.logits(maxent.start_weights(v), maxent.features(np.arange(3), 5))).sum(1), 1)


def test_score_by_brute_force(spark, monkeypatch):
    """Every token's probability from the trained weights, feature by feature, in plain Python."""
    monkeypatch.setattr(maxent, "TOP", 12)
    learnt = {}
    train = maxent.train

    def kept(docs, key, text, v, shared):
        learnt["v"], learnt["w"] = v, train(docs, key, text, v, shared)
        return learnt["w"]

    monkeypatch.setattr(maxent, "train", kept)
    rows = [(i, f"the cat w{i % 5} sat on the mat by x{i} and " * (1 + i % 3)) for i in range(60)] + [(99, None), (None, "the dog")]
    got = {r.doc_id: r.score for r in maxent.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    v, w = learnt["v"], learnt["w"].astype(float)
    toks = {i: [*(t or "").lower().split(), ""] for i, t in rows}
    seen = Counter(x for i in toks if zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1 for x in toks[i])
    place = {x.decode(): n for x, n in v.ids.items()}
    group = lambda x: v.endings.get(x.encode()[-2:], 0)
    mass, tail_n, tail_v = Counter(), Counter(), Counter()
    for x, n in seen.items():
        if x in place:
            mass[int(v.classes[place[x]])] += n
        else:
            tail_n[group(x)] += n
            tail_v[group(x)] += 1
    big = (1 << 64) - 1
    bucket = lambda x, k: (((x & big) * 0x9E3779B97F4A7C15 & big) >> 40) % maxent.BUCKETS + k * maxent.BUCKETS
    for i, words in toks.items():
        codes = [place.get(x, len(place) + group(x)) for x in words]
        total = 0.0
        for t, x in enumerate(words):
            a, b, c = (codes[t - d] if t >= d else len(place) + maxent.GROUPS for d in (1, 2, 3))
            rows_of = [bucket(a, 0), bucket(b + 1_000_003, 1), bucket(a * 2_654_435_761 + b * 40_503 + 7, 2), bucket(c + 5_000_011, 3)]
            z = w[-1] + sum(w[r] for r in rows_of)
            own = int(v.classes[codes[t]])
            total += (z[own] - z.max() - math.log(np.exp(z - z.max()).sum())) / math.log(10)
            total += math.log10(seen[x] / mass[own]) if x in place else math.log10((seen[x] + 0.5) / (tail_n[group(x)] + 0.5 * (tail_v[group(x)] + 1)))
        assert got[i] == pytest.approx(total, rel=1e-4), i

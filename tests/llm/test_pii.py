"""Operator 10 against the stated patterns and plain counting, both written here from the contract."""

import hashlib
import math
import random
import re
import time
from collections import Counter

from pyspark.sql import functions as F

from quire.llm import pii

STATED = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
ORDER = [*STATED, "term"]


def checksum(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def base(s):
    """(kind, start, end) by start and kind, and the entity of each."""
    out = []
    for kind, pattern in STATED.items():
        for m in re.finditer(pattern, s or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and max(int(p) for p in m[0].split(".")) > 255:
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and checksum(digits)) or kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            entity = m[0].lower() if kind == "email" else ".".join(str(int(p)) for p in m[0].split(".")) if kind == "ip" else digits
            out.append((m.start(), ORDER.index(kind), m.end(), f"{kind}:{entity}"))
    return sorted(out)


def lower(w):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)


def outside(s, found):
    return [(m.start(), m.end()) for m in re.finditer("[0-9A-Za-z\x80-\U0010ffff]+", s) if not any(m.start() < z and a < m.end() for a, _, z, _ in found)]


def near(s, found):
    places, out = outside(s, found), set()
    for a, _, z, e in found:
        for b, c in [p for p in places if p[1] <= a][-6:] + [p for p in places if p[0] >= z][:6]:
            w = lower(s[b:c])
            if len(w.encode()) > 1 and not re.fullmatch("[0-9]+", w):
                out.add((e, w))
    return out


def all_spans(texts):
    """Base and all spans of each text, by counting in memory."""
    df, de, co, n = Counter(), Counter(), Counter(), len(texts)
    found = [base(s) for s in texts]
    for s, f in zip(texts, found):
        df.update({lower(w) for w in re.findall("[0-9A-Za-z\x80-\U0010ffff]+", s)})
        de.update({e for *_, e in f})
        co.update(near(s, f))
    share = {}
    for (e, t), c in co.items():
        bits = math.log2(n / de[e]) if c >= 5 else math.log2(n / c)
        share[e, t] = n > de[e] and math.log2(c * n / (de[e] * df[t])) >= 0.8 * bits - 1e-9
    out = []
    for s, f in zip(texts, found):
        terms = {t for e, t in near(s, f) if share[e, t]}
        out.append((f, [(b, 4, z) for b, z in outside(s, f) if lower(s[b:z]) in terms]))
    return out


def shown(spans):
    return ",".join(f"{ORDER[k]}:{a}:{z}" for a, k, z in sorted(spans))


def masked(s, spans):
    out, at = "", 0
    for a, k, z in sorted(spans):
        if z > at:
            out, at = out + s[at:a] + ("" if k == 4 else f"[{ORDER[k].upper()}]"), z
    return out + s[at:]


def test_documents(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r.doc_id: r for r in pii.query(spark, sf).collect()}
    assert got.keys() == {i for i, _ in rows}
    for (i, _), (found, terms) in zip(rows, all_spans([t for _, t in rows])):
        spans = [x[:3] for x in found]
        assert got[i].base_sha256 == hashlib.sha256(shown(spans).encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(ORDER[x[1]] == k for x in spans) for k in pii.KINDS]
        assert got[i].spans == shown(spans + terms) and got[i].n_terms == len(terms)
    assert sum(r.n_terms for r in got.values()) > 0


def test_sanitized_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: r.text for r in pii.sanitize(docs).collect()}
    assert got == {i: masked(t, [x[:3] for x in f] + own) for (i, t), (f, own) in zip(rows, all_spans([t for _, t in rows]))}


def test_patterns():
    rnd = random.Random(7)
    alphabet = ["1", "23", "456", "255", ".", ".", "@", "a", "b-", "x.y", " ", "-", "+", "(", ")", "_", "%", "é", "\n", "4111 1111 1111 1111", "+1 (487) 555-7209", "a@b.c", "1.2.3.4", "000255", "١", "²"]
    for _ in range(20000):
        s = "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(1, 14)))
        found = pii.base_spans(s)
        assert found == base(s), s
        assert pii.contexts(s, found) == near(s, found) and pii.words_outside(s, found) == outside(s, found), s


def test_long_texts():
    for s in ("1" * 200_000, "a" * 200_000, "a@" * 50_000, "1." * 100_000, "+1" * 100_000, "1 " * 100_000):
        pii.base_spans(s)
    s = " ".join(f"write to user{i}@host.org today" for i in range(100_000))
    began = time.time()
    found = pii.base_spans(s)
    assert len(found) == 100_000 and len(pii.contexts(s, found)) > 100_000 and len(pii.term_spans(s, found, {"today"})) == 100_000
    assert time.time() - began < 30


def test_terms(spark):
    text = "please write to the bearer zanzibar at kim@example.org or call in"
    rows = [(i, f"{text} {i}", "c") for i in range(8)] + [(i, "please write to the or call in at night", "c") for i in range(10, 200)]
    rows += [(300, None, "c"), (301, "", "c"), (301, "", "c"), (None, f"{text} zanzibar", "c"), (302, f"{text} {'pad ' * 30000} bearer", "c")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    want = {i: (f, own) for (i, *_), (f, own) in zip(rows, all_spans([t or "" for _, t, _ in rows]))}
    for r in pii.find(frame, ["doc_id"]).collect():
        assert [(x.start, 4, x.end) for x in r.terms] == want[r.doc_id][1]
    clean = {i: t and masked(t, [x[:3] for x in want[i][0]] + want[i][1]) for i, t, _ in rows}
    out = pii.sanitize(frame)
    assert out.columns == frame.columns and out.count() == len(rows)
    assert {r.doc_id: r.text for r in out.collect()} == clean
    assert clean[3] == "please write to the   at [EMAIL] or call in 3" and clean[20] == rows[18][1] and clean[302].endswith("pad  ")
    assert pii.find(frame.limit(0), ["doc_id"]).collect() == [] and pii.sanitize(frame.limit(0)).collect() == []


def test_clashing_names(spark, tmp_path):
    names = ("_row_file", "_ROW_NUMBER", "_metadata", "_spans", "file", "value", "a.b")
    frame = spark.createDataFrame([(1, "mail a@b.cd now", *range(7))], "doc_id long, text string, " + ", ".join(f"`{n}` long" for n in names))
    frame.write.parquet(str(tmp_path / "t"))
    for d in (frame, spark.read.parquet(str(tmp_path / "t"))):
        out = pii.sanitize(d)
        assert out.columns == d.columns and [tuple(r) for r in out.collect()] == [(1, "mail [EMAIL] now", *range(7))]
    assert pii.find(frame.withColumn("spans", F.lit(1)), ["doc_id", "_spans"]).columns == ["doc_id", "_spans", "spans", "terms"]

"""Operators 4 and 8 against plain loops."""

import hashlib
from collections import Counter

import duckdb
import pytest

from quire.llm import sharding, urlfilter


def test_table():
    names, size = tuple("abcde"), 101
    owner = sharding.fill(names, size)
    num = lambda s: int(hashlib.sha256(s.encode()).hexdigest()[:15], 16)
    orders = [[(num(f"offset:{n}") % size + j * (num(f"skip:{n}") % (size - 1) + 1)) % size for j in range(size)] for n in names]
    want, turn = {}, 0
    while len(want) < size:
        free = next(s for s in orders[turn % 5] if s not in want)
        want[free] = turn % 5
        turn += 1
    assert owner == [want[i] for i in range(size)]
    assert max(Counter(owner).values()) - min(Counter(owner).values()) <= 1
    fewer = sharding.fill(names[:-1], size)
    assert sum(a != b for a, b in zip(owner, fewer) if a != 4) < size // 4
    with pytest.raises(ValueError):
        sharding.fill(names, 100)


def test_place(spark, sf, tmp_path):
    owner = sharding.fill(sharding.SHARDS, sharding.SIZE)
    got = sharding.query(spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all((r.slot, r.shard) == (s := int(hashlib.sha256(str(r.doc_id).encode()).hexdigest()[:15], 16) % sharding.SIZE, sharding.SHARDS[owner[s]]) for r in got)
    odd = spark.createDataFrame([("", 1), (None, 2), ("x" * 99999, 3), ("k", 4), ("k", 5)], "k string, shard int")
    rows = sharding.place(odd, "k").collect()
    assert rows[0].shard == rows[1].shard and rows[3].shard == rows[4].shard and sharding.place(odd.limit(0), "k").collect() == []
    assert sharding.write(odd.withColumnRenamed("shard", "_shard"), f"{tmp_path}/s", "k") == "_shard_"
    back = spark.read.parquet(f"{tmp_path}/s")
    assert sorted(back.columns) == ["_shard", "_shard_", "k"] and sorted(r._shard for r in back.collect()) == [1, 2, 3, 4, 5]
    assert sharding.place(odd, "shard").columns == ["shard", "slot", "shard_"]
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert sorted(con.sql(sharding.SQL).select("doc_id, slot, shard").fetchall()) == sorted(map(tuple, got))


URLS = ["http://A.Example.NET/en/x?q#f", "https://example.com/de/a", "https://myexample.com/de/a", "ftp://org/fr/", "org/fr/", None, "", "x://", "x://h", "x://h?p=/a", "x://h#/", "HTTP://Ä.org/fr/é", "a://b://c/d", "x://net", "x://net/", "x://dup/p?1", "y://dup/p#2", "x://dup/p", "x://dup/P"]


def verdicts(rows):
    keys = []
    for _, u in rows:
        rest = (u or "").partition("://")[2]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, tail = "".join(c.lower() if c.isascii() else c for c in rest[:cut]), rest[cut:]
        keys.append((host, tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]))
    often = Counter(keys)
    out = []
    for (i, _), (h, p) in zip(rows, keys, strict=True):
        fit = max(((rh + rp, v) for v, rh, rp in urlfilter.RULES if (h == rh or h.endswith("." + rh)) and p.startswith(rp)), key=lambda x: len(x[0]), default=None)
        out.append((i, h, p, fit and fit[0], fit[1] if fit else "block" if often[h, p] > 1 else "allow"))
    return sorted(out, key=str)


def test_urls(spark, sf, monkeypatch):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").collect()]
    got = sorted(map(tuple, urlfilter.query(spark, sf).collect()), key=str)
    assert got == verdicts(rows)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    assert sorted(con.sql(urlfilter.SQL).select("page_id, host, path, rule, verdict").fetchall(), key=str) == got


def test_url_cases(spark, monkeypatch):
    odd = [(i, u) for i, u in enumerate(URLS)] + [(None, "x://dup/p"), (3, "ftp://org/fr/")]
    more = [(1000 + i, f"x://h{i % 1500}.com/p") for i in range(2000)]
    frame = spark.createDataFrame([(*r, "c") for r in odd + more], "page_id long, url string, host string")
    for size in (200_000, 100):
        monkeypatch.setattr(urlfilter, "SHARD_KEYS", size)
        monkeypatch.setattr(urlfilter, "HELD_SHARDS", 2)
        assert sorted(map(tuple, urlfilter.judge(frame, urlfilter.repeated(frame)).collect()), key=str) == verdicts(odd + more)
    few = spark.createDataFrame([(f"h{i}.com", "/p") for i in range(10)], "host string, path string")
    monkeypatch.setattr(urlfilter, "SHARD_KEYS", 2)  # 10 listed keys, and a universe whose false positives need more shards
    got = {r.host: r.verdict for r in urlfilter.judge(frame, few).where("rule is null").collect()}
    assert all((v == "block") == (h in {f"h{i}.com" for i in range(10)}) for h, v in got.items())
    none = urlfilter.repeated(frame.limit(0))
    assert urlfilter.judge(frame.limit(0), none).collect() == []
    assert {r.verdict for r in urlfilter.judge(frame, none).where("rule is null").collect()} == {"allow"}

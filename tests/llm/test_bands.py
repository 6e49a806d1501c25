"""Operator 3's bands against generated junk of each length."""

import base64
import random

from quire.llm import quality

KINDS = {
    "base64": (450, lambda rnd, n: base64.b64encode(rnd.randbytes(12)).decode()[:n]),
    "alphanumeric": (700, lambda rnd, n: "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=n))),
    "hex": (5600, lambda rnd, n: "".join(rnd.choices("0123456789abcdef", k=n))),
}
LENGTHS = (450, 600, 700, 850, 1000, 1400, 2000, 2800, 4000, 5600, 8000, 16000, 40000)


def test_junk():
    rnd = random.Random(1)
    for kind, (least, word) in KINDS.items():
        for size in (x for x in LENGTHS if x >= least):
            words = [word(rnd, rnd.randrange(3, 10)) for _ in range(size)]
            v = quality.verdicts([" ".join(words)[:size].encode()], quality.Bands())[0]
            assert not v[5] and not v[6], (kind, size, v[7])


def test_half_repetitive(spark, sf):
    texts = [r.text.encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    bands = quality.Bands()
    clean = [t for t, v in zip(texts, quality.verdicts(texts, bands), strict=True) if not v[5]]
    assert all(v[6] for v in quality.verdicts(clean, bands))
    for size in (x for x in LENGTHS if 1000 <= x <= 8000):
        cut = []
        for b in (t for t in clean if len(t) > size):
            line = b"\n" + b" ".join(b.split()[-8:])
            cut.append((b[: size * 55 // 100] + (line * size)[: size * 42 // 100]).decode(errors="ignore").encode())
        passed = [v for v in quality.verdicts(cut, bands) if not v[5]]
        assert passed and not any(v[6] for v in passed), size

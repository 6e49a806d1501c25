"""Operator 3, quality rules by compression bands.

A text is rejected as repetitive or incompressible when its zstandard ratio (bytes over compressed
bytes, level 3), over the whole text, leaves the band for its length, or when more than a set share of
its fixed chunks leave theirs.  Short texts compress less, so the bands depend on length.

Chunks cover every byte of a text longer than one of them.  A very long text is compressed whole and by chunks, with memory in proportion to itself.

Null and empty texts have no words and fail the base rule.  Ties and repeated rows are judged alone:
equal texts get equal rows.  An empty table gives an empty result.  Columns other than the id and the text are
not read by judge(), and kept() returns them untouched, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession

from quire.llm.common import keep_rows, map_batches, table, utf8

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Bands:
    """Limits of zstandard ratios.  whole: (bytes below, least, most), the last for all longer texts.

    They stand some hundredths outside the ratios of the 326,057 texts that pass the base rule in sf0.01, sf0.1, check_s, check_l and check_h;
    14 of these are rejected, 13 for repetition and one clean text by the lower limit below 1000 bytes.  Hexadecimal words compress like clean text of up to 5,600 bytes and stay there.
    """

    whole: tuple[tuple[int, float, float], ...] = (
        (350, 1.28, 2.0), (400, 1.26, 2.03), (500, 1.31, 2.08), (600, 1.35, 2.12), (700, 1.40, 2.27), (850, 1.46, 2.35), (1000, 1.5, 2.4), (1200, 1.57, 2.5), (1400, 1.61, 2.5), (2000, 1.66, 2.62),
        (2800, 1.74, 2.67), (4000, 1.81, 2.73), (5600, 1.87, 2.86), (8000, 1.96, 2.95), (16000, 2.06, 3.0), (32000, 2.19, 3.1), (1 << 62, 2.25, 3.3),
    )
    chunk_bytes: int = 4096
    #: Limits for a chunk; every chunk is whole.
    chunk: tuple[float, float] = (1.88, 2.85)
    #: Texts whose chunks leave the band in more than this share are rejected.
    bad_share: float = 0.3
    level: int = 3


def base_counts(b: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text in UTF-8."""
    words = b.split()
    n = len(words)
    if not n:
        return 0, 0, 0, 0, 0
    chars = len(b"".join(words)) if b.isascii() else len(b"".join(words).decode())
    lines = [x for x in b.split(b"\n") if x.strip()]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    covered = 0
    if len(set(windows)) < len(windows):
        often = {w for w, c in Counter(windows).items() if c > 1}
        end = 0
        for i, w in enumerate(windows):
            if w in often:
                covered += i + 3 - max(i, end)
                end = i + 3
    return n, chars, len(b) - len(b.translate(None, SYMBOLS)), len(lines) - len(set(lines)), covered


def within(size: int, ratio: float, limits: tuple[tuple[int, float, float], ...]) -> bool:
    least, most = next((lo, hi) for below, lo, hi in limits if size < below)
    return least <= ratio <= most


def ratios(b: bytes, bands: Bands, z: zstandard.ZstdCompressor) -> tuple[float, int, int]:
    """Whole ratio, chunks, chunks out of their band.

    Chunks follow one another, and the last one ends with the text, so no byte of a text longer than a chunk is left out; a shorter text is
    judged as a whole alone.
    """
    whole = len(b) / len(z.compress(b)) if b else 0.0
    size, least, most = bands.chunk_bytes, *bands.chunk
    if len(b) <= size:
        return whole, 0, 0
    starts = [*range(0, len(b) - size, size), len(b) - size]
    bad = sum(not least <= size / len(z.compress(b[a : a + size])) <= most for a in starts)
    return whole, len(starts), bad


def in_band(size: int, whole: float, chunks: int, bad: int, bands: Bands) -> bool:
    return within(size, whole, bands.whole) and bad <= bands.bad_share * chunks


def verdicts(texts: list[bytes], bands: Bands) -> list[tuple]:
    z = zstandard.ZstdCompressor(level=bands.level)
    out = []
    for b in texts:
        n, chars, symbols, dup, rep = base_counts(b)
        failed = n < 50 or 100 * rep > 50 * n
        whole, chunks, bad = ratios(b, bands, z)
        out.append((n, chars, symbols, dup, rep, failed, not failed and in_band(len(b), whole, chunks, bad, bands), whole, chunks, bad))
    return out


FIELDS = (("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("whole_ratio", pa.float64()), ("n_chunks", pa.int64()), ("n_bad_chunks", pa.int64()))


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", bands: Bands = Bands()) -> DataFrame:
    """One row for each document: the base counts, the ratios and the verdict."""

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = list(zip(*verdicts(utf8(b.column(1)), bands), strict=True)) or [()] * len(FIELDS)
        return pa.RecordBatch.from_arrays([b.column(0), *(pa.array(r, t) for r, (_, t) in zip(rows, FIELDS, strict=True))], [key, *(f for f, _ in FIELDS)])

    kind = dict(docs.dtypes)[key]
    return map_batches(
        docs.select(key, text),
        fn,
        f"`{key}` {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, whole_ratio double, n_chunks long, n_bad_chunks long",
    )


def kept(docs: DataFrame, text: str = "text", bands: Bands = Bands()) -> DataFrame:
    """The documents that pass, every column as it was."""
    return keep_rows(docs, lambda ts: [v[6] for v in verdicts(ts, bands)], text)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))

"""Operator 10, personal data: patterns, then information-theoretic sanitisation of what stands around them.

Base kinds are found by pattern.  Each finding's value is a protected entity; the SIDE words next to it on each side, findings left out, are
its context.  Over the corpus, with N documents, df(t) documents with the word t, df(e) with the entity e and co(e, t) with t in a context of e,
    PMI(e; t) = log2(co * N / (df(e) * df(t)))   and   IC(e) = log2(N / df(e))
say how many of the entity's bits a term gives away.  A term that gives away a share of `disclosure` or more of an entity of a document is a
finding of kind `term` wherever it stands in that document; documents without the entity keep it, as nothing there or
in what is left of the others ties it to the entity.  No pair is too rare to be judged: where co is under `least`, so that chance may
have made PMI high, the share is of the pair's own bits, log2(N / co) >= IC(e).  For an entity in one document that is IC(e)
itself, for a term that stands by a frequent entity once it is far more.  sanitize() puts a
general label in the place of entities and removes disclosing terms.

A document is searched twice, in time linear in its length and findings: once for counts, once with its own terms, which the task that reads
it takes from a side file of the rows it scans.  So no text is shuffled, and a document's row of terms is all that is gathered of it.

Counts are of documents (rows), over the whole table.  Null text is empty.  Repeated rows each count and each get their
findings; an entity in a third of all rows is only a key whose partial sums are merged, and the joins are between staged
scans, which adaptive execution splits.  Empty tables give empty results.  Columns besides the id and
the text are not read by find(), and sanitize() returns them untouched, whatever their names.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import bound_batches, drop, map_batches, named, side_values, stage, table, texts, with_row_id, write_side
from quire.llm.decontam import FOLD

# The base kinds in their order, and the labels that stand for them.
KINDS = ("email", "ip", "card", "phone")
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": ""}
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TERM = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
#: Words on either side of a finding that are its context.
SIDE = 6
LEAST, DISCLOSURE = 5, 0.8
#: Distinct words whose counts a task holds before it hands them on; pairs of a document in one row.
HELD, PAIRS = 300_000, 20_000


def emails(s: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses: at each @ the local part reaches back as far as it can."""
    out, past, at = [], 0, s.find("@")
    while at >= 0:
        m = DOMAIN.match(s, at) if at > past and s[at - 1] in LOCAL else None
        if m:
            a = at - 1
            while a > past and s[a - 1] in LOCAL:
                a -= 1
            out.append((a, m.end()))
            past = m.end()
        at = s.find("@", max(at + 1, past))
    return out


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    for d in digits[-2::-2]:
        total += 2 * int(d) - 9 * (d > "4")
    return total % 10 == 0


def base_spans(s: str) -> list[tuple[int, int, int, str]]:
    """(start, kind's number, end, entity) by start, then kind."""
    out = [(a, 0, z, "email:" + s[a:z].lower()) for a, z in emails(s)] if "@" in s else []
    for m in IP.finditer(s):
        parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
        if all(len(p) < 4 and int(p) <= 255 for p in parts):
            out.append((m.start(), 1, m.end(), "ip:" + ".".join(parts)))
    for m in CARD.finditer(s):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end(), "card:" + digits))
    if "+" in s:
        for m in PHONE.finditer(s):
            digits = "".join(filter(str.isdecimal, m[0]))
            if 10 <= len(digits) <= 15:
                out.append((m.start(), 3, m.end(), "phone:" + digits))
    out.sort()
    return out


def term(raw: bytes) -> bool:
    return len(raw) > 1 and not raw.isdigit()


def words_outside(s: str, spans: list[tuple[int, int, int, str]]) -> list[tuple[int, int]]:
    """(start, end) of the words that no finding touches."""
    out, k, past = [], 0, 0  # past: the furthest end of the findings that begin before
    for m in TERM.finditer(s):
        b, e = m.span()
        while k < len(spans) and spans[k][0] < e:
            past = max(past, spans[k][2])
            k += 1
        if past <= b:
            out.append((b, e))
    return out


def folded(s: str) -> bytes:
    return s.encode().translate(FOLD)


def contexts(s: str, spans: list[tuple[int, int, int, str]]) -> set[tuple[str, str]]:
    """(entity, term) pairs of a text, from the nearest SIDE words on each side of each finding."""
    places = words_outside(s, spans)
    starts = [b for b, _ in places]
    own = [folded(s[b:e]) for b, e in places]
    out = set()
    for a, _, z, entity in spans:
        i, j = bisect_left(starts, a), bisect_left(starts, z)
        out.update((entity, w.decode()) for w in (*own[max(0, i - SIDE) : i], *own[j : j + SIDE]) if term(w))
    return out


def term_spans(s: str, spans: list[tuple[int, int, int, str]], terms: set[str]) -> list[tuple[int, int]]:
    """Where these terms stand in the text, outside its findings."""
    return [(b, e) for b, e in words_outside(s, spans) if folded(s[b:e]).decode() in terms]


PAIR = pa.list_(pa.struct([("entity", pa.string()), ("term", pa.string())]))
SCAN = pa.schema([("file", pa.string()), ("row", pa.int64()), ("pairs", PAIR), ("a", pa.string()), ("b", pa.string()), ("n", pa.int64())])
SCAN_SQL = "file string, row long, pairs array<struct<entity:string,term:string>>, a string, b string, n long"


def scan(rows: DataFrame, ident: list[str], text: str) -> DataFrame:
    """One pass over the texts: the (entity, term) pairs of each document that has any (file, row, pairs), and counts (a, b, n).

    Counts: ('', '') documents; (entity, '') documents with it; ('', term) documents with it; (entity, term) documents with
    the term in a context of the entity.  A task sums them up before it hands them on.
    """
    bound_batches(rows.sparkSession)

    def run(batches):
        df, pairs, docs = Counter(), Counter(), 0

        def counts():
            flat = [("", "", docs)] + [("", w.decode(), n) for w, n in df.items() if term(w)] + [(a, b, n) for (a, b), n in pairs.items()]
            for at in range(0, len(flat), 50_000):
                a, b, n = zip(*flat[at : at + 50_000], strict=True)
                yield pa.RecordBatch.from_arrays([*(pa.nulls(len(a), t) for t in SCAN.types[:3]), pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(n, pa.int64())], SCAN.names)

        for batch in batches:
            held, size = [], 0
            for s, file, row in zip(texts(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                docs += 1
                df.update(set(folded(s).split()))
                found = base_spans(s)
                if not found:
                    continue
                near = sorted(contexts(s, found))
                pairs.update(near)
                pairs.update({(e, "") for *_, e in found})
                for at in range(0, len(near), PAIRS):
                    part = [{"entity": e, "term": t} for e, t in near[at : at + PAIRS]]
                    held.append((file, row, part))
                    size += len(part)
                    if size >= PAIRS:
                        yield given(held)
                        held, size = [], 0
            if held:
                yield given(held)
            if len(df) + len(pairs) > HELD:
                yield from counts()
                df, pairs, docs = Counter(), Counter(), 0
        if docs:
            yield from counts()

    def given(held):
        n = len(held)
        return pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(zip(*held, strict=True), SCAN.types, strict=False)), *(pa.nulls(n, t) for t in SCAN.types[3:])], SCAN.names)

    return rows.select(named(text), *ident).mapInArrow(run, SCAN_SQL)


def disclosing(scanned: DataFrame, least: int, disclosure: float) -> tuple[DataFrame, list[str]]:
    """(entity, term) pairs over the threshold, from a staged scan(); and their path."""
    counts, a = stage(scanned.where("n IS NOT NULL AND (a <> '' OR b = '')").groupBy("a", "b").agg(F.sum("n").alias("n")), "pii-counts")
    total = counts.where("a = '' AND b = ''").select("n").first()
    n = float(total.n if total else 1)
    pairs = counts.where("a <> '' AND b <> ''").select(F.col("a").alias("entity"), F.col("b").alias("term"), F.col("n").alias("co"))
    entities = counts.where("a <> '' AND b = ''").select(F.col("a").alias("entity"), F.col("n").alias("df_e"))
    near, c = stage(pairs.select(F.col("term").alias("b")).distinct(), "pii-near")
    terms = scanned.where("a = '' AND b <> ''").groupBy("b").agg(F.sum("n").alias("df_t")).join(near, "b", "left_semi").withColumnRenamed("b", "term")
    pmi, ic = F.log2(F.col("co") * F.lit(n) / (F.col("df_e") * F.col("df_t"))), F.log2(F.lit(n) / F.col("df_e"))
    bits = F.when(F.col("co") >= least, ic).otherwise(F.log2(F.lit(n) / F.col("co")))
    out, b = stage(pairs.join(entities, "entity").join(terms, "term").where((ic > 0) & (pmi >= disclosure * bits - 1e-9)).select("entity", "term"), "pii-terms")
    drop(scanned.sparkSession, a, c)
    return out, [b]


def side_terms(rows: DataFrame, ident: list[str], text: str, least: int, disclosure: float) -> str:
    """Side files of the disclosing terms of each document that has any."""
    spark = rows.sparkSession
    scanned, a = stage(scan(rows, ident, text), "pii-scan")
    pairs, b = disclosing(scanned, least, disclosure)
    near = scanned.where("pairs IS NOT NULL").select("file", "row", F.explode("pairs").alias("c")).select("file", "row", "c.entity", "c.term")
    terms, c = stage(near.join(pairs, ["entity", "term"]).groupBy("file", "row").agg(F.collect_set("term").alias("value")), "pii-own")
    root = write_side(terms, "pii-side")
    drop(spark, a, *b, c)
    return root


def searched(root: str, b: pa.RecordBatch, at: int):
    """(text, base findings, term spans) of each row of a batch with the columns text, file and number from `at` on; null texts are None."""
    terms: dict[int, set[str]] = {}
    for places, value in side_values(root, b.column(at + 1), b.column(at + 2))[1]:
        terms.update(zip(places.tolist(), map(set, value.to_pylist()), strict=True))
    for i, s in enumerate(b.column(at).to_pylist()):
        found = base_spans(s) if s else []
        yield s, found, term_spans(s, found, terms[i]) if i in terms else []


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
SPANS_SQL = "array<struct<kind:string,start:long,end:long>>"


def find(docs: DataFrame, ident: list[str], text: str = "text", least: int = LEAST, disclosure: float = DISCLOSURE) -> DataFrame:
    """(ident…, spans, terms) of each document: base findings, and term findings, as arrays of (kind, start, end); ident may repeat among rows."""
    rows, place, _ = with_row_id(docs.select(*map(named, [*ident, text])))
    root = side_terms(rows, place, text, least, disclosure)
    n = len(ident)

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        spans, terms = [], []
        for _, found, own in searched(root, b, n):
            spans.append([(KINDS[k], a, z) for a, k, z, _ in found])
            terms.append([("term", a, z) for a, z in own])
        return pa.RecordBatch.from_arrays([*b.columns[:n], structs(spans), structs(terms)], [*ident, "spans", "terms"])

    kinds = dict(docs.dtypes)
    return map_batches(rows.select(*map(named, [*ident, text]), *place), fn, ", ".join(f"{named(c)} {kinds[c]}" for c in ident) + f", spans {SPANS_SQL}, terms {SPANS_SQL}")


def structs(lists: list[list[tuple[str, int, int]]]) -> pa.Array:
    flat = [x for xs in lists for x in xs]
    kind, start, end = zip(*flat, strict=True) if flat else ((), (), ())
    ends = [0]
    for xs in lists:
        ends.append(ends[-1] + len(xs))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(kind, pa.string()), pa.array(start, pa.int64()), pa.array(end, pa.int64())], ["kind", "start", "end"]))


def joined(spans) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def replace(s: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with labels in place of findings (start, kind's number, end); what a later one reaches beyond an earlier one has its own label."""
    out, at = [], 0
    for a, k, z in sorted(spans):
        if z > at:
            out += [s[at:a], LABELS[(*KINDS, "term")[k]]]
            at = z
    return "".join([*out, s[at:]])


def sanitize(docs: DataFrame, text: str = "text", least: int = LEAST, disclosure: float = DISCLOSURE) -> DataFrame:
    """docs with findings generalised (entities) or removed (terms) in the text; all other columns and null texts as they were."""
    rows, place, _ = with_row_id(docs)
    root = side_terms(rows, place, text, least, disclosure)
    names, n = docs.columns, len(docs.columns)
    where = names.index(text)

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        term_kind = len(KINDS)
        own = pa.RecordBatch.from_arrays([b.column(where), b.column(n), b.column(n + 1)], ["text", "file", "row"])
        new = [replace(s, [(a, k, z) for a, k, z, _ in found] + [(a, term_kind, z) for a, z in terms]) if found else s for s, found, terms in searched(root, own, 0)]
        columns = list(b.columns[:n])
        columns[where] = pa.array(new, b.column(where).type)
        return pa.RecordBatch.from_arrays(columns, names)

    return map_batches(rows.select(*map(named, names), *place), fn, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"), ["doc_id"])
    place = "array_position(array('email', 'ip', 'card', 'phone', 'term'), {}.kind)"
    order = F.expr(f"array_sort(concat(spans, terms), (x, y) -> CASE WHEN x.start < y.start THEN -1 WHEN x.start > y.start THEN 1 ELSE int(sign({place.format('x')} - {place.format('y')})) END)")
    count = {k: F.expr(f"CAST(size(filter(spans, s -> s.kind = '{k}')) AS BIGINT)").alias(f"n_{k}") for k in KINDS}
    return found.select("doc_id", *count.values(), F.sha2(joined(F.col("spans")), 256).alias("base_sha256"), joined(order).alias("spans"), F.size("terms").cast("long").alias("n_terms"))

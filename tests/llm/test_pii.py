import re

from pyspark.sql import functions as F

from orderflow.llm import pii
from tests.llm.conftest import ODD

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def plain_spans(text):
    out = []
    for place, (kind, pattern) in enumerate(PLAIN.items()):
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in match[0].split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((match.start(), place, match.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


PARTS = [
    "a", "b.c", "@", "1", "23", ".", "-", " ", "+", "4111111111111111", "x_y", "%", "é", "😀", "\n", "(", ")",
    "+49 30 ", "1.2.3.4", "256.1.1.1", "d@e.f", "IBAN DE89 3704 0044 0532 0130 00", "ssn 123-45-6789", "0007.",
]


def base(spans="spans"):
    return pii.listed(pii.of_kind(F.col(spans), *PLAIN))


def test_base_spans_are_those_of_the_plain_expressions(table, chance):
    rows = [(i, "".join(chance.choice(PARTS) for _ in range(chance.randint(0, 60)))) for i in range(1500)]
    found = pii.find(table(*rows, *ODD)).select("text", base().alias("b")).collect()
    assert len(found) == len(rows) + len(ODD)
    for row in found:
        assert row["b"] == plain_spans(row["text"]), repr(row["text"])


def test_checks_and_context(table):
    rows = [
        (1, "IBAN DE89 3704 0044 0532 0130 00 AND"),
        (2, "IBAN DE89 3704 0044 0532 0130 01"),
        (3, "my ssn is 123-45-6789"),
        (4, "part 123-45-6789"),
        (5, "SSN 000-45-6789"),
        (6, "card 4111 1111 1111 1111, not 4111 1111 1111 1112"),
    ]
    found = {r["doc_id"]: r["s"] for r in pii.find(table(*rows)).select("doc_id", pii.listed(F.col("spans")).alias("s")).collect()}
    assert found == {1: "iban:5:32", 2: "", 3: "ssn:10:21", 4: "", 5: "", 6: "card:5:24"}
    scores = {r["doc_id"]: r["spans"][0]["score"] for r in pii.find(table((1, "4111111111111111"), (2, "visa 4111111111111111"))).collect()}
    assert scores[2] > scores[1]


def test_long_runs_take_linear_time(table):
    rows = [(i, t) for i, t in enumerate(["1" * 200_000, "a" * 200_000 + "@", "1 " * 80_000, "+1" + "." * 80_000, "1." * 40_000, "x@y.zz " * 4000])]
    sizes = {r["doc_id"]: r["n"] for r in pii.find(table(*rows)).select("doc_id", F.size("spans").alias("n")).collect()}
    assert sizes == {0: 0, 1: 0, 2: 0, 3: 0, 4: 10_000, 5: 4000}


def test_redaction_keeps_rows_and_columns(table):
    rows = [(1, "é a@b.co x +49 30 1234567, (1.2.3.4)"), (2, "+1.22.33.44 55 66"), *ODD]
    docs = table(*rows)
    found = pii.redact(docs)
    assert found.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in found.collect()}
    assert texts[1] == "é [EMAIL] x [PHONE], ([IP])" and texts[2] == "[PHONE]"
    assert texts[901] is None and texts[906] == "word " * 30_000
    assert pii.redact(docs.limit(0)).collect() == []


def test_time_grows_with_hits_in_proportion(table):
    """Four times the hits in one text take at most five times as long, above what any query takes."""
    import time

    def took(hits):
        docs = table((1, "ab@cd.ef 1.2.3.4 " * (hits // 2))).persist()
        docs.count()
        start = time.time()
        found = pii.redact(docs).selectExpr("length(text) AS n").first()["n"]
        assert found == len("[EMAIL] [IP] ") * (hits // 2)
        return time.time() - start

    took(1000)
    base, small, large = took(2), took(10_000), took(40_000)
    assert large - base <= 5 * max(small - base, 0.5)


def plain_redacted(text, spans):
    out, at = [], 0
    for start, _, end, kind in sorted(spans):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def test_redaction_of_many_and_overlapping_spans(table, chance, monkeypatch):
    monkeypatch.setattr(pii, "BLOCK", 4)
    monkeypatch.setattr(pii, "LARGE", 12)
    monkeypatch.setattr(pii, "STRETCH", 50)
    rows = [(i, "".join(chance.choice(PARTS) for _ in range(chance.randint(0, 250)))) for i in range(300)]
    docs = table(*rows)
    spans = {r["doc_id"]: r["spans"] for r in pii.find(docs).collect()}
    found = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    for doc_id, text in rows:
        assert base_of(spans[doc_id]) == plain_spans(text)
        assert found[doc_id] == plain_redacted(text, [(s["start"], s["place"], s["end"], s["kind"]) for s in spans[doc_id]])


def base_of(spans):
    return ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans if s["kind"] in PLAIN)


def test_odd_column_names(spark):
    docs = spark.createDataFrame([("a@b.co", 1)], "text string, `a.b` int")
    assert pii.redact(docs).columns == ["text", "a.b"] and pii.redact(docs).first()["text"] == "[EMAIL]"


def test_no_python_runs(table):
    docs = table(*ODD)
    plan = pii.redact(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow(?!Eval)|InArrow", plan)

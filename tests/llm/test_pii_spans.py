"""Personal data: texts of many spans, spans that look alike, added spans against a plain version."""

import re
import time

import pytest

from lakepipe.llm import pii


def found(spark, texts):
    rows = list(enumerate(texts))
    return {r.doc_id: r for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}


@pytest.mark.parametrize("n", [1, 60, 500])
def test_spans_that_look_alike(spark, n):
    got = found(spark, [" ".join(f"user{k}@host{k}.org" for k in range(n))])
    assert got[0].n_email == n and got[0].spans.count("email:") == n


def test_time_is_linear_in_the_spans_of_a_text(spark):
    def seconds(n):
        t = time.perf_counter()
        got = found(spark, ["call 202-555-0147 or " + " ".join(f"a{k}@b.cc {k % 200}.1.1.1" for k in range(n))])
        assert (got[0].n_email, got[0].n_ip) == (n, n)
        return time.perf_counter() - t

    seconds(10)
    few = seconds(1_500)
    assert seconds(12_000) < 8 * few + 10


def test_added_spans_touch_no_base_span(spark, monkeypatch):
    """Every loose match that passes its check is added where no base span overlaps it, whatever their order."""
    monkeypatch.setattr(pii, "_classifier", lambda spans, n: lambda span: span["digit_share"] * 0 + 1.0)
    texts = [
        "Dr. Smith, phone 202-555-0147, Mr Jones 123-45-6789 at joe (at) site (dot) org and joe@site.org",
        "+1 202-555-0147 and 202-555-0147 then 4111 1111 1111 1111 DE89370400440532013000",
        "Mrs Ann Lee mail ann@lee.de. Frau Kim +49 170 123 4567 666-12-3456 é 900-12-3456",
        "x" * 50 + " 202.555.0147 " + "1.2.3.4 " * 30 + "(202) 555-0147",
    ]
    got = found(spark, texts)
    for i, text in enumerate(texts):
        spans = [s.split(":") for s in got[i].spans.split(",") if s]
        base = [(int(a), int(b)) for k, a, b in spans if k in pii.BASE]
        want = set()
        for kind in pii.LOOSE:
            for m in re.finditer(pii._pattern(kind)[0], text):
                ok = {"national_id": not re.match("000|666|9", m[0]), "iban": 15 <= len(m[0]) <= 34}.get(kind, True)
                if ok and not any(a < m.end() and m.start() < b for a, b in base):
                    want.add((kind, str(m.start()), str(m.end())))
        assert {tuple(s) for s in spans if s[0] in pii.LOOSE} == want
        order = [(int(a), pii._ORDER.index(k)) for k, a, b in spans]
        assert order == sorted(order)

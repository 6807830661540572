import hashlib
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from regstar.llm import pii, quality
from regstar.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.conftest import pairs

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@pytest.mark.parametrize("which", ["odd_docs", "small_docs"])
def test_quality_against_python(request, which):
    docs = request.getfixturevalue(which).select("doc_id", "text")
    got = pairs(quality.judge(docs, always=BASE), "doc_id", *BASE, "kept")
    want = [brute.quality_row(*r) for r in pairs(docs, "doc_id", "text")]
    assert sorted(got, key=repr) == sorted(((*r[:6], r[7]) for r in want), key=repr)


def test_quality_query_and_order(spark, small_docs):
    got = sorted(tuple(r) for r in QUERIES["op4_quality_rules"](spark, SF_SMALL).collect())
    assert got == sorted(brute.quality_row(*r) for r in pairs(small_docs, "doc_id", "text"))
    kept = {r[0] for r in got if r[7]}
    for rules in (quality.RULES, quality.RULES[::-1]):
        assert {r[0] for r in pairs(quality.keep_good(small_docs, rules), "doc_id")} == kept
    order = quality.order_rules(small_docs)
    assert sorted(r.name for r in order) == sorted(r.name for r in quality.RULES)


def test_quality_cascade_measures_only_what_is_left(small_docs):
    plan = quality.judge(small_docs.select("text"))._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN kept" in plan


def test_keep_good_keeps_columns(odd_docs, no_docs):
    kept = quality.keep_good(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() > 0
    assert quality.keep_good(no_docs).count() == 0


@pytest.mark.parametrize("which", ["odd_docs", "small_docs"])
def test_base_spans_against_python(request, which):
    docs = request.getfixturevalue(which)
    got = pairs(pii.find_spans(docs, F.col("doc_id")).select("doc_id", pii.told(F.col("base")).alias("t")), "doc_id", "t")
    want = [(d, brute.told(brute.base_spans(t))) for d, t in pairs(docs, "doc_id", "text")]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_pii_query(spark, small_docs):
    rows = QUERIES["op3_pii"](spark, SF_SMALL).collect()
    assert sorted(tuple(r)[:6] for r in rows) == sorted(brute.pii_row(*r) for r in pairs(small_docs, "doc_id", "text"))
    for r in rows:
        base = ",".join(s for s in r.spans.split(",") if s.split(":")[0] in pii.BASE_KINDS)
        assert hashlib.sha256(base.encode()).hexdigest() == r.base_sha256


def test_added_kinds(odd_docs):
    found = dict(pairs(pii.find_spans(odd_docs, F.col("doc_id")).select("doc_id", pii.told(F.col("spans")).alias("t")), "doc_id", "t"))
    text = {d: t for d, t in pairs(odd_docs, "doc_id", "text")}
    by_text = {text[d]: s for d, s in found.items() if d is not None}
    assert by_text["DE89 3704 0044 0532 0130 00"] == "iban:0:27"
    assert by_text["my ssn is 123-45-6789"] == "ssn:10:21"
    assert by_text["ref 123-45-6789"] == ""
    assert by_text["call 555-123-4567 now"] == "local_phone:5:17"


PIECES = st.sampled_from(["a", "b.", "@", "c.d", "1", "22.3", ".", "255", "-", " ", "+", "(", "4111111111111111", "\n", "é", "_"])


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=14).map("".join), min_size=60, max_size=60))
def test_base_spans_of_random_texts(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = dict(pairs(pii.find_spans(docs, F.col("doc_id")).select("doc_id", pii.told(F.col("base")).alias("t")), "doc_id", "t"))
    assert got == {i: brute.told(brute.base_spans(t)) for i, t in enumerate(texts)}


def test_time_follows_the_matches(spark):
    """Spans of one text with very many matches, and ten times as many."""

    def seconds(n):
        text = "a@b.co my ssn is 123-45-6789 ref 555-12-3456 " * n
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string").coalesce(1)
        begin = time.perf_counter()
        found = pii.find_spans(docs, F.col("doc_id")).select(pii.told(F.col("base")), pii.told(F.col("spans"))).first()
        took = time.perf_counter() - begin
        assert found[0] == brute.told(brute.base_spans(text))
        assert found[1].count("ssn:") == 2 * n and found[1].startswith("email:0:6,ssn:17:28,ssn:33:44,email:45:51")
        clean = pii.redact(docs).first().text
        assert clean == "[EMAIL] my ssn is [SSN] ref [SSN] " * n
        return took

    seconds(10)
    few, many = seconds(2_000), seconds(20_000)
    assert many < 20 * max(few, 1.0)


def test_redact(odd_docs, small_docs, no_docs):
    clean = pii.redact(odd_docs)
    assert clean.columns == odd_docs.columns and clean.count() == odd_docs.count()
    texts = {r[0]: r[1:] for r in pairs(clean, "doc_id", "text", "n_chars")}
    for d, t in pairs(odd_docs, "doc_id", "text"):
        if d is not None and not brute.base_spans(t) and not re.search("ssn is|DE89|call 555", t or ""):
            assert texts[d][0] == t
    assert any(t[0] == "é [IP] 😀 [EMAIL]" and t[1] == 16 for t in texts.values())
    again = pii.find_spans(pii.redact(small_docs)).select(F.size("spans").alias("n")).collect()
    assert not any(r.n for r in again) and pii.redact(no_docs).count() == 0

"""Fill-in-middle against a plain version, its inverse, and its edge cases."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowspark.llm import fill_in_middle as fim

MARKS = [m.encode() for m in fim.SENTINELS]


def plain_version(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    if not text or any(m in text for m in fim.SENTINELS) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = (
        "".join(p) for p in (units[:low], units[low:high], units[high:])
    )
    if h[3] % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def by_operator(doc_id, text):
    row_id = "" if doc_id is None else str(doc_id)
    n, form, a, b, out = fim.transform(text.encode(), fim.draws(row_id, 1), 90, 20, MARKS)
    assert fim.restore(out, form, MARKS) == text.encode()
    return n, form, a, b, out.decode()


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**6), st.text(st.sampled_from("abZ é漢😀\n<>PSM\x00"), max_size=60))
def test_equals_plain_version(doc_id, text):
    assert by_operator(doc_id, text) == plain_version(doc_id, text)


@pytest.mark.parametrize("unit", ["a", "é ", "ab <", "漢"])
def test_very_long_texts(unit):
    """Longer than several blocks, with cuts in all of them."""
    text = unit * 100_000
    for doc_id in range(12):
        assert by_operator(doc_id, text) == plain_version(doc_id, text)


def test_rotation_and_reversal():
    for size in (0, 1, 2, 7, 2 * fim.BLOCK, 2 * fim.BLOCK + 1, 5 * fim.BLOCK + 3):
        data = bytearray(i * 7 % 251 for i in range(size))
        before = bytes(data)
        for cut in {0, size // 3, size}:
            fim.rotate(data, 0, cut, size)
            assert data == before[cut:] + before[:cut]
            fim.rotate(data, 0, size - cut, size)
            assert data == before


def test_edge_rows(spark):
    texts = [
        (1, "one two"), (2, ""), (3, None), (None, "no id, some text"), (None, None),
        (4, "has <M> inside"), (5, "<P><S>"), (6, "< P> a<"), (7, "same"), (7, "same"),
        (8, " \n\t "), (9, "é漢字 😀 " * 50),
    ]
    rows = [(d, t, "x", "y", 1) for d, t in texts for _ in (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, output string, n int")
    made = fim.fill_in_middle(docs)
    back = made.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    key = lambda r: tuple(map(str, r))
    expected = [(d, *plain_version(d, t), t or "") for d, t, *_ in rows]
    assert sorted(map(tuple, back), key=key) == sorted(expected, key=key)
    assert fim.digests(fim.fill_in_middle(docs.limit(0))).count() == 0


def test_rates_and_other_sentinels(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("some words here").alias("text"))
    forms = {r["form"]: r["n"] for r in fim.fill_in_middle(docs, fim_percent=50, spm_percent=50)
             .groupBy("form").agg(F.count("*").alias("n")).collect()}
    assert all(abs(forms[f] - n) < 120 for f, n in (("plain", 1000), ("psm", 500), ("spm", 500)))
    other = ("[pre]", "[suf]", "[mid]")
    made = fim.fill_in_middle(docs, fim_percent=100, sentinels=other)
    texts = made.select(fim.restored(F.col("output"), F.col("form"), other).alias("t")).distinct()
    assert [r.t for r in texts.collect()] == ["some words here"]
    assert made.where("output like '%[mid]%'").count() == 2000


@pytest.mark.parametrize("marks", [("<P>", "<P>", "<M>"), ("<P>", "<PP", "<P"), ("aba", "<S>", "<M>")])
def test_sentinels_that_could_be_misread_are_refused(spark, marks):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError):
        fim.fill_in_middle(docs, sentinels=marks)

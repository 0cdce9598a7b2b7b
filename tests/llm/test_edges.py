"""NULLs, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import random

import pytest
from brute import component_of, lines, quality, sha, simhash, substrings, words_of
from pyspark.sql import functions as F

from flowspark.llm import (
    chat_format,
    fingerprints,
    line_dedup,
    mixing,
    packing,
    quality_classifier,
    quality_rules,
    simhash as simhash_op,
    substring_dedup,
    token_counts,
)
from flowspark.llm.packing import encoder
from flowspark.llm.token_counts import counter
from flowspark.llm.vocabulary import default_path

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "_doc string, _row string, size string, score string, block string, h string, _n int"
)


def _rows():
    draw = random.Random(5)
    long = " ".join(draw.choice(["alpha", "beta", "gamma", str(draw.randrange(900))]) for _ in range(30_000))
    shared = "A line that many documents share."
    texts = [
        (1, "one two three.\n" + shared), (2, shared.upper() + " \nrest"), (3, ""), (4, None),
        (None, shared), (None, None), (5, long), (6, long + " end"), (7, " \t\n"), (7, "other text"),
        (8, "x " * 500), (9, "é漢字 😀 " * 40), (10, "same"), (10, "same"), (11, "<|endoftext|>a  b"),
        (12, "short line\r\nshort line\n  short line"),
    ]
    return [
        (doc, text, None, ["a", None, "b", "é"][i % 4], None, "x", "y", "z", "s", "b", None, i)
        for i, (doc, text) in enumerate(texts)
    ]


ROWS = _rows()
BAG = lambda rows: sorted(rows, key=repr)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (2, 0, None), (5, 1, 0), (None, 1, 0), (6, None, 1), (99, 1, 1), (8, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_quality_rules(docs):
    got = quality_rules.quality_rules(docs).collect()
    assert BAG((r[0], *r[1:7]) for r in got) == BAG((d[0], *quality(d[1])) for d in ROWS)


def test_token_counts(docs):
    known = counter(default_path())
    got = token_counts.token_counts(docs, limit=6).collect()
    assert BAG((r.doc_id, r.n_tokens) for r in got) == BAG((d[0], known.count(d[1] or "")) for d in ROWS)
    assert all(r.fitting_chars <= r.n_bytes and r.over_limit == (r.n_tokens > 6) for r in got)


def test_prefix_table(docs):
    stored = docs.where("doc_id in (1, 9)").select(
        "text", token_counts.prefix_tokens(F.col("text")).alias("prefixes")
    )
    rows = stored.select(
        "text", "prefixes",
        token_counts.tokens_at(F.col("prefixes"), 12).alias("at"),
        token_counts.truncation_point(F.col("prefixes"), 9).alias("cut"),
    ).collect()
    for r in rows:
        counts = counter(default_path()).prefixes(r.text)
        assert r.prefixes == counts and r.at == counts[12]
        assert r.cut == max(i for i, n in enumerate(counts) if n <= 9)


def test_substring_dedup(docs):
    for hot in (20_000, 3):
        got = substring_dedup.substring_dedup(docs, hot_anchor=hot).collect()
        expected = [(d[0], *e) for d, e in zip(ROWS, substrings([d[1] for d in ROWS], 35))]
        assert BAG(tuple(r) for r in got) == BAG(expected)


def test_fingerprints(docs):
    got = fingerprints.edited_fingerprints(docs, blocks=3).collect()
    assert len(got) == len(ROWS)
    prints = fingerprints.fingerprints(docs).collect()
    by_text = {}
    for r in prints:
        by_text.setdefault(r.fingerprint, []).append(r.doc_id)
    assert len(by_text) == len({d[1] or "" for d in ROWS})
    chars = BAG((d[0], len(d[1] or "")) for d in ROWS)
    assert BAG((r.doc_id, r.n_chars) for r in got) == chars


def test_differing_branches(spark):
    lines_ = [f"Paragraph {i} says this. And that." for i in range(60)]
    other = [*lines_]
    other[17] = "Another one."
    row = spark.createDataFrame([("\n".join(lines_), "\n".join(other))], "a string, b string").select(
        fingerprints.differing(fingerprints.tree(F.col("b")), fingerprints.tree(F.col("a"))).alias("d"),
        fingerprints.tree(F.col("b")).alias("t"),
    )
    found = row.first()
    assert len(found.d) == 1
    before = sum(len(s.paragraphs) for s in found.t.sections[: found.d[0].section - 1])
    assert before + found.d[0].paragraph == 18


def test_quality_classifier(docs, labels):
    got = quality_classifier.quality_classifier(docs, labels).collect()
    assert BAG(r.doc_id for r in got) == BAG(d[0] for d in ROWS)
    assert all(0 <= r.score <= 1 for r in got)
    assert quality_classifier.accepted(docs, labels).columns == docs.columns
    none = quality_classifier.quality_classifier(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}


def test_line_dedup(docs):
    expected = lines([d[:2] for d in ROWS])
    got = line_dedup.line_dedup(docs).collect()
    assert BAG(tuple(r) for r in got) == BAG((d, n, k, sha(t)) for d, n, k, t in expected)
    kept = line_dedup.dedup_lines(docs)
    assert kept.columns == docs.columns
    assert BAG((r.doc_id, r.text or "") for r in kept.collect()) == BAG((d, t) for d, _, _, t in expected)


def test_line_dedup_of_three(docs):
    counted = line_dedup.line_dedup(docs, min_documents=3).collect()
    assert sum(r.n_dropped for r in counted) == 2


def test_chat_format(spark):
    rows = [
        (1, 0, "user", None), (1, 1, None, "a\\b<|end|>"), (1, 1, None, "a\\b<|end|>"),
        (2, 0, "assistant", "<<s></s>"), (2, 2, "tool", ""), (3, 1, "", ""),
    ]
    loose = [(None, None, "user", "[[INST]"), (None, 1, "assistant", "x"), (None, 1, "assistant", "x")]
    df = spark.createDataFrame(
        [(*r, "x") for r in rows + loose], "conv_id long, turn long, role string, text string, turns string"
    )
    found = chat_format.digests(chat_format.format_conversations(df)).collect()
    assert BAG(r.turns_sha256 for r in found if r.conv_id is None) == BAG(
        sha(f"{role}\n{text}\n") for _, _, role, text in loose
    )
    got = {r.conv_id: r for r in found}
    for conv in (1, 2, 3):
        own = [(r[2] or "", r[3] or "") for r in rows if r[0] == conv]
        assert got[conv].n_turns == len(own)
        assert got[conv].turns_sha256 == sha("".join(f"{a}\n{b}\n" for a, b in own))
        loss = "".join(b for a, b in own if a == "assistant")
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), sha(loss))
    assert not got[2].in_order


def test_packing(docs):
    got = packing.packing(docs).collect()
    encode = encoder(default_path()).encode
    assert sum(r.length for r in got) == sum(len(encode(d[1] or "")) // 4 + 1 for d in ROWS)
    assert {r.doc_id for r in got} == {d[0] for d in ROWS}


def test_simhash(docs):
    got = simhash_op.simhash_near_dedup(docs).collect()
    values = [simhash(d[1]) for d in ROWS]
    assert BAG((r.doc_id, r.fingerprint) for r in got) == BAG((d[0], f"{v:016x}") for d, v in zip(ROWS, values))
    roots = component_of(values)
    smallest = {}
    for d, root in zip(ROWS, roots):
        if d[0] is not None:
            smallest[root] = min(d[0], smallest.get(root, d[0]))
    expected = BAG((d[0], smallest.get(root)) for d, root in zip(ROWS, roots))
    assert BAG((r.doc_id, r.component_id) for r in got) == expected
    kept = simhash_op.one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(roots))


def test_mixing(docs):
    got = mixing.mixing(docs).collect()
    assert BAG((r.doc_id, r.size) for r in got) == BAG((d[0], len(words_of(d[1]))) for d in ROWS)
    total = sum(r.size for r in got)
    sources = {}
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        sources.setdefault((r.source_size, r.target), []).append(r.taken)
    assert abs(sum(t for _, t in sources) - total) < 1e-6 * total
    for (_, target), taken in sources.items():
        assert sum(taken) == int(target)
    again = mixing.mixing(docs.repartition(5)).collect()
    assert BAG(map(tuple, got)) == BAG(map(tuple, again))
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    assert sum(len(words_of(r.text)) for r in mixed.collect()) == sum(r.taken for r in got)


def test_empty_tables(docs, labels):
    none = docs.limit(0)
    for result in (
        quality_rules.quality_rules(none), token_counts.token_counts(none), mixing.mixing(none),
        mixing.mix_documents(none), substring_dedup.substring_dedup(none),
        fingerprints.edited_fingerprints(none), quality_classifier.quality_classifier(none, labels),
        line_dedup.line_dedup(none), line_dedup.dedup_lines(none), packing.packing(none),
        simhash_op.simhash_near_dedup(none), simhash_op.one_of_each(none),
    ):
        assert result.count() == 0


def test_packing_of_many_tiny_texts(spark):
    many = spark.range(30_000).select(F.col("id").alias("doc_id"), F.lit("a").alias("text"))
    rows = packing.packing(many).collect()
    fills = {}
    for r in rows:
        fills[r.sequence_id] = fills.get(r.sequence_id, 0) + r.length
    assert len(rows) == 30_000 and max(fills.values()) <= 2048
    assert len(fills) <= -(-60_000 // 2048) + 8

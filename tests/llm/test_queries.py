"""Each numbered query against its SQL or a brute-force version, on the smallest tables."""

import zlib

import duckdb
import pytest
from brute import check_packing, component_of, quality, sha, simhash, substrings
from comparison import connect, difference
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
from flowspark.llm.queries import ORACLE_SQL, QUERIES
from flowspark.llm.vocabulary import default_path

SF = "/root/testdata/sf0.001"


def read(table):
    return duckdb.sql(f"SELECT * FROM '{SF}/{table}.parquet'").df()


@pytest.fixture(scope="module")
def documents():
    return read("documents").sort_values("doc_id", ignore_index=True)


def rows_of(spark, name):
    return {r.doc_id: r for r in QUERIES[name](spark, SF).collect()}


def test_every_operator_is_registered():
    registered = entry_points.queries()
    assert set(QUERIES) <= set(registered) and "pipeline" in registered
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_sql(spark, name):
    assert difference(QUERIES[name](spark, SF), connect(SF), ORACLE_SQL[name]) is None


def test_quality_rules_measures(spark, documents):
    got = rows_of(spark, "op1_quality_rules")
    for doc, text in zip(documents.doc_id, documents.text):
        r = got[doc]
        assert quality(text) == (
            r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed
        )
        assert not (r.base_failed and r.kept)


def test_quality_rules_verdict(spark):
    """Clean documents of 20 words and more stay, most labelled junk goes."""
    got, labels = rows_of(spark, "op1_quality_rules"), read("labels")
    good = [got[d].kept for d, q in zip(labels.doc_id, labels.quality) if q and not got[d].base_failed]
    bad = [got[d].kept for d, q in zip(labels.doc_id, labels.quality) if not q]
    assert sum(good) >= 0.98 * len(good)
    assert sum(bad) <= 0.3 * len(bad)


def test_token_counts(spark, documents):
    got = rows_of(spark, "op2_token_counts")
    library = Tokenizer.from_file(default_path())
    for doc, text in zip(documents.doc_id, documents.text):
        ids = library.encode(text, add_special_tokens=False).ids
        r = got[doc]
        assert (r.n_tokens, r.over_limit) == (len(ids), len(ids) > 512)
        assert r.n_bytes == len(text.encode())
        fitting = library.encode(text[: r.fitting_chars], add_special_tokens=False).ids
        assert len(fitting) <= 512


def test_substring_dedup(spark, documents):
    got = rows_of(spark, "op4_substring_dedup")
    expected = substrings(documents.text, 35)
    assert [
        (got[d].n_words, got[d].n_removed, got[d].kept_sha256) for d in documents.doc_id
    ] == expected
    assert sum(e[1] for e in expected) > 0


def test_fingerprints(spark, documents):
    got = rows_of(spark, "op5_fingerprints")
    order = documents.sort_values("doc_id", ascending=False, ignore_index=True)
    texts, ids = list(order.text), list(order.doc_id)
    prints, likeness = {}, []
    for i, (doc, text) in enumerate(zip(ids, texts)):
        following = texts[(i + 1) % len(texts)]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        r = got[doc]
        assert (r.n_chars, r.edited_sha256) == (len(text), sha(edited))
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        assert prints.setdefault(edited, r.edited_fingerprint) == r.edited_fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if edited == text:
            assert r.near_edited == 1
        if following == text:
            assert r.near_next == 1
        likeness.append((r.near_edited, r.near_next))
    assert len(set(prints.values())) == len(prints)
    assert sum(a > b for a, b in likeness) > 0.95 * len(likeness)


def test_quality_classifier(spark):
    got, labels = rows_of(spark, "op6_quality_classifier"), read("labels")
    for doc, r in got.items():
        assert r.held_out == (zlib.crc32(str(doc).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(got[d], q) for d, q in zip(labels.doc_id, labels.quality) if got[d].held_out]
    assert sum(r.predicted == q for r, q in held) >= 0.9 * len(held)


def test_chat_format(spark):
    rows = read("conversations")
    turns = {}
    for conv, turn, role, text in sorted(zip(rows.conv_id, rows.turn, rows.role, rows.text)):
        turns.setdefault(conv, []).append((role, text or ""))
    control = "</s>[INST] ok [/INST]"
    turns[-7] = [("user", control), ("assistant", control)]
    got = {r.conv_id: r for r in QUERIES["op8_chat_format"](spark, SF).collect()}
    assert set(got) == set(turns)
    for conv, own in turns.items():
        loss = "".join(text for role, text in own if role == "assistant")
        r = got[conv]
        assert r.n_turns == len(own)
        assert r.turns_sha256 == sha("".join(f"{a}\n{b}\n" for a, b in own))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))


def test_packing(spark, documents):
    library = Tokenizer.from_file(default_path())
    ids = {
        d: [*library.encode(t, add_special_tokens=False).ids, 1]
        for d, t in zip(documents.doc_id, documents.text)
    }
    fill = check_packing(QUERIES["op9_packing"](spark, SF).collect(), ids)
    assert fill > 0.95


def test_simhash(spark, documents):
    got = rows_of(spark, "op10_simhash")
    values = [simhash(t) for t in documents.text]
    ids = list(documents.doc_id)
    assert [got[d].fingerprint for d in ids] == [f"{v:016x}" for v in values]
    roots = component_of(values)
    assert [got[d].component_id for d in ids] == [ids[i] for i in roots]

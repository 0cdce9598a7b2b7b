"""The pipeline's stages, each against brute force on what the one before kept."""

import glob
import os
from collections import Counter

import numpy as np
import pytest
from brute import component_of, lines, simhash, words_of

import corpus_pipeline
from flowspark.llm import quality_classifier
from flowspark.llm.common import saved, table
from flowspark.llm.packing import encoder
from flowspark.llm.vocabulary import default_path
from flowspark.scratch import shared_root

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def frames(spark):
    """The documents and what each stage made of them."""
    docs = table(spark, SF, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, SF), name)
        out.append(docs)
    return out


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_columns_stay(frames):
    for df in frames[1:-1]:
        assert df.columns == frames[0].columns


def test_classifier_rejects(spark, frames):
    scored = quality_classifier.quality_classifier(frames[0], table(spark, SF, "labels"))
    kept = {r.doc_id for r in scored.where("predicted = 1").collect()}
    assert {d for d, _ in pairs(frames[1])} == kept
    assert 0 < len(kept) < frames[0].count()
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    good = [d for d, q in labels.items() if q == 1]
    assert sum(d in kept for d in good) >= 0.97 * len(good)


def test_lines(frames):
    expected = Counter((d, t) for d, _, _, t in lines(pairs(frames[1])))
    assert Counter(pairs(frames[2])) == expected


def test_one_of_each_group(frames):
    before = sorted(pairs(frames[2]))
    roots = component_of([simhash(text) for _, text in before])
    kept = {before[root] for root in roots}
    assert sorted(pairs(frames[3])) == sorted(kept)


def test_mix(frames):
    texts = dict(pairs(frames[3]))
    sources = {r.doc_id: r.source for r in frames[3].collect()}
    size = Counter()
    for doc, text in texts.items():
        size[sources[doc]] += len(words_of(text))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(size))}
    total, capped = sum(size.values()), set()
    while True:
        free = total - sum(3 * size[s] for s in capped)
        open_ = sum(w for s, w in weight.items() if s not in capped)
        target = {s: 3 * size[s] if s in capped else free * w / open_ for s, w in weight.items()}
        above = {s for s in size if target[s] >= 3 * size[s]}
        if above == capped:
            break
        capped = above
    taken, times = Counter(), Counter()
    for doc, text in pairs(frames[4]):
        own = words_of(texts[doc])
        assert words_of(text) == own[: len(words_of(text))]
        taken[sources[doc]] += len(words_of(text))
        times[doc] += 1
    assert max(times.values()) <= 3
    for source, wanted in target.items():
        assert taken[source] == int(wanted)


def test_packed(frames):
    encode = encoder(default_path()).encode
    expected = np.concatenate([np.frombuffer(encode(t), "<u4") for _, t in pairs(frames[4])])
    rows = frames[5].collect()
    assert sum(r.length for r in rows) == len(expected) + frames[4].count()
    fills = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fills.get(r.sequence_id, 0)
        fills[r.sequence_id] = r.offset + r.length
    assert max(fills.values()) <= 2048


def folders(spark):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{shared_root(spark)}/flowspark-*")}


def test_run(spark, frames):
    """The same rows as stage by stage; of each run only they are left on the disk."""
    left = []
    for _ in range(2):
        before = folders(spark)
        again = corpus_pipeline.run(spark, SF)
        assert again.columns == frames[5].columns and again.count() == frames[5].count()
        new = folders(spark).keys() - before.keys()
        left.append(sum(os.path.getsize(f) for folder in new
                        for f in glob.glob(f"{folder}/**", recursive=True) if os.path.isfile(f)))
        assert len(new) == 1
    assert abs(left[0] - left[1]) < 0.2 * left[0]


EDGES = [
    (1, "one two three four five six\nA line that many documents share.", "a", 1), (2, "", "a", 0),
    (3, None, None, 1), (None, "A line that many documents share.\nwith no id at all", "b", 1),
    (None, None, "b", 0), (4, "the same text in full again", "a", 1), (4, "the same text in full again", "a", 1),
    (5, "x " * 20_000 + "end", "é", 1), (6, " \t\n" * 30_000, "é", 1), (7, "é漢字 😀 " * 40, None, 1),
    (8, "the same text in full again", "b", 1),
]


def edge_folder(spark, tmp_path, rows):
    docs = spark.createDataFrame(
        [(d, t, None, s, None, "x", 1) for d, t, s, _ in rows],
        "doc_id long, text string, lang string, source string, n_chars long, _row string, size int",
    )
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(d, q, 0) for d, _, _, q in rows if d is not None],
                                   "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_edge_rows(spark, tmp_path):
    """Every stage against brute force on what the one before kept of the edge rows."""
    folder = edge_folder(spark, tmp_path, EDGES)
    docs = table(spark, folder, "documents")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, folder), name)
        kept.append(docs)
    for df in kept[1:-1]:
        assert df.columns == kept[0].columns
    key = lambda row: (row[0] is None, row[0] or 0, row[1] is not None, row[1] or "")
    rows = sorted(pairs(kept[2]), key=key)
    roots = component_of([simhash(text or "") for _, text in rows])
    assert len(pairs(kept[3])) == len(set(roots))
    assert {d for d, _ in pairs(kept[3])} <= {d for d, _ in rows}
    mixed = pairs(kept[4])
    encode = encoder(default_path()).encode
    tokens = sum(len(encode(t or "")) // 4 + 1 for _, t in mixed)
    packed = kept[5].collect()
    assert sum(r.length for r in packed) == tokens
    run = corpus_pipeline.run(spark, folder)
    assert run.count() == len(packed)


def test_empty_tables(spark, tmp_path):
    folder = edge_folder(spark, tmp_path, [])
    assert corpus_pipeline.run(spark, folder).count() == 0

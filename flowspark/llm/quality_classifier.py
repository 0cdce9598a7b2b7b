"""Quality classifier: random-indexing word vectors, pooled, under a two-layer network.

A word's index vector is sparse and random, drawn from a hash of the word; its context
vector is the sum of the index vectors of its neighbours. Vectors are learned from a
bounded sample of labelled documents (about ``sample_rows``, drawn by hash of their ids) and
kept for the most frequent words, ``vocabulary`` at most, so the model has a fixed size and
is broadcast. A document is pooled to the mean vector of its words, the mean of its distinct
words and four measures of its vocabulary. A network with one hidden layer is trained in
numpy; the temperature that fits a held-back tenth best calibrates its probabilities.

Only texts enter a score: no label, language, source or id does.

Cases: a NULL or empty text pools to zeros and gets the network's score for them. Labels
without a quality or a document are not used; a document with several labels counts once,
with the lowest, and of several texts of one id the least is learned from. Without a row
to learn from every score is 0.5. Repeated rows get equal scores; further columns do not
matter.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowspark.llm.common import saved, ship

TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+|[^\s0-9a-z\x80-\xff]")
DIMENSIONS = 64
#: Places of an index vector that are not zero, half of them +1 and half -1.
NONZERO = 4
CONTEXT = 2
#: Tokens pooled at once; of longer texts the parts are added up.
BLOCK = 1 << 20
#: Words whose vectors a task sums up before it passes them on, and tokens at once.
SUMMED_WORDS = 50_000
CONTEXT_BLOCK = 1 << 13
HASHES = 1 << 32


def tokens_of(text: str) -> list[bytes]:
    return TOKEN.findall(text.encode().lower())


def index_vector(word: bytes) -> np.ndarray:
    vector = np.zeros(DIMENSIONS, np.float32)
    for i in range(NONZERO):
        place = xxhash.xxh64_intdigest(word, i) % DIMENSIONS
        vector[place] += 1 if i % 2 else -1
    return vector


@dataclass
class Model:
    words: dict[bytes, int]
    vectors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    hidden: tuple[np.ndarray, np.ndarray]
    out: tuple[np.ndarray, np.ndarray]
    temperature: float

    def pool(self, text: str) -> np.ndarray:
        return pool(text, self.words, self.vectors)

    def score(self, features: np.ndarray) -> np.ndarray:
        if not len(features):
            return np.zeros(0)
        logits = _logits((features - self.centre) / self.scale, self.hidden, self.out)
        return _probability(logits / self.temperature)


def pool(text: str, words: dict[bytes, int], vectors: np.ndarray) -> np.ndarray:
    """Mean of the words and of the distinct words; neighbours that are one word (whose
    vectors' likeness is 1), length, variety, share of words without a vector."""
    tokens = tokens_of(text)
    out = np.zeros(2 * DIMENSIONS + 4, np.float64)
    if not tokens:
        return out
    counts = np.zeros(len(vectors) + 1, np.int64)
    for start in range(0, len(tokens), BLOCK):
        part = tokens[start : start + BLOCK]
        place = np.fromiter((words.get(t, -1) for t in part), np.int64, len(part))
        counts += np.bincount(place + 1, minlength=len(counts))
    known = np.flatnonzero(counts[1:])
    if len(known):
        own = vectors[known]
        weight = counts[1:][known]
        out[:DIMENSIONS] = weight @ own / weight.sum()
        out[DIMENSIONS : 2 * DIMENSIONS] = own.mean(axis=0)
    out[-4] = np.sqrt(sum(map(operator.eq, tokens, tokens[1:])) / len(tokens))
    out[-3] = np.log1p(len(tokens))
    out[-2] = np.log(len(set(tokens)) / len(tokens))
    out[-1] = counts[0] / len(tokens)
    return out


def _probability(logits: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logits, -50, 50)))


def _logits(x: np.ndarray, hidden, out) -> np.ndarray:
    return np.maximum(x @ hidden[0] + hidden[1], 0) @ out[0] + out[1]


def train(features: np.ndarray, labels: np.ndarray, units: int = 32, rounds: int = 30, seed: int = 7):
    """(hidden, out) layers after Adam steps on the cross entropy, in batches of 256."""
    random = np.random.default_rng(seed)
    n = features.shape[1]
    params = [
        random.normal(0, np.sqrt(2 / n), (n, units)),
        np.zeros(units),
        random.normal(0, np.sqrt(1 / units), units),
        np.zeros(1),
    ]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(rounds):
        order = random.permutation(len(labels))
        for start in range(0, len(order), 256):
            rows = order[start : start + 256]
            x, y = features[rows], labels[rows]
            inner = np.maximum(x @ params[0] + params[1], 0)
            error = (_probability(inner @ params[2] + params[3]) - y) / len(rows)
            back = np.outer(error, params[2]) * (inner > 0)
            grads = [x.T @ back, back.sum(axis=0), inner.T @ error, np.array([error.sum()])]
            step += 1
            for i, grad in enumerate(grads):
                grad = grad + 1e-4 * params[i]
                first[i] += 0.1 * (grad - first[i])
                second[i] += 0.001 * (grad * grad - second[i])
                rate = 0.003 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                params[i] = params[i] - rate * first[i] / (np.sqrt(second[i]) + 1e-8)
    return (params[0], params[1]), (params[2], params[3])


def best_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the least cross entropy."""
    candidates = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
    signs = 2 * labels - 1
    losses = [np.logaddexp(0, -signs * logits / t).mean() for t in candidates]
    return float(candidates[int(np.argmin(losses))])


def learn_vectors(texts: DataFrame, vocabulary: int) -> tuple[dict[bytes, int], np.ndarray]:
    """Context vectors of the most frequent words of ``text``, of unit length."""

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = SUMMED_WORDS + CONTEXT_BLOCK + 2 * CONTEXT
        place: dict[bytes, int] = {}
        index = np.zeros((rows, DIMENSIONS), np.float32)
        sums, counts = np.zeros_like(index), np.zeros(rows, np.int64)

        def place_of(token: bytes) -> int:
            known = place.get(token)
            if known is None:
                known = place[token] = len(place)
                index[known] = index_vector(token)
            return known

        def summed() -> pa.RecordBatch:
            n = len(place)
            vectors = pa.ListArray.from_arrays(
                pa.array(np.arange(0, n * DIMENSIONS + 1, DIMENSIONS), pa.int32()),
                pa.array(sums[:n].ravel().copy()),  # Arrow keeps the buffer it is given
            )
            words = [pa.array(list(place), pa.binary()), pa.array(counts[:n].copy()), vectors]
            place.clear()
            sums[:], counts[:] = 0, 0
            return pa.RecordBatch.from_arrays(words, ["word", "n", "vector"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                tokens = tokens_of(text)
                for start in range(0, len(tokens), CONTEXT_BLOCK):
                    low = max(0, start - CONTEXT)
                    stop = min(len(tokens), start + CONTEXT_BLOCK)
                    around = np.array([place_of(t) for t in tokens[low : stop + CONTEXT]])
                    own = around[start - low : stop - low]
                    padded = np.zeros((len(own) + 2 * CONTEXT, DIMENSIONS), np.float32)
                    lead = CONTEXT - (start - low)
                    padded[lead : lead + len(around)] = index[around]
                    total = sum(
                        padded[s : s + len(own)] for s in range(2 * CONTEXT + 1) if s != CONTEXT
                    )
                    np.add.at(sums, own, total)
                    counts[:] += np.bincount(own, minlength=rows)
                    if len(place) >= SUMMED_WORDS:
                        yield summed()
        if place:
            yield summed()

    parts = texts.mapInArrow(contexts, "word binary, n long, vector array<float>")
    sums = [F.sum(F.get("vector", F.lit(i))).cast("float") for i in range(DIMENSIONS)]
    words = saved(
        parts.groupBy("word")
        .agg(F.sum("n").alias("n"), F.array(*sums).alias("vector"))
        .where("n > 1"),
        "words",
    )
    # Not a top-n: each task would send that many vectors. Few counts are asked for first.
    least, room = 1 << 62, vocabulary
    for n, rows in words.groupBy("n").count().orderBy(F.desc("n")).collect():
        if rows > room:
            break
        least, room = n, room - rows
    table = words.where(F.col("n") >= least).select("word", "vector").toArrow().sort_by("word")
    known = table.column("word").to_pylist()
    vectors = _matrix(table.column("vector"), len(known)).astype(np.float32)
    if len(vectors):
        # What all words share (the commonest neighbours) says little about any of them.
        vectors -= vectors.mean(axis=0)
        vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-6)
    return {bytes(word): i for i, word in enumerate(known)}, vectors


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    """A column of lists of one length as a matrix."""
    if not rows:
        return np.zeros((0, DIMENSIONS))
    flat = pa.concat_arrays([chunk.flatten() for chunk in column.chunks])
    return flat.to_numpy().reshape(rows, -1)


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def fit(
    docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, vocabulary: int = 20_000
) -> Model | None:
    """A model of ``quality`` from the labelled rows that are not held out; None without any."""
    spark = docs.sparkSession
    ship(spark)
    labelled = (
        labels.where("doc_id is not null and quality is not null")
        .where(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").cast("int").alias("quality"))
    )
    share = min(1.0, sample_rows / max(1, labelled.count()))
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(HASHES)) < int(share * HASHES)
    # About sample_rows pairs of numbers.
    sample = F.broadcast(labelled.where(drawn))
    texts = saved(
        docs.select(
            docs["doc_id"].cast("long").alias("doc_id"),
            F.coalesce(docs["text"], F.lit("")).alias("text"),
        )
        .join(sample, "doc_id")
        .groupBy("doc_id", "quality")
        .agg(F.min("text").alias("text")),
        "sample",
    )
    words, vectors = learn_vectors(texts.select("text"), vocabulary)
    shared = spark.sparkContext.broadcast((words, vectors))

    def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, matrix = shared.value
        for batch in batches:
            rows = [pool(t, known, matrix).tolist() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.float64()))],
                ["doc_id", "quality", "features"],
            )

    rows = (
        texts.select("doc_id", "quality", "text")
        .mapInArrow(pooled, "doc_id long, quality int, features array<double>")
        .toArrow()
        .sort_by("doc_id")
    )
    shared.unpersist()
    if not rows.num_rows:
        return None
    features = _matrix(rows.column("features"), rows.num_rows)
    quality = rows.column("quality").to_numpy().astype(np.float64)
    aside = np.array(
        [xxhash.xxh64_intdigest(str(i), 1) % 10 == 0 for i in rows.column("doc_id").to_pylist()]
    )
    if aside.all() or not aside.any():
        aside = np.zeros(len(aside), bool)
    centre, scale = features[~aside].mean(axis=0), features[~aside].std(axis=0) + 1e-6
    scaled = (features - centre) / scale
    hidden, out = train(scaled[~aside], quality[~aside])
    temperature = 1.0
    if aside.any():
        temperature = best_temperature(_logits(scaled[aside], hidden, out), quality[aside])
    return Model(words, vectors, centre, scale, hidden, out, temperature)


def score(text: Column, model: Model | None, spark) -> Column:
    """Probability of quality 1 of each text."""
    ship(spark)
    if model is None:
        return F.when(text.isNull(), 0.5).otherwise(0.5)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = shared.value
        for batch in batches:
            rows = [known.pool(t) for t in batch.to_pylist()]
            features = np.array(rows).reshape(len(rows), -1)
            yield pa.array(known.score(features), pa.float64())

    return run(F.coalesce(text, F.lit("")))


def quality_classifier(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **limits) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``."""
    model = fit(docs, labels, **limits)
    scored = docs.select("doc_id", score(docs["text"], model, docs.sparkSession).alias("score"))
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **limits) -> DataFrame:
    """The rows of ``docs`` that are not rejected."""
    model = fit(docs, labels, **limits)
    return docs.where(score(docs["text"], model, docs.sparkSession) >= threshold)

"""Toxicity by multiple-instance learning: only documents have labels, sentences get scores.

A sentence's score is logistic in the features of its words: each word (lower-case ASCII, marks cut off) and its
beginnings of PREFIXES bytes, hashed to BUCKETS. A document is toxic if any sentence is: P = 1 - prod(1 - p) (noisy-or). The
likelihood of the documents' labels is maximised over all sentences at once, so the model finds by itself which sentences made a
document toxic; offending() tells them.

A document's score grows with the number of its sentences, as a noisy-or does; how little a plain sentence adds is learned from the
longest clean documents among the labelled.

Which features take part is decided by counts of documents of both labels over the labelled sample, in fixed arrays.

Defined results: null and empty texts have no sentence and score 0; without labelled rows or with labels of one kind every
sentence scores 0; rows that repeat score alike; columns named like added ones are replaced.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import Words, byte_values, prefix_sums, range_hashes, slices, utf8
from .columns import named, plain
from .labelled import SAMPLE, sample
from .storage import spread, stash

BUCKETS = 1 << 20
PREFIXES = (4, 5, 6)
FEATURES = 8192
APART = 4.0
ROUNDS = 250
#: Bytes that end a sentence, and marks around words.
ENDS = b".!?"
MARKS = b".,!?;:*%$&#|\"'()[]{}<>-_=+/\\@~`^"

_U = np.uint64


class Sentences:
    """The sentences of some rows and the features of their words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, i: int, j: int):
        words = Words(data, offsets, i, j)
        low = words.data + (((words.data >= 65) & (words.data <= 90)).astype(np.uint8) << 5)
        mark = np.zeros(256, bool)
        mark[list(MARKS)] = True
        plain = ~mark[low]
        at = np.arange(len(low))
        before = np.maximum.accumulate(np.where(plain, at, -1)) if len(low) else at
        ahead = np.minimum.accumulate(np.where(plain, at, len(low))[::-1])[::-1] if len(low) else at
        starts = np.minimum(ahead[words.starts], words.ends)
        ends = np.maximum(np.minimum(before[words.ends - 1] + 1, words.ends), starts)
        lines = np.zeros(len(low) + 1, np.int64)
        np.cumsum(low == 0x0A, out=lines[1:])
        stop = np.isin(low[words.ends - 1], np.frombuffer(ENDS, np.uint8))
        new = np.ones(len(words.starts), bool)
        new[1:] = stop[:-1] | (words.row[1:] != words.row[:-1]) | (lines[words.starts[1:]] > lines[words.ends[:-1]])
        self.words = words
        self.of_word = np.cumsum(new) - 1
        self.first_word = np.flatnonzero(new)
        self.row = words.row[self.first_word]
        sums = prefix_sums(byte_values()[low])
        kinds = [range_hashes(sums, starts, ends) ^ _U(0x1F)]
        for n in PREFIXES:
            h = range_hashes(sums, starts, np.minimum(starts + n, ends))
            h ^= _U(0x2B * n)
            kinds.append(h)
        self.features = np.stack([(h & _U(BUCKETS - 1)).astype(np.int32) for h in kinds], 1)

    def scores(self, weights: np.ndarray, bias: float) -> np.ndarray:
        """A score a sentence."""
        if not len(self.first_word):
            return np.zeros(0)
        z = np.add.reduceat(weights[self.features].sum(1, dtype=np.float64), self.first_word) + bias
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def noisy_or(scores: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    clean = np.bincount(row, np.log1p(-np.minimum(scores, 1 - 1e-12)), n)
    return -np.expm1(clean)


def _counts(rows: DataFrame, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Documents of label 0 and 1 in the first, and those that have each feature in the second (2 x BUCKETS)."""

    def count(batches):
        total, has = np.zeros(2, np.int64), np.zeros((2, BUCKETS), np.uint32)
        for batch in batches:
            data, offsets = utf8(batch["__text"])
            label = batch["__label"].to_numpy()
            for i, j in slices(offsets):
                found = Sentences(data, offsets, i, j)
                key = np.unique(np.repeat(found.words.row, found.features.shape[1]).astype(np.int64) << 20 | found.features.ravel())
                np.add.at(has, (label[i:j][key >> 20], key & (BUCKETS - 1)), 1)
            total += np.bincount(label, minlength=2)[:2]
        yield pa.RecordBatch.from_pydict({"k": pa.array([0, 1], pa.int32()), "n": pa.array(total), "has": pa.array([zlib.compress(x.tobytes(), 1) for x in has])})

    def add(found: pa.Table) -> pa.Table:
        has = sum(np.frombuffer(zlib.decompress(x), np.uint32) for x in found["has"].to_pylist())
        return pa.table({"k": found["k"][:1], "n": pa.array([sum(found["n"].to_pylist())]), "has": pa.array([zlib.compress(has.tobytes(), 1)])})

    n, has = np.zeros(2, np.int64), np.zeros((2, BUCKETS), np.uint32)
    kind = "k int, n long, has binary"
    for r in rows.mapInArrow(count, kind).groupBy("k").applyInArrow(add, kind).collect():  # two fixed arrays
        n[r["k"]] += r["n"]
        has[r["k"]] += np.frombuffer(zlib.decompress(r["has"]), np.uint32)
    return n, has


def train(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", modulus: int | None = None, held: int | None = None, most: int = SAMPLE) -> tuple[np.ndarray, float]:
    """Weights of all buckets and the bias, from at most so many labelled rows."""
    rows = sample(docs.select(F.col(key), F.col(text).cast("string").alias("__text")), labels.select(key, label), label, key, modulus, held, most)
    rows = stash(rows.select(F.col(key).cast("string").alias("__key"), "__text", "__label").where(F.col("__label").isin(0, 1))).coalesce(16)
    n, has = _counts(rows, "__text")
    weights = np.zeros(BUCKETS, np.float32)
    if n.min() == 0:
        return weights, -60.0
    rates = (has + 0.5) / (n[:, None] + 1.0)
    # how many standard errors the two rates lie apart: of BUCKETS features none should by chance
    pooled = (has.sum(0) + 1.0) / (n.sum() + 2.0)
    apart = (rates[1] - rates[0]) / np.sqrt(pooled * (1 - pooled) * (1 / n).sum())
    chosen = np.sort(np.argsort(-apart, kind="stable")[:FEATURES])
    chosen = chosen[apart[chosen] >= APART].astype(np.int32)

    def select(batches):
        for batch in batches:
            data, offsets = utf8(batch["__text"])
            for i, j in slices(offsets):
                found = Sentences(data, offsets, i, j)
                flat, of = found.features.ravel(), np.repeat(found.of_word, found.features.shape[1])
                at = np.searchsorted(chosen, flat)
                at[at == len(chosen)] = 0
                hit = chosen[at] == flat
                row = found.row[of[hit]]
                bounds = np.searchsorted(row, np.arange(j - i + 1)).astype(np.int32)
                sentence = (of[hit] - np.searchsorted(found.row, row)).astype(np.int32)
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": batch["__key"][i:j],
                        "label": batch["__label"][i:j],
                        "sentences": pa.array(np.bincount(found.row, minlength=j - i)),
                        "sentence": pa.ListArray.from_arrays(pa.array(bounds), pa.array(sentence)),
                        "feature": pa.ListArray.from_arrays(pa.array(bounds), pa.array(at[hit].astype(np.int32))),
                    }
                )

    table = rows.mapInArrow(select, "key string, label int, sentences long, sentence array<int>, feature array<int>").toArrow().sort_by([("key", "ascending"), ("sentences", "ascending")])
    w, bias = fit(table["label"].to_numpy(), table["sentences"].to_numpy(), table["sentence"].combine_chunks(), table["feature"].combine_chunks(), len(chosen))
    weights[chosen] = w
    return weights, bias


def fit(label: np.ndarray, sentences: np.ndarray, sentence, feature, width: int) -> tuple[np.ndarray, float]:
    """Maximum likelihood of the documents' labels under the noisy-or, with a small quadratic penalty, by adaptive gradients."""
    lengths = pc.list_value_length(sentence).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(label)), lengths)
    base = np.cumsum(sentences) - sentences
    node = base[row] + np.asarray(sentence.flatten())
    column = np.asarray(feature.flatten())
    n = int(sentences.sum())
    of = np.repeat(np.arange(len(label)), sentences)
    y = label.astype(np.float64)
    w, bias = np.zeros(width), -5.0
    square, bias_square = np.full(width, 1e-8), 1e-8
    weight = 1.0 / len(y)
    for _ in range(ROUNDS):
        z = np.bincount(node, w[column], n) + bias
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        total = np.clip(noisy_or(p, of, len(y)), 1e-9, 1 - 1e-12)
        pull = weight * np.where(y > 0, (1 - total) / total, -1.0)
        slope = pull[of] * p
        g = np.bincount(column, slope[node], width) - 1e-6 * w
        g_bias = float(slope.sum())
        square += g * g
        bias_square += g_bias * g_bias
        w += 0.5 * g / np.sqrt(square)
        bias += 0.3 * g_bias / np.sqrt(bias_square)
    return w.astype(np.float32), float(bias)


def score(docs: DataFrame, model: tuple[np.ndarray, float], text: str = "text", output: str = "score") -> DataFrame:
    """docs with the probability that a text is toxic; the text column stays if it is among docs' columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers
    docs = spread(plain(docs))
    kept = [c for c in docs.columns if c != output]
    schema = T.StructType([*(f for f in docs.schema.fields if f.name != output), T.StructField(output, T.DoubleType())])

    def run(batches):
        weights, bias = shared.value
        for batch in batches:
            data, offsets = utf8(batch[text].cast(pa.string()))
            out = [np.zeros(0)]
            for i, j in slices(offsets):
                found = Sentences(data, offsets, i, j)
                out.append(noisy_or(found.scores(weights, bias), found.row, j - i))
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), pa.array(np.concatenate(out))], names=[*kept, output])

    return named(docs.mapInArrow(run, schema))


def offending(docs: DataFrame, model: tuple[np.ndarray, float], text: str = "text", key: str = "doc_id", least: float = 0.3) -> DataFrame:
    """The sentences that score so high: id, sentence (from 0), its score and its text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        weights, bias = shared.value
        for batch in batches:
            data, offsets = utf8(batch["__text"])
            ids = batch[key]
            for i, j in slices(offsets):
                found = Sentences(data, offsets, i, j)
                p = found.scores(weights, bias)
                at = np.flatnonzero(p >= least)
                last = np.append(found.first_word[1:], len(found.words.starts)) - 1
                raw = found.words.data.tobytes()
                texts = [raw[a:b].decode() for a, b in zip(found.words.starts[found.first_word[at]].tolist(), found.words.ends[last[at]].tolist(), strict=True)]
                begin = np.searchsorted(found.row, found.row[at])
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(found.row[at] + i)), pa.array(at - begin), pa.array(p[at]), pa.array(texts, pa.string())], names=[key, "sentence", "score", "text"])

    return docs.select(key, F.col(text).cast("string").alias("__text")).mapInArrow(run, f"`{key}` {kind}, sentence long, score double, text string")

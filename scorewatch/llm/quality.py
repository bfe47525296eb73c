"""Quality classifier: attention-based multiple-instance learning.

A text is a bag of passages of PASSAGE words. Every passage is encoded as a vector (shares of
bytes, hashed words, and some shapes), projected to h = tanh(x P). Gated attention weighs the
passages of a bag, a = softmax(w (tanh(V h) * sigmoid(U h))), and the score is the sigmoid of
a linear function of the weighted sum of h. P, V, U, w and the last layer are learned together
from labels of whole texts, by Adam on the driver.

Fitting: at most `max_texts` labelled rows (those with the smallest hash of their id, so the
same at any partitioning), of each at most `max_passages` passages, spread evenly. Scoring
encodes every passage of every row.

An empty or null text is a bag with one passage of zeros and gets a score like any other. Rows
with a null or odd label are not learned from; with no labelled row of both classes every
score is the share of label 1, or 0.5 without any. Repeated rows are scored each for itself;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorewatch.llm.words import SPACE, Words, windows, word_slices

PASSAGE = 100
BYTES, HASHED, SHAPES = 256, 128, 6
WIDTH = BYTES + HASHED + SHAPES
MAX_TEXTS, MAX_PASSAGES = 4_000, 12
UNITS, GATE, ROUNDS, BATCH, RATE, DECAY = 32, 16, 25, 64, 0.004, 1e-4


def encode(words: Words, size: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """(vectors of all passages, index of each text's first passage)."""
    n = words.count
    bags = np.maximum(1, -(-n // size))
    first = np.concatenate([[0], np.cumsum(bags)])
    text = words.text_of
    own = first[text] + (np.arange(len(text)) - words.first[text]) // size
    total = int(first[-1])
    out = np.zeros((total, WIDTH), np.float32)
    count = np.bincount(own, minlength=total).astype(np.float32)
    some = np.maximum(count, 1)

    word_at = ~SPACE[words.data]
    begin = np.zeros(len(words.data) + 1, np.int64)
    begin[words.start] = 1
    which = np.cumsum(begin[:-1]) - 1
    letters = words.data[word_at]
    home = own[which[word_at]]
    table = np.bincount(home * BYTES + letters, minlength=total * BYTES).reshape(total, BYTES)
    size_ = np.maximum(table.sum(1, keepdims=True), 1)
    out[:, :BYTES] = np.sqrt(table / size_)

    h = words.hashes()
    slot = (h >> np.uint64(40)).astype(np.int64) % HASHED
    out[:, BYTES : BYTES + HASHED] = np.sqrt(
        np.bincount(own * HASHED + slot, minlength=total * HASHED).reshape(total, HASHED) / some[:, None]
    )

    shapes = out[:, BYTES + HASHED :]
    shapes[:, 0] = np.log1p(count) / 5
    shapes[:, 1] = table.sum(1) / some / 10
    order = np.lexsort((h, own))
    same = (h[order][1:] == h[order][:-1]) & (own[order][1:] == own[order][:-1])
    shapes[:, 2] = np.bincount(own[order][1:][same], minlength=total) / some
    at, key = windows(h, words.first, 3)
    order = np.lexsort((key, own[at]))
    same = (key[order][1:] == key[order][:-1]) & (own[at][order][1:] == own[at][order][:-1])
    shapes[:, 3] = np.bincount(own[at][order][1:][same], minlength=total) / some
    lines = np.flatnonzero(words.data == 10)
    near = which[lines]
    inside = near >= 0
    shapes[:, 4] = np.bincount(own[near[inside]], minlength=total) / some
    length = (words.end - words.start).astype(np.float32)
    shapes[:, 5] = np.bincount(own, weights=length * length, minlength=total) / some / 100
    return out, first


@dataclass
class AttentionModel:
    """Gated attention over passages; `prior` is the answer where nothing was learned."""

    layers: dict[str, np.ndarray] | None
    prior: float = 0.5

    def score(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        if self.layers is None:
            return np.full(len(first) - 1, self.prior)
        _, _, _, _, _, logit = forward(self.layers, x, first)
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def forward(p: dict[str, np.ndarray], x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hidden vectors, both gates, attention, bag vectors, logits."""
    h = np.tanh((x - p["mean"]) / p["spread"] @ p["P"] + p["p"])
    t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
    e = (t * g) @ p["w"]
    starts, sizes = first[:-1], np.diff(first)
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
    a = e / np.repeat(np.add.reduceat(e, starts), sizes)
    z = np.add.reduceat(a[:, None] * h, starts, axis=0)
    return h, t, g, a, z, z @ p["c"] + p["b"]


def gradients(p: dict[str, np.ndarray], x: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the mean log loss of bags."""
    h, t, g, a, z, logit = forward(p, x, first)
    starts, sizes = first[:-1], np.diff(first)
    d = (1 / (1 + np.exp(-logit)) - y) / len(y)
    out = {"c": z.T @ d, "b": d.sum()}
    dz = np.repeat(d[:, None] * p["c"], sizes, axis=0)
    da = (dz * h).sum(1)
    de = a * (da - np.repeat(np.add.reduceat(a * da, starts), sizes))
    out["w"] = (t * g).T @ de
    dt, dg = de[:, None] * p["w"] * g * (1 - t * t), de[:, None] * p["w"] * t * g * (1 - g)
    out["V"], out["U"] = h.T @ dt, h.T @ dg
    dh = (a[:, None] * dz + dt @ p["V"].T + dg @ p["U"].T) * (1 - h * h)
    out["P"], out["p"] = ((x - p["mean"]) / p["spread"]).T @ dh, dh.sum(0)
    return out


def learn(bags: list[np.ndarray], labels: np.ndarray, rounds: int = ROUNDS, seed: int = 7) -> AttentionModel:
    """Fit by Adam over shuffled batches of bags."""
    if len(set(labels.tolist())) < 2:
        return AttentionModel(None, float(labels.mean()) if len(labels) else 0.5)
    draw = np.random.default_rng(seed)
    x = np.concatenate(bags).astype(np.float64)
    p = {
        "mean": x.mean(0),
        "spread": x.std(0) + 0.02,
        "P": draw.normal(0, 1 / np.sqrt(WIDTH), (WIDTH, UNITS)),
        "p": np.zeros(UNITS),
        "V": draw.normal(0, 0.2, (UNITS, GATE)),
        "U": draw.normal(0, 0.2, (UNITS, GATE)),
        "w": draw.normal(0, 0.2, GATE),
        "c": np.zeros(UNITS),
        "b": np.array(np.log(labels.mean() / (1 - labels.mean()))),
    }
    fitted = ("P", "p", "V", "U", "w", "c", "b")
    m, v = {k: np.zeros_like(p[k]) for k in fitted}, {k: np.zeros_like(p[k]) for k in fitted}
    step = 0
    for _ in range(rounds):
        order = draw.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            first = np.concatenate([[0], np.cumsum([len(bags[i]) for i in some])])
            grad = gradients(p, np.concatenate([bags[i] for i in some]).astype(np.float64), first, labels[some])
            step += 1
            for k in fitted:
                d = grad[k] + DECAY * p[k]
                m[k] = 0.9 * m[k] + 0.1 * d
                v[k] = 0.999 * v[k] + 0.001 * d * d
                p[k] = p[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return AttentionModel({k: x.astype(np.float32) for k, x in p.items()})


def _bags(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, words in word_slices(batch.column(1)):
            x, first = encode(words)
            picked = []
            for a, b in zip(first[:-1], first[1:], strict=True):
                at = np.unique(np.linspace(a, b - 1, min(most, b - a)).astype(int))
                picked.append(x[at].astype("<f2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), pa.array(picked, pa.binary())], ["label", "bag"]
            )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    allowed: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_texts: int = MAX_TEXTS,
    max_passages: int = MAX_PASSAGES,
) -> AttentionModel:
    """Learn from labelled rows where `allowed` (an expression of the id) holds."""
    known = labels.where(allowed).where(labels[label_col].isin(0, 1) & labels[id_col].isNotNull())
    known = known.groupBy(labels[id_col].alias("id")).agg(F.min(labels[label_col]).cast("double").alias("label"))
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    # Only labels of rows that are there count towards the bound.
    present = known.join(texts.select("id"), "id", "left_semi")
    chosen = present.orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(max_texts)
    rows = texts.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
    rows = rows.select("label", "text").mapInArrow(lambda b: _bags(b, max_passages), "label double, bag binary")
    found = sorted(((r["label"], bytes(r["bag"])) for r in rows.collect()), key=lambda r: (r[1], r[0]))
    bags = [np.frombuffer(b, "<f2").reshape(-1, WIDTH).astype(np.float32) for _, b in found]
    return learn(bags, np.array([y for y, _ in found]))


def score(docs: DataFrame, model: AttentionModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row."""
    plain = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [id_col, "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, words in word_slices(batch.column(1), size=1_000_000):
                found = shared.value.score(*encode(words)).astype(np.float64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(found)], names)

    schema = T.StructType(
        [T.StructField(id_col, plain.schema["id"].dataType), T.StructField("score", T.DoubleType())]
    )
    return plain.mapInArrow(run, schema)


def keep(docs: DataFrame, model: AttentionModel, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows with a score of `least` or more, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, words in word_slices(batch.column(place)):
                yield batch.slice(i, j - i).filter(pa.array(shared.value.score(*encode(words)) >= least))

    return docs.mapInArrow(run, docs.schema)

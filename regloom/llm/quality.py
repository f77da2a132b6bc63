"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages of ``PASSAGE`` words. Each passage is described by how its
characters follow each other (pairs of sixteen classes of bytes) and by how its words repeat,
and encoded by a layer of its own. Gated attention weighs the passages of a document, and the
weighted sum of their encodings gives the score. Only documents have labels; what to attend
to is learned from them.

The model is fitted in one task on at most ``most_labelled`` labelled documents, those whose
hashed ids are least; everything else covers all rows. Ids, languages and sources are never
read for a score, and a text is scored whole.

Defined results: a null or empty text, or one without words, is one empty passage. Labels
other than 0 and 1 are not used, of several labels for an id the least is. Without labelled
documents every score is 0.5; with labels of one kind only, their share is learned. Equal
texts have equal scores. Columns named ``score`` or ``predicted`` are replaced.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regloom.llm import text as tx
from regloom.llm.ship import ship

PASSAGE, MOST_LABELLED = 64, 8000
#: Bytes of text described at once.
SLICE = 1 << 20
ENCODING, ATTENTION, EPOCHS, BATCH, RATE, SHRINK = 24, 12, 30, 128, 0.005, 1e-4

CLASSES = np.zeros(256, np.uint8)
for _n, _bytes in enumerate([range(0x61, 0x7B), range(0x41, 0x5B), range(0x30, 0x3A), b" ", b"\n\r", b"\t\x0b\x0c", b".", b",;:", b"!?", b"|/\\", b"#@", b"$%&*+=~^", b"'\"`", b"()[]{}<>-_", range(0x80, 0x100)]):
    CLASSES[list(_bytes)] = _n + 1
PAIRS = 256
FEATURES = PAIRS + 6


def passages_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The features of all passages, and where those of each text begin."""
    tx.entering("quality")
    data, offsets = tx.utf8(column)
    starts, ends, firsts = tx.word_bounds(data, offsets, tx.SPACE)
    words = np.diff(firsts)
    counts = np.maximum(1, -(-words // PASSAGE))
    bags = np.concatenate([[0], np.cumsum(counts)])
    x = np.zeros((bags[-1], FEATURES), np.float32)
    if not len(starts):
        return x, bags
    text = np.repeat(np.arange(len(words)), words)
    passage = bags[text] + (np.arange(len(starts)) - firsts[text]) // PASSAGE
    # A byte belongs to the passage of the last word that began; what stands before the first
    # word of a text belongs to none.
    word = np.searchsorted(starts, np.arange(len(data)), "right") - 1
    owner = np.where(word >= 0, passage[np.maximum(word, 0)], 0)
    inside = (word >= 0) & (word >= firsts[np.repeat(np.arange(len(words)), np.diff(offsets))])
    kinds = CLASSES[data].astype(np.int64)
    pair = np.flatnonzero(inside[:-1] & inside[1:] & (owner[:-1] == owner[1:]))
    x[:, :PAIRS] = np.bincount(owner[pair] * PAIRS + kinds[pair] * 16 + kinds[pair + 1], minlength=len(x) * PAIRS).reshape(len(x), PAIRS)
    x[:, :PAIRS] = np.sqrt(x[:, :PAIRS] / np.maximum(1, x[:, :PAIRS].sum(1, keepdims=True)))
    hashes = tx.Rolling(tx.BYTE_VALUES[data]).of(starts, ends)
    size = np.bincount(passage, minlength=len(x))
    whole = np.maximum(1, size)
    again = np.zeros(len(starts), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (passage[1:] == passage[:-1])
    order = np.lexsort((hashes, passage))
    distinct = np.ones(len(order), bool)
    distinct[1:] = (hashes[order][1:] != hashes[order][:-1]) | (passage[order][1:] != passage[order][:-1])
    lengths = (ends - starts).astype(np.float64)
    x[:, PAIRS] = np.bincount(passage, again, len(x)) / whole
    x[:, PAIRS + 1] = np.bincount(passage[order], distinct, len(x)) / whole
    x[:, PAIRS + 2] = np.log1p(np.bincount(passage, lengths, len(x)) / whole)
    x[:, PAIRS + 3] = np.log1p(size)
    x[:, PAIRS + 4] = np.bincount(passage, lengths == 1, len(x)) / whole
    x[:, PAIRS + 5] = size > 0
    return x, bags


@dataclass
class Model:
    """Weights by name; ``mean`` and ``scale`` make features alike."""

    weights: dict[str, np.ndarray]
    mean: np.ndarray
    scale: np.ndarray

    def forward(self, x: np.ndarray, bags: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        encoded = np.tanh(x @ w["encode"] + w["encode_bias"])
        gate_t, gate_s = np.tanh(encoded @ w["tanh"]), 1 / (1 + np.exp(-(encoded @ w["gate"])))
        logits = (gate_t * gate_s) @ w["attend"]
        sizes, first = np.diff(bags), bags[:-1]
        weights = np.exp(logits - np.repeat(np.maximum.reduceat(logits, first), sizes))
        weights /= np.repeat(np.add.reduceat(weights, first), sizes)
        pooled = np.add.reduceat(weights[:, None] * encoded, first)
        score = 1 / (1 + np.exp(-np.clip(pooled @ w["out"] + w["bias"][0], -30, 30)))
        return {"encoded": encoded, "gate_t": gate_t, "gate_s": gate_s, "attention": weights, "pooled": pooled, "score": score}

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def scores(self, column: pa.Array) -> np.ndarray:
        x, bags = passages_of(column)
        return self.forward(self.standard(x), bags)["score"].astype(np.float64)


def gradients(model: Model, x: np.ndarray, bags: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean logistic loss of the documents."""
    w, f, sizes = model.weights, model.forward(x, bags), np.diff(bags)
    d_logit = (f["score"] - y) / len(y)
    d_pooled = np.repeat(np.outer(d_logit, w["out"]), sizes, 0)
    # Through the weighted sum: to the encodings, and to the attention's softmax.
    d_encoded = f["attention"][:, None] * d_pooled
    d_weight = (d_pooled * f["encoded"]).sum(1)
    mean = np.repeat(np.add.reduceat(f["attention"] * d_weight, bags[:-1]), sizes)
    d_attend = f["attention"] * (d_weight - mean)
    both = f["gate_t"] * f["gate_s"]
    d_t = np.outer(d_attend, w["attend"]) * f["gate_s"] * (1 - f["gate_t"] ** 2)
    d_s = np.outer(d_attend, w["attend"]) * both * (1 - f["gate_s"])
    d_encoded += d_t @ w["tanh"].T + d_s @ w["gate"].T
    d_in = d_encoded * (1 - f["encoded"] ** 2)
    return {
        "encode": x.T @ d_in,
        "encode_bias": d_in.sum(0),
        "tanh": f["encoded"].T @ d_t,
        "gate": f["encoded"].T @ d_s,
        "attend": both.T @ d_attend,
        "out": f["pooled"].T @ d_logit,
        "bias": np.array([d_logit.sum()]),
    }


def fit(texts: list[str], labels: np.ndarray) -> Model:
    """Adam on batches of documents, in an order fixed by a seed."""
    random = np.random.default_rng(11)
    shapes = {"encode": (FEATURES, ENCODING), "encode_bias": (ENCODING,), "tanh": (ENCODING, ATTENTION), "gate": (ENCODING, ATTENTION), "attend": (ATTENTION,), "out": (ENCODING,), "bias": (1,)}
    weights = {k: (np.zeros(s) if k.endswith("bias") else random.normal(0, 1 / np.sqrt(s[0]), s)).astype(np.float32) for k, s in shapes.items()}
    if not texts:
        weights["out"][:] = 0
        return Model(weights, np.zeros(FEATURES, np.float32), np.ones(FEATURES, np.float32))
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    parts = [passages_of(p.column(0)) for p in tx.slices(batch, "text", SLICE)]
    x = np.concatenate([p for p, _ in parts])
    bags = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(b) for _, b in parts]))])
    mean = x.mean(0)
    deviation = np.sqrt(np.maximum(0, np.einsum("ij,ij->j", x, x, dtype=np.float64) / len(x) - mean.astype(np.float64) ** 2))
    model = Model(weights, mean, np.maximum(deviation, 0.02).astype(np.float32))
    for at in range(0, len(x), 4096):
        x[at : at + 4096] = model.standard(x[at : at + 4096])
    y = labels.astype(np.float32)
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    step = 0
    for epoch in range(EPOCHS):
        order = random.permutation(len(y))
        rate = RATE * (1 - epoch / EPOCHS) + 1e-5
        for at in range(0, len(y), BATCH):
            docs = np.sort(order[at : at + BATCH])
            sizes = bags[docs + 1] - bags[docs]
            own = np.concatenate([[0], np.cumsum(sizes)])
            rows = np.repeat(bags[docs] - own[:-1], sizes) + np.arange(own[-1])
            step += 1
            for k, g in gradients(model, x[rows], own, y[docs]).items():
                g = g + SHRINK * weights[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                weights[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


def fold(id: str) -> Column:
    """The fold of an id: its crc32 as text, modulo 3. Fold 1 is held out."""
    return F.crc32(F.col(id).cast("string")) % 3


def train(documents: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", label: str = "quality", most_labelled: int = MOST_LABELLED) -> Model:
    """Fits a model on labelled documents outside fold 1, at most so many."""
    ship(documents.sparkSession)
    known = labels.where(F.col(label).isin(0, 1) & (fold(id) != 1)).groupBy(F.col(id).alias("known")).agg(F.min(label).alias("label"))
    few = known.orderBy(F.xxhash64("known"), "known").limit(most_labelled)
    # At most `most_labelled` pairs of numbers: small enough for every executor.
    sample = documents.join(F.broadcast(few), F.col(id) == F.col("known")).select("known", F.coalesce(F.col(text), F.lit("")).alias("text"), "label")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("known", "text", "label"))))
        model = fit([t for _, t, _ in rows], np.array([y for _, _, y in rows]))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    found = sample.repartition(1).mapInArrow(work, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else fit([], np.zeros(0))


def score(documents: DataFrame, model: Model, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) to the kept columns."""
    ship(documents.sparkSession)
    wanted = [c for c in (keep if keep is not None else documents.columns) if c.lower() not in ("score", "predicted")]
    schema = T.StructType([*(documents.schema[c] for c in wanted), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.slices(batch, text, SLICE):
                scores = model.scores(part.column(text))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in wanted), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], [*wanted, "score", "predicted"])

    return documents.select(*dict.fromkeys([*wanted, text])).mapInArrow(work, schema)

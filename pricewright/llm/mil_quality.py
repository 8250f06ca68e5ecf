"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. Each passage is described by
shares of character classes, word lengths, repeats and hashed words, and encoded by
one hidden layer. Gated attention weighs the passages; the weighted sum of their
codes is scored. Only the document has a label: the weights are learned with the rest.

Training takes a bounded sample: about ``PER_CLASS`` labelled documents of each class, and
of each at most ``TRAIN_PASSAGES`` passages at even distances. Scoring sees every passage.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from pricewright.llm import words as W
from pricewright.llm.ship import shipped

PER_CLASS = 1000
TRAIN_PASSAGES = 32
PASSAGE = 64
HASHED = 128
HIDDEN, GATE = 24, 12
ROUNDS = 200
DECAY = 3e-3
SEED = 10

_CLASSES = np.zeros(256, dtype=np.int64)
for _at, _members in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ",
                                b"\n", b"\t\r\x0b\x0c", b".", b",", b"!", b"?", b";:", b"'\"", b"-", b"()", b"[]{}",
                                b"<>", b"#", b"*", b"$", b"%", b"&", b"|", b"/\\", b"=+", b"@", b"_~^`"), start=1):
    _CLASSES[list(_members)] = _at
_CLASSES[128:] = 27
N_CLASSES = 28
WIDTH = N_CLASSES + 4 + HASHED


class Model(NamedTuple):
    """Input scaling, encoder, attention (value and gate) and output weights."""

    mean: np.ndarray
    scale: np.ndarray
    encode: np.ndarray
    encode_b: np.ndarray
    value: np.ndarray
    gate: np.ndarray
    attend: np.ndarray
    out: np.ndarray
    out_b: np.ndarray
    shift: float


def passages(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows of features of all passages, and where each document starts; a text without words is one empty passage."""
    found = W.words(column, W.SPACED)
    _, ends_at = W.flat(column)
    sizes = np.diff(found.bounds)
    per = np.maximum(1, -(-sizes // PASSAGE))
    starts = np.concatenate(([0], np.cumsum(per)))
    total = int(starts[-1])
    doc = np.repeat(np.arange(len(sizes)), sizes)
    nth = np.arange(len(doc)) - found.bounds[doc]
    passage = starts[doc] + nth // PASSAGE
    x = np.zeros((total, WIDTH))
    n = np.bincount(passage, minlength=total).astype(float)
    some = np.maximum(n, 1)

    lengths = found.ends - found.starts
    head = np.flatnonzero(nth % PASSAGE == 0)
    until = np.concatenate((found.starts[head[1:]], ends_at[-1:]))
    until = np.minimum(until, ends_at[doc[head] + 1])
    low, high = found.starts[head], until
    where = np.repeat(passage[head], high - low)
    at = np.arange(len(where)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + np.repeat(low, high - low)
    counts = np.bincount(where * N_CLASSES + _CLASSES[found.data[at]], minlength=total * N_CLASSES)
    counts = counts.reshape(total, N_CLASSES)
    x[:, :N_CLASSES] = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)

    grid = np.arange(PASSAGE, dtype=np.uint64)[None, :].repeat(total, axis=0)
    grid[passage, nth % PASSAGE] = found.hashes
    grid.sort(axis=1)
    repeats = (grid[:, 1:] == grid[:, :-1]).sum(axis=1)
    echo = np.flatnonzero((found.hashes[1:] == found.hashes[:-1]) & (passage[1:] == passage[:-1]))
    x[:, N_CLASSES] = repeats / some
    x[:, N_CLASSES + 1] = np.bincount(passage[echo], minlength=total) / some
    x[:, N_CLASSES + 2] = np.log1p(np.bincount(passage, lengths, total) / some)
    x[:, N_CLASSES + 3] = n / PASSAGE
    hashed = (found.hashes >> np.uint64(57)).astype(np.int64)
    x[:, N_CLASSES + 4:] = np.sqrt(np.bincount(passage * HASHED + hashed, minlength=total * HASHED).reshape(
        total, HASHED) / some[:, None])
    return x, starts


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _forward(model: Model, x: np.ndarray, starts: np.ndarray):
    """Codes, value, gate, attention weights, bag codes and logits."""
    code = np.tanh(((x - model.mean) * model.scale) @ model.encode + model.encode_b)
    value, gate = np.tanh(code @ model.value), _sigmoid(code @ model.gate)
    raw = (value * gate) @ model.attend
    first, size = starts[:-1], np.diff(starts)
    raw = np.exp(raw - np.repeat(np.maximum.reduceat(raw, first), size))
    weight = raw / np.repeat(np.add.reduceat(raw, first), size)
    bag = np.add.reduceat(code * weight[:, None], first, axis=0)
    return code, value, gate, weight, bag, bag @ model.out + model.out_b[0]


def scores(model: Model, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Chance of label 1 for each bag."""
    return _sigmoid(_forward(model, x, starts)[-1] + model.shift)


def trained(texts: list[str], labels: list[int], share: float = 0.5, rounds: int = ROUNDS, seed: int = SEED) -> Model:
    """Fits all layers together; ``share`` of label 1 in the whole table shifts the scores of the balanced sample."""
    rng = np.random.default_rng(seed)
    small = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
    blank = Model(np.zeros(WIDTH), np.ones(WIDTH), small(WIDTH, HIDDEN), np.zeros(HIDDEN), small(HIDDEN, GATE),
                  small(HIDDEN, GATE), small(GATE), np.zeros(HIDDEN), np.zeros(1), 0.0)
    if len(set(labels)) < 2:
        return blank._replace(shift=0.0 if not labels else (4.0 if labels[0] else -4.0))
    x, starts = passages(pa.array([t.encode() for t in texts], pa.binary()))
    keep = np.concatenate([np.unique(np.linspace(a, b - 1, TRAIN_PASSAGES).astype(int)) if b - a > TRAIN_PASSAGES
                           else np.arange(a, b) for a, b in zip(starts[:-1], starts[1:])])
    size = np.minimum(np.diff(starts), TRAIN_PASSAGES)
    x, starts = x[keep], np.concatenate(([0], np.cumsum(size)))
    spread = x.std(axis=0)
    model = blank._replace(mean=x.mean(axis=0), scale=1 / np.maximum(spread, 0.02))
    y = np.array(labels, dtype=float)
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    z = (x - model.mean) * model.scale
    names = ("encode", "encode_b", "value", "gate", "attend", "out", "out_b")
    first, second = ({n: np.zeros_like(getattr(model, n)) for n in names} for _ in range(2))
    size = np.diff(starts)
    for k in range(1, rounds + 1):
        code, value, gate, attention, bag, logit = _forward(model, x, starts)
        d_logit = weight * (_sigmoid(logit) - y)
        d_bag = np.repeat(d_logit[:, None] * model.out, size, axis=0)
        d_weight = (d_bag * code).sum(axis=1)
        mean = np.repeat(np.add.reduceat(d_weight * attention, starts[:-1]), size)
        d_raw = attention * (d_weight - mean)
        d_value = d_raw[:, None] * gate * model.attend * (1 - value ** 2)
        d_gate = d_raw[:, None] * value * model.attend * gate * (1 - gate)
        d_code = (d_bag * attention[:, None] + d_value @ model.value.T + d_gate @ model.gate.T) * (1 - code ** 2)
        slopes = {"encode": z.T @ d_code + DECAY * model.encode, "encode_b": d_code.sum(axis=0),
                  "value": code.T @ d_value, "gate": code.T @ d_gate, "attend": (value * gate).T @ d_raw,
                  "out": bag.T @ d_logit + 1e-3 * model.out, "out_b": np.array([d_logit.sum()])}
        moved = {}
        for n, g in slopes.items():
            first[n] = 0.9 * first[n] + 0.1 * g
            second[n] = 0.99 * second[n] + 0.01 * g * g
            moved[n] = getattr(model, n) - 0.02 * (first[n] / (1 - 0.9 ** k)) / (
                np.sqrt(second[n] / (1 - 0.99 ** k)) + 1e-8)
        model = model._replace(**moved)
    share = min(max(share, 0.01), 0.99)
    return model._replace(shift=float(np.log(share / (1 - share))))


def held_out(id_col: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")), F.lit(3)) == 1


def fitted(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
           label_col: str = "quality", per_class: int = PER_CLASS) -> Model:
    """A model from about ``per_class`` labelled documents of each class, none of them held out."""
    known = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label")).where(
        ~held_out("id") & F.col("label").isin(0, 1)).groupBy("id").agg(F.min("label").alias("label"))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if not counts:
        return trained([], [])
    size = F.when(F.col("label") == 1, counts.get(1, 0)).otherwise(counts.get(0, 0))
    taken = known.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) * size < F.lit(per_class * 1_000_000))
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    # at most a few thousand ids, by the bound on the sample
    got = texts.join(F.broadcast(taken), "id").groupBy("id").agg(F.min("label").alias("label"), F.min("text").alias("text"))
    got = sorted((r["text"], r["label"]) for r in got.select("label", "text").toLocalIterator())
    return trained([t for t, _ in got], [y for _, y in got], counts.get(1, 0) / sum(counts.values()))


def _score(held):
    def run(batches):
        for batch in batches:
            texts = batch.column(1)
            found = [scores(held.value, *passages(texts.slice(low, high - low))) for low, high in W.slices(texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(found) if found else [], pa.float64())], ["__id", "score"])
    return run


def assessed(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", per_class: int = PER_CLASS) -> DataFrame:
    """Quality of every document: id, ``held_out, score`` (0 to 1), ``predicted`` (score >= 0.5).

    Null and empty texts are one empty passage and scored like any other. Without labels
    of both classes every score is that of the one class seen, or 0.5. Labels other than 0
    and 1, null ids of labels and labels without a document teach nothing; several
    labels of one id count as the lowest. A null id is not held out. Repeated rows are
    scored alike; an empty table gives no rows; other columns are not looked at.
    """
    model = fitted(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, per_class=per_class)
    held = shipped(docs.sparkSession).sparkContext.broadcast(model)
    frame = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").cast("binary").alias("__bytes"))
    done = frame.mapInArrow(_score(held), T.StructType([frame.schema["__id"], T.StructField("score", T.DoubleType())]))
    return done.select(F.col("__id").alias(id_col), "score").select(
        id_col, F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))

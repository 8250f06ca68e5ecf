"""Language identification by a linear-chain conditional random field over words.

Every word is labelled with a language. Its features are affixes, byte trigrams and
membership in per-language lexicons of the training words; transitions between
the labels of neighbouring words are learned from sequences in which stretches of
different documents, hence languages, follow one another. Forward-backward gives the
chance of each label at each word; a document gets the language with most of them.

The passes over long texts run on chunks: the product of a chunk's transfer matrices
says how it maps what enters to what leaves, so all chunks of a batch advance
together and the result is that of one long chain.

Training takes a bounded sample: about ``per_language`` documents of each language and
``CHARACTERS`` of each. Everything else sees every word.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from pricewright.llm import words as W
from pricewright.llm.ship import shipped
from pricewright.staging import staged

PER_LANGUAGE = 300
CHARACTERS = 1500
BUCKETS = 1 << 15
CHUNK = 256
LENGTH = 48
ROUNDS = 60
SEED = 1
UNKNOWN = "und"
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Model(NamedTuple):
    """Labels in order, lexicon (sorted word hashes and the label of each), feature weights, transitions."""

    labels: list[str]
    lexicon: np.ndarray
    lexicon_label: np.ndarray
    weights: np.ndarray
    transitions: np.ndarray


def _bucket(kind: int, code: np.ndarray) -> np.ndarray:
    return ((code + np.uint64(kind + 1)) * _SPREAD * np.uint64(2 * kind + 3) >> np.uint64(49)).astype(np.int64)


def _features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """(words, buckets) pairs of affix and trigram features of each word."""
    size = ends - starts
    code = np.zeros(len(starts), dtype=np.uint64)
    for k in range(3):
        code = code * np.uint64(257) + data[np.minimum(starts + k, ends - 1)].astype(np.uint64) + np.uint64(1)
        rows = np.flatnonzero(size > k)
        yield rows, _bucket(k, code[rows])
    code = np.zeros(len(starts), dtype=np.uint64)
    for k in range(4):
        code = code * np.uint64(257) + data[np.maximum(ends - 1 - k, starts)].astype(np.uint64) + np.uint64(1)
        rows = np.flatnonzero(size > k)
        yield rows, _bucket(3 + k, code[rows])
    inner = np.maximum(size - 2, 0)
    rows = np.repeat(np.arange(len(starts)), inner)
    at = np.arange(len(rows)) - np.repeat(np.cumsum(inner) - inner, inner) + np.repeat(starts, inner)
    code = (data[at].astype(np.uint64) << np.uint64(16)) | (data[at + 1].astype(np.uint64) << np.uint64(8)) | data[at + 2]
    yield rows, _bucket(7, code)


def _known(lexicon: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Position in the lexicon, or -1."""
    if not len(lexicon):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(lexicon, hashes), len(lexicon) - 1)
    return np.where(lexicon[at] == hashes, at, -1)


def _distinct(found: W.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes, first occurrence of each distinct word, and the distinct word of every word."""
    _, first, which = np.unique(found.hashes, return_index=True, return_inverse=True)
    return W.LETTERS.folded[found.data], found.starts[first], found.ends[first], which


def _emissions(model: Model, found: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """Scores of the labels for each distinct word, and the distinct word of every word."""
    data, starts, ends, which = _distinct(found)
    scores = np.zeros((len(starts), len(model.labels)))
    for rows, buckets in _features(data, starts, ends):
        for k in range(scores.shape[1]):
            scores[:, k] += np.bincount(rows, model.weights[buckets, k], len(starts))
    hashes = np.empty(len(starts), np.uint64)
    hashes[which] = found.hashes
    at = _known(model.lexicon, hashes)
    rows = np.flatnonzero(at >= 0)
    scores[rows] += model.weights[BUCKETS + model.lexicon_label[at[rows]]]
    return scores, which


def _scaled(x: np.ndarray) -> np.ndarray:
    """Divided by its sum over all but the first axis."""
    return x / x.reshape(len(x), -1).sum(axis=1).reshape(-1, *[1] * (x.ndim - 1))


def label_mass(scores: np.ndarray, which: np.ndarray, bounds: np.ndarray, transitions: np.ndarray,
               chunk: int = CHUNK) -> np.ndarray:
    """Sum over the words of each document of the chances of each label, by forward-backward."""
    n_labels = scores.shape[1]
    weight = np.exp(scores - scores.max(axis=1, keepdims=True)) if len(scores) else scores
    move = np.exp(transitions - transitions.max())
    sizes = np.diff(bounds)
    per = -(-sizes // chunk)
    first = np.cumsum(per) - per
    owner = np.repeat(np.arange(len(sizes)), per)
    nth = np.arange(len(owner)) - first[owner]
    start = bounds[:-1][owner] + nth * chunk
    length = np.minimum(chunk, bounds[1:][owner] - start)
    order = np.argsort(-length, kind="stable")
    start, length = start[order], length[order]
    steps = [int((length > t).sum()) for t in range(int(length[0]) if len(length) else 0)]
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))

    maps = np.broadcast_to(np.eye(n_labels), (len(order), n_labels, n_labels)).copy()
    for t, active in enumerate(steps):
        maps[:active] = (maps[:active] @ move) * weight[which[start[:active] + t]][:, None, :]
        if t % 16 == 15:
            maps[:active] = _scaled(maps[:active])
    maps = _scaled(maps) if len(maps) else maps

    enter, leave = np.empty((len(order), n_labels)), np.empty((len(order), n_labels))
    state, rear = np.full((len(sizes), n_labels), 1 / n_labels), np.ones((len(sizes), n_labels))
    for k in range(int(per.max()) if len(per) else 0):
        docs = np.flatnonzero(per > k)
        at = place[first[docs] + k]
        enter[at] = state[docs]
        state[docs] = _scaled(np.einsum("di,dij->dj", state[docs], maps[at]))
        docs_back = docs
        at = place[first[docs_back] + per[docs_back] - 1 - k]
        leave[at] = rear[docs_back]
        rear[docs_back] = _scaled(np.einsum("dij,dj->di", maps[at], rear[docs_back]))

    ahead, state = [], enter
    for t, active in enumerate(steps):
        state = _scaled((state[:active] @ move) * weight[which[start[:active] + t]])
        ahead.append(state)
    mass, back = np.zeros((len(order), n_labels)), leave
    for t in range(len(steps) - 1, -1, -1):
        active = steps[t]
        mass[:active] += _scaled(ahead[t] * back[:active])
        back[:active] = _scaled((weight[which[start[:active] + t]] * back[:active]) @ move.T)
    total = np.zeros((len(sizes), n_labels))
    np.add.at(total, owner, mass[place])
    return total


def _spliced(which: np.ndarray, labels: np.ndarray, bounds: np.ndarray, rng) -> tuple[np.ndarray, np.ndarray]:
    """Sequences of equal length in which stretches of random documents follow one another."""
    docs = np.flatnonzero(np.diff(bounds) > 0)
    words, own, total = [], [], int(bounds[-1])
    while total > 0:
        doc = int(rng.choice(docs))
        size = int(min(rng.integers(8, 64), bounds[doc + 1] - bounds[doc]))
        low = int(rng.integers(bounds[doc], bounds[doc + 1] - size + 1))
        words.append(which[low:low + size])
        own.append(np.full(size, labels[doc]))
        total -= size
    words, own = np.concatenate(words), np.concatenate(own)
    n = max(1, len(words) // LENGTH)
    length = len(words) // n if len(words) < LENGTH else LENGTH
    return words[:n * length].reshape(n, length), own[:n * length].reshape(n, length)


def trained(texts: list[str], languages: list[str], rounds: int = ROUNDS, seed: int = SEED) -> Model:
    """Maximum likelihood of word labels by full-batch gradient steps with per-weight rates."""
    labels = sorted(set(languages))
    n_labels = len(labels)
    if not labels:
        return Model([], np.empty(0, np.uint64), np.empty(0, np.int64), np.zeros((BUCKETS, 0)), np.zeros((0, 0)))
    found = W.words(pa.array([t.encode() for t in texts], pa.binary()), W.LETTERS)
    data, starts, ends, which = _distinct(found)
    of_doc = np.array([labels.index(x) for x in languages], dtype=np.int64)
    n_words = len(starts)
    word_label = np.zeros((n_words, n_labels))
    np.add.at(word_label, (which, np.repeat(of_doc, np.diff(found.bounds))), 1)
    often = np.flatnonzero((word_label.sum(axis=1) >= 8) & (word_label.max(axis=1) >= 0.8 * word_label.sum(axis=1)))
    hashes = np.empty(n_words, np.uint64)
    hashes[which] = found.hashes
    often = often[np.argsort(hashes[often])]
    empty = Model(labels, hashes[often], word_label[often].argmax(axis=1), np.zeros((BUCKETS + n_labels, n_labels)),
                  np.zeros((n_labels, n_labels)))
    if n_labels < 2 or not n_words:
        return empty
    parts = [*_features(data, starts, ends), (often, BUCKETS + empty.lexicon_label)]
    rows, buckets = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(buckets, kind="stable")
    rng = np.random.default_rng(seed)
    seqs, truth = _spliced(which, of_doc, found.bounds, rng)
    n, length = seqs.shape
    weights, moves = empty.weights, empty.transitions
    rate_w, rate_m = np.full_like(weights, 1e-3), np.full_like(moves, 1e-3)
    truth_one = np.eye(n_labels)[truth]
    truth_moves = np.einsum("ati,atj->ij", truth_one[:, :-1], truth_one[:, 1:])
    for _ in range(rounds):
        scores = np.stack([np.bincount(rows, weights[buckets, k], n_words) for k in range(n_labels)], axis=1)
        e = np.exp(scores - scores.max(axis=1, keepdims=True))[seqs]
        move = np.exp(moves)
        ahead = np.empty_like(e)
        state = np.full((n, n_labels), 1 / n_labels)
        for t in range(length):
            state = ahead[:, t] = _scaled((state @ move) * e[:, t])
        back, slope = np.ones((n, n_labels)), np.empty_like(e)
        expected = np.zeros_like(moves)
        for t in range(length - 1, -1, -1):
            slope[:, t] = truth_one[:, t] - _scaled(ahead[:, t] * back)
            if t:
                onward = e[:, t] * back
                pair = ahead[:, t - 1][:, :, None] * move * onward[:, None, :]
                expected += _scaled(pair).sum(axis=0)
                back = _scaled(onward @ move.T)
        by_word = np.stack([np.bincount(seqs.ravel(), slope[:, :, k].ravel(), n_words) for k in range(n_labels)], axis=1)
        step = np.stack([np.bincount(buckets[order], by_word[rows[order], k], len(weights)) for k in range(n_labels)],
                        axis=1) / n - 1e-4 * weights
        step_m = (truth_moves - expected) / n - 1e-4 * moves
        rate_w += step ** 2
        rate_m += step_m ** 2
        weights = weights + 0.5 * step / np.sqrt(rate_w)
        moves = moves + 0.2 * step_m / np.sqrt(rate_m)
    return empty._replace(weights=weights, transitions=moves)


def held_out(id_col: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")), F.lit(4)) == 2


def fitted(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           per_language: int = PER_LANGUAGE) -> Model:
    """A model from about ``per_language`` documents of each language, cut to ``CHARACTERS`` from a place by hash."""
    rows = docs.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang"),
                       F.xxhash64(f"`{id_col}`", f"`{text_col}`").alias("salt")).where(
        "lang IS NOT NULL AND length(text) > 0")
    # one staged row per language: its known size lets Spark broadcast it, and no text moves
    counts = staged(rows.groupBy("lang").count(), "languages")
    taken = rows.join(counts, "lang").where(
        F.pmod("salt", F.lit(1_000_000)) * F.col("count") < F.lit(per_language * 1_000_000))
    start = F.pmod(F.col("salt"), F.greatest(F.length("text") - CHARACTERS + 1, F.lit(1))) + 1
    got = taken.select("lang", F.substring("text", start.cast("int"), F.lit(CHARACTERS)).alias("text")).distinct()
    got = sorted((r["text"], r["lang"]) for r in got.collect())
    return trained([t for t, _ in got], [x for _, x in got])


def _no_letter(text: bytes | None) -> bool:
    return not text or not any(c.isalpha() for c in text.decode("utf-8", "replace"))


def _predict(held):
    def run(batches):
        model: Model = held.value
        for batch in batches:
            names = batch.schema.names
            texts = batch.column(names.index("__bytes"))
            best, score = [], []
            for low, high in W.slices(texts):
                part = texts.slice(low, high - low)
                found = W.words(part, W.LETTERS)
                sizes = np.diff(found.bounds)
                if not model.labels:
                    best += [UNKNOWN] * len(sizes)
                    score += [0.0] * len(sizes)
                    continue
                mass = label_mass(*_emissions(model, found), found.bounds, model.transitions)
                ascii_letter = W.LETTERS.inside.copy()
                ascii_letter[128:] = False
                hit = np.concatenate(([0], np.cumsum(ascii_letter[found.data[found.starts]])))
                plain = np.diff(hit[found.bounds])
                top, share = mass.argmax(axis=1), mass.max(axis=1) / np.maximum(sizes, 1)
                for row in range(len(sizes)):
                    none = not sizes[row] or (not plain[row] and _no_letter(part[row].as_py()))
                    best.append(UNKNOWN if none else model.labels[top[row]])
                    score.append(0.0 if none else min(1.0, float(share[row])))
            keep = [k for k, n in enumerate(names) if n != "__bytes"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keep), pa.array(best, pa.string()), pa.array(score, pa.float64())],
                [*(names[k] for k in keep), "lang_pred", "score"])
    return run


def labelled(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text",
             carried: list[str] | None = None) -> DataFrame:
    """The ``carried`` columns (the id by default) with ``lang_pred`` and ``score`` of the whole text."""
    held = shipped(docs.sparkSession).sparkContext.broadcast(model)
    names = carried or [id_col]
    frame = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("__row"),
                        F.col(f"`{text_col}`").cast("binary").alias("__bytes"))
    schema = T.StructType([frame.schema["__row"], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    return frame.mapInArrow(_predict(held), schema)


def identified(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
               per_language: int = PER_LANGUAGE) -> DataFrame:
    """Language of every document: id, ``held_out, lang_pred, score`` (mean chance of the label, 0 to 1).

    The model learns from documents that are not held out and have a language.
    Null texts and texts without a letter are ``und`` with score 0, as is every document
    if there is nothing to learn from. Equal masses go to the first label in order. Null ids
    are not held out and are carried along; repeated rows are judged alike; an empty
    table gives no rows; other columns are not looked at.
    """
    test = F.coalesce(held_out(id_col), F.lit(False))
    model = fitted(docs.where(~test), id_col=id_col, text_col=text_col, lang_col=lang_col, per_language=per_language)
    return labelled(docs, model, id_col=id_col, text_col=text_col).select(
        F.col("__row")[id_col].alias(id_col), "lang_pred", "score").select(
        id_col, test.alias("held_out"), "lang_pred", "score")


def in_known_language(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                      least: float = 0.5, per_language: int = PER_LANGUAGE) -> DataFrame:
    """The documents with a language of score ``least`` or more, with all their columns."""
    model = fitted(docs, id_col=id_col, text_col=text_col, lang_col=lang_col, per_language=per_language)
    return labelled(docs, model, id_col=id_col, text_col=text_col, carried=docs.columns).where(
        (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select("__row.*")

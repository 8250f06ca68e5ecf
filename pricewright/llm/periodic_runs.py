"""Periodic runs of words, found through string synchronising sets, and texts with the repeats cut.

A run is a maximal stretch of words with smallest period q that holds it four times
at least. Texts are runs of 64-bit word hashes here, many texts end to end with a
separator of its own after each, so every step is an array operation.

* Periods 1 to 3 are compared directly.
* For each tau = 4, 8, 16, ... a synchronising set holds the positions whose smallest
  window hash among the tau + 1 windows of tau words that start at i to i + tau belongs to the
  first or the last of them. Membership depends on the 2 tau words from i alone, so equal
  contexts are chosen alike wherever they stand.
* Windows of period tau / 4 or less would make the set dense. They lie inside runs found
  at smaller scales and are left out of it; those runs supply the small periods.
* Two neighbouring set positions with equal contexts, delta apart with tau <= delta < 2 tau, propose
  the period delta. A run with period p and length 4 p has such a pair at tau in (p/2, p]: any
  3 tau - 1 words of it are not of period tau / 4, so a set position stands in its first tau
  words, and it and its copy p later have their contexts inside the run.
* Proposals that overlap are one stretch, which is extended word by word at both ends.

Every run is confirmed on its words; if hashes of different words ever agree,
the text is done again with numbered words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from pricewright.llm import words as W
from pricewright.llm.ship import shipped

#: A run holds its period so many times, and so many words, at least.
TIMES, SHORTEST = 4, 6
_NONE = np.uint64(2**64 - 1)
_STEP = 64


def _stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(np.concatenate(([0], flags.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _small_periods(h: np.ndarray) -> list[np.ndarray]:
    found = []
    for q in (1, 2, 3):
        start, end = _stretches(h[:-q] == h[q:])
        found.append(np.stack([start, end + q, np.full(len(start), q)]))
    return found


def _extended(h: np.ndarray, low: np.ndarray, high: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches ``low <= x < high`` with word x = word x + q, as far as they go on."""
    low, high = low.copy(), high.copy()
    for bound, sign in ((high, 1), (low, -1)):
        active = np.arange(len(bound))
        while len(active):
            first = bound[active] - (sign < 0)
            x = first[:, None] + sign * np.arange(_STEP)
            inside = (x >= 0) & (x + q[active, None] < len(h))
            x = np.where(inside, x, 0)
            same = inside & (h[x] == h[np.where(inside, x + q[active, None], 0)])
            steps = np.where(same.all(axis=1), _STEP, same.argmin(axis=1))
            bound[active] += sign * steps
            active = active[steps == _STEP]
    return low, high


def _synchronising(ids: np.ndarray, tau: int, periodic: np.ndarray) -> np.ndarray:
    """Positions of the tau-synchronising set; ``periodic`` windows take no part."""
    ids = np.where(periodic, _NONE, ids)
    least, width = ids, 1
    while width < tau:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:-1], least[1:])
    n = len(least)
    return np.flatnonzero((least != _NONE) & ((least == ids[:n]) | (least == ids[tau:tau + n])))


def _proposals(places: np.ndarray, contexts: np.ndarray, tau: int) -> tuple[np.ndarray, ...]:
    """Stretches ``low, high, q`` that neighbouring equal contexts cover, overlapping ones joined."""
    order = np.lexsort((places, contexts))
    places, contexts = places[order], contexts[order]
    gap = np.diff(places)
    fits = (contexts[1:] == contexts[:-1]) & (gap >= tau) & (gap < 2 * tau)
    low, q = places[:-1][fits], gap[fits]
    order = np.lexsort((low, q))
    low, q = low[order], q[order]
    fresh = np.ones(len(low), dtype=bool)
    fresh[1:] = (q[1:] != q[:-1]) | (low[1:] > low[:-1] + 2 * tau)
    last = np.append(np.flatnonzero(fresh)[1:] - 1, len(low) - 1) if len(low) else np.empty(0, np.int64)
    return low[fresh], low[last] + 2 * tau, q[fresh]


def runs(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) of all runs in texts of hashed words; ``bounds[d]:bounds[d+1]`` is text d.

    Each text ends with a word that stands nowhere else, its separator. Sorted by start and period.
    """
    if len(h) < 4:
        return np.empty((0, 3), np.int64)
    kept = np.concatenate(_small_periods(h), axis=1)
    kept = kept[:, kept[1] - kept[0] >= TIMES * kept[2]]
    sizes = np.diff(bounds)
    own, place, tau = h, np.arange(len(h)), 4
    for width in (1, 2):
        own = W.mixed(own[:-width] * W._STEP[0] + own[width:])
    while len(own) and (sizes > TIMES * tau).any():
        long = np.repeat(sizes > TIMES * tau, sizes)[place]
        if long.mean() < 0.7:
            # only texts that can hold such a period go on; windows keep their own separators
            keep = long[:len(own)]
            place, own = place[long], own[keep]
        row = np.full(len(h) + 1, -1)
        row[place] = np.arange(len(place))
        short = kept[:, (kept[2] * 4 <= tau) & (kept[1] - kept[0] >= tau)]
        short = short[:, row[short[0]] >= 0]
        mark = np.zeros(len(place) + 1, dtype=np.int32)
        np.add.at(mark, row[short[0]], 1)
        np.add.at(mark, row[short[0]] + short[1] - short[0] - tau + 1, -1)
        periodic = np.cumsum(mark)[:len(own)] > 0
        at = _synchronising(own, tau, periodic)
        own = W.mixed(own[:-tau] * W._STEP[tau.bit_length()] + own[tau:]) if len(own) > tau else own[:0]
        at = at[at < len(own)]
        low, high, q = _proposals(at, own[at], tau)
        if len(low):
            base = place[low]
            low, high = _extended(h, base, base + high - low, q)
            new = np.stack([low, high + q, q])
            kept = np.concatenate([kept, new[:, new[1] - new[0] >= TIMES * q]], axis=1)
        tau *= 2
    order = np.lexsort((kept[2], kept[1], kept[0]))
    kept = kept[:, order]
    fresh = np.ones(kept.shape[1], dtype=bool)
    fresh[1:] = (kept[0, 1:] != kept[0, :-1]) | (kept[1, 1:] != kept[1, :-1])
    kept = kept[:, fresh]
    kept = kept[:, kept[1] - kept[0] >= SHORTEST]
    return kept[:, np.lexsort((kept[2], kept[0]))].T


def _separated(found: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes with a separator after each text, and the bounds with it."""
    n = len(found.bounds) - 1
    bounds = found.bounds + np.arange(n + 1)
    h = np.empty(len(found.hashes) + n, dtype=np.uint64)
    h[bounds[1:] - 1] = W.mixed(np.arange(n, dtype=np.uint64) + W._STEP[63])
    inner = np.ones(len(h), dtype=bool)
    inner[bounds[1:] - 1] = False
    h[inner] = found.hashes
    return h, bounds


def _numbered(found: W.Words, text: int, data: bytes) -> np.ndarray:
    """Hashes of one text from the numbers of its distinct words."""
    numbers: dict[bytes, int] = {}
    low, high = found.bounds[text:text + 2]
    own = [numbers.setdefault(data[s:e], len(numbers)) for s, e in
           zip(found.starts[low:high].tolist(), found.ends[low:high].tolist())]
    return W.mixed(np.array([*own, len(numbers)], dtype=np.uint64) + np.uint64(1))


def text_runs(found: W.Words) -> np.ndarray:
    """Rows (text, start, end, period) of the runs of a batch, confirmed on the words."""
    h, bounds = _separated(found)
    rows = runs(h, bounds)
    text = np.searchsorted(bounds, rows[:, 0], "right") - 1
    rows = np.column_stack([text, rows[:, :2] - bounds[text][:, None], rows[:, 2]])
    if not len(rows):
        return rows
    data, wrong = found.data.tobytes(), set()
    for d, start, end, q in rows.tolist():
        first = found.bounds[d] + start
        own = [data[s:e] for s, e in zip(found.starts[first:first + end - start].tolist(),
                                         found.ends[first:first + end - start].tolist())]
        if own[q:] != own[:-q]:
            wrong.add(d)
    for d in wrong:
        own = _numbered(found, d, data)
        again = runs(own, np.array([0, len(own)]))
        rows = np.concatenate([rows[rows[:, 0] != d], np.column_stack([np.full(len(again), d), again])])
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))] if wrong else rows


def _collapsed(found: W.Words, rows: np.ndarray) -> pa.Array:
    """Texts of the words that no run holds after its first period, joined by one space."""
    first = found.bounds[rows[:, 0]]
    mark = np.zeros(len(found.starts) + 1, dtype=np.int64)
    np.add.at(mark, first + rows[:, 1] + rows[:, 3], 1)
    np.add.at(mark, first + rows[:, 2], -1)
    kept = np.flatnonzero(np.cumsum(mark[:-1]) == 0)
    start, end = found.starts[kept], found.ends[kept]
    bounds = np.searchsorted(kept, found.bounds)
    last = np.zeros(len(kept) + 1, dtype=bool)
    last[bounds[1:][bounds[1:] > bounds[:-1]]] = True
    size = end - start + ~last[1:]
    # a word and the byte after it, which becomes the space; the last word of a text has none
    inside = np.zeros(len(found.data) + 2, dtype=np.int8)
    inside[start] = 1
    np.add.at(inside, start + size, -1)
    data = np.where(W.SPACED.inside[found.data], found.data, np.uint8(32))
    data = data[np.cumsum(inside[:len(data)], dtype=np.int8) > 0]
    offsets = np.concatenate(([0], np.cumsum(size)))[bounds].astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(offsets), pa.py_buffer(data.tobytes()))


def _batches(batches):
    for batch in batches:
        for low, high in W.slices(batch.column(1), 1 << 21):
            ids, texts = batch.column(0).slice(low, high - low), batch.column(1).slice(low, high - low)
            found = W.words(texts, W.SPACED)
            rows = text_runs(found)
            offsets = np.searchsorted(rows[:, 0], np.arange(len(ids) + 1)).astype(np.int32)
            number = lambda x: pa.array(x, pa.int64())
            each = pa.StructArray.from_arrays(
                [number(rows[:, 1]), number(rows[:, 2] - rows[:, 1]), number(rows[:, 3])], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [ids, number(np.diff(found.bounds)), pa.ListArray.from_arrays(offsets, each),
                 _collapsed(found, rows).cast(pa.string())], ["id", "n_words", "runs", "collapsed"])


def periodic(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id, ``n_words``, ``runs`` (array of start, length, period) and ``collapsed``.

    Runs go by start, then period; ``collapsed`` keeps a run's first period, its words
    joined by one space. A null or empty text has no words, no runs and an empty
    ``collapsed``. Rows are independent: repeated rows and ids give a row each,
    null ids stay null, an empty table gives none; other columns are not looked at.
    """
    shipped(docs.sparkSession)
    run = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(run)), T.StructField("collapsed", T.StringType())])
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text")
                       ).mapInArrow(_batches, schema).withColumnRenamed("id", id_col)

"""Benchmark decontamination: a broadcast hash set of normalised n-grams, scanned over whole texts.

The windows of the benchmark are hashed into sorted arrays. A scan hashes the
words of a batch of documents, looks every window up, and confirms each hit on
the words themselves. The benchmark is cut into blocks of at most
``BLOCK_WORDS`` words (on average; items are dealt by hash), 40 bytes each. A report over more than
``TOGETHER`` blocks writes its state between groups of them and drops their broadcasts. Hits are taken from the
same text over all blocks before anything is cut, so the result does not depend on the number of blocks.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from pricewright.llm import words as W
from pricewright.llm.ship import shipped
from pricewright.staging import staged

WINDOW = 10
BLOCK_WORDS = 2_000_000
TOGETHER = 4
_FOLD = W.ALNUM.folded
_SIEVE_BITS = 20


class Block:
    """Windows of some items in flat arrays: about 40 bytes a word, whatever the words are.

    ``spelled`` holds the folded words of all items, one space between them, ``at`` where each begins. By length of
    window: a sieve, the sorted hashes, and beside each hash the first word of its window and its item.
    """

    def __init__(self, items: list[tuple[object, bytes]], window: int):
        self.names = ["" if item is None else str(item) for item, _ in items]
        found = W.words(pa.array([text for _, text in items], pa.binary()), W.ALNUM)
        self.spelled, self.at = _spelled(found)
        self.lengths: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        counts = np.diff(found.bounds)
        sizes = np.minimum(counts, window)
        for size in np.unique(sizes[sizes > 0]).tolist():
            own = np.flatnonzero(sizes == size)
            each = counts[own] - size + 1
            item = np.repeat(own, each)
            first = np.arange(len(item)) - np.repeat(np.cumsum(each) - each, each) + found.bounds[item]
            known = W.windows(found.hashes, size)[first]
            order = np.argsort(known, kind="stable")
            known = known[order]
            sieve = np.zeros(1 << _SIEVE_BITS, dtype=bool)
            sieve[known >> np.uint64(64 - _SIEVE_BITS)] = True
            self.lengths[size] = (sieve, known, first[order], item[order].astype(np.int32))

    def _owners(self, size: int, low: int, high: int, words: bytes) -> set[str]:
        """Items of the windows ``low`` to ``high`` that are spelled like this; a hash alone proves nothing."""
        _, _, first, item = self.lengths[size]
        return {self.names[item[k]] for k in range(low, high)
                if self.spelled[self.at[first[k]]:self.at[first[k] + size] - 1] == words}

    def hits(self, found: W.Words) -> list[tuple[int, int, set]]:
        """First word, number of words and items of every confirmed window, over the whole batch."""
        out = []
        for size, (sieve, known, _, _) in self.lengths.items():
            runs = W.windows(found.hashes, size)
            maybe = np.flatnonzero(sieve[runs >> np.uint64(64 - _SIEVE_BITS)])
            low, high = (np.searchsorted(known, runs[maybe], side) for side in ("left", "right"))
            whole = (high > low) & (np.searchsorted(found.bounds, maybe, "right") == np.searchsorted(
                found.bounds, maybe + size - 1, "right"))
            for k, a, b in zip(maybe[whole].tolist(), low[whole].tolist(), high[whole].tolist()):
                owners = self._owners(size, a, b, b" ".join(found.text_of(j, _FOLD) for j in range(k, k + size)))
                if owners:
                    out.append((k, size, owners))
        return out


def _spelled(found: W.Words) -> tuple[bytes, np.ndarray]:
    """The folded words with a space behind each, and where each begins (and the end)."""
    size = found.ends - found.starts + 1
    at = np.concatenate(([0], np.cumsum(size)))
    place = np.arange(at[-1]) - np.repeat(at[:-1], size) + np.repeat(found.starts, size)
    out = _FOLD[np.append(found.data, 32).astype(np.uint8)[np.minimum(place, len(found.data))]]
    out[at[1:] - 1] = 32
    return out.tobytes(), at


def blocks(benchmark: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text",
           block_words: int = BLOCK_WORDS):
    """The benchmark as blocks of bounded size, one at a time; items without text are left out.

    A word and what parts it from the next take two characters at least, so a block of twice
    ``block_words`` characters has no more words than that. Items are not divided: one of more words is a block alone.
    """
    rows = benchmark.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")
                            ).where(F.length("text") > 0).distinct()
    total = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    parts = 1 + int(total // (2 * block_words))
    for part in range(parts):
        own = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == part)
        yield Block([(r[0], r[1].encode()) for r in own.toLocalIterator()], window)


#: Bytes of text whose words a task holds at a time.
SLICE = 1 << 22


def _sliced(batches, text_col: str):
    """The batches in pieces of about ``SLICE`` bytes of text, one row at least."""
    for batch in batches:
        for low, high in W.slices(batch.column(batch.schema.names.index(text_col)), SLICE):
            yield batch.slice(low, high - low)


_STATE = {"__n": pa.int64(), "__hit": pa.int64(), "__mask": pa.binary(), "__items": pa.list_(pa.string())}


def _scan(held, kept: list[str]):
    def run(batches):
        block = held.value
        for batch in _sliced(batches, "__bytes"):
            names = batch.schema.names
            found = W.words(batch.column(names.index("__bytes")), W.ALNUM)
            bounds, rows = found.bounds, batch.num_rows
            hit = np.zeros(len(found.hashes), dtype=bool)
            own = defaultdict(set)
            masks, items = (batch.column(names.index(n)).to_pylist() for n in ("__mask", "__items"))
            for row in (r for r in range(rows) if masks[r] is not None):
                low, high = bounds[row], bounds[row + 1]
                hit[low:high] = np.unpackbits(np.frombuffer(masks[row], np.uint8))[:high - low]
                own[row] |= set(items[row])
            marks = np.zeros(len(hit) + 1, dtype=np.int64)
            for first, size, owners in block.hits(found):
                marks[first] += 1
                marks[first + size] -= 1
                own[int(np.searchsorted(bounds, first, "right")) - 1] |= owners
            hit |= np.cumsum(marks[:-1]) > 0
            total = np.concatenate(([0], np.cumsum(hit)))[bounds]
            state = {"__n": np.diff(bounds), "__hit": np.diff(total),
                     "__mask": [np.packbits(hit[bounds[r]:bounds[r + 1]]).tobytes() if r in own else None
                                for r in range(rows)],
                     "__items": [sorted(own[r]) if r in own else None for r in range(rows)]}
            yield pa.RecordBatch.from_arrays(
                [pa.array(state[n], _STATE[n]) if n in state else batch.column(names.index(n)) for n in kept], kept)
    return run


def scanned(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
            window: int = WINDOW, item_col: str = "item_id", item_text: str = "text",
            block_words: int = BLOCK_WORDS) -> DataFrame:
    """``__id``, number of words, hit words, packed mask of hit words, and items that hit (null: none)."""
    spark = shipped(docs.sparkSession)
    frame = docs.select(
        F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").cast("binary").alias("__bytes"),
        F.lit(0).cast("long").alias("__n"), F.lit(0).cast("long").alias("__hit"),
        F.lit(None).cast("binary").alias("__mask"), F.lit(None).cast("array<string>").alias("__items"))
    full = list(frame.schema.fields)
    held: list = []
    for block in blocks(benchmark, window, item_col, item_text, block_words):
        if len(held) == TOGETHER:
            # the next group of blocks starts from a written table, and this one's broadcasts can go
            frame = staged(frame, "scanned")
            for old in held:
                old.unpersist(blocking=True)
            held = []
        held.append(spark.sparkContext.broadcast(block))
        frame = frame.mapInArrow(_scan(held[-1], [f.name for f in full]), T.StructType(full))
    return frame.drop("__bytes")


def contamination(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  window: int = WINDOW, item_col: str = "item_id", item_text: str = "text",
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """What of each document occurs in the benchmark.

    Words are runs of ASCII letters and digits and of anything past ASCII, A-Z
    lower-cased. A window is ``window`` consecutive words of an item; an item of
    fewer words is one window, one of none has no window. A document word inside
    any occurrence of a window is hit. Columns: id, ``n_words, n_hit, n_items,
    items, items_sha256`` (of the ids sorted as strings, comma-joined)
    and ``contaminated``.

    A null or empty text has no words and no hits. An item without an id counts as
    the empty id, repeated items as one. Either table may be empty. Rows that share
    an id are scanned one by one. Other columns of either table are not looked at.
    """
    frame = scanned(docs, benchmark, id_col=id_col, text_col=text_col, window=window, item_col=item_col,
                    item_text=item_text, block_words=block_words)
    items = F.coalesce("__items", F.array().cast("array<string>"))
    return frame.select(
        F.col("__id").alias(id_col), F.col("__n").alias("n_words"), F.col("__hit").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"), items.alias("items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (F.col("__hit") > 0).alias("contaminated"))


class _Held:
    """All blocks of the benchmark, looked up as one."""

    def __init__(self, held):
        self.held = held

    def hits(self, found: W.Words) -> list[tuple[int, int, set]]:
        return [hit for block in self.held for hit in block.value.hits(found)]


def _without_hits(block: Block | _Held, text: bytes) -> tuple[bytes, int, int]:
    """The text without hit words and what stands between them; words before and words removed.

    Cutting can join words to a new window, so it is repeated until none is left.
    """
    before, removed = None, 0
    while True:
        found = W.words(pa.array([text], pa.binary()), W.ALNUM)
        before = len(found.hashes) if before is None else before
        marks = np.zeros(len(found.hashes) + 1, dtype=np.int64)
        for first, size, _ in block.hits(found):
            marks[first] += 1
            marks[first + size] -= 1
        hit = np.cumsum(marks[:-1]) > 0
        if not hit.any():
            return text, before, removed
        removed += int(hit.sum())
        edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
        parts, at = [], 0
        for first, last in zip(edges[::2].tolist(), edges[1::2].tolist()):
            parts.append(text[at:found.starts[first]])
            at = int(found.ends[last - 1])
        text = b"".join([*parts, text[at:]])


def _cutter(block: _Held, text_col: str, drop_share: float):
    def run(batches):
        for batch in _sliced(batches, text_col):
            text_at = batch.schema.names.index(text_col)
            found = W.words(batch.column(text_at), W.ALNUM)
            touched = {int(np.searchsorted(found.bounds, first, "right")) - 1 for first, _, _ in block.hits(found)}
            if not touched:
                yield batch
                continue
            texts, keep = batch.column(text_at).to_pylist(), np.ones(batch.num_rows, dtype=bool)
            for row in touched:
                texts[row], n, gone = _without_hits(block, texts[row])
                keep[row] = gone < drop_share * n
            columns = [pa.array(texts, c.type) if k == text_at else c for k, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names).filter(pa.array(keep))
    return run


def remove_spans(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", window: int = WINDOW,
                 drop_share: float = 0.5, item_col: str = "item_id", item_text: str = "text",
                 block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without the benchmark's passages, all columns kept.

    Hit words go, with what stands between them; a document of which ``drop_share``
    or more of the words are hit goes as a whole. Words that a cut joins to a window are
    hit too. Untouched documents, null and empty texts stay as they are. Rows and texts
    are the same for any ``block_words``.
    """
    held = [shipped(docs.sparkSession).sparkContext.broadcast(b)
            for b in blocks(benchmark, window, item_col, item_text, block_words)]
    frame = docs.withColumn(text_col, F.col(f"`{text_col}`").cast("binary"))
    frame = frame.mapInArrow(_cutter(_Held(held), text_col, drop_share), frame.schema)
    return frame.withColumn(text_col, F.col(f"`{text_col}`").cast("string"))

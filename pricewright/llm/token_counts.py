"""Token counts that follow edits: a segment tree of pre-token runs per document.

A leaf holds a run of whole pre-tokens of about ``LEAF`` characters. It is cut where
white space starts: the pre-tokeniser lets white space stand only at the start of a
pre-token, so texts on both sides of such a place are encoded independently. The
tree keeps sums of characters and tokens, as a heap with the root at 1.

An edit finds the leaves it touches by descending the character sums. Only these are
encoded again, with a neighbour where the edit has undone a boundary (the new
run does not start with white space, or ends with it), and the sums above them are
updated. Everything else is neither read nor encoded.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, functions as F, types as T

from pricewright.llm.ship import shipped

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-token pattern the vocabulary was made with.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Fixed value: Unicode white space, which is what the pattern's \s means.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_IS_SPACE = re.compile(f"[{_SPACE}]")
_BOUNDARY = re.compile(f"(?<=[^{_SPACE}])(?=[{_SPACE}])")
LEAF = 512
GROWN = 4


@lru_cache(maxsize=4)
def _encoding(vocabulary: bytes) -> tiktoken.Encoding:
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def counter(vocabulary: bytes) -> Callable[[str], int]:
    """Number of tokens of a text that stands alone."""
    encode = _encoding(vocabulary).encode_ordinary
    return lambda text: len(encode(text))


def runs(text: str, leaf: int = LEAF) -> list[str]:
    """The text cut at starts of white space, at least ``leaf`` characters apart."""
    out, low = [], 0
    while low < len(text):
        cut = _BOUNDARY.search(text, low + leaf) if low + leaf < len(text) else None
        high = cut.start() if cut else len(text)
        out.append(text[low:high])
        low = high
    return out


class Tree:
    """Leaves with their texts, and heaps of character and token sums."""

    def __init__(self, pieces: list[str], tokens: list[int]):
        self.half = 1 << max(0, (len(pieces) - 1).bit_length())
        spare = self.half - len(pieces)
        self.pieces = [*pieces, *[""] * spare]
        self.chars = [0] * self.half + [len(p) for p in pieces] + [0] * spare
        self.tokens = [0] * self.half + list(tokens) + [0] * spare
        for k in range(self.half - 1, 0, -1):
            self._sum(k)

    @classmethod
    def of(cls, text: str, count: Callable[[str], int]) -> Tree:
        pieces = runs(text)
        return cls(pieces, [count(p) for p in pieces])

    @classmethod
    def kept(cls, text: str, chars: list[int], tokens: list[int]) -> Tree:
        """The tree of stored heaps over the text they were made from; nothing is encoded."""
        half, pieces, low = len(chars) // 2, [], 0
        for size in chars[half:]:
            pieces.append(text[low:low + size])
            low += size
        return cls(pieces, tokens[half:])

    def _sum(self, k: int) -> None:
        self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]
        self.tokens[k] = self.tokens[2 * k] + self.tokens[2 * k + 1]

    def _put(self, slot: int, piece: str, tokens: int) -> None:
        self.pieces[slot] = piece
        k = slot + self.half
        self.chars[k], self.tokens[k] = len(piece), tokens
        while k > 1:
            k //= 2
            self._sum(k)

    def _at(self, position: int) -> tuple[int, int]:
        """Leaf and offset of a character; the end of the text lies behind its last character."""
        if position >= self.chars[1]:
            slot, offset = self._at(self.chars[1] - 1) if self.chars[1] else (0, -1)
            return slot, offset + 1
        k = 1
        while k < self.half:
            k *= 2
            if position >= self.chars[k]:
                position -= self.chars[k]
                k += 1
        return k - self.half, position

    def _beside(self, slot: int, step: int) -> int | None:
        """The next leaf with text in a direction."""
        slot += step
        while 0 <= slot < self.half and not self.pieces[slot]:
            slot += step
        return slot if 0 <= slot < self.half else None

    def edit(self, start: int, end: int, new: str, count: Callable[[str], int]) -> int:
        """Replace ``start:end``, clamped to the text; the number of characters encoded again."""
        total = self.chars[1]
        start = min(max(start, 0), total)
        end = min(max(end, start), total)
        first, left = self._at(start)
        last, right = self._at(end - 1) if end > start else (first, left - 1)
        run = self.pieces[first][:left] + new + self.pieces[last][right + 1:]
        before, after = self._beside(first, -1), self._beside(last, 1)
        if run and before is not None and not _IS_SPACE.match(run[0]):
            run, first = self.pieces[before] + run, before
        if run and after is not None and _IS_SPACE.match(run[-1]):
            run, last = run + self.pieces[after], after
        if len(run) > GROWN * LEAF:
            leaves = self.tokens[self.half:]
            fresh = runs(run)
            self.__init__([*self.pieces[:first], *fresh, *self.pieces[last + 1:]],
                          [*leaves[:first], *map(count, fresh), *leaves[last + 1:]])
            return len(run)
        self._put(first, run, count(run))
        for slot in range(first + 1, last + 1):
            if self.pieces[slot]:
                self._put(slot, "", 0)
        return len(run)

    def text(self) -> str:
        return "".join(self.pieces)


_LONGS = T.ArrayType(T.LongType())


def _with(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    names = [*batch.schema.names, *(n for n in columns if n not in batch.schema.names)]
    return pa.RecordBatch.from_arrays(
        [columns[n] if n in columns else batch.column(batch.schema.names.index(n)) for n in names], names)


def _build(held):
    def run(batches):
        count = counter(held.value)
        for batch in batches:
            trees = [Tree.of(text or "", count) for text in batch.column(1).to_pylist()]
            yield _with(batch, {"tree_chars": pa.array([t.chars for t in trees], pa.list_(pa.int64())),
                                "tree_tokens": pa.array([t.tokens for t in trees], pa.list_(pa.int64()))})
    return run


def _edit(held):
    def run(batches):
        count = counter(held.value)
        for batch in batches:
            out = {n: [] for n in ("__text", "tree_chars", "tree_tokens", "n_encoded")}
            for text, chars, tokens, edits in zip(*(batch.column(k).to_pylist() for k in range(1, 5))):
                encoded = 0
                if edits:
                    tree = Tree.kept(text or "", chars, tokens)
                    for e in edits:
                        encoded += tree.edit(e["start"], e["end"], e["replacement"] or "", count)
                    text, chars, tokens = tree.text(), tree.chars, tree.tokens
                for name, value in zip(out, (text, chars, tokens, encoded)):
                    out[name].append(value)
            kinds = (pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64())
            yield _with(batch.drop_columns(["edits"]), {n: pa.array(v, k) for (n, v), k in zip(out.items(), kinds)})
    return run


def _vocabulary(frame: DataFrame, path: str):
    with open(path, "rb") as file:  # the driver's copy; its size is that of the vocabulary
        return shipped(frame.sparkSession).sparkContext.broadcast(file.read())


def _heaped(id_field: T.StructField) -> list[T.StructField]:
    return [id_field, T.StructField("__text", T.StringType()), T.StructField("tree_chars", _LONGS),
            T.StructField("tree_tokens", _LONGS)]


def counted(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
            vocabulary: str = VOCABULARY) -> DataFrame:
    """``id_col, text_col, tree_chars, tree_tokens, n_tokens`` of every whole text.

    A null text has no tokens. Repeated rows and null ids are counted row by row. An
    empty table gives no rows. Other columns are not looked at.
    """
    frame = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").alias("__text"))
    done = frame.mapInArrow(_build(_vocabulary(docs, vocabulary)), T.StructType(_heaped(frame.schema["__id"])))
    return done.select(F.col("__id").alias(id_col), F.col("__text").alias(text_col), "tree_chars", "tree_tokens",
                       _root("tree_tokens").alias("n_tokens"))


def _root(heap: str) -> Column:
    return F.coalesce(F.get(heap, F.lit(1)), F.lit(0).cast("long"))


def recounted(counts: DataFrame, edits: Column, *, id_col: str = "doc_id", text_col: str = "text",
              vocabulary: str = VOCABULARY) -> DataFrame:
    """``counts`` after ``edits``, an array of (start, end, replacement) applied in order, in code points.

    Adds ``n_before`` and ``n_encoded``, the characters that were encoded again. Each
    edit sees the text the one before it left; places outside the text are clamped to it, a
    null replacement is empty, a null or empty array changes nothing.
    """
    kind = "array<struct<start:bigint,end:bigint,replacement:string>>"
    frame = counts.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").alias("__text"), "tree_chars",
                          "tree_tokens", edits.cast(kind).alias("edits"), F.col("n_tokens").alias("n_before"))
    fields = [*_heaped(frame.schema["__id"]), T.StructField("n_before", T.LongType()),
              T.StructField("n_encoded", T.LongType())]
    done = frame.mapInArrow(_edit(_vocabulary(counts, vocabulary)), T.StructType(fields))
    return done.select(F.col("__id").alias(id_col), F.col("__text").alias(text_col), "tree_chars", "tree_tokens",
                       "n_before", "n_encoded", _root("tree_tokens").alias("n_tokens"))


def with_edits(counts: DataFrame, edits: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """``counts`` with the rows (id, seq, start, end, replacement) of an edit table as the array ``edits``."""
    own = edits.groupBy(F.col(f"`{id_col}`").alias("__key")).agg(F.sort_array(F.collect_list(
        F.struct("seq", "start", "end", "replacement"))).alias("edits"))
    listed = own.withColumn("edits", F.transform("edits", lambda e: F.struct(e["start"], e["end"], e["replacement"])))
    return counts.join(listed, counts[id_col] == listed["__key"], "left").drop("__key")

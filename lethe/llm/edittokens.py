"""Edit-aware token counts: a segment tree of pre-token groups per document.

A document's leaves are stretches of some ``LEAF_CHARS`` characters with their number of ids.
Leaves begin at white space behind other characters, where the pre-token split never
depends on what stands before, so counts of leaves add up; an added token has no white space
and stays within a leaf. An edit re-encodes the leaves
it touches, and a neighbour where it touches the edge (the boundary context); the
sums above the changed leaves are updated and nothing else is looked at.

``build`` makes the state (a column ``leaves``), ``apply`` takes rows with state and ``edits``
(start, stop, text; code points of the old text) and returns the new text, state and
count. Edits of a row are taken by position; one that starts before an earlier one
ends, or beyond the text, is an error. Edits may touch, insert, or delete.

Nulls: a null text is empty, null edits are none, a null replacement deletes. Repeated rows
are each counted; long texts have more leaves, never a cut. An empty table gives no rows.
Further columns pass through, result columns replace their namesakes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lethe.llm.common import bounded, slices, without
from lethe.llm.tokens import _SPACE, Encoder, _classes, encoder

LEAF_CHARS = 192
LEAVES = T.ArrayType(T.StructType([T.StructField("chars", T.IntegerType()), T.StructField("tokens", T.IntegerType())]))
EDITS = T.ArrayType(T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType()), T.StructField("text", T.StringType())]))
_LEAVES_ARROW = pa.list_(pa.struct([("chars", pa.int32()), ("tokens", pa.int32())]))
BUILT = {"leaves": LEAVES, "n_tokens": T.LongType()}
APPLIED = {**BUILT, "n_edits": T.LongType(), "n_reencoded": T.LongType()}
_SAFE = re.compile(r"(?<=[!-~])(?= )")


class Tree:
    """Sums of characters and ids over leaves, as two implicit binary trees."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.n = len(chars)
        self.base = 1 << max(0, (self.n - 1)).bit_length()
        self.sums = np.zeros((2, 2 * self.base), np.int64)
        self.sums[:, self.base : self.base + self.n] = chars, tokens
        level = self.base
        while level > 1:
            half = level // 2
            self.sums[:, half:level] = self.sums[:, level : 2 * level : 2] + self.sums[:, level + 1 : 2 * level : 2]
            level = half

    @property
    def leaves(self) -> tuple[np.ndarray, np.ndarray]:
        chars, tokens = self.sums[:, self.base : self.base + self.n]
        return chars[chars > 0], tokens[chars > 0]

    @property
    def chars(self) -> int:
        return int(self.sums[0, 1])

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def find(self, at: int) -> tuple[int, int]:
        """The leaf with character ``at`` and where it starts."""
        node, start = 1, 0
        while node < self.base:
            node *= 2
            left = int(self.sums[0, node])
            if at - start >= left:
                start, node = start + left, node + 1
        return node - self.base, start

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        node = leaf + self.base
        change = np.array([chars, tokens]) - self.sums[:, node]
        while node:
            self.sums[:, node] += change
            node //= 2

    def replace(self, first: int, last: int, chars: np.ndarray, tokens: np.ndarray) -> None:
        """New leaves for first..last: on their places, or with a rebuild of the sums if they are more."""
        places = last - first + 1
        if len(chars) <= places:
            for k in range(places):
                self.put(first + k, *((int(chars[k]), int(tokens[k])) if k < len(chars) else (0, 0)))
            return
        old = self.sums[:, self.base : self.base + self.n]
        self.__init__(*(np.concatenate([o[:first], x, o[last + 1 :]]) for o, x in zip(old, (chars, tokens), strict=True)))


def leaves_of(own: Encoder, texts: list[str], leaf_chars: int = LEAF_CHARS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Characters and ids of the leaves of each text."""
    if any(t.lstrip or t.rstrip or re.search(r"\s", t.content) for t in own.added):
        raise ValueError("an added token with white space may cross the edges of leaves")
    odd = {k for k, t in enumerate(texts) if own.odd(t)}
    codes, offsets, starts, _, entry = own.pieces(["" if k in odd else t for k, t in enumerate(texts)])
    width = own.begin[entry + 1] - own.begin[entry]
    found = []
    if len(starts):
        space = _classes()[codes] == _SPACE
        doc = np.searchsorted(offsets, starts, side="right") - 1
        head = starts == offsets[doc]
        safe = head | (space[starts] & ~space[starts - 1])
        at = np.flatnonzero(safe)
        step = (starts[at] - offsets[doc[at]]) // leaf_chars
        new = np.concatenate([[True], (step[1:] != step[:-1]) | (doc[at][1:] != doc[at][:-1])])
        cut = at[new]
        tokens = np.add.reduceat(width, cut)
        chars = np.diff(np.append(starts[cut], len(codes)))
        bounds = np.searchsorted(doc[cut], np.arange(len(texts) + 1))
    else:
        tokens = chars = np.zeros(0, np.int64)
        bounds = np.zeros(len(texts) + 1, np.int64)
    for k, text in enumerate(texts):
        if k not in odd:
            found.append((chars[bounds[k] : bounds[k + 1]], tokens[bounds[k] : bounds[k + 1]]))
            continue
        places, last = [0], 0
        for m in _SAFE.finditer(text):
            if m.start() - last >= leaf_chars:
                last = m.start()
                places.append(last)
        parts = [text[a:b] for a, b in zip(places, [*places[1:], len(text)], strict=True)]
        found.append((np.array([len(p) for p in parts]), own.counts(parts)))
    return found


def regions(tree: Tree, edits: list[tuple[int, int, str]]) -> list[list]:
    """Disjoint leaf ranges that the edits touch, with context: [first, last, start, stop, edits]."""
    out: list[list] = []
    before = 0
    for start, stop, text in sorted(edits, key=lambda e: (e[0], e[1])):
        if not before <= start <= stop <= tree.chars:
            raise ValueError(f"edit {start}..{stop} overlaps another one or is outside of the text")
        before = stop
        if not tree.chars:
            out = out or [[0, tree.n - 1, 0, 0, []]]
            out[-1][4].append((start, stop, text))
            continue
        first, begin = tree.find(max(start - 1, 0))  # at a leaf's edge, the leaf before
        last, at = tree.find(min(stop, tree.chars - 1))  # and the one behind
        end = at + int(tree.sums[0, tree.base + last])
        if out and first <= out[-1][1]:
            out[-1][1], out[-1][3] = max(last, out[-1][1]), max(end, out[-1][3])
        else:
            out.append([first, last, begin, end, []])
        out[-1][4].append((start, stop, text))
    return out


def edited(own: Encoder, rows: list[tuple[str, Tree, list[tuple[int, int, str]]]], leaf_chars: int = LEAF_CHARS) -> list[tuple[str, int]]:
    """Apply each row's edits to its tree; the new text and the number of characters encoded again."""
    todo, texts = [], []
    for k, (text, tree, edits) in enumerate(rows):
        for first, last, start, stop, own_edits in regions(tree, edits):
            parts, at = [], start
            for a, b, new in own_edits:
                parts += [text[at:a], new]
                at = b
            todo.append((k, first, last, start, stop))
            texts.append("".join([*parts, text[at:stop]]))
    found = leaves_of(own, texts, leaf_chars) if texts else []
    out = [[text, 0] for text, _, _ in rows]
    # From the last region to the first, so that leaf numbers and positions stay valid.
    for (k, first, last, start, stop), new, (chars, tokens) in zip(todo[::-1], texts[::-1], found[::-1], strict=True):
        rows[k][1].replace(first, last, chars, tokens)
        out[k][0] = out[k][0][:start] + new + out[k][0][stop:]
        out[k][1] += len(new)
    return [tuple(x) for x in out]


def _state(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(c) for c, _ in found])])
    chars, tokens = (np.concatenate([x[k] for x in found]) if found else np.zeros(0) for k in (0, 1))
    inner = pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in (chars, tokens)], ["chars", "tokens"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), inner)


def build(docs: DataFrame, vocabulary: str, *, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """``docs`` with the state: leaves and n_tokens."""
    docs = without(docs, *BUILT)
    schema = T.StructType([*docs.schema.fields, *(T.StructField(k, v) for k, v in BUILT.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        for batch in slices(batches):
            found = leaves_of(own, [t or "" for t in batch.column("text").to_pylist()], leaf_chars)
            sums = pa.array([int(t.sum()) for _, t in found], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, _state(found), sums], schema.fieldNames())

    return bounded(docs).mapInArrow(run, schema)


def apply(trees: DataFrame, vocabulary: str, *, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """New text, leaves and n_tokens of rows with ``edits``; n_edits and n_reencoded (characters)."""
    kept = [f for f in trees.schema.fields if f.name != "edits" and f.name.lower() not in APPLIED]
    schema = T.StructType([*kept, *(T.StructField(k, v) for k, v in APPLIED.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        for batch in slices(batches):
            texts, rows = batch.column("text").to_pylist(), []
            for k, edits in enumerate(batch.column("edits").to_pylist()):
                leaves = batch.column("leaves")[k].values
                tree = Tree(*(leaves.field(i).to_numpy(zero_copy_only=False) for i in (0, 1)))
                rows.append((texts[k] or "", tree, [(e["start"], e["stop"], e["text"] or "") for e in edits or ()]))
            done = edited(own, rows, leaf_chars)
            new = [t if t or texts[k] is not None else None for k, (t, _) in enumerate(done)]
            numbers = ([r[1].tokens for r in rows], [len(r[2]) for r in rows], [n for _, n in done])
            columns = [pa.array(new, pa.string()) if f.name == "text" else batch.column(f.name) for f in kept]
            state = _state([r[1].leaves for r in rows])
            yield pa.RecordBatch.from_arrays([*columns, state, *(pa.array(x, pa.int64()) for x in numbers)], schema.fieldNames())

    return bounded(trees).mapInArrow(run, schema)


def replacing(docs: DataFrame, pattern: str, replacement: str) -> DataFrame:
    """``docs`` with the column ``edits``: every match of ``pattern`` becomes ``replacement``."""
    docs = without(docs, "edits")
    schema = T.StructType([*docs.schema.fields, T.StructField("edits", EDITS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = re.compile(pattern).finditer
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("text", pa.string())]))
        for batch in slices(batches):
            edits = [[{"start": m.start(), "stop": m.end(), "text": replacement} for m in find(t or "")] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(edits, kind)], schema.fieldNames())

    return bounded(docs).mapInArrow(run, schema)

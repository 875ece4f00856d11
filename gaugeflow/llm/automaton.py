"""Weighted acyclic automata over words: counts of phrases of equal length.

States of a level are kept in the order of their paths as (state above, word); the weight of
a path stands at its last arc. Built from sorted phrases, united by adding the weights of
equal paths, composed with another automaton to look its paths up, and cut by ranges of
paths. Written down, last states with equal arcs and weights are one (the automaton is then
minimal in its last level, where nearly all states are).
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from gaugeflow.llm import text as T

FIELDS = ("labels binary, sizes array<int>, words array<int>, fans array<int>, targets array<int>, "
          "weights array<long>")


def field_types() -> list[pa.Field]:
    return [pa.field("labels", pa.binary()), pa.field("sizes", pa.list_(pa.int32())),
            pa.field("words", pa.list_(pa.int32())), pa.field("fans", pa.list_(pa.int32())),
            pa.field("targets", pa.list_(pa.int32())),
            pa.field("weights", pa.list_(pa.int64()))]


def _segments(fans: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each fan."""
    ends = np.cumsum(fans)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - fans), fans)


@dataclass(frozen=True)
class Automaton:
    labels: pa.Array  # the words, sorted by bytes
    parents: list[np.ndarray]
    words: list[np.ndarray]
    weights: np.ndarray

    def __len__(self) -> int:
        return len(self.weights)

    @staticmethod
    def build(labels: pa.Array, columns: list[np.ndarray], weights: np.ndarray | None = None,
              combine: np.ufunc = np.add) -> Automaton:
        """The automaton of some phrases: a column of word numbers per place. Equal phrases
        count once each, or their weights are added (or combined otherwise)."""
        size = max(len(labels), 1)
        state = np.zeros(len(columns[0]), np.int64)
        parents, words = [], []
        for level, column in enumerate(columns):
            last = level == len(columns) - 1
            keys = state * size + column
            if last and weights is None:
                unique, weights = np.unique(keys, return_counts=True)
            else:
                unique, state = np.unique(keys, return_inverse=True)
                if last:
                    total = np.zeros(len(unique), np.int64)
                    combine.at(total, state, weights)
                    weights = total
            parents.append(unique // size)
            words.append(unique % size)
        return Automaton(labels, parents, words, np.asarray(weights, np.int64))

    def columns(self) -> list[np.ndarray]:
        """The word numbers of all paths, a column per place."""
        state = np.arange(len(self))
        out = []
        for parents, words in zip(reversed(self.parents), reversed(self.words)):
            out.append(words[state])
            state = parents[state]
        return out[::-1]

    def some(self, chosen: np.ndarray) -> Automaton:
        """The paths at some places, in order, without words they do not use."""
        state, parents, words = chosen, [], []
        for level in range(len(self.words) - 1, -1, -1):
            above, number = np.unique(self.parents[level][state], return_inverse=True)
            parents.append(number if level else np.zeros(len(state), np.int64))
            words.append(self.words[level][state])
            state = above
        used = np.unique(np.concatenate(words)) if len(chosen) else np.zeros(0, np.int64)
        return Automaton(self.labels.take(pa.array(used)), parents[::-1],
                         [np.searchsorted(used, w) for w in words[::-1]], self.weights[chosen])

    def find(self, labels: pa.Array, columns: list[np.ndarray]) -> np.ndarray:
        """Composition with phrases (word numbers of other labels, a column per place): the
        place here of each, or -1."""
        number = pc.fill_null(pc.index_in(labels, value_set=self.labels), -1).to_numpy(
            zero_copy_only=False).astype(np.int64)
        size, at = max(len(self.labels), 1), np.zeros(len(columns[0]), np.int64)
        for parents, words, column in zip(self.parents, self.words, columns):
            word, keys = number[column], parents * size + words
            wanted = at * size + word
            place = np.searchsorted(keys, wanted)
            found = (at >= 0) & (word >= 0) & (place < len(keys))
            found[found] = keys[place[found]] == wanted[found]
            at = np.where(found, place, -1)
        return at

    def place(self, path: tuple[bytes, ...]) -> int:
        """How many paths come before this one."""
        size, at, exact = len(self.labels), 0, True
        for level, word in enumerate(path):
            keys = self.parents[level] * size + self.words[level]
            number = bisect_left(range(size), word, key=lambda i: self.labels[i].as_py())
            known = number < size and self.labels[number].as_py() == word
            wanted = at * size + (number if exact else 0)
            at = int(np.searchsorted(keys, wanted))
            exact = exact and known and at < len(keys) and keys[at] == wanted
        return at

    def path(self, at: int) -> tuple[bytes, ...]:
        out = []
        for parents, words in zip(reversed(self.parents), reversed(self.words)):
            out.append(self.labels[int(words[at])].as_py())
            at = int(parents[at])
        return tuple(out[::-1])

    def row(self) -> dict:
        """The automaton as lists; last states with equal arcs are written once."""
        above = len(self.words[-2])
        fans = [len(self.words[0]), *(np.bincount(p, minlength=len(w)) for p, w in zip(
            self.parents[1:-1], self.words[:-2]))]
        fan = np.bincount(self.parents[-1], minlength=above)
        starts = np.cumsum(fan) - fan
        word, weight = self.words[-1], self.weights
        arcs = T.mix(word.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + T.mix(weight.view(np.uint64)))
        sign = np.add.reduceat(arcs, starts) + fan.view(np.uint64) if above else arcs
        _, first, same = np.unique(sign, return_index=True, return_inverse=True)
        like = first[same]
        like = np.where(fan == fan[like], like, np.arange(above))
        twin = _segments(fan, starts[like])
        differs = (word != word[twin]) | (weight != weight[twin])
        if differs.any():  # equal signs, other arcs
            like[self.parents[-1][differs]] = self.parents[-1][differs]
        kept = np.unique(like)
        arcs_kept = _segments(fan[kept], starts[kept])
        data, offsets = T.utf8(self.labels)
        return {"labels": data[offsets[0]:offsets[-1]].tobytes(), "sizes": np.diff(offsets),
                "words": np.concatenate([*self.words[:-1], word[arcs_kept]]),
                "fans": np.concatenate([np.atleast_1d(f) for f in [*fans, fan[kept]]]),
                "targets": np.searchsorted(kept, like), "weights": weight[arcs_kept]}

    @staticmethod
    def from_row(levels: int, labels: pa.Array, words: np.ndarray, fans: np.ndarray,
                 targets: np.ndarray, weights: np.ndarray) -> Automaton:
        size, at, begin = int(fans[0]), 1, int(fans[0])
        parents, arcs = [np.zeros(size, np.int64)], [words[:size].astype(np.int64)]
        for _ in range(levels - 2):
            fan = fans[at:at + size]
            at, size = at + size, int(fan.sum())
            parents.append(np.repeat(np.arange(len(fan)), fan))
            arcs.append(words[begin:begin + size].astype(np.int64))
            begin += size
        fan = fans[at:].astype(np.int64)
        starts = np.cumsum(fan) - fan
        own = fan[targets]
        place = _segments(own, starts[targets])
        return Automaton(labels, [*parents, np.repeat(np.arange(len(own)), own)],
                         [*arcs, words[begin:][place].astype(np.int64)], weights[place])


def sorted_labels(values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct values in order, and each value's number."""
    coded = values.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return coded.dictionary.take(pa.array(order)), rank[coded.indices.to_numpy(zero_copy_only=False)]


def union(parts: list[Automaton], combine: np.ufunc = np.add) -> Automaton:
    """All paths; the weights of equal paths are added (or combined otherwise)."""
    if len(parts) == 1:
        return parts[0]
    labels, number = sorted_labels(pa.concat_arrays([p.labels for p in parts]))
    shift = np.cumsum([0, *(len(p.labels) for p in parts)])
    columns = [np.concatenate(c) for c in zip(*(
        [number[shift[i] + column] for column in p.columns()] for i, p in enumerate(parts)))]
    return Automaton.build(labels, columns, np.concatenate([p.weights for p in parts]), combine)


def as_batch(rows: list[dict], automata: list[Automaton], more: list[pa.Field]) -> pa.RecordBatch:
    """Rows of automata, each with some more values."""
    written = [a.row() for a in automata]
    arrays = [pa.array([r[f.name] for r in rows], f.type) for f in more]
    for field in field_types():
        values = [w[field.name] for w in written]
        if field.name == "labels":
            arrays.append(pa.array(values, pa.binary()))
            continue
        offsets = np.cumsum([0, *map(len, values)]).astype(np.int32)
        flat = pa.array(np.concatenate(values) if values else [], field.type.value_type)
        arrays.append(pa.ListArray.from_arrays(pa.array(offsets), flat))
    return pa.RecordBatch.from_arrays(arrays, schema=pa.schema([*more, *field_types()]))


def from_batch(batch, row: int, levels: int) -> Automaton:
    sizes, *numbers = (batch.column(n)[row].values.to_numpy(zero_copy_only=False)
                       for n in ("sizes", "words", "fans", "targets", "weights"))
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    labels = pa.Array.from_buffers(pa.binary(), len(sizes), [
        None, pa.py_buffer(offsets), batch.column("labels")[row].as_buffer()])
    return Automaton.from_row(levels, labels, *numbers)

"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For every byte prefix of a piece exactly one token can be last in its encoding:
the token t that ends there, where the prefix before t has last token s and the
pair (s, t) is one that merging would leave apart. Storing that token per prefix
encodes a piece from left to right without a merge queue, makes an append exact
(old prefixes keep their tokens) and an edit local (prefixes before it stay, and
pieces after it are reused). Whole pieces that are tokens are one token, as the
reference library has it.

Documents are handled in blocks: texts are cut into pieces by character class,
equal pieces of a block are encoded once, and the programme runs over all pieces
of a block at once. Null and empty texts have no tokens. Other columns are
ignored; repeated rows give repeated results. The tables (50,000 tokens) are
bounded by the vocabulary and travel with the tasks.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm import text as T

#: Pieces of more bytes are encoded one by one: tokens are found at all places at once, then
#: the programme runs over them.
LONG_PIECE = 64
#: Places of a long piece that are searched at once, and pieces that are compared at once.
SEARCHED, COMPARED = 1 << 16, 1 << 16
#: Slots for remembered pairs.
PAIR_SLOTS = 1 << 20

SPACE, LETTER, NUMBER, OTHER = range(4)
# The code points that are white space.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
         0x202F, 0x205F, 0x3000]
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


@lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """The class of each code point: white space, letter, number or other."""
    letter, number = regex.compile(r"\p{L}"), regex.compile(r"\p{N}")
    table = np.full(0x110000, OTHER, np.uint8)
    for point in range(0x110000):
        char = chr(point)
        table[point] = LETTER if letter.match(char) else NUMBER if number.match(char) else OTHER
    table[WHITE] = SPACE
    return table


def cut(block: T.Block, classes: np.ndarray) -> np.ndarray:
    """First bytes of the pieces of all texts of a block, in order."""
    data = block.data
    if not len(data):
        return np.zeros(0, np.int64)
    at = np.flatnonzero((data & 0xC0) != 0x80)
    first = data[at]
    kind = classes[first]
    wide = np.flatnonzero(first >= 0x80)
    if len(wide):
        place, lead = at[wide], first[wide].astype(np.int64)
        tail = [data[np.minimum(place + i, len(data) - 1)].astype(np.int64) & 0x3F for i in (1, 2, 3)]
        point = np.where(
            lead < 0xE0, (lead & 0x1F) << 6 | tail[0],
            np.where(lead < 0xF0, (lead & 0x0F) << 12 | tail[0] << 6 | tail[1],
                     (lead & 0x07) << 18 | tail[0] << 12 | tail[1] << 6 | tail[2]))
        kind[wide] = classes[np.minimum(point, 0x10FFFF)]
        first = first.copy()
        first[wide] = 0x80
    n = len(at)
    text_start = np.zeros(n + 1, dtype=bool)
    text_start[np.searchsorted(at, block.offsets)] = True
    text_start[n] = True
    run = text_start[:n].copy()
    run[1:] |= kind[1:] != kind[:-1]
    begin = run.copy()
    follows = np.zeros(n, dtype=bool)  # in the same text, the next character is no white space
    follows[:-1] = (kind[1:] != SPACE) & ~text_start[1:n]
    last_space = (kind == SPACE) & follows
    begin |= last_space
    attached = np.zeros(n, dtype=bool)
    attached[1:] = last_space[:-1] & (first[:-1] == 0x20)
    begin &= ~attached
    quote = np.flatnonzero((first[:-1] == 0x27) & run[:-1] & ~attached[:-1]
                           & (kind[1:] == LETTER) & ~text_start[1:n])
    if len(quote):
        padded = np.concatenate([first, np.zeros(2, np.uint8)])
        second, third = padded[quote + 1], padded[quote + 2]
        third = np.where(text_start[np.minimum(quote + 2, n)], 0, third)
        taken = np.zeros(len(quote), np.int64)
        for suffix in CONTRACTIONS:
            match = second == ord(suffix[0])
            if len(suffix) == 2:
                match &= third == ord(suffix[1])
            taken[match & (taken == 0)] = len(suffix)
        quote, taken = quote[taken > 0], taken[taken > 0]
        begin[quote + 1] = False
        rest = quote + 1 + taken
        rest = rest[rest < n]
        begin[rest[~text_start[rest] & (kind[rest] == LETTER)]] = True
    return at[begin]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class _Lookup:
    """Vectorised exact lookup of non-negative integer keys by open addressing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.bits = max(4, int(len(keys) * 3).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        left = np.arange(len(keys))
        slot = self._slot(keys)
        while len(left):
            free = self.keys[slot[left]] < 0
            _, winner = np.unique(slot[left[free]], return_index=True)
            put = left[free][winner]
            self.keys[slot[put]], self.values[slot[put]] = keys[put], values[put]
            left = left[self.keys[slot[left]] != keys[left]]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 for others."""
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], -1).astype(np.int32)
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out


class PrefixEncoder:
    """Tables of a vocabulary and the dynamic programme over prefixes."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.lengths = np.array([len(t) for t in self.tokens], np.int32)
        self.left = np.arange(len(self.tokens), dtype=np.int32)
        self.right = self.left.copy()
        nodes: dict[bytes, int] = {b"": 0}
        edges: list[tuple[int, int]] = []
        ends: dict[int, int] = {}
        for token, rank in ranks.items():
            if len(token) > 1 and (halves := _last_merge(token, rank, ranks)):
                self.left[rank], self.right[rank] = ranks[halves[0]], ranks[halves[1]]
            node = 0
            for i in range(1, len(token) + 1):
                child = nodes.setdefault(token[:i], len(nodes))
                if child == len(nodes) - 1:
                    edges.append((node << 8 | token[i - 1], child))
                node = child
            ends[node] = rank
        edges = sorted(set(edges))
        self.children = _Lookup(np.array([e[0] for e in edges], np.int64),
                                np.array([e[1] for e in edges], np.int32))
        self.ends = np.full(len(nodes), -1, np.int32)
        self.ends[list(ends)] = list(ends.values())
        made = np.flatnonzero(self.left != np.arange(len(self.tokens)))
        self.merges = _Lookup(self.left[made].astype(np.int64) << 32 | self.right[made],
                              made.astype(np.int32))
        self.pair_keys = np.full(PAIR_SLOTS, -1, np.int64)
        self.pair_apart = np.zeros(PAIR_SLOTS, dtype=bool)

    # ---- pairs

    def _stay_apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging would leave a token boundary between a and b.

        The merges that made the two tokens are undone from the latest on. A pair
        that meets at the boundary breaks it if its merge ranks before the merge
        just undone, for it would then have come first.
        """
        n = len(a)
        a, b = a.astype(np.int64), b.astype(np.int64)
        apart = np.zeros(n, dtype=bool)
        limit = np.full(n, 1 << 40, np.int64)
        live = np.arange(n)
        while len(live):
            x, y = a[live], b[live]
            merged = self.merges(x << 32 | y)
            live = live[~((merged >= 0) & (merged < limit[live]))]
            x, y = a[live], b[live]
            x_whole, y_whole = self.left[x] == x, self.left[y] == y
            apart[live[x_whole & y_whole]] = True
            undo_x = ~x_whole & ((x > y) | y_whole)
            undo_y = ~y_whole & ~undo_x
            limit[live[undo_x]] = x[undo_x]
            a[live[undo_x]] = self.right[x[undo_x]]
            limit[live[undo_y]] = y[undo_y] + 1
            b[live[undo_y]] = self.left[y[undo_y]]
            live = live[undo_x | undo_y]
        return apart

    def stay_apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a.astype(np.int64) << 32 | b
        slots = ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                 >> np.uint64(44)).astype(np.int64) & (PAIR_SLOTS - 1)
        unknown = np.flatnonzero(self.pair_keys[slots] != keys)
        out = self.pair_apart[slots]
        if len(unknown):
            fresh, back = np.unique(keys[unknown], return_inverse=True)
            apart = self._stay_apart(fresh >> 32, fresh & 0xFFFFFFFF)
            out[unknown] = apart[back]
            self.pair_keys[slots[unknown]] = keys[unknown]
            self.pair_apart[slots[unknown]] = apart[back]
        return out

    # ---- the dynamic programme

    def last_tokens(self, piece: bytes, known: list[int] | None = None) -> list[int]:
        """The last token of each prefix (index 0 is unused), continuing `known` prefixes."""
        last = list(known or [-1])
        for end in range(len(last), len(piece) + 1):
            found = -1
            for start in range(max(0, end - int(self.lengths.max())), end):
                token = self.rank_of(piece[start:end])
                if token >= 0 and self._reachable(token) and (start == 0 or self.stay_apart(
                        np.array([last[start]]), np.array([token]))[0]):
                    found = token
                    break
            last.append(found)
        return last

    def _tokens_at(self, data: np.ndarray, low: int, high: int):
        """Tokens that merging reaches, by their place: (start, end, token)."""
        live = np.arange(low, high)
        node, found, step = np.zeros(len(live), np.int64), [], 0
        while len(live):
            node = self.children(node << 8 | data[live + step])
            live, node = live[node >= 0], node[node >= 0].astype(np.int64)
            step += 1
            token = self.ends[node]
            good = token >= 0
            good[good] = (self.left[token[good]] != token[good]) | (self.lengths[token[good]] == 1)
            found.append((live[good], np.full(int(good.sum()), step), token[good]))
            inside = live + step < len(data)
            live, node = live[inside], node[inside]
        start, size, token = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(start, kind="stable")
        return start[order].tolist(), (start + size)[order].tolist(), token[order].tolist()

    def long_tokens(self, piece: bytes) -> list[int]:
        """``last_tokens`` of a long piece."""
        data = np.frombuffer(piece, np.uint8)
        last, apart = [-1] * (len(piece) + 1), {}
        for low in range(0, len(piece), SEARCHED):
            for start, end, token in zip(*self._tokens_at(data, low, min(low + SEARCHED, len(piece)))):
                if start:
                    pair = last[start] << 32 | token
                    fits = apart.get(pair)
                    if fits is None:
                        fits = apart[pair] = bool(self.stay_apart(
                            np.array([last[start]]), np.array([token]))[0])
                    if not fits:
                        continue
                last[end] = token
        return last

    def _reachable(self, token: int) -> bool:
        return self.lengths[token] == 1 or self.left[token] != token

    def rank_of(self, piece: bytes) -> int:
        return self.ranks.get(piece, -1)

    def piece_ids(self, piece: bytes, last: list[int] | None = None) -> list[int]:
        whole = self.rank_of(piece)
        if whole >= 0:
            return [whole]
        last = self.long_tokens(piece) if last is None else last
        ids, at = [], len(piece)
        while at:
            ids.append(last[at])
            at -= int(self.lengths[last[at]])
        return ids[::-1]

    def encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Token ids of many pieces, joined, and each piece's number of tokens."""
        sizes = ends - starts
        order = np.argsort(-sizes, kind="stable")
        sizes = sizes[order]
        long = int(np.searchsorted(-sizes, -LONG_PIECE, side="left"))
        order, long_ones = order[long:], order[:long]
        s, size = starts[order], sizes[long:]
        base = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
        last = np.full(int((size + 1).sum()), -1, np.int32)
        whole = np.full(len(order), -1, np.int32)
        unreachable = (self.left == np.arange(len(self.left))) & (self.lengths > 1)
        for j in range(int(size[0]) if len(size) else 0):
            live = np.arange(int(np.searchsorted(-size, -j, side="left")))
            node = np.zeros(len(live), np.int64)
            step = 0
            while len(live):
                node = self.children(node << 8 | data[s[live] + j + step])
                keep = node >= 0
                live, node = live[keep], node[keep].astype(np.int64)
                step += 1
                token = self.ends[node]
                some = np.flatnonzero(token >= 0)
                if len(some):
                    who, token = live[some], token[some]
                    if j == 0:
                        full = size[who] == step
                        whole[who[full]] = token[full]
                        good = ~unreachable[token]
                    else:
                        good = ~unreachable[token] & self.stay_apart(last[base[who] + j], token)
                    last[base[who[good]] + j + step] = token[good]
                keep = size[live] > j + step
                live, node = live[keep], node[keep]
        # walk back from the ends
        counts = np.zeros(len(starts), np.int64)
        short = np.ones(len(order), np.int64)
        walk = np.flatnonzero(whole < 0)
        at = size.copy()
        rounds = []
        if len(walk):
            short[walk] = 0
        while len(walk):
            token = last[base[walk] + at[walk]]
            rounds.append((walk, token))
            short[walk] += 1
            at[walk] -= self.lengths[token]
            walk = walk[at[walk] > 0]
        counts[order] = short
        slow = {int(i): self.piece_ids(data[starts[i]:ends[i]].tobytes()) for i in long_ones}
        for i, ids in slow.items():
            counts[i] = len(ids)
        place = np.concatenate([[0], np.cumsum(counts)])
        out = np.empty(int(place[-1]), np.int32)
        first = place[:-1][order]
        one = whole >= 0
        out[first[one]] = whole[one]
        for back, (who, token) in enumerate(rounds):
            out[first[who] + short[who] - 1 - back] = token
        for i, ids in slow.items():
            out[place[i]:place[i] + len(ids)] = ids
        return out, counts


def _last_merge(token: bytes, rank: int, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts whose merge makes a token, or None if merging does not reach it."""
    parts = [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 2:
        best, at = rank, -1
        for i in range(len(parts) - 1):
            r = ranks.get(parts[i] + parts[i + 1], rank)
            if r < best:
                best, at = r, i
        if at < 0:
            return None
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts[0], parts[1]


@lru_cache(maxsize=4)
def encoder(path: str) -> PrefixEncoder:
    """The tables of a rank file; the file is read on the driver only."""
    return PrefixEncoder(read_ranks(path))


def told_apart(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray,
               group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Groups of equal hashes as groups of equal bytes: what differs from the first of its
    group gets a group of its own."""
    sizes = ends - starts
    twin = starts[first[group]]
    differs = sizes != sizes[first[group]]
    alike = np.flatnonzero(~differs & (twin != starts))
    for low in range(0, len(alike), COMPARED):
        some = alike[low:low + COMPARED]
        stops = np.cumsum(sizes[some])
        inside = np.arange(stops[-1]) - np.repeat(stops - sizes[some], sizes[some])
        same = (data[np.repeat(starts[some], sizes[some]) + inside]
                == data[np.repeat(twin[some], sizes[some]) + inside])
        differs[some] = ~np.logical_and.reduceat(same, stops - sizes[some])
    odd = np.flatnonzero(differs)
    if len(odd):
        group = group.copy()
        group[odd] = len(first) + np.arange(len(odd))
        first = np.concatenate([first, odd])
    return first, group


class Encoded:
    """Tokens of a block: the distinct pieces with their tokens, and the texts as piece numbers."""

    def __init__(self, model: PrefixEncoder, classes: np.ndarray, block: T.Block) -> None:
        starts = cut(block, classes)
        ends = np.append(starts[1:], len(block.data)) if len(starts) else starts
        hashes = T.span_hashes(block.data, starts, ends)
        _, first, self.piece = np.unique(hashes, return_index=True, return_inverse=True)
        first, self.piece = told_apart(block.data, starts, ends, first, self.piece)
        self.ids, counts = model.encode(block.data, starts[first], ends[first])
        self.places = np.concatenate([[0], np.cumsum(counts)])
        self.counts = counts
        self.bounds = np.searchsorted(starts, block.offsets)

    def row_counts(self) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(self.counts[self.piece])])
        return total[self.bounds[1:]] - total[self.bounds[:-1]]

    def joined(self, parts: list[bytes], glue: bytes) -> list[bytes]:
        """Per text the parts of its tokens (one entry per id), joined."""
        ids = [parts[i] for i in self.ids.tolist()]
        places = self.places.tolist()
        distinct = np.empty(len(places) - 1, object)
        distinct[:] = [glue.join(ids[a:b]) for a, b in zip(places, places[1:])]
        bounds = self.bounds.tolist()
        return [glue.join(distinct[self.piece[a:b]].tolist()) for a, b in zip(bounds, bounds[1:])]


class EditableText:
    """A text whose encoding survives appends and edits: untouched pieces and prefixes are kept."""

    def __init__(self, model: PrefixEncoder, text: str = "") -> None:
        self.model, self.classes = model, char_classes()
        self.pieces: list[tuple[str, list[int]]] = []
        self._extend(0, text)

    @property
    def text(self) -> str:
        return "".join(piece for piece, _ in self.pieces)

    def ids(self) -> list[int]:
        return [i for piece, last in self.pieces for i in self.model.piece_ids(piece.encode(), last)]

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> None:
        """Put `new` in place of the characters from start to end.

        Cutting depends on one piece before and one character after a place, so it
        resumes two pieces before the edit and ends where two old cuts are met again.
        """
        cuts = [0]
        for piece, _ in self.pieces:
            cuts.append(cuts[-1] + len(piece))
        head = max(0, next((i for i, c in enumerate(cuts[1:]) if c >= start), len(self.pieces)) - 2)
        tail = next((i for i, c in enumerate(cuts) if c >= end), len(self.pieces))
        tail = min(len(self.pieces), tail + 3)
        text = self.text
        middle = text[cuts[head]:start] + new + text[end:cuts[tail]]
        kept, old = self.pieces[tail:], self.pieces[head:tail]
        self.pieces = self.pieces[:head]
        if kept:  # cut with what follows, then keep the part before it
            pieces = self._cut(middle + "".join(p for p, _ in kept))
            count, at = 0, 0
            while at < len(middle):
                at += len(pieces[count])
                count += 1
            if at == len(middle):
                self._add(pieces[:count], old)
                self.pieces += kept
                return
            self._add(pieces, old + kept)
            return
        self._add(self._cut(middle), old)

    def _extend(self, head: int, text: str) -> None:
        self.pieces = self.pieces[:head]
        self._add(self._cut(text), [])

    def _cut(self, text: str) -> list[str]:
        data = np.frombuffer(text.encode(), np.uint8)
        starts = cut(T.Block(0, 1, data, np.array([0, len(data)])), self.classes).tolist()
        raw = text.encode()
        return [raw[a:b].decode() for a, b in zip(starts, starts[1:] + [len(raw)])]

    def _add(self, pieces: list[str], old: list[tuple[str, list[int]]]) -> None:
        for n, piece in enumerate(pieces):
            raw = piece.encode()
            before, last = old[n] if n < len(old) else ("", [-1])
            prior = before.encode()
            same = 0
            while same < min(len(raw), len(prior)) and raw[same] == prior[same]:
                same += 1
            self.pieces.append((piece, self.model.last_tokens(raw, last[:same + 1])))


def encoded_documents(documents: DataFrame, path: str) -> DataFrame:
    """Per document row: number of tokens, digest of the ids, digest of the decoded bytes."""
    held = documents.sparkSession.sparkContext.broadcast((encoder(path), char_classes()))

    def run(batches):
        model, classes = held.value
        numbers = [str(i).encode() for i in range(len(model.tokens))]
        for batch in batches:
            for block in T.blocks(batch.column(1)):
                done = Encoded(model, classes, block)
                digest = lambda rows: pa.array([hashlib.sha256(x).hexdigest() for x in rows])
                yield pa.record_batch(
                    [batch.column(0).slice(block.first, block.rows), pa.array(done.row_counts()),
                     digest(done.joined(numbers, b" ")), digest(done.joined(model.tokens, b""))],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return (documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"))

"""SentencePiece encoding and decoding (op8) in batched numpy.

Texts are cut into segments that no piece can cross; distinct segments of equal length (in
characters) form one matrix and advance together.  A substring is looked up by its hash among the
sorted hashes of the pieces.

* Unigram models: Viterbi.  Position by position, the best score over all piece lengths is a
  vectorised maximum over the matrix, which also stores the backpointers.
* BPE models (the installed ``piece_bpe_32k.model`` is one): their scores are merge ranks, and the
  path with the largest sum of ranks isn't the model's encoding.  But a sequence of pieces is the
  encoding exactly where each neighbouring pair is compatible, that is, where merges of the two
  pieces' characters alone end in these two.  So a prefix ends in the one piece that is compatible
  with the last piece of the prefix before it: the same position-by-position pass, with a mask of
  compatible pairs in place of the maximum, and stored backpointers (``linked``).  Needed for it: each
  piece comes out of its own characters, by merges of rising rank.  Models without that property
  (``Model.parts`` is None) advance by merges: each round every segment joins its best-ranked
  adjacent pair, the leftmost of equals.

The model file is read and never trained.  A character that no piece covers becomes the pieces of
its bytes where the model has them, else the unknown piece.
"""

from __future__ import annotations

import heapq
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.store import modest_batches, table
from rollcall.llm.textvec import BYTE_BASE, Spans, chunks, frugal, ragged

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)
NONE = np.iinfo(np.int32).max
TOP_BITS = 20
PAIR_BITS = 20
CHUNK = 256 << 10  # bytes of texts encoded at a time
LONGEST = 64  # longer segments are cut further, or encoded one by one
CELLS = 1 << 18  # starts and widths of segments looked up at once
STEP = 1 << 12  # positions of a long segment looked up at once
KEPT = 1 << 19  # tokens of known segments that a task remembers


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or varint()
            yield key >> 3, data[at : at + size]
            at += size


class Model:
    """Pieces, scores and kinds of a model file's bytes."""

    def __init__(self, data: bytes, parts: np.ndarray | None = None):
        self.pieces: list[str] = []
        scores, kinds = [], []
        self.kind, self.prefix, squeeze, charsmap = UNIGRAM, True, True, b""
        for field, value in _fields(data):
            if field == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0])
                kinds.append(piece.get(3, NORMAL))
            elif field == 2:
                self.kind = dict(_fields(value)).get(3, UNIGRAM)
            elif field == 3:
                rules = dict(_fields(value))
                self.prefix, squeeze, charsmap = bool(rules.get(3, 1)), bool(rules.get(4, 1)), rules.get(2, b"")
        if self.kind not in (UNIGRAM, BPE) or squeeze or charsmap:
            raise ValueError("only unigram and BPE models that keep texts as they are")
        self._index(scores, np.array(kinds))
        self.parts = parts if parts is not None or self.kind != BPE else self._parts()
        if self.parts is not None:
            self.formed, self.split, self.left, self.right = self.parts

    def _index(self, scores: list[float], kinds: np.ndarray) -> None:
        self.unknown = int(np.flatnonzero(kinds == UNKNOWN)[0])
        raw = [p.replace("▁", " ").encode() for p in self.pieces]
        self.bytes = np.full(256, -1, np.int32)
        for i in np.flatnonzero(kinds == BYTE):
            value = int(self.pieces[i][3:5], 16)
            raw[i], self.bytes[value] = bytes([value]), i
        for i in np.flatnonzero(kinds == CONTROL):
            raw[i] = b""
        raw[self.unknown] = " ⁇ ".encode()
        self.fallback = bool((self.bytes >= 0).all())
        self.length = np.array([len(r) for r in raw])
        self.start = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(raw), np.uint8)

        own = np.flatnonzero(np.isin(kinds, (NORMAL, USER)) & (self.length > 0))
        hashes = Spans(self.flat).hashes(self.start[own], self.start[own] + self.length[own])
        order = np.argsort(hashes)
        self.keys, self.ids = hashes[order], own[order].astype(np.int32)
        if len(np.unique(self.keys)) < len(self.keys):
            raise ValueError("two pieces have one hash")
        score = np.array(scores)[self.ids]
        self.scores = score
        self.ranks = np.unique(-score, return_inverse=True)[1].astype(np.int32)
        top = (self.keys >> np.uint64(64 - TOP_BITS)).astype(np.int64)
        self.first = np.full(1 << TOP_BITS, -1, np.int32)  # the first key of each leading bits
        self.first[top[::-1]] = np.arange(len(top) - 1, -1, -1)
        self.most = int(np.bincount(top, minlength=1).max())
        self.pairs_met = np.full(1 << PAIR_BITS, -1, np.int64)  # pairs judged before, and whether compatible in the last bit
        self.least = float(score.min()) - 10 if len(score) else 0.0

        texts = [self.pieces[i].replace("▁", " ") for i in own]
        self.widest = max((len(t) for t in texts), default=1)
        self.pairs = {t[i : i + 2] for t in texts for i in range(len(t) - 1)}
        self.lonely = np.ones(256, bool)  # ASCII characters of no piece with more than one
        self.lonely[128:] = False
        for t in texts:
            if len(t) > 1:
                self.lonely[[ord(c) for c in t if ord(c) < 128]] = False
        self.cut_at_space = not any(a != " " and b == " " for a, b in self.pairs)

    def _parts(self) -> np.ndarray | None:
        """Per place: the rank of the merge that forms the piece, the bytes of its left part, and both parts' places (-1: none, as in the last column, a character without a piece)."""
        texts = [self.pieces[i].replace("▁", " ") for i in self.ids]
        place = {t: k for k, t in enumerate(texts)}
        out = np.full((4, len(texts) + 1), -1, np.int64)
        for k, t in enumerate(texts):
            symbols, before, parts = list(t), -1, None
            while len(symbols) > 1:
                rank, i = min((self.ranks[place[a + b]] if a + b in place else NONE, i) for i, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False)))
                if rank == NONE or rank < before:
                    return None
                before, parts = rank, symbols[i : i + 2]
                symbols[i : i + 2] = ["".join(parts)]
            if parts:
                out[:, k] = before, len(parts[0].encode()), place.get(parts[0], -1), place.get(parts[1], -1)
        return out

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Places among the sorted keys, -1 for none."""
        at = self.first[(hashes >> np.uint64(64 - TOP_BITS)).astype(np.int64)].astype(np.int64)
        maybe = np.nonzero(at >= 0)
        few, place = hashes[maybe], at[maybe]
        wrong = np.flatnonzero(self.keys[place] != few)
        for _ in range(self.most - 1):  # keys of equal leading bits follow each other
            place[wrong] = np.minimum(place[wrong] + 1, len(self.keys) - 1)
            wrong = wrong[self.keys[place[wrong]] != few[wrong]]
        place[wrong] = -1
        at[maybe] = place
        return at

    def rank(self, hashes: np.ndarray) -> np.ndarray:
        at = self.find(hashes)
        return np.where(at >= 0, self.ranks[at], NONE)


def merge(model: Model, spans: Spans, edges: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """BPE of segments whose characters lie between the columns of ``edges``: ``(rows, edges of their pieces)`` as they finish."""
    rows = np.arange(len(edges))
    ranks = model.rank(spans.hashes(edges[:, :-2], edges[:, 2:])) if edges.shape[1] > 2 else None
    while len(rows):
        symbols = edges.shape[1] - 1
        if symbols == 1:
            yield rows, edges
            return
        best = ranks.argmin(1)
        live = ranks[np.arange(len(rows)), best] < NONE
        if not live.all():
            yield rows[~live], edges[~live]
            rows, edges, ranks, best = rows[live], edges[live], ranks[live], best[live]
        each = np.arange(len(rows))
        stays = np.ones(edges.shape, bool)
        stays[each, best + 1] = False
        edges = edges[stays].reshape(len(rows), symbols)
        stays = np.ones(ranks.shape, bool)
        stays[each, best] = False
        ranks = ranks[stays].reshape(len(rows), symbols - 2)
        for moved, at in ((best > 0, best - 1), (best < symbols - 2, best)):
            r, c = each[moved], at[moved]
            ranks[r, c] = model.rank(spans.hashes(edges[r, c], edges[r, c + 2]))


def merge_one(model: Model, spans: Spans, edges: np.ndarray) -> np.ndarray:
    """The same for one long segment, with a heap."""
    n = len(edges) - 1
    end, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n

    def rank(i: int) -> int:
        return int(model.rank(spans.hashes(edges[[i]], edges[[end[end[i]]]] if end[i] < n else edges[[n]]))[0])

    first = model.rank(spans.hashes(edges[:-2], edges[2:]))
    heap = [(int(first[i]), i, i + 1, i + 2) for i in np.flatnonzero(first < NONE).tolist()]
    heapq.heapify(heap)
    while heap:
        _, i, middle, stop = heapq.heappop(heap)
        if not alive[i] or end[i] != middle or middle >= n or end[middle] != stop:
            continue
        alive[middle], end[i] = False, stop
        if stop < n:
            before[stop] = i
        for j in (before[i], i):
            if j >= 0 and end[j] < n:
                r = rank(j)
                if r < NONE:
                    heapq.heappush(heap, (r, j, end[j], end[end[j]]))
    return edges[[*(i for i in range(n) if alive[i]), n]]


def viterbi(model: Model, spans: Spans, edges: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The best-scored cut of each segment; of equal scores the one with the longest last piece."""
    count, length = edges.shape[0], edges.shape[1] - 1
    best = np.full((count, length + 1), -np.inf)
    back = np.zeros((count, length + 1), np.int64)
    best[:, 0] = 0
    for i in range(1, length + 1):
        reach = range(min(model.widest, i), 0, -1)
        scored = np.empty((len(reach), count))
        for k, width in enumerate(reach):
            at = model.find(spans.hashes(edges[:, i - width], edges[:, i]))
            scored[k] = np.where(at >= 0, model.scores[at], model.least if width == 1 else -np.inf) + best[:, i - width]
        k = scored.argmax(0)
        best[:, i], back[:, i] = scored[k, np.arange(count)], i - np.array(reach)[k]
    yield from _followed(back, edges)


def compatible(model: Model, spans: Spans, start: np.ndarray, middle: np.ndarray, end: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether no merge crosses ``middle`` when the characters of piece ``a`` and the following piece ``b`` are merged.

    The pieces are taken apart again, the one formed later first; between two steps back the two
    symbols at the border stood beside each other until the later step, so they must have no piece,
    or one of a later rank (of equal ranks the left merge comes first).
    """
    out = model.rank(spans.hashes(start, end)) == NONE
    at = np.flatnonzero(out)
    start, middle, end, a, b = start[at], middle[at], end[at], a[at], b[at]
    while len(at):
        of_a, of_b = model.formed[a], model.formed[b]
        left = of_a > of_b
        start, end = np.where(left, start + model.split[a], start), np.where(left, end, middle + model.split[b])
        a, b = np.where(left, model.right[a], a), np.where(left, b, model.left[b])
        whole = (of_a < 0) & (of_b < 0)
        end = np.where(whole, middle, end)
        rank = model.rank(spans.hashes(start, end))
        crossed = ~whole & np.where(left, rank < of_a, rank <= of_b)
        out[at[crossed]] = False
        on = ~(whole | crossed)
        at, start, middle, end, a, b = at[on], start[on], middle[on], end[on], a[on], b[on]
    return out


def judged(model: Model, spans: Spans, a: np.ndarray, b: np.ndarray, borders: Callable[[np.ndarray], tuple[np.ndarray, ...]]) -> np.ndarray:
    """``compatible``, with start, middle and end of some pairs from ``borders``.

    Pairs are remembered in a table of fixed size, and only those not in it are worked out; a
    character without a piece is none to remember.
    """
    key = a * len(model.keys) + b
    slot = ((key.view(np.uint64) * np.uint64(BYTE_BASE)) >> np.uint64(64 - PAIR_BITS)).view(np.int64)
    met = model.pairs_met[slot]
    out = (met & 1).astype(bool)
    named = (a >= 0) & (b >= 0)
    new = np.flatnonzero(~(named & (met >> 1 == key)))
    out[new] = compatible(model, spans, *borders(new), a[new], b[new])
    new = new[named[new]]
    model.pairs_met[slot[new]] = key[new] << 1 | out[new]
    return out


def linked(model: Model, spans: Spans, edges: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """BPE of each segment: per position the one piece compatible with the last of the prefix before it.

    All pieces in the matrix and all neighbouring pairs of them are looked up at once; then the
    rows advance together, position by position.
    """
    length = edges.shape[1] - 1
    widths = np.arange(1, min(model.widest, length) + 1)
    step = max(1, CELLS // (length * len(widths)))
    for low in range(0, len(edges), step):
        some = edges[low : low + step]
        count, each = len(some), np.arange(len(some))
        starts = np.arange(1, length + 1)[:, None] - widths
        inside = np.flatnonzero(starts >= 0)
        at = np.full((len(some), starts.size), -1, np.int64)
        at[:, inside] = model.find(spans.hashes(some[:, starts.ravel()[inside]], some[:, inside // len(widths) + 1]))
        at = at.reshape(len(some), *starts.shape)
        pieces = at >= 0
        pieces[:, :, 0] = True  # a character without a piece stands for itself
        row, stop, column = np.nonzero(pieces)
        begin, place = starts[stop, column], at[pieces]
        number = np.full(at.shape, -1, np.int64)
        number[pieces] = np.arange(len(row))
        amount = pieces.sum(2).ravel()  # pieces that end in each position of each row
        first = np.cumsum(amount) - amount
        cell = np.maximum(row * length + begin - 1, 0)  # the pieces that end where this one begins
        counts = np.where(begin > 0, amount[cell], 0)
        a, b = ragged(first[cell], counts), np.repeat(np.arange(len(row)), counts)
        border = lambda k: (some[row[a[k]], begin[a[k]]], some[row[b[k]], begin[b[k]]], some[row[b[k]], stop[b[k]] + 1])  # noqa: B023, E731
        fits = np.append(judged(model, spans, place[a], place[b], border), True)
        offset = np.cumsum(counts) - counts - first[cell]
        last, back = np.zeros((count, length + 1), np.int64), np.zeros((count, length + 1), np.int64)
        for i in range(1, length + 1):
            reach = slice(0, min(i, len(widths)))
            mine, begins = number[:, i - 1, reach], starts[i - 1, reach]
            pair = np.where(begins > 0, offset[mine] + last[:, begins], -1)  # a piece at the start fits
            k = ((mine >= 0) & fits[np.where(mine >= 0, pair, -1)]).argmax(1)
            last[:, i], back[:, i] = mine[each, k], begins[k]
        for rows, found in _followed(back, some):
            yield low + rows, found


def linked_one(model: Model, spans: Spans, edges: np.ndarray) -> np.ndarray:
    """The same for one long segment: pieces and compatible pairs of ``STEP`` positions are looked up at once."""
    n = len(edges) - 1
    back, chosen = [0] * (n + 1), [-1] * (n + 1)  # start, and number of the last piece of each prefix
    begin, stop, place = (np.zeros(0, np.int64) for _ in range(3))  # pieces that end in the positions looked at
    first = 0  # number of the first of them
    for low in range(0, n, STEP):
        high = min(low + STEP, n)
        keep = stop > low - model.widest
        first += int(len(keep) - keep.sum())
        old = int(keep.sum())
        ends, widths = np.arange(low + 1, high + 1)[:, None], np.arange(1, min(model.widest, high) + 1)[None, :]
        starts = ends - widths
        at = model.find(spans.hashes(edges[np.maximum(starts, 0)], edges[np.broadcast_to(ends, starts.shape)]))
        row, column = np.nonzero((starts >= 0) & ((at >= 0) | (widths == 1)))
        begin = np.concatenate([begin[keep], starts[row, column]])
        stop, place = np.concatenate([stop[keep], row + low + 1]), np.concatenate([place[keep], at[row, column]])
        b = np.arange(old, len(stop))
        before = np.searchsorted(stop, begin[b])
        counts = np.where(begin[b] > 0, np.searchsorted(stop, begin[b], "right") - before, 0)
        a, of = ragged(before, counts), np.repeat(b, counts)
        fits = judged(model, spans, place[a], place[of], lambda k: (edges[begin[a[k]]], edges[stop[a[k]]], edges[stop[of[k]]]))  # noqa: B023
        offset = np.cumsum(counts) - counts - before - first
        for k, s, e, shift in zip((b + first).tolist(), begin[b].tolist(), stop[b].tolist(), offset.tolist(), strict=True):
            if not s or fits[shift + chosen[s]]:
                back[e], chosen[e] = s, k
    out = [n]
    while out[-1]:
        out.append(back[out[-1]])
    return edges[out[::-1]]


def _followed(back: np.ndarray, edges: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Edges of the pieces that the backpointers name from the end, rows of equally many pieces together."""
    count, length = len(back), back.shape[1] - 1
    used = np.zeros((count, length + 1), bool)
    at, each = np.full(count, length), np.arange(count)
    used[:, length] = True
    while (at > 0).any():
        at = back[each, at]
        used[each, at] = True
    pieces = used.sum(1)
    for n in np.unique(pieces).tolist():
        rows = np.flatnonzero(pieces == n)
        yield rows, edges[rows][used[rows]].reshape(len(rows), n)


class Encoder:
    """Encodes columns; remembers tokens of segments it has met, up to ``KEPT`` of them."""

    def __init__(self, model: Model):
        self.model = model
        self.keys, self.start, self.length, self.flat = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def normal(self, column: pa.Array) -> pa.Array:
        wide = pa.large_string()
        column = pc.replace_substring(pc.fill_null(column.cast(wide), ""), "▁", " ")
        if not self.model.prefix:
            return column
        return pc.if_else(pc.equal(pc.binary_length(column), 0), column, pc.binary_join_element_wise(pa.scalar(" ", wide), column, pa.scalar("", wide)))

    def encode(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Per chunk: first row, end row, ids, id offsets per row, and the normalised bytes with their offsets."""
        for row, end, data, offsets in chunks(self.normal(column), CHUNK):
            if not len(data):
                yield row, end, np.zeros(0, np.int32), np.zeros(end - row + 1, np.int64), data, offsets
                continue
            starts, which = self._segments(data, offsets)
            first = np.searchsorted(starts, offsets)
            sizes = np.concatenate([[0], np.cumsum(self.length[which])])
            yield row, end, self.flat[ragged(self.start[which], self.length[which])], sizes[first], data, offsets

    def _segments(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the chunk's segments, and the place of each among the known ones."""
        chars = np.flatnonzero((data & 0xC0) != 0x80)
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        byte = data[chars]
        before = np.concatenate([[0], byte[:-1]])
        cut = edge[chars] | self.model.lonely[byte] | self.model.lonely[before]
        if self.model.cut_at_space:
            cut |= (byte == 32) & (before != 32)
        starts = chars[cut]
        spans = Spans(data)
        hashes = spans.hashes(starts, np.append(starts[1:], len(data)))
        unique, index, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.flat) > KEPT:
            self.__init__(self.model)
        at = np.minimum(np.searchsorted(self.keys, unique), max(len(self.keys) - 1, 0))
        new = self.keys[at] != unique if len(self.keys) else np.ones(len(unique), bool)
        if new.any():
            ends = np.append(chars, len(data))
            place = np.flatnonzero(cut)
            counts = np.diff(np.append(place, len(chars)))
            tokens, lengths = self._tokens(data, spans, ends, place[index[new]], counts[index[new]])
            keys = np.concatenate([self.keys, unique[new]])
            order = np.argsort(keys)
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(lengths) - lengths])[order]
            self.keys, self.length = keys[order], np.concatenate([self.length, lengths])[order]
            self.flat = np.concatenate([self.flat, tokens])
        return starts, np.searchsorted(self.keys, unique)[inverse]

    def _tokens(self, data: np.ndarray, spans: Spans, ends: np.ndarray, place: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of segments of ``counts`` characters from character ``place``, in turn, and how many each has."""
        advance, alone = (viterbi, None) if self.model.kind != BPE else (merge, merge_one) if self.model.parts is None else (linked, linked_one)
        rows, froms, tos = [], [], []

        def add(which, edges):
            rows.append(np.repeat(which, edges.shape[1] - 1))
            froms.append(edges[:, :-1].ravel())
            tos.append(edges[:, 1:].ravel())

        for count in np.unique(counts).tolist():
            these = np.flatnonzero(counts == count)
            if count > LONGEST:
                for i in these:
                    for edges in self._long(data, ends[place[i] : place[i] + count + 1]):
                        if alone and len(edges) > LONGEST:
                            add(np.array([i]), alone(self.model, spans, edges)[None, :])
                        else:
                            for _, found in advance(self.model, spans, edges[None, :]):
                                add(np.array([i]), found)
                continue
            for s in range(0, len(these), 1 << 14):
                some = these[s : s + (1 << 14)]
                for which, edges in advance(self.model, spans, ends[place[some][:, None] + np.arange(count + 1)]):
                    add(some[which], edges)
        row, start, stop = (np.concatenate(x) for x in (rows, froms, tos))
        order = np.argsort(row, kind="stable")
        row, start, stop = row[order], start[order], stop[order]
        at = self.model.find(spans.hashes(start, stop))
        known = at >= 0
        size = np.where(known, 1, stop - start) if self.model.fallback else np.ones(len(row), np.int64)
        ids = np.repeat(np.where(known, self.model.ids[at], self.model.unknown), size)
        if self.model.fallback:
            spelt = np.repeat(~known, size)
            ids[spelt] = self.model.bytes[data[ragged(start[~known], size[~known])]]
        return ids.astype(np.int32), np.bincount(row, size, len(counts)).astype(np.int64)

    def _long(self, data: np.ndarray, edges: np.ndarray) -> Iterator[np.ndarray]:
        """A long segment, cut wherever two neighbouring characters stand together in no piece."""
        text = data[edges[0] : edges[-1]].tobytes().decode()
        at = [0, *(i for i in range(1, len(text)) if text[i - 1 : i + 1] not in self.model.pairs), len(text)]
        for a, b in zip(at, at[1:], strict=False):
            yield edges[a : b + 1]


def decode(model: Model, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """Bytes of each row's ids, without the space that encoding puts in front."""
    sizes = np.concatenate([[0], np.cumsum(model.length[ids])])[offsets]
    flat = model.flat[ragged(model.start[ids], model.length[ids])]
    out = [flat[a:b].tobytes() for a, b in zip(sizes, sizes[1:], strict=False)]
    return [x[1:] if model.prefix and x[:1] == b" " else x for x in out]


def encode_documents(docs: DataFrame, model_path: str = MODEL, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids, round_trip`` per row.

    round_trip: the ids decode to the text again, with U+2581 as the space it stands for.  A null
    or empty text has no ids and comes back empty.  Repeated rows are encoded each.
    """
    modest_batches(docs.sparkSession)
    with open(model_path, "rb") as f:  # the driver's copy goes to the tasks
        data = f.read()
    shared = docs.sparkSession.sparkContext.broadcast((data, Model(data).parts))

    def run(batches):
        model = Model(*shared.value)
        encoder = Encoder(model)
        for batch in batches:
            for row, end, ids, offsets, data, bounds in encoder.encode(batch.column(1)):
                whole = data.tobytes()
                skip = 1 if model.prefix else 0
                texts = [whole[a + skip : b] for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False)]
                same = [x == y for x, y in zip(decode(model, ids, offsets), texts, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[row:end], pa.array(np.diff(offsets)), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids)), pa.array(same, pa.bool_())],
                    ["doc_id", "n_tokens", "ids", "round_trip"],
                )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(frugal(run), "doc_id long, n_tokens long, ids array<int>, round_trip boolean")


def decode_documents(rows: DataFrame, model_path: str = MODEL, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``doc_id, text`` of encoded rows; bytes that aren't UTF-8 become U+FFFD, null ids an empty text."""
    with open(model_path, "rb") as f:
        data = f.read()
    shared = rows.sparkSession.sparkContext.broadcast((data, Model(data).parts))

    def run(batches):
        model = Model(*shared.value)
        for batch in batches:
            lists = [x.as_py() or [] for x in batch.column(1)]
            offsets = np.cumsum([0, *(len(x) for x in lists)])
            texts = decode(model, np.array([i for x in lists for i in x], np.int64), offsets)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())], ["doc_id", "text"])

    return rows.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(ids).alias("ids")).mapInArrow(run, "doc_id long, text string")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))

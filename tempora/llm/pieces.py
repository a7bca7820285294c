"""SentencePiece encoding with sampled segmentations, and decoding.

A text becomes a lattice: every piece that matches somewhere is an edge between two byte positions. Forward filtering sums
the weights of all paths to each position; backward sampling then draws a path from the end, each edge with its exact
posterior probability. Draws come from a hash of the row's key, the seed, and the place in the text, so a row gives the same
pieces in every run, on every cluster, however the rows are dealt out.

The model file has merge ranks for scores. A piece of rank r has the weight (r + 2.7)**-alpha (Zipf's law): a larger alpha
prefers longer pieces, alpha 0 draws all paths alike. A character without a piece of its own is spelled in byte pieces.

No piece of the model goes on after white space that it does not start with, so the lattice of a text falls apart where
a space follows something else, and around line ends. The parts between (units) are independent; each distinct unit's lattice is
built once a batch and every occurrence draws its own path. A unit falls apart once more wherever no piece crosses a place, so a
long text without spaces is many short lattices, unless its pieces overlap without end.

Defined results: a null or empty text has no pieces and decodes to an empty text; decoding gives back every other text to the byte,
U+2581 and line ends included; rows that repeat are encoded alike; null keys draw alike; columns named like the
added one are replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import byte_values, memo, mix, prefix_sums, range_hashes, row_keys, slices, strings, uniform, utf8
from .columns import named, plain
from .storage import spread
from .units import ranges

BATCH_BYTES = 1 << 17
#: A worker keeps the lattices of the units that are most frequent in the first LEARN_BYTES it sees, of at most KEPT_BYTES together.
LEARN_BYTES = 1 << 20
KEPT_BYTES = 1 << 18
RANK_SHIFT = 2.7

_U = np.uint64


class Model:
    """The pieces of a model file as arrays."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        self.size = n
        self.byte_ids = np.zeros(256, np.int32)
        raw: list[bytes] = [b""] * n
        plain = np.zeros(n, bool)
        for i in range(n):
            if sp.is_byte(i):
                self.byte_ids[int(names[i][3:5], 16)] = i
                raw[i] = bytes([int(names[i][3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                raw[i] = names[i].replace("▁", " ").encode()
                plain[i] = True
                if " " in raw[i].decode().lstrip(" ") or b"\n" in raw[i]:
                    raise ValueError(f"piece {names[i]!r} crosses a unit boundary")
        self.log_rank = np.log(np.array([-sp.get_score(i) for i in range(n)]) + RANK_SHIFT)
        self.bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.length = np.array([len(x) for x in raw], np.int64)
        self.start = np.cumsum(self.length) - self.length
        ids = np.flatnonzero(plain)
        hashes = range_hashes(prefix_sums(byte_values()[self.bytes]), self.start[ids], self.start[ids] + self.length[ids])
        self.hashes, self.ids = hashes, ids.astype(np.int32)
        self.lengths = np.unique(self.length[ids]).tolist()
        self.common: dict = {}
        # where a hash may lie among the pieces': by its top bits, and for those that find the place taken by lower bits
        self.top, self.low = np.full(1 << 20, -1, np.int32), np.full(1 << 20, -1, np.int32)
        top, low = (hashes >> _U(44)).astype(np.int64), (hashes >> _U(8) & _U(0xFFFFF)).astype(np.int64)
        self.top[top] = np.arange(len(ids))
        second = np.flatnonzero(self.top[top] != np.arange(len(ids)))
        self.low[low[second]] = second
        if (self.low[low[second]] != second).any():
            raise ValueError("too many pieces for the tables of hashes")

    @classmethod
    def kept(cls, path: str) -> Model:
        kept = memo()
        if ("pieces", path) not in kept:
            kept["pieces", path] = cls(path)
        return kept["pieces", path]

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are pieces', and those pieces."""
        place = self.top[(hashes >> _U(44)).astype(np.int64)]
        may = np.flatnonzero(place >= 0)
        place, sought = place[may], hashes[may]
        hit = self.hashes[place] == sought
        other = np.flatnonzero(~hit)
        place[other] = self.low[(sought[other] >> _U(8) & _U(0xFFFFF)).astype(np.int64)]
        hit[other] = self.hashes[place[other]] == sought[other]  # (-1: of the last piece, whose hash it is not)
        return may[hit], self.ids[place[hit]]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The UTF-8 bytes of rows of ids, without the space that encoding puts in front, and their offsets."""
        out, ends = ranges(self.bytes, self.start[ids], self.length[ids])
        bounds = np.append(0, ends)[offsets]
        some = np.flatnonzero(bounds[1:] > bounds[:-1])
        keep = np.ones(len(out), bool)
        keep[bounds[:-1][some]] = False
        shift = np.zeros(len(bounds), np.int64)
        np.cumsum(bounds[1:] > bounds[:-1], out=shift[1:])
        return out[keep], bounds - shift


class Lattices:
    """The lattices of distinct units, edges in order of the node they end at, with cumulative posterior probabilities."""

    def __init__(self, model: Model, data: np.ndarray, starts: np.ndarray, alpha: float):
        n, total = len(starts) - 1, len(data)
        unit = np.repeat(np.arange(n), np.diff(starts))
        end = starts[1:][unit]
        sums = prefix_sums(byte_values()[data])
        begin_at, length, piece = [], [], []
        lead = (data & 0xC0) != 0x80
        starts_char = np.flatnonzero(lead)
        for size in model.lengths:
            p = starts_char[starts_char + size <= end[starts_char]]
            at, found = model.find(range_hashes(sums, p, p + size))
            begin_at.append(p[at])
            length.append(np.full(len(at), size))
            piece.append(found)
        # characters without a piece: spelled in bytes
        width = np.zeros(total, np.int32)
        width[starts_char] = np.diff(np.append(starts_char, total))
        covered = np.zeros(total, bool)
        for p, size in zip(begin_at, model.lengths, strict=True):
            covered[p[width[p] == size]] = True
        p = starts_char[~covered[starts_char]]
        begin_at.append(p)
        length.append(width[p])
        piece.append(np.full(len(p), -1, np.int32))
        begin, length, piece = np.concatenate(begin_at), np.concatenate(length), np.concatenate(piece)
        # all paths of a unit go through the places that no edge crosses: its parts between them are independent
        crossed = np.cumsum(np.bincount(begin + 1, minlength=total + 2) - np.bincount(begin + length, minlength=total + 2))
        cut = crossed[:total] == 0
        parts, of_part = np.flatnonzero(cut), np.cumsum(cut) - 1
        self.part = np.searchsorted(parts, starts[:-1])
        self.parts = np.diff(np.append(self.part, len(parts)))
        n, starts = len(parts), np.append(parts, total)
        # edges in order of the node they end at, and there of length, so the order is the same however units come together
        owner = of_part[begin]
        order = np.argsort((begin + length + owner) * 64 + np.minimum(length, 63))
        begin, length, piece, owner = begin[order], length[order], piece[order], owner[order]
        weight = np.where(piece >= 0, -alpha * model.log_rank[piece], -alpha * np.log(model.size + RANK_SHIFT) * length)
        self.values = np.concatenate([np.arange(model.size, dtype=np.int32), model.byte_ids[data]])
        self.source = np.where(piece >= 0, piece, model.size + begin)
        self.count = np.where(piece >= 0, 1, length)
        self.from_node, to_node = begin + owner, begin + length + owner
        depth = begin + length - starts[owner]
        forward = np.full(total + n, -np.inf)
        forward[starts[:-1] + np.arange(n)] = 0.0
        by_depth = np.argsort(depth.astype(np.uint16) if total < 1 << 16 or depth.max() < 1 << 16 else depth, kind="stable")
        depth, from_node, to, weight = depth[by_depth], self.from_node[by_depth], to_node[by_depth], weight[by_depth]
        cuts = np.flatnonzero(np.diff(depth, prepend=-1, append=-1))
        share = np.empty(len(depth))
        new = np.diff(to, prepend=-1) != 0  # nodes of one depth lie together, each with its edges
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            x = forward[from_node[a:b]] + weight[a:b]
            first = np.flatnonzero(new[a:b])
            first = first if len(first) and first[0] == 0 else np.append(0, first)
            top = np.maximum.reduceat(x, first)
            top[top == -np.inf] = 0.0
            sizes = np.diff(np.append(first, b - a))
            e = np.exp(x - np.repeat(top, sizes))
            s = np.add.reduceat(e, first)
            with np.errstate(divide="ignore"):
                forward[to[a:b][first]] = top + np.log(s)
            share[a:b] = e / np.repeat(np.maximum(s, 1e-300), sizes)
        posterior = np.empty(len(share))
        posterior[by_depth] = share
        q = np.cumsum(posterior)
        first = np.flatnonzero(np.diff(to_node, prepend=-1))
        sizes = np.diff(np.append(first, len(to_node)))
        low = np.append(0.0, q)[first]
        within = np.minimum(q - np.repeat(low, sizes), 1.0)
        if len(first):
            within[first + sizes - 1] = 1.0
        self.within = within
        self.edge = np.zeros(total + n, np.int64)
        self.edge[to_node[first]] = first
        self.first_node = starts[:-1] + np.arange(n)
        self.last_node = starts[1:] + np.arange(n)

    def draw(self, units: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A path for each occurrence of a unit (keys: 64 bits each): the flat ids of all, in order, and how many each has."""
        pieces = self.parts[units]
        which, stops = ranges(np.arange(len(self.first_node)), self.part[units], pieces)
        ordinal = np.arange(len(which)) - np.repeat(stops - pieces, pieces)
        ids, counts = self._draw(which, np.repeat(keys, pieces) + ordinal.astype(np.uint64) * _U(0xA0761D6478BD642F))
        return ids, np.diff(np.append(0, np.cumsum(counts))[np.append(0, stops)])

    def _draw(self, units: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """draw() for parts of units."""
        n = len(units)
        node, stop = self.last_node[units], self.first_node[units]
        active = np.flatnonzero(node > stop)
        who, edges, step = [], [], 0
        while len(active):
            u = uniform(keys[active] + _U(step * 0x9E3779B97F4A7C15 % (1 << 64)))
            edge = self.edge[node[active]]
            more = np.flatnonzero(self.within[edge] <= u)
            while len(more):  # the last edge of a node ends at 1, which no draw reaches
                edge[more] += 1
                more = more[self.within[edge[more]] <= u[more]]
            who.append(active)
            edges.append(edge)
            node[active] = self.from_node[edge]
            active = active[node[active] > stop[active]]
            step += 1
        steps = np.zeros(n, np.int64)
        for w in who:
            steps[w] += 1
        ends = np.cumsum(steps)
        path = np.empty(int(ends[-1]) if n else 0, np.int64)
        for k, (w, e) in enumerate(zip(who, edges, strict=True)):
            path[ends[w] - 1 - k] = e
        ids, stops = ranges(self.values, self.source[path], self.count[path])
        return ids, np.diff(np.append(0, np.append(0, stops)[ends]))


class Common:
    """The lattices of frequent units, built once a worker; what they are has no effect on the draws."""

    def __init__(self, model: Model, alpha: float):
        self.model, self.alpha, self.lattice = model, alpha, None
        self.seen: list[tuple] = []
        self.size = 0

    @classmethod
    def kept(cls, model: Model, alpha: float) -> Common:
        return model.common.setdefault(alpha, cls(model, alpha))

    def learn(self, hashes: np.ndarray, counts: np.ndarray, text: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
        self.seen.append((hashes, counts, *ranges(text, starts, lengths), lengths))
        self.size += int(lengths @ counts)
        if self.size < LEARN_BYTES:
            return
        every, first, code = np.unique(np.concatenate([x[0] for x in self.seen]), return_index=True, return_inverse=True)
        total = np.bincount(code, weights=np.concatenate([x[1] for x in self.seen]))
        length = np.concatenate([x[4] for x in self.seen])
        start = np.cumsum(length) - length
        best = np.argsort(-total, kind="stable")
        best = best[total[best] > 1]
        best = np.sort(best[np.cumsum(length[first[best]]) <= KEPT_BYTES])
        units, stops = ranges(np.concatenate([x[2] for x in self.seen]), start[first[best]], length[first[best]])
        self.hashes, self.lattice, self.seen = every[best], Lattices(self.model, units, np.append(0, stops), self.alpha), []

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The unit of each hash in the lattices, -1 where it is none."""
        if self.lattice is None or not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        return np.where(self.hashes[at] == hashes, at, -1)


def encode_rows(model: Model, data: np.ndarray, offsets: np.ndarray, keys: np.ndarray, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """Sampled ids of all rows, flat, and the number of each."""
    flat, counts, common = [], [], Common.kept(model, alpha)
    for i, j in slices(offsets, BATCH_BYTES):
        lengths = np.diff(offsets[i : j + 1])
        some = lengths > 0
        bounds = np.zeros(j - i + 1, np.int64)
        np.cumsum(lengths + some, out=bounds[1:])
        text = np.full(bounds[-1], 0x20, np.uint8)
        body = np.ones(len(text), bool)
        body[bounds[:-1][some]] = False
        text[body] = data[offsets[i] : offsets[j]]
        space, line = text == 0x20, text == 0x0A
        start = line.copy()
        start[1:] |= line[:-1] | (space[1:] & ~space[:-1])
        start[bounds[:-1][some]] = True
        at = np.flatnonzero(start)
        if not len(at):
            counts.append(np.zeros(j - i, np.int64))
            continue
        ends = np.append(at[1:], len(text))
        codes, unique = pd.factorize(range_hashes(prefix_sums(byte_values()[text]), at, ends))
        first = np.empty(len(unique), np.int64)
        first[codes[::-1]] = np.arange(len(at) - 1, -1, -1)
        known = common.find(unique)
        if common.lattice is None:
            common.learn(unique, np.bincount(codes), text, at[first], (ends - at)[first])
        new = np.flatnonzero(known < 0)
        place = np.empty(len(unique), np.int64)
        place[new] = np.arange(len(new))
        distinct, stops = ranges(text, at[first[new]], (ends - at)[first[new]])
        lattice = Lattices(model, distinct, np.append(0, stops), alpha)
        row = np.searchsorted(bounds, at, "right") - 1
        begins = np.searchsorted(at, bounds[:-1])
        ordinal = (np.arange(len(at)) - begins[row]).astype(np.uint64)
        draws = mix(keys[i:j][row] + ordinal * _U(0xD1342543DE82EF95))
        old, fresh = np.flatnonzero(known[codes] >= 0), np.flatnonzero(known[codes] < 0)
        ids, per_fresh = lattice.draw(place[codes[fresh]], draws[fresh])
        per_unit = np.zeros(len(at), np.int64)
        per_unit[fresh] = per_fresh
        if len(old):
            more, per_old = common.lattice.draw(known[codes[old]], draws[old])
            per_unit[old] = per_old
            begin = np.empty(len(at), np.int64)
            begin[fresh] = np.cumsum(per_fresh) - per_fresh
            begin[old] = np.cumsum(per_old) - per_old + len(ids)
            ids, _ = ranges(np.concatenate([ids, more]), begin, per_unit)
        flat.append(ids)
        counts.append(np.bincount(row, weights=per_unit, minlength=j - i).astype(np.int64))
    if not flat:
        return np.zeros(0, np.int32), np.concatenate(counts) if counts else np.zeros(0, np.int64)
    return np.concatenate(flat), np.concatenate(counts)


def _replaced(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name != name] + [T.StructField(name, kind)])


def encode(docs: DataFrame, model_path: str, text: str = "text", key: str = "doc_id", *, alpha: float = 1.0, seed: int = 0, output: str = "piece_ids", drop_text: bool = False, decoded: str | None = None) -> DataFrame:
    """docs with a column of sampled piece ids; decoded names a further column for the text that the ids decode to."""
    source = spread(plain(docs).withColumn(text, F.col(text).cast("string")))
    kept = [c for c in source.columns if c not in (output, decoded) and not (drop_text and c == text)]
    schema = _replaced(source.select(*[f"`{c}`" for c in kept]).schema, output, T.ArrayType(T.IntegerType()))
    if decoded:
        schema = _replaced(schema, decoded, T.StringType())

    def run(batches):
        model = Model.kept(model_path)
        for batch in batches:
            data, offsets = utf8(batch[text])
            keys = row_keys(batch[key], seed)
            for i, j in slices(offsets, 4 * BATCH_BYTES):
                ids, counts = encode_rows(model, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], keys[i:j], alpha)
                ends = np.append(0, np.cumsum(counts)).astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32)))
                more = [strings(*model.decode(ids, ends.astype(np.int64))).cast(pa.string())] if decoded else []
                yield pa.RecordBatch.from_arrays([*(batch[c][i:j] for c in kept), column, *more], names=schema.names)

    return named(source.mapInArrow(run, schema))


def decode(encoded: DataFrame, model_path: str, ids: str = "piece_ids", output: str = "decoded") -> DataFrame:
    """encoded with the text of its piece ids; null ids give an empty text."""
    encoded = plain(encoded)
    kept = [c for c in encoded.columns if c != output]
    schema = _replaced(encoded.schema, output, T.StringType())

    def run(batches):
        model = Model.kept(model_path)
        for batch in batches:
            column = batch[ids].cast(pa.list_(pa.int32()))
            sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            data, offsets = model.decode(column.flatten().to_numpy(zero_copy_only=False), np.append(0, np.cumsum(sizes)))
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), strings(data, offsets).cast(pa.string())], names=[*kept, output])

    return named(encoded.mapInArrow(run, schema))

"""Near-duplicate texts: consistent weighted sampling over TF-IDF shingles, banded, verified by weighted Jaccard similarity.

Shingles are SHINGLE consecutive words ([^\\x20\\x09-\\x0D]+, unchanged); a shorter text with words is one shingle. The weight
of a shingle in a text is (1 + ln tf) * idf, with idf = 1 + ln(1 / max(df / n, RARE)) / ln(1 / RARE): 1 for a shingle that all n texts
have, 2 for one that no more than RARE of them have. So weights depend on shares of texts and are the same at every size of the input.
df is exact where it matters: a count-min row of WIDTH counters over all texts rules out shingles that are rare for sure, the others are
counted exactly in a second pass. No more than FREQUENT shingles can be above RARE (which is raised if texts are so long that they
could), so their table has a bounded size and is broadcast.

1. Every text gets BANDS * ROWS samples by the improved consistent weighted sampling of Ioffe (2010): two texts share a
   sample with the probability of their weighted Jaccard similarity. ROWS samples make a band. At similarity 0.8 a pair
   shares a band with probability 1 - (1 - 0.8**3)**12 = 0.9998, at 0.5 with 0.80, at 0.3 with 0.28.
2. Texts of equal vectors are one class from here on. Classes that share a band are candidates; candidate clusters are
   the components of the graph of classes and bands (a star a band, never its pairs).
3. Texts of clusters travel to tasks of at most BLOCK classes of a cluster, once, and pairs that share a band are verified by their exact weighted
   Jaccard similarity, THRESHOLD or more being a link, unless links join them already. A cluster over BLOCK classes is cut into blocks; about
   HUBS of its classes, chosen by hash, go to all its blocks, so near copies of the same text are linked across blocks at once.
4. Pairs of different blocks that no link joins meet by prefixes: two vectors as similar as THRESHOLD share a shingle among the first
   ones, in any fixed order, that hold 1 - THRESHOLD of their weights. The order puts shingles that many of the hubs have last, so
   variants of one template share no prefix and are never compared, however many they are, while no similar pair is lost. Of classes whose prefixes
   meet, those outside the largest linked part are verified against all. (Work is quadratic only in classes that are alike in their
   prefixes and yet below THRESHOLD, as variants of a template that is most of each text are.)
5. Groups are the components of the links.

Defined results: a null, empty or blank text is in a group of its own (class_id is its id); rows that repeat are copies;
the id of a group is its smallest id, copies included, and null only if all ids of the group are null; an empty table gives an empty table.
Columns of docs do not matter but id and text; a text of any length is one row of a task.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import Words, mix, prefix_sums, range_hashes, slices, utf8, window_hashes
from .components import components
from .storage import discard, identified, release, row_hash, spread, stash

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 12
ROWS = 3
#: The share of texts up to which a shingle is as rare as can be, and the most shingles that may be above it.
RARE = 0.001
FREQUENT = 2_000_000
WIDTH = 1 << 22
SEGMENTS = 64
BLOCK = 384
HUBS = 32
BIN_BYTES = 4 << 20
TASK_BYTES = 64 << 20
#: Shingles that a task gathers before it sends their counts.
GATHER = 1_000_000

_U = np.uint64
#: A shingle keeps this many bits of its hash, the rest tells the row.
_BITS = 44
_STEP = 16_384


def shingles(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """row, id (44 bits) and count of each distinct shingle of each row, ordered by row and id."""
    hashes = words.hashes()
    sums = prefix_sums(hashes)
    starts = words.window_starts(SHINGLE)
    ids, row = window_hashes(sums, starts, SHINGLE), words.row[starts]
    short = np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE))
    if len(short):
        ids = np.concatenate([ids, range_hashes(sums, words.first[short], words.first[short + 1])])
        row = np.concatenate([row, short])
    keys = np.sort(row.astype(np.uint64) << _U(_BITS) | ids >> _U(64 - _BITS))
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(new)
    keys = keys[at]
    return (keys >> _U(_BITS)).astype(np.int64), keys & _U((1 << _BITS) - 1), np.diff(np.append(at, len(new)))


def _sketch(docs: DataFrame) -> tuple[int, np.ndarray]:
    """The number of texts (__text) with words, and the count-min row of their shingles."""
    import zlib

    part = WIDTH // SEGMENTS

    def count(batches):
        row, n = np.zeros(WIDTH, np.uint32), 0
        for batch in batches:
            data, offsets = utf8(batch["__text"])
            for i, j in slices(offsets):
                words = Words(data, offsets, i, j)
                n += int((words.counts > 0).sum())
                np.add.at(row, (shingles(words)[1] & _U(WIDTH - 1)).astype(np.int64), np.uint32(1))
        yield pa.RecordBatch.from_pydict({"segment": pa.array([*range(SEGMENTS), -1], pa.int32()), "counts": pa.array([*(zlib.compress(row[k * part : (k + 1) * part].astype("<u4").tobytes(), 1) for k in range(SEGMENTS)), b""]), "n": pa.array([0] * SEGMENTS + [n], pa.int64())})

    def add(rows: pa.Table) -> pa.Table:
        total = np.zeros(part, np.uint64)
        for x in rows["counts"].to_pylist():
            if x:
                total += np.frombuffer(zlib.decompress(x), "<u4")
        counts = np.minimum(total, 2**32 - 1).astype("<u4").tobytes()
        return pa.table({"segment": rows["segment"][:1], "counts": pa.array([counts]), "n": pa.array([sum(rows["n"].to_pylist())], pa.int64())})

    kind = "segment int, counts binary, n long"
    found = docs.select("__text").mapInArrow(count, kind).groupBy("segment").applyInArrow(add, kind).collect()
    segments = {r["segment"]: bytes(r["counts"]) for r in found}
    return sum(r["n"] for r in found), np.frombuffer(b"".join(segments.get(k, bytes(4 * part)) for k in range(SEGMENTS)), "<u4")


class Weights:
    """TF-IDF weights: n texts, and the shingles (in order) that more than a share rare of them have, with their counts.

    maybe: a bit a counter of the count-min row, not set where all shingles of the counter are rare.
    """

    def __init__(self, n: int, rare: float, ids: np.ndarray, counts: np.ndarray, maybe: np.ndarray | None = None):
        self.n, self.rare, self.ids, self.counts = n, rare, ids, counts
        self.maybe = None if maybe is None else np.unpackbits(maybe).view(bool)

    def idf(self, ids: np.ndarray) -> np.ndarray:
        out = np.full(len(ids), 2.0)
        at = np.arange(len(ids)) if self.maybe is None else np.flatnonzero(self.maybe[(ids & _U(len(self.maybe) - 1)).astype(np.int64)])
        if len(self.ids):
            place = np.searchsorted(self.ids, ids[at])
            place[place == len(self.ids)] = 0
            known = self.ids[place] == ids[at]
            share = np.maximum(self.counts[place[known]] / self.n, self.rare)
            out[at[known]] = 1 + np.log(share) / math.log(self.rare)
        return out

    def of(self, ids: np.ndarray, tf: np.ndarray) -> np.ndarray:
        return (self.idf(ids) * (1 + np.log(tf))).astype(np.float32)


def frequent_shingles(docs: DataFrame) -> tuple:
    """What Weights takes, for the texts of docs (__text): exact counts of all shingles above the share."""
    n, row = _sketch(docs)
    rare = max(RARE, float(row.sum(dtype=np.float64)) / max(n, 1) / FREQUENT)
    rare = min(rare, 0.5)
    maybe = np.packbits(row > rare * n)
    shared = docs.sparkSession.sparkContext.broadcast(maybe)  # WIDTH bits

    def count(batches):
        may, held, size = np.unpackbits(shared.value).view(bool), [], 0

        def sent():
            ids, counts = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_pydict({"id": pa.array(ids.view(np.int64)), "n": pa.array(counts)})

        for batch in batches:
            data, offsets = utf8(batch["__text"])
            for i, j in slices(offsets):
                ids = shingles(Words(data, offsets, i, j))[1]
                held.append(ids[may[(ids & _U(WIDTH - 1)).astype(np.int64)]])
                size += len(held[-1])
                if size > GATHER:
                    yield sent()
                    held, size = [], 0
        if size:
            yield sent()

    counted = docs.select("__text").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    found = counted.where(F.col("n") > rare * n).toArrow()  # fewer than 1 / rare times the shingles of an average text
    ids = found["id"].to_numpy().astype(np.uint64)
    order = np.argsort(ids)
    return n, rare, ids[order], found["n"].to_numpy()[order].astype(np.float32 if n < 1 << 24 else np.float64), maybe


def samples(row: np.ndarray, ids: np.ndarray, weights: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows that have shingles, and count consistent weighted samples of each as 32-bit names (rows x count)."""
    first = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, np.int64)
    out = np.zeros((len(first), count), np.uint32)
    log_s = np.log(weights)
    mixed = mix(ids.copy())
    best = np.empty(len(ids), np.uint64)
    for k in range(count):
        salt = _U((k * 2 + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        for a in range(0, len(ids), _STEP):
            part = slice(a, a + _STEP)
            x = mix(mixed[part] + salt)
            y = mix(x ^ _U(0xA24BAED4963EE407))
            scale = np.float32(2.0**-21)
            u1 = ((x & _U(0x1FFFFF)).astype(np.float32) + np.float32(0.5)) * scale
            u2 = ((x >> _U(21) & _U(0x1FFFFF)).astype(np.float32) + np.float32(0.5)) * scale
            beta = (x >> _U(42) & _U(0x1FFFFF)).astype(np.float32) * scale
            r = -np.log(u1 * u2)
            u1 = ((y & _U(0x1FFFFF)).astype(np.float32) + np.float32(0.5)) * scale
            u2 = ((y >> _U(21) & _U(0x1FFFFF)).astype(np.float32) + np.float32(0.5)) * scale
            c = -np.log(u1 * u2)
            t = np.floor(log_s[part] / r + beta)
            log_a = np.log(c) - r * (t - beta + 1)
            bits = log_a.view(np.uint32)
            order = bits ^ np.where(bits >> np.uint32(31), np.uint32(0xFFFFFFFF), np.uint32(0x80000000))
            name = (y >> _U(32)).astype(np.uint32) ^ (t.astype(np.int32).view(np.uint32) * np.uint32(0x9E3779B1))
            best[part] = order.astype(np.uint64) << _U(32) | name
        if len(first):
            out[:, k] = np.minimum.reduceat(best, first).astype(np.uint32)
    return row[first], out


def digests(row: np.ndarray, ids: np.ndarray, tf: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that tell a row's vector of shingles and counts."""
    one, two = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    x = mix(ids + tf.astype(np.uint64) * _U(0xD6E8FEB86659FD93))
    np.add.at(one, row, x)
    np.add.at(two, row, mix(x ^ _U(0x5851F42D4C957F2D)))
    return one.view(np.int64), two.view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray, float], b: tuple[np.ndarray, np.ndarray, float]) -> float:
    """Weighted Jaccard similarity of two vectors (ids in order, weights, sum of weights)."""
    if len(a[0]) > len(b[0]):
        a, b = b, a
    at = np.searchsorted(b[0], a[0])
    at[at == len(b[0])] = 0
    same = b[0][at] == a[0]
    shared = float(np.minimum(a[1][same], b[1][at[same]]).sum(dtype=np.float64))
    return shared / (a[2] + b[2] - shared)


class _Sets:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        self.up[max(x, y)] = min(x, y)


def prefix(vector: tuple[np.ndarray, np.ndarray, float], known: np.ndarray, counts: np.ndarray, threshold: float) -> np.ndarray:
    """The first shingles of a vector that hold 1 - threshold of its weight, in the order of their counts (0 if not known) and ids.

    Two vectors as similar as threshold share one of them: else all they share is in the rest of the one whose first shingles
    end earlier, and that weighs less than threshold of it."""
    ids, weights, total = vector
    place = np.searchsorted(known, ids) if len(known) else np.zeros(len(ids), np.int64)
    count = np.zeros(len(ids), np.int64)
    if len(known):
        place[place == len(known)] = 0
        hit = known[place] == ids
        count[hit] = counts[place[hit]]
    order = np.argsort(count, kind="stable")
    before = np.cumsum(weights[order], dtype=np.float64) - weights[order]
    return ids[order[before <= (1 - threshold) * total * (1 + 1e-5)]]


def linked(vectors: list, bands: np.ndarray, side: np.ndarray, across: bool, threshold: float, label: list | None = None, firsts: list | None = None) -> list[tuple[int, int]]:
    """Links that connect what all links of similar pairs with a shared band connect.

    Pairs of two members of side 1 do not count; with across only pairs of both sides do. What has one label is connected already; pairs
    whose firsts (sets) share nothing are not similar.
    """
    sets, links, failed = _Sets(len(vectors)), [], set()
    if label is not None:
        first: dict = {}
        for x, name in enumerate(label):
            if first.setdefault(name, x) != x:
                sets.join(sets.find(first[name]), sets.find(x))
    for band in range(bands.shape[1]):
        order = np.argsort(bands[:, band], kind="stable")
        values = bands[order, band]
        for bucket in np.split(order, np.flatnonzero(values[1:] != values[:-1]) + 1):
            members = bucket.tolist()
            if len(members) < 2 or len({sets.find(x) for x in members}) == 1:
                continue
            for p, x in enumerate(members):
                new = False
                for y in members[p + 1 :]:
                    if (side[x] and side[y]) or (across and side[x] == side[y]):
                        continue
                    rx, ry = sets.find(x), sets.find(y)
                    if rx == ry or (x, y) in failed:
                        continue
                    small, large = sorted((vectors[x][2], vectors[y][2]))
                    if small >= threshold * large * (1 - 1e-6) and (firsts is None or not firsts[x].isdisjoint(firsts[y])) and similarity(vectors[x], vectors[y]) >= threshold:
                        sets.join(rx, ry)
                        links.append((x, y))
                        new = True
                    else:
                        failed.add((x, y))
                if new and len({sets.find(x) for x in members}) == 1:
                    break
    return links


_FOUND = "kind int, a long, b long, root long"
#: Kinds of rows that verification gives: a link of two nodes, and a node (a) with a shingle of its prefix (b).
LINK, PREFIX = 0, 1


def _verifier(weights, threshold: float, across: bool):
    """The function that verifies a task's texts, group by group (root, low, high)."""

    def verify(table: pa.Table) -> pa.Table:
        weigh = Weights(*weights.value)
        data, offsets = utf8(table["__text"])
        vectors: list = []
        for i, j in slices(offsets):
            row, ids, tf = shingles(Words(data, offsets, i, j))
            w = weigh.of(ids, tf)
            stops = np.searchsorted(row, np.arange(j - i + 1))
            vectors += [(ids[a:b].copy(), w[a:b].copy(), float(w[a:b].sum(dtype=np.float64))) for a, b in zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True)]
        bands = np.array(table["bands"].combine_chunks().flatten()).reshape(-1, BANDS)
        nodes, side, labels, large = (table[c].to_numpy() for c in ("node", "side", "label", "large"))
        keys = np.stack([table[c].to_numpy() for c in ("root", "low", "high")], 1).astype(np.int64)
        order = np.lexsort([nodes, side, *keys.T[::-1]])
        keys = keys[order]
        links: list[tuple] = []
        heads: list[tuple] = []
        for group in np.split(order, np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1):
            seen, members = set(), []
            for k in group.tolist():  # rows that repeat stand for one node; a hub is no guest in its own block
                name = (nodes[k], side[k]) if across else nodes[k]
                if name not in seen:
                    seen.add(name)
                    members.append(k)
            root, some = int(table["root"][group[0]].as_py()), [vectors[k] for k in members]
            firsts = None
            if len(members) > 8:
                of = [v for v, k in zip(some, members, strict=True) if side[k]] or some if large[members[0]] and not across else some
                known, counts = np.unique(np.concatenate([v[0] for v in of]), return_counts=True)
                known, counts = known[counts > 1], counts[counts > 1]
                firsts = [prefix(v, known, counts, threshold) for v in some]
            if len(members) > 1:
                names = [labels[k] for k in members] if across else None
                shared = None if firsts is None else [frozenset(f.tolist()) for f in firsts]
                found = linked(some, bands[members], side[members], across, threshold, names, shared)
                links += [(nodes[members[x]], nodes[members[y]], root) for x, y in found]
            if large[members[0]] and not across:
                of = [vectors[k] for k in group.tolist() if side[k]]
                known, counts = np.unique(np.concatenate([v[0] for v in of] or [np.zeros(0, np.uint64)]), return_counts=True)
                for k, v in zip(members, some, strict=True):
                    if not side[k]:
                        heads.append((nodes[k], prefix(v, known, counts, threshold).view(np.int64), root))
        sizes = [len(x) for _, x, _ in heads]
        a = np.concatenate([np.array([x[0] for x in links], np.int64), np.repeat(np.array([x[0] for x in heads], np.int64), sizes)])
        b = np.concatenate([np.array([x[1] for x in links], np.int64), *(x for _, x, _ in heads)])
        of = np.concatenate([np.array([x[2] for x in links], np.int64), np.repeat(np.array([x[2] for x in heads], np.int64), sizes)])
        kind = np.repeat(np.array([LINK, PREFIX], np.int32), [len(links), sum(sizes)])
        return pa.table({"kind": kind, "a": a, "b": b, "root": of})

    return verify


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """A row a row of docs: its id (under its name) and class_id, the smallest id of its group. Runs jobs when it is called."""
    found = _grouped(docs.select(F.col(f"`{key}`").cast("long").alias("__key"), F.col(f"`{text}`").cast("string").alias("__text")), threshold)
    return found.select(F.col("key").alias(key), "class_id")


def _grouped(light: DataFrame, threshold: float, more: tuple[str, ...] = ()) -> DataFrame:
    """key, class_id and group of each row of light (__key, __text): group tells groups apart where ids repeat, and is null where a
    row without words is a group of its own. Also more, long columns of light."""
    spark = light.sparkSession
    # the id and a hash of the text tell a row to fetch: neither a null id nor one that many rows share is a hot key
    light = spread(light).select("__key", "__text", *more, F.xxhash64("__text").alias("__hash"))
    weights = spark.sparkContext.broadcast(frequent_shingles(light))  # at most FREQUENT numbers twice, and WIDTH bits

    def sign(batches):
        weigh = Weights(*weights.value)
        for batch in batches:
            data, offsets = utf8(batch["__text"])
            for i, j in slices(offsets):
                words = Words(data, offsets, i, j)
                row, ids, tf = shingles(words)
                d1, d2 = digests(row, ids, tf, j - i)
                has, found = samples(row, ids, weigh.of(ids, tf), BANDS * ROWS)
                bands = np.zeros((len(has), BANDS), np.uint64)
                for k in range(ROWS):
                    bands = mix(bands ^ found[:, k::ROWS])
                at = np.zeros(j - i + 1, np.int32)
                at[has + 1] = BANDS
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": batch["__key"][i:j],
                        **{c: batch[c][i:j] for c in more},
                        "hash": batch["__hash"][i:j],
                        "d1": pa.array(d1),
                        "d2": pa.array(d2),
                        "size": pa.array(np.diff(offsets[i : j + 1])),
                        "bands": pa.ListArray.from_arrays(pa.array(np.cumsum(at, dtype=np.int32)), pa.array(bands.view(np.int64).ravel())),
                    }
                )

    signed = stash(light.mapInArrow(sign, ", ".join(["key long", *(f"{c} long" for c in more), "hash long, d1 long, d2 long, size long, bands array<long>"])))
    release(spark)
    # a class of equal vectors: one row stands for it, with bands and a node number of its own
    first = F.min(F.struct("key", "hash", "size")).alias("first")
    classes = signed.where(F.size("bands") > 0).groupBy("d1", "d2").agg(F.min("key").alias("least"), first, F.min("bands").alias("bands"))
    classes = stash(classes.select("d1", "d2", "least", F.col("first.key").alias("key"), F.col("first.hash").alias("hash"), F.col("first.size").alias("size"), "bands", F.xxhash64("d1", "d2").alias("node")))
    buckets = classes.select("node", F.posexplode("bands").alias("band", "value"))
    shared = buckets.groupBy("band", "value").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1").drop("n")
    stars = buckets.join(shared, ["band", "value"]).where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    clusters = stash(components(stars))
    # as many rows as there are clusters over a block
    large = stash(clusters.groupBy("root").agg(F.count("*").alias("members")).where(F.col("members") > BLOCK))
    wanted = stash(clusters.join(large, "root", "left").join(classes.select("node", "key", "hash", "size", "bands"), "node"))
    total = wanted.agg(F.sum("size")).first()[0] or 0
    bins = max(64, -(-total // BIN_BYTES))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_BYTES))

    def fetched(rows: DataFrame) -> DataFrame:
        texts = light.select("__key", "__hash", "__text")
        return texts.join(rows, F.col("__key").eqNullSafe(F.col("key")) & (F.col("__hash") == F.col("hash"))).drop("__key", "__hash", "key", "hash", "size")

    parts = F.ceil(F.col("members") / F.lit(float(BLOCK))).cast("int")
    mine = F.pmod(F.xxhash64("node", F.lit(7)), F.coalesce(parts, F.lit(1))).cast("int")
    is_hub = F.coalesce(F.pmod(F.xxhash64("node", F.lit(9)), F.col("members")) < HUBS, F.lit(False))
    seats = F.array(F.struct(mine.alias("low"), F.lit(0).alias("side")))
    seats = F.when(is_hub, F.concat(seats, F.transform(F.sequence(F.lit(0), parts - 1), lambda b: F.struct(b.alias("low"), F.lit(1).alias("side"))))).otherwise(seats)
    placed = fetched(wanted).withColumn("seat", F.explode(seats)).select("node", "root", "bands", "__text", "seat.low", "seat.side", F.col("members").isNotNull().alias("large"))
    placed = placed.withColumn("high", F.lit(0)).withColumn("label", F.col("node"))
    work = F.when(F.col("large"), F.xxhash64("root", "low")).otherwise(F.pmod(F.xxhash64("root"), F.lit(bins)))
    found = stash(placed.withColumn("work", work).repartition(tasks, "work").groupBy("work").applyInArrow(_verifier(weights, threshold, False), _FOUND))
    release(spark)
    links = found.where(F.col("kind") == LINK).select("a", "b")
    if not large.isEmpty():
        links = links.unionByName(_across(spark, found, stash(components(links)), wanted, fetched, weights, threshold))
    groups = stash(components(links))
    least = stash(groups.join(classes.select("node", "least"), "node").groupBy("root").agg(F.min("least").alias("least")))
    named = groups.join(least, "root").select("node", "root", "least")
    whole = classes.select("d1", "d2", "node", F.col("least").alias("own")).join(named, "node", "left")
    whole = stash(whole.select("d1", "d2", F.when(F.col("root").isNotNull(), F.col("least")).otherwise(F.col("own")).alias("class"), F.coalesce("root", "node").alias("group")))
    discard(clusters, large, wanted, found, groups, least)
    rows = signed.select("key", *more, "d1", "d2", (F.size("bands") > 0).alias("some"))
    joined = rows.join(whole, ["d1", "d2"], "left")
    return joined.select("key", *more, F.when(F.col("some"), F.col("class")).otherwise(F.col("key")).alias("class_id"), F.when(F.col("some"), F.col("group")).alias("group"))


def _across(spark, found: DataFrame, linked_: DataFrame, wanted: DataFrame, fetched, weights, threshold: float) -> DataFrame:
    """Links (a, b) of similar classes in different blocks of a cluster that linked_ (node, root) does not connect."""
    heads = found.where(F.col("kind") == PREFIX).select(F.col("a").alias("node"), F.col("b").alias("shingle"), F.col("root").alias("cluster"))
    heads = stash(heads.join(linked_, "node", "left").select("node", "shingle", "cluster", F.coalesce("root", "node").alias("label")))
    # prefixes that more than one linked part has
    met = stash(heads.groupBy("cluster", "shingle").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").drop("high"))
    again = heads.join(met, ["cluster", "shingle"]).select("node", "label", "low")
    parts = stash(components(again.where("label <> low").select(F.col("label").alias("a"), F.col("low").alias("b"))))
    nodes = again.select("node", "label").distinct().join(parts.select(F.col("node").alias("label"), F.col("root").alias("part")), "label")
    nodes = stash(nodes.select("node", "label", "part"))
    sizes = nodes.groupBy("part", "label").agg(F.count("*").alias("n"))
    # a row a part: its size and its largest linked piece
    most = stash(sizes.groupBy("part").agg(F.sum("n").alias("n"), F.max(F.struct("n", "label")).alias("most")).select("part", "n", F.col("most.label").alias("main"), (F.col("n") - F.col("most.n")).alias("rest")))
    blocks = lambda n: F.ceil(F.col(n) / F.lit(float(BLOCK))).cast("int")
    block = lambda n: F.pmod(F.xxhash64("node", F.lit(11)), blocks(n)).cast("int")
    rows = nodes.join(most, "part").join(wanted.select("node", "key", "hash", "size", "bands"), "node")
    every = F.transform(F.sequence(F.lit(0), blocks("rest") - 1), lambda b: F.struct(b.alias("low"), block("n").alias("high"), F.lit(1).alias("side")))
    rest = F.transform(F.sequence(F.lit(0), blocks("n") - 1), lambda b: F.struct(block("rest").alias("low"), b.alias("high"), F.lit(0).alias("side")))
    seats = F.when(F.col("label") == F.col("main"), every).otherwise(F.concat(every, rest))
    rows = stash(rows.withColumn("seat", F.explode(seats)).select("node", "key", "hash", "size", "bands", "label", F.col("part").alias("root"), "seat.*"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_BYTES))
    placed = fetched(rows).withColumn("large", F.lit(True)).withColumn("work", F.xxhash64("root", "low", "high"))
    links = stash(placed.repartition(tasks, "work").groupBy("work").applyInArrow(_verifier(weights, threshold, True), _FOUND))
    discard(heads, met, parts, nodes, most, rows)
    release(spark)
    return links.select("a", "b")


def keep_first(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of docs a near-duplicate group, the first by id (null first), hash of the row and place in its file; rows without words all stay.

    Rows are told apart by their places, so ids may repeat or be null and no join meets a key that many rows share."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    placed, place = identified(docs), ("__file", "__row")
    light = placed.select(F.col(f"`{key}`").cast("long").alias("__key"), F.col(f"`{text}`").cast("string").alias("__text"), *place, row_hash(docs).alias("__whole"))
    found = stash(_grouped(light, THRESHOLD, (*place, "__whole")))
    first = found.where(F.col("group").isNotNull()).groupBy("group").agg(F.min(F.struct("key", "__whole", *place)).alias("first")).select("first.__file", "first.__row")
    kept = first.unionByName(found.where(F.col("group").isNull()).select(*place))
    return placed.join(kept, list(place), "left_semi").select(*columns)

"""Similarity digests of documents from improbable features.

A feature is FEATURE consecutive bytes of the UTF-8 text. Its entropy tells how probable it is: windows of prose crowd around
TYPICAL bits, and a feature ranks the rarer the further its entropy lies from there; windows under LEAST bits (runs, padding) do not
count. In every stretch of STRETCH features the rarest, leftmost first, gets a point; features with POINTS or more are
selected. They go, each once, into a chain of Bloom filters of BITS bits with HASHES bits a feature, the next filter beginning
after PER_FILTER features. The digest is the chain.

Likeness: of each filter of the shorter chain the best normalised overlap with a filter of the other, averaged. Overlap is
normalised between what chance would share, plus a margin, and all it could share: 0 for unrelated texts, 1 for equal ones.

A digest depends on its text alone: the ranks are a rule, not learned.

A text under SHORT_TEXT bytes has so few windows that the rarest of them are all of them: there each window of SHORT_FEATURE bytes is
selected, whatever its rank.

Defined results: null counts as empty; a text under SHORT_FEATURE bytes or without any feature has one, all its bytes; an empty text has the digest of that, so empty texts are alike; rows that repeat have equal digests; the document after a
row that repeats is the next row in order of id and a hash of the text; null ids come first; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import byte_values, prefix_sums, range_hashes, slices, utf8
from .columns import named, plain
from .storage import text_bytes
from .units import ranges

FEATURE = 32
STRETCH = 32
POINTS = 8
TYPICAL = 3.6
LEAST = 2.0
BITS = 2048
HASHES = 5
PER_FILTER = 160
#: A text under SHORT_TEXT bytes has few windows: each of its SHORT_FEATURE bytes is a feature, too.
SHORT_TEXT = 160
SHORT_FEATURE = 6
MARGIN = 0.3
#: Bytes of text in a range, and the most ranges (beyond them ranges grow), whose bounds are broadcast.
PART_BYTES = 16 << 20
MOST_PARTS = 1 << 20

_NONE = np.int64(1) << 62
_U = np.uint64


def _n_log_n() -> np.ndarray:
    n = np.arange(FEATURE + 2, dtype=np.float64)
    return np.round(np.where(n > 0, n * np.log2(np.maximum(n, 1)), 0) * 65536).astype(np.int64)


def ranks(data: np.ndarray) -> np.ndarray:
    """For each start of a window in data (0xFF where there is no text, FEATURE of them in front) its rank, 0 the rarest; _NONE where it does not count."""
    n = len(data)
    order = np.argsort(data, kind="stable").astype(np.int64)
    keys = data[order].astype(np.int64) * (2 * n) + order
    here = np.arange(n)
    ahead, behind = np.empty(n, np.int64), np.empty(n, np.int64)
    # how often a byte's value occurs in the window that it starts, and in the one that it ends
    ahead[order] = np.searchsorted(keys, keys + FEATURE) - here
    behind[order] = here - np.searchsorted(keys, keys - FEATURE + 1) + 1
    table = _n_log_n()
    windows = n - FEATURE + 1
    change = np.empty(windows, np.int64)
    change[0] = table[FEATURE]
    out, come = np.minimum(ahead[: windows - 1], FEATURE), np.minimum(behind[FEATURE:], FEATURE)
    change[1:] = table[out - 1] - table[out] + table[come] - table[come - 1]
    # (bytes that leave and come with the same value cancel out: both counts hold the byte itself)
    entropy = np.log2(FEATURE) - np.cumsum(change) / (65536.0 * FEATURE)
    rank = 1000 - np.minimum(np.round(np.abs(entropy - TYPICAL) * 400), 1000).astype(np.int64)
    blank = np.concatenate([[0], np.cumsum(data == 0xFF)])
    rank[(blank[FEATURE:] - blank[:windows] > 0) | (entropy < LEAST)] = _NONE
    return rank


def _rarest(rank: np.ndarray) -> np.ndarray:
    """Points of each feature: in how many stretches it is the rarest, leftmost first."""
    n = len(rank)
    least = np.where(rank == _NONE, _NONE, rank << 32 | np.arange(n))
    width = 1
    while width < STRETCH:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    return np.bincount(least[least != _NONE] & 0xFFFFFFFF, minlength=n)


def digests(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The chain of filters (filters x BITS / 8 bytes) of each text."""
    found: list[np.ndarray] = []
    for i, j in slices(offsets):
        lengths = np.diff(offsets[i : j + 1])
        begins = np.cumsum(lengths + 2 * FEATURE) - lengths - FEATURE
        padded = np.full(int(lengths.sum()) + 2 * FEATURE * (j - i), 0xFF, np.uint8)
        row = np.repeat(np.arange(j - i), lengths)
        place = np.arange(int(lengths.sum())) + (row * 2 + 1) * FEATURE
        padded[place] = data[offsets[i] : offsets[j]]
        sums = prefix_sums(byte_values()[padded])
        at = np.flatnonzero(_rarest(ranks(padded)) >= POINTS)
        owner = np.searchsorted(begins, at, "right") - 1
        hashes = range_hashes(sums, at, at + FEATURE)
        few = np.flatnonzero((lengths < SHORT_TEXT) & (lengths >= SHORT_FEATURE))
        starts, ends = begins[few], begins[few] + lengths[few] - SHORT_FEATURE + 1
        small, _ = ranges(np.arange(len(padded)), starts, ends - starts)
        small_owner = np.repeat(few, ends - starts)
        bare = np.setdiff1d(np.arange(j - i), np.concatenate([owner, few]))
        hashes = np.concatenate([hashes, range_hashes(sums, small, small + SHORT_FEATURE), range_hashes(sums, begins[bare], begins[bare] + lengths[bare])])
        owner = np.concatenate([owner, small_owner, bare])
        place = np.arange(len(owner))
        order = np.lexsort([place, hashes, owner])
        first = np.ones(len(order), bool)
        first[1:] = (owner[order][1:] != owner[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
        keep = np.sort(order[first])
        keep = keep[np.argsort(owner[keep], kind="stable")]
        owner, hashes = owner[keep], hashes[keep]
        counts = np.bincount(owner, minlength=j - i)
        ordinal = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        chain = -(-counts // PER_FILTER)
        base = np.cumsum(chain) - chain
        filters = np.zeros((int(chain.sum()), BITS), bool)
        of = base[owner] + ordinal // PER_FILTER
        for h in range(HASHES):
            filters[of, (hashes >> _U(11 * h) & _U(BITS - 1)).astype(np.int64)] = True
        packed = np.packbits(filters, axis=1)
        found += [packed[b : b + c] for b, c in zip(base.tolist(), chain.tolist(), strict=True)]
    return found


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Normalised bit overlap of two digests, 0 to 1."""
    if len(a) > len(b):
        a, b = b, a
    if a.shape == b.shape and (a == b).all():
        return 1.0
    x, y = a.view(np.uint64), b.view(np.uint64)
    n, m = np.bitwise_count(x).sum(1, dtype=np.int64), np.bitwise_count(y).sum(1, dtype=np.int64)
    total = 0.0
    for k in range(len(x)):
        shared = np.bitwise_count(x[k] & y).sum(1, dtype=np.int64)
        most = np.minimum(n[k], m)
        chance = n[k] * m / BITS
        cutoff = chance + MARGIN * (most - chance)
        with np.errstate(divide="ignore", invalid="ignore"):
            score = np.where(most > cutoff, (shared - cutoff) / (most - cutoff), (shared == most).astype(float))
        total += float(np.clip(score, 0.0, 1.0).max())
    return total / len(x)


def text_of(digest: np.ndarray) -> str:
    return base64.b64encode(digest.tobytes()).decode()


def fingerprints(docs: DataFrame, text: str = "text", output: str = "fingerprint") -> DataFrame:
    """docs with the digest of each text, in base64."""
    from pyspark.sql import types as T

    docs = plain(docs)
    kept = [c for c in docs.columns if c != output]
    schema = T.StructType([*(f for f in docs.schema.fields if f.name != output), T.StructField(output, T.StringType())])

    def run(batches):
        for batch in batches:
            found = digests(*utf8(batch[text].cast(pa.string())))
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), pa.array(map(text_of, found), pa.string())], names=[*kept, output])

    return named(docs.mapInArrow(run, schema))


def ranges_before(ids: np.ndarray, ties: np.ndarray, rows: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """How many of the bounds (ids, ties), in order, are no larger than each row."""
    low, high = np.searchsorted(ids, rows, "left"), np.searchsorted(ids, rows, "right")
    out = low.copy()
    some = np.flatnonzero(high > low)
    one = some[high[some] == low[some] + 1]
    out[one] += ties[low[one]] <= tie[one]
    more = some[high[some] > low[some] + 1]
    for k in np.unique(low[more]).tolist():  # ids with several bounds
        at = more[low[more] == k]
        out[at] += np.searchsorted(ties[k : high[at[0]]], tie[at], "right")
    return out


_RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_with_edits(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Digests of every text and of its edited text, and how alike it is to that and to the next document.

    Edited: the last floor(n / 4) code points are replaced by the first as many (or all) of the next document in ascending id order.

    Documents are dealt to ranges of ids (and, where ids repeat or are null, of hashes of their texts); a range also gets the first
    document of the next one, the last range that of the first. So the texts are shuffled once and no task holds more than a range. Where
    ranges begin is a row a range, MOST_PARTS at most, no more than Spark itself keeps of a range partitioning.
    """
    spark = docs.sparkSession
    light = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("__text"))
    light = light.withColumn("__tie", F.xxhash64("__text"))
    parts = min(MOST_PARTS, max(spark.sparkContext.defaultParallelism, -(-text_bytes(docs, f"`{text}`") // PART_BYTES)))

    def least(batches):
        done = False
        for batch in batches:
            if not done and len(batch):
                done = True
                yield batch.slice(0, 1)

    order = ["doc_id", "__tie"]
    ranged = light.select(*order).repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(least, "doc_id long, __tie long").distinct()
    firsts = ranged.toArrow()
    ids, ties = firsts["doc_id"].fill_null(-(2**63)).to_numpy(), firsts["__tie"].to_numpy()
    place = np.lexsort([ties, ids])
    bounds = spark.sparkContext.broadcast((ids[place], ties[place]))
    count = max(1, len(ids))

    def deal(batches):
        ids, ties = bounds.value
        for batch in batches:
            rows, tie = batch["doc_id"].fill_null(-(2**63)).to_numpy(zero_copy_only=False), batch["__tie"].to_numpy()
            after = ranges_before(ids, ties, rows, tie)
            part = np.maximum(after - 1, 0)
            edge = np.flatnonzero((ids[part] == rows) & (ties[part] == tie))  # these come first in their range
            both = batch.take(pa.array(np.concatenate([np.arange(len(rows)), edge])))
            where = np.concatenate([part, (part[edge] - 1) % count])
            turn = np.concatenate([np.zeros(len(rows), np.int32), np.ones(len(edge), np.int32)])
            yield pa.RecordBatch.from_arrays([*both.columns, pa.array(where.astype(np.int32)), pa.array(turn)], names=["doc_id", "__text", "__tie", "__part", "__after"])

    dealt = light.mapInArrow(deal, "doc_id long, __text string, __tie long, __part int, __after int")
    ordered = dealt.repartitionById(count, F.col("__part")).sortWithinPartitions("__after", "doc_id", "__tie")

    def run(batches):
        last = None  # the latest row whose next is not known: id, text, digest
        done = False
        for batch in batches:
            if done:
                continue
            data, offsets = utf8(batch["__text"])
            ids, after = batch["doc_id"].to_pylist(), batch["__after"].to_numpy()
            for i, j in slices(offsets, 1 << 20):
                if done:
                    break
                stop = j if not after[i:j].any() else i + int(np.argmax(after[i:j])) + 1  # of the rows after, the first is all that counts
                done = stop < j or bool(after[stop - 1])
                part = data[offsets[i] : offsets[stop]]
                bounds = offsets[i : stop + 1] - offsets[i]
                raw = part.tobytes()
                texts = [raw[a:b].decode() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                found = digests(part, bounds)
                rows = [*([last] if last else []), *zip(ids[i:stop], texts, found, strict=True)]
                last = rows[-1]
                if len(rows) > 1:
                    yield from _pairs(rows)

    return ordered.mapInArrow(run, _RESULT)


def _pairs(rows: list):
    edits = []
    for (_, text, _), (_, following, _) in zip(rows[:-1], rows[1:], strict=True):
        cut = len(text) // 4
        edits.append((text[: len(text) - cut] + following[:cut]).encode())
    offsets = np.cumsum([0, *map(len, edits)])
    edited = digests(np.frombuffer(b"".join(edits), np.uint8), offsets)
    yield pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array([r[0] for r in rows[:-1]], pa.int64()),
            "n_chars": pa.array([len(r[1]) for r in rows[:-1]], pa.int64()),
            "edited_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in edits]),
            "fingerprint": pa.array([text_of(r[2]) for r in rows[:-1]]),
            "edited_fingerprint": pa.array(list(map(text_of, edited))),
            "near_edited": pa.array([likeness(r[2], x) for r, x in zip(rows[:-1], edited, strict=True)]),
            "near_next": pa.array([likeness(r[2], s[2]) for r, s in zip(rows[:-1], rows[1:], strict=True)]),
        }
    )


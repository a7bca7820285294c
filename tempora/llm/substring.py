"""Substring deduplication with difference-cover anchors.

A window is WIDTH consecutive words of one text. Every word covered by a window whose word sequence also starts
anywhere else (same text included) is removed.

Not every window is hashed. Positions p of a text with p mod PERIOD in COVER start an anchor, a hash of ANCHOR words.
COVER is a difference cover: for any two positions i and j some shift d < PERIOD puts both i + d and j + d on the
cover. As PERIOD - 1 + ANCHOR = WIDTH, two equal windows hold two equal, equally placed anchors. So

1. anchors are counted; a chunk of texts learns which of its anchors occur twice or more;
2. only the windows around those anchors (the anchor extended to WIDTH words) are hashed and counted;
3. the words under the windows that occur twice or more go.

Texts are never shuffled: every step reads them where they lie, with the number of their chunk (from their places in the files they are
read from, or written for it). A chunk sends
the sorted hashes it holds (each at most twice) to ranges of hashes, as one message a range that it has any of, so messages
are never more than hashes; a range tells each chunk which of its hashes repeat, and the answers of a chunk are a file in the
shared folder that its readers open. A hash that occurs in a third of all texts is two entries a chunk, so no task
gathers a hot group. Ranges and the tasks that count them grow with the input. Hashes have 64 bits.

Defined results: null and empty texts have no words; texts under WIDTH words stay as they are; rows that repeat are
copies of each other, so their windows repeat; ids do not matter and may be null or repeat; a column of the
input named like an added one is replaced; an empty table gives an empty table. A text of any length is one row of a task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import SLICE_BYTES, Words, prefix_sums, slices, utf8, window_hashes
from .columns import named, plain, plain_name
from .storage import exists, identified, read_file, reads_files, release, shared_folder, spread, stash, text_bytes, write_file

WIDTH = 35
PERIOD = 21
#: A perfect difference set modulo 21.
COVER = (3, 6, 7, 12, 14)
ANCHOR = WIDTH - PERIOD + 1
#: Bytes of text whose hashes a task holds and sends together, and that a range of hashes stands for.
CHUNK_BYTES = 32 << 20
LEAST_RANGES = 64
#: Rows of a file in a chunk (a power of two).
CHUNK_ROWS = 4096
#: Bytes of text a record batch of results holds.
OUT_BYTES = 4 << 20

_SENT = "range int, chunk long, hashes binary"
_U = np.uint64


def _blobs(hashes: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """hashes[cuts[k] : cuts[k + 1]] as binary values, without a step a value."""
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * 8).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(hashes))])


def sent(hashes: np.ndarray, chunk: int, ranges: int) -> pa.RecordBatch:
    """A message for each range of hashes that has any: the hashes in order, each at most twice."""
    hashes = np.sort(hashes)
    keep = np.ones(len(hashes), bool)
    keep[2:] = hashes[2:] != hashes[:-2]
    hashes = hashes[keep]
    of = (((hashes >> _U(32)) * _U(ranges)) >> _U(32)).astype(np.int32)
    first = np.flatnonzero(np.diff(of, prepend=-1))
    cuts = np.append(first, len(hashes))
    return pa.RecordBatch.from_arrays([pa.array(of[first]), pa.array(np.full(len(first), chunk)), _blobs(hashes, cuts)], names=["range", "chunk", "hashes"])


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All hashes of a column of messages, and how many each holds."""
    parts = [(np.frombuffer(c.buffers()[1], np.int32)[c.offset : c.offset + len(c) + 1], c.buffers()[2]) for c in column.chunks if len(c)]
    every = [np.frombuffer(b, np.uint8)[o[0] : o[-1]].view(np.uint64) if o[-1] > o[0] else np.zeros(0, np.uint64) for o, b in parts]
    return np.concatenate(every or [np.zeros(0, np.uint64)]), np.concatenate([np.diff(o) // 8 for o, _ in parts] or [np.zeros(0, np.int32)])


def repeated(messages: pa.Table) -> pa.Table:
    """Of a range's messages, to each chunk its hashes that occur twice or more: chunk, hashes."""
    every, sizes = _flat(messages["hashes"])
    order = np.argsort(every, kind="stable")
    ordered = every[order]
    same = ordered[1:] == ordered[:-1]
    twice = np.zeros(len(every), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    counts = np.add.reduceat(np.append(twice, False), np.cumsum(sizes) - sizes).astype(np.int64) * (sizes > 0) if len(sizes) else sizes
    some = np.flatnonzero(counts)
    cuts = np.append(0, np.cumsum(counts[some]))
    return pa.table({"chunk": messages["chunk"].combine_chunks().take(pa.array(some)), "hashes": _blobs(every[twice], cuts)})


def anchors(words: Words, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words that start an anchor, and the anchors' hashes."""
    starts = words.window_starts(ANCHOR)
    place = (starts - words.first[words.row[starts]]) % PERIOD
    on = np.zeros(PERIOD, bool)
    on[list(COVER)] = True
    starts = starts[on[place]]
    return starts, window_hashes(sums, starts, ANCHOR)


def _candidates(words: Words, at: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The starts of windows of WIDTH words that hold one of the anchors."""
    row = words.row[at]
    low = np.maximum(at + ANCHOR - WIDTH, words.first[row])
    change = np.zeros(len(words.starts) + 1, np.int64)
    np.add.at(change, low, 1)
    np.add.at(change, at + 1, -1)
    return starts[np.cumsum(change)[starts] > 0]


def held(sorted_hashes: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of hashes are among the sorted ones."""
    if not len(sorted_hashes):
        return np.zeros(len(hashes), bool)
    at = np.searchsorted(sorted_hashes, hashes)
    at[at == len(sorted_hashes)] = 0
    return sorted_hashes[at] == hashes


class _Answers:
    """The answers about the chunk at hand, from its files."""

    def __init__(self, folder: str):
        self.folder, self.chunk, self.known = folder, None, {}

    def of(self, chunk: int, kind: int) -> np.ndarray:
        if chunk != self.chunk:
            self.chunk, self.known = chunk, {}
        if kind not in self.known:
            path = f"{self.folder}/{kind}-{chunk}"
            self.known[kind] = np.frombuffer(read_file(path), "<u8") if exists(path) else np.zeros(0, np.uint64)
        return self.known[kind]


def _windows(words: Words, chunk: int, answers: _Answers) -> tuple[np.ndarray, np.ndarray]:
    """The starts of the windows around repeated anchors, and the windows' hashes."""
    marks = answers.of(chunk, 1)
    if not len(marks):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    sums = prefix_sums(words.hashes())
    at, hashes = anchors(words, sums)
    at = at[held(marks, hashes)]
    starts = _candidates(words, at, words.window_starts(WIDTH)) if len(at) else at
    return starts, window_hashes(sums, starts, WIDTH)


def _runs(chunks: np.ndarray):
    """Ranges of rows of one chunk each."""
    cuts = np.flatnonzero(np.diff(chunks, prepend=chunks[:1] - 1, append=chunks[-1:] + 1))
    return zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)


def _sender(hashes_of, ranges: int):
    """A task's messages: those of hashes_of(words, chunk), chunk by chunk."""

    def send(batches):
        kept, chunk, size = [], None, 0
        for batch in batches:
            numbers = batch["__chunk"].to_numpy()
            data, offsets = utf8(batch["__text"])
            for a, b in _runs(numbers):
                if kept and (numbers[a] != chunk or size > CHUNK_BYTES):
                    yield sent(np.concatenate(kept), chunk, ranges)
                    kept, size = [], 0
                chunk = int(numbers[a])
                for i, j in slices(offsets[a : b + 1]):
                    found = hashes_of(Words(data, offsets, a + i, a + j), chunk)
                    if len(found):
                        kept.append(found)
                        size += int(offsets[a + j] - offsets[a + i])
        if kept:
            yield sent(np.concatenate(kept), chunk, ranges)

    return send


def _answered(messages: DataFrame, ranges: int, folder: str, kind: int) -> None:
    """Count the messages' hashes by range and write what each chunk has to know."""

    def write(rows: pa.Table) -> pa.Table:
        every = np.unique(_flat(rows["hashes"])[0])
        write_file(f"{folder}/{kind}-{rows['chunk'][0].as_py()}", every.astype("<u8").tobytes())
        return pa.table({"n": pa.array([len(every)])})

    least = int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = min(max(ranges // 2, least), 1 << 20)
    counted = messages.repartition(tasks, "range").groupBy("range").applyInArrow(repeated, "chunk long, hashes binary")
    counted.repartition(tasks, "chunk").groupBy("chunk").applyInArrow(write, "n long").agg(F.sum("n")).first()


def _chunked(docs: DataFrame, text: str) -> DataFrame:
    """docs with __text and __chunk: CHUNK_ROWS consecutive rows of a file, told by their places in it; where docs does not read files,
    consecutive rows of one task with about CHUNK_BYTES of text, written for it."""
    rest = [f for f in docs.schema.fields if f.name != text]
    if spread(docs) is docs and reads_files(docs):
        placed = identified(docs)
        return placed.select(*[F.col(f"`{f.name}`") for f in rest], F.col(f"`{text}`").cast("string").alias("__text"), F.xxhash64("__file", F.shiftright("__row", CHUNK_ROWS.bit_length() - 1)).alias("__chunk"))
    wide = docs.select(*[F.col(f"`{f.name}`") for f in rest], F.col(f"`{text}`").cast("string").alias("__text"))
    schema = T.StructType([*rest, T.StructField("__text", T.StringType()), T.StructField("__chunk", T.LongType())])

    def number(batches):
        from pyspark import TaskContext

        chunk, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            _, offsets = utf8(batch["__text"])
            numbers = np.empty(len(batch), np.int64)
            for i, j in slices(offsets, min(SLICE_BYTES, CHUNK_BYTES)):
                if size >= CHUNK_BYTES:
                    chunk, size = chunk + 1, 0
                numbers[i:j] = chunk
                size += int(offsets[j] - offsets[i])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers)], names=schema.names)

    return stash(spread(wide).mapInArrow(number, schema))


def remove_repeats(docs: DataFrame, text: str = "text", *, keep_text: bool = True, prefix: str = "") -> DataFrame:
    """Rows of docs with n_words, n_removed and, as the text, the kept words joined by one space (unchanged where none is removed).

    With keep_text False the text column is dropped and kept_sha256 tells the digest of the kept words joined by one space. The names
    of added columns begin with the prefix. Runs jobs when it is called.
    """
    spark, docs, text = docs.sparkSession, plain(docs), plain_name(text)
    n_words, n_removed, sha = (prefix + c for c in ("n_words", "n_removed", "kept_sha256"))
    added = [n_words, n_removed] + ([] if keep_text else [sha])
    passed = [f for f in docs.schema.fields if f.name not in added and (keep_text or f.name != text)]
    names = [f.name for f in passed]
    rows = _chunked(docs.select(*[F.col(f"`{n}`") for n in names if n != text], F.col(f"`{text}`")), text)
    ranges = max(LEAST_RANGES, -(-text_bytes(rows, "__text") // CHUNK_BYTES))
    light, folder = rows.select("__chunk", "__text"), shared_folder(spark)

    def first(words: Words, chunk: int) -> np.ndarray:
        return anchors(words, prefix_sums(words.hashes()))[1]

    _answered(light.mapInArrow(_sender(first, ranges), _SENT), ranges, folder, 1)
    release(spark)

    def second(batches):
        answers = _Answers(folder)
        yield from _sender(lambda words, chunk: _windows(words, chunk, answers)[1], ranges)(batches)

    _answered(light.mapInArrow(second, _SENT), ranges, folder, 2)
    release(spark)
    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name == text else f.dataType) for f in passed] + [T.StructField(n, T.StringType() if n == sha else T.LongType()) for n in added])

    def third(batches):
        answers = _Answers(folder)
        for batch in batches:
            numbers = batch["__chunk"].to_numpy()
            data, offsets = utf8(batch["__text"])
            for a, b in _runs(numbers):
                for c, d in slices(offsets[a : b + 1], OUT_BYTES):
                    found = [_kept(Words(data, offsets, a + c + i, a + c + j), int(numbers[a]), answers) for i, j in slices(offsets[a + c : a + d + 1])]
                    part = batch.slice(a + c, d - c)
                    removed = np.concatenate([x[1] for x in found])
                    columns = {n_words: pa.array(np.concatenate([x[0] for x in found])), n_removed: pa.array(removed)}
                    if keep_text:
                        columns[text] = _texts(part["__text"], removed, [x[2:] for x in found])
                    else:
                        columns[sha] = pa.array([y for x in found for y in _digests(*x[2:])], pa.string())
                    yield pa.RecordBatch.from_arrays([columns[n] if n in columns else part[n] for n in schema.names], names=schema.names)

    return named(rows.mapInArrow(third, schema))


def _kept(words: Words, chunk: int, answers: _Answers) -> tuple[np.ndarray, np.ndarray, bytes, list[int]]:
    """n_words and n_removed of each row; the kept words of all rows, a space after each, and where each row's begin."""
    gone = np.zeros(len(words.starts), bool)
    starts, hashes = _windows(words, chunk, answers)
    if len(starts):
        starts = starts[held(answers.of(chunk, 2), hashes)]
        change = np.zeros(len(words.starts) + 1, np.int32)
        np.add.at(change, starts, 1)
        np.add.at(change, starts + WIDTH, -1)
        gone = np.cumsum(change)[:-1] > 0
    removed = np.add.reduceat(np.append(gone, False), words.first[:-1]).astype(np.int64) * (words.counts > 0)
    keep = ~gone
    cover = np.zeros(len(words.data) + 1, np.int8)
    cover[words.starts[keep]] += 1
    cover[words.ends[keep] + 1] -= 1  # the word and the white space after it
    mask = np.cumsum(cover[:-1], dtype=np.int8) > 0
    data = words.data.copy()
    data[words.ends[keep]] = 0x20
    bounds = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=bounds[1:])
    return words.counts, removed, data[mask].tobytes(), bounds[words.row_starts].tolist()


def _digests(raw: bytes, bounds: list[int]) -> list[str]:
    import hashlib

    return [hashlib.sha256(raw[a : max(a, b - 1)]).hexdigest() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _texts(old: pa.Array, removed: np.ndarray, kept: list[tuple[bytes, list[int]]]) -> pa.Array:
    """The old texts where nothing was removed, else the kept words joined by one space."""
    new = [raw[a : max(a, b - 1)] for raw, bounds in kept for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    changed = np.flatnonzero(removed)
    if not len(changed):
        return old
    out = old.to_pylist()
    for k in changed.tolist():
        out[k] = new[k].decode()
    return pa.array(out, pa.string())


#: The same in SQL: every window of every text as a string, which one engine on one machine may do.
ORACLE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
w AS (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d),
k AS (SELECT r, i, x, CASE WHEN count(*) OVER f = {WIDTH} THEN md5(string_agg(x, ' ') OVER f) END AS k FROM w WINDOW f AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND {WIDTH - 1} FOLLOWING)),
n AS (SELECT r, i, x, k IS NOT NULL AND count(*) OVER (PARTITION BY k) > 1 AS again FROM k),
g AS (SELECT r, i, x, bool_or(again) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN {WIDTH - 1} PRECEDING AND CURRENT ROW) AS gone FROM n)
SELECT doc_id, count(x) AS n_words, count(x) FILTER (WHERE gone) AS n_removed, sha256(coalesce(string_agg(x, ' ' ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM d LEFT JOIN g USING (r) GROUP BY r, doc_id
"""

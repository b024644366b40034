"""Removal of long repeated word sequences, found through difference-cover anchors.

Two equal windows of ``window`` words in different documents are found without hashing every window. The
positions whose remainder by ``period`` lies in a difference cover have this property: whatever the two
start positions are, some shift below the period takes both onto cover positions. Both documents therefore
hash the same ``window - period + 1`` words there. Only documents with an anchor that another document also
has go on, and only windows around such anchors are hashed in full to extend the match to exact windows.

Every task folds equal hashes before the shuffle: of a sequence that thousands of its documents hold it
sends one row, so the rows of one hash are at most one for each task (and place in a document), whatever
share of the corpus holds it. No pairs of documents are made.

Document order is the id, an integer; a null id comes after all others. Defined results: a null text has no
words; rows that repeat an id are not smaller than each other, so they keep what only they share; repeated
rows get a row each; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.session import stage

LAST = 2**63 - 1
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # odd, so that their powers can be undone
BATCH_WORDS = 1_000_000
# upto is 0 for an occurrence still to be judged, KNOWN for one that only shows its task judged the rest, else
# the end of a span of words that is judged already
FOUND = "hash long, check int, ord long, text_key long, pos int, upto int"
SPAN = "ord long, text_key long, pos int, upto int"
KNOWN = -1


def difference_cover(period: int) -> list[int]:
    """The smallest set of remainders whose differences take every value modulo ``period``."""
    for size in range(1, period + 1):
        for rest in combinations(range(1, period), size - 1):
            cover = (0, *rest)
            if len({(a - b) % period for a in cover for b in cover}) == period:
                return list(cover)
    raise ValueError("period must be positive")


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def rolling(hashes: np.ndarray, length: int, base: int) -> np.ndarray:
    """A hash of every run of ``length`` words, from prefix sums of a polynomial modulo 2**64."""
    n = len(hashes)
    if n < length:
        return np.empty(0, np.uint64)
    steps = np.full(n, base, np.uint64)
    steps[0] = 1
    undo = np.full(n, pow(base, -1, 2**64), np.uint64)
    undo[0] = 1
    sums = np.concatenate(([np.uint64(0)], np.cumsum(hashes * np.cumprod(steps))))
    out = (sums[length:] - sums[:-length]) * np.cumprod(undo)[:n - length + 1]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD1B54A32D192ED03)
    return out ^ out >> np.uint64(29)


def _batches(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Lists of (ord, text_key, words, ...) of about ``BATCH_WORDS`` words; a longer text is a list of its own."""
    held, size = [], 0
    for row in rows:
        if held and size + len(row[2]) > BATCH_WORDS:
            yield held
            held, size = [], 0
        held.append(row)
        size += len(row[2])
    if held:
        yield held


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Start of each run of equal rows in sorted columns."""
    n = len(columns[0])
    new = np.ones(n, bool)
    if n > 1:
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return np.flatnonzero(new)


def _found_batch(hash_, check, ord_, key, pos, upto) -> pa.RecordBatch:
    columns = [(np.asarray(hash_, np.uint64).view(np.int64), pa.int64()), (check, pa.int32()), (ord_, pa.int64()), (key, pa.int64()),
               (pos, pa.int32()), (upto, pa.int32())]
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in columns], ["hash", "check", "ord", "text_key", "pos", "upto"])


def _spans(ord_: np.ndarray, key: np.ndarray, pos: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of ``length`` at sorted places join into spans: index of each span's first place, and its end."""
    gap = np.ones(len(pos), bool)
    gap[1:] = (ord_[1:] != ord_[:-1]) | (key[1:] != key[:-1]) | (pos[1:] > pos[:-1] + length)
    first = np.flatnonzero(gap)
    return first, pos[np.append(first[1:], len(pos)) - 1] + length


def _fold(ord_, key, pos, hash_, check, length: int, any_other: bool) -> Iterator[pa.RecordBatch]:
    """What a task sends of its occurrences: rows still to be judged, and the spans it can judge itself.

    With ``any_other`` an occurrence counts if any other id has the sequence, else only if a smaller one has.
    """
    order = np.lexsort((pos, key, ord_, check, hash_))
    starts = _runs(hash_[order], check[order])
    sizes = np.diff(np.append(starts, len(order)))
    sorted_ord = ord_[order]
    least, most = sorted_ord[starts], sorted_ord[starts + sizes - 1]
    smaller = sorted_ord > np.repeat(least, sizes)
    judged = np.repeat(least != most, sizes) if any_other else smaller
    # rows of the smallest id speak for the task; where all are judged already, one is enough
    first = np.zeros(len(order), bool)
    first[starts] = True
    send = ~judged | first if any_other else ~smaller
    at = np.sort(order[send])  # in document order, which compresses best
    known = np.zeros(len(order), bool)
    known[order] = judged
    yield _found_batch(hash_[at], check[at], ord_[at], key[at], pos[at], np.where(known[at], KNOWN, 0))
    at = order[judged]
    at = at[np.lexsort((pos[at], key[at], ord_[at]))]
    if len(at):
        begin, end = _spans(ord_[at], key[at], pos[at], length)
        own = at[begin]
        yield _found_batch(ord_[own].astype(np.uint64), np.zeros(len(own)), ord_[own], key[own], pos[own], end)


def _judge(found: DataFrame, length: int, any_other: bool) -> DataFrame:
    """``ord, text_key, pos, upto`` (several rows a document): the spans that count among all tasks' occurrences."""

    def settle(rows: pa.Table) -> pa.RecordBatch:
        hash_, check, ord_, key, pos, upto = (rows.column(c).to_numpy() for c in range(6))
        starts = _runs(hash_, check)
        sizes = np.diff(np.append(starts, len(ord_)))
        least = np.minimum.reduceat(ord_, starts)
        if any_other:
            other = (least != np.maximum.reduceat(ord_, starts)) | (np.minimum.reduceat(upto, starts) == KNOWN)
            yes = np.repeat(other, sizes) & (upto == 0)
        else:
            yes = ord_ > np.repeat(least, sizes)
        at = np.flatnonzero(yes)
        at = at[np.lexsort((pos[at], key[at], ord_[at]))]
        begin, end = _spans(ord_[at], key[at], pos[at], length) if len(at) else (at, at)
        own = at[begin]
        return pa.RecordBatch.from_arrays([pa.array(ord_[own]), pa.array(key[own]), pa.array(pos[own]), pa.array(end, pa.int32())],
                                          ["ord", "text_key", "pos", "upto"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            ready = pc.greater(batch.column(5), 0)
            if passed := batch.filter(ready):
                yield passed.select([2, 3, 4, 5])
            batch = batch.filter(pc.invert(ready))
            if not batch.num_rows:
                continue
            hash_ = batch.column(0).to_numpy()
            cut = int(np.searchsorted(hash_, hash_[-1]))  # the last hash may go on in the next batch
            if cut:
                yield settle(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield settle(pa.Table.from_batches(held))

    return found.repartition("hash").sortWithinPartitions("hash", "check").mapInArrow(run, SPAN)


def _pairs(spans) -> np.ndarray:
    """An Arrow list of spans as rows of from, to."""
    parts = spans.values
    return np.stack([parts.field(0).to_numpy(), parts.field(1).to_numpy()], axis=1).astype(np.int64)


def _scan(given: DataFrame, occurrences: Callable, length: int, any_other: bool) -> DataFrame:
    """Fold what ``occurrences(words, spans)`` gives for each text: positions, hashes, check hashes."""

    def rows(batches):
        for batch in batches:
            for ord_, key, text, *rest in zip(*batch.columns):
                words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                yield ord_.as_py(), key.as_py(), words, _pairs(rest[0]) if rest else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _batches(rows(batches)):
            parts = [(o, k, *occurrences(words, spans)) for o, k, words, spans in group]
            parts = [p for p in parts if len(p[2])]
            if parts:
                sizes = [len(p[2]) for p in parts]
                ord_, key = (np.repeat(np.array([p[i] for p in parts], np.int64), sizes) for i in (0, 1))
                pos, hash_, check = (np.concatenate([p[i] for p in parts]) for i in (2, 3, 4))
                yield from _fold(ord_, key, pos, hash_, check, length, any_other)

    return given.mapInArrow(run, FOUND)


def anchor_positions(count: int, cover: list[int], period: int) -> np.ndarray:
    """Cover positions among the first ``count``."""
    at = np.arange(count)
    return at[np.isin(at % period, cover)]


def repeated_spans(docs: DataFrame, window: int = 50, period: int = 31, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``ord, text_key, text, spans`` for texts with words to remove; the spans cover them."""
    anchor = window - period + 1
    if anchor < 1:
        raise ValueError("the period must not exceed the window")
    cover = difference_cover(period)
    given = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("ord"), F.xxhash64(text_col).alias("text_key"),
                        F.col(text_col).alias("text"))

    def anchors(words, _):
        if len(words) < window:
            return (np.empty(0, np.int64),) * 3
        pos = anchor_positions(len(words) - anchor + 1, cover, period)
        hash_ = rolling(word_hashes(words), anchor, BASES[0])[pos]
        return pos, hash_, np.zeros(len(pos), np.int32)

    def windows(words, spans):
        hashes, count = word_hashes(words), len(words) - window + 1
        marks = np.zeros(len(words) + 1, np.int64)  # windows that hold a whole shared anchor; a span may join several
        for a, b in spans:
            begin, end = max(0, a - window + anchor), min(b - anchor + 1, count)
            if begin < end:
                marks[begin] += 1
                marks[end] -= 1
        pos = np.flatnonzero(np.cumsum(marks)[:max(count, 0)] > 0)
        return pos, rolling(hashes, window, BASES[0])[pos], (rolling(hashes, window, BASES[1])[pos] >> np.uint64(32)).astype(np.uint32).view(np.int32)

    spans = F.collect_list(F.struct("pos", "upto")).alias("spans")
    # the texts of one id share its anchors, which can only add windows to hash
    slim = given.select("ord", F.lit(0).cast("long").alias("text_key"), "text")
    shared = _judge(_scan(slim, anchors, anchor, True), anchor, True).groupBy("ord").agg(spans)
    candidates = stage(given.join(shared, "ord"), "candidates")
    removed = _judge(_scan(candidates.select("ord", "text_key", "text", "spans"), windows, window, False), window, False)
    return candidates.select("ord", "text_key", "text").join(removed.groupBy("ord", "text_key").agg(spans), ["ord", "text_key"])


def kept_words(text: str | None, spans) -> tuple[list[bytes], int]:
    """The words outside the spans, and how many there were."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    if spans is None:
        return words, len(words)
    marks = np.zeros(len(words) + 1, np.int64)
    np.add.at(marks, spans[:, 0], 1)
    np.add.at(marks, spans[:, 1], -1)
    gone = np.cumsum(marks[:-1]) > 0
    return [w for w, g in zip(words, gone.tolist()) if not g], len(words)


def remove_repeats(docs: DataFrame, window: int = 50, period: int = 31, id_col: str = "doc_id", text_col: str = "text",
                   with_text: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for each row.

    With ``with_text`` also ``text``, the kept words joined by a space; null where nothing is removed.
    """
    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            spans = batch.column("spans") if "spans" in names else None
            out: list[list] = [[], [], [], []]
            for i, text in enumerate(batch.column("text")):
                words, total = kept_words(text.as_py(), _pairs(spans[i]) if spans is not None else None)
                joined = b" ".join(words)
                for column, value in zip(out, (joined.decode("utf-8", "surrogatepass") if with_text and spans is not None else None, total, total - len(words),
                                               hashlib.sha256(joined).hexdigest())):
                    column.append(value)
            ids = [batch.column(c) for c in names if c not in ("text", "spans")]
            yield pa.RecordBatch.from_arrays(
                [*ids, pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.string())],
                [c for c in names if c not in ("text", "spans")] + ["kept", "n_words", "n_removed", "kept_sha256"])

    changed = repeated_spans(docs, window, period, id_col, text_col).mapInArrow(
        digests, "ord long, text_key long, kept string, n_words long, n_removed long, kept_sha256 string")
    changed = changed.dropDuplicates(["ord", "text_key"]).select(
        "ord", "text_key", F.col("kept").alias("text"), F.col("n_removed").alias("__removed"), F.col("kept_sha256").alias("__kept"))
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("ord"),
                        F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    whole = given.mapInArrow(digests, "doc_id long, ord long, text_key long, kept string, n_words long, n_removed long, kept_sha256 string")
    return whole.join(changed, ["ord", "text_key"], "left").select(
        "doc_id", *["text"] * with_text, "n_words", F.coalesce("__removed", "n_removed").alias("n_removed"),
        F.coalesce("__kept", "kept_sha256").alias("kept_sha256"))

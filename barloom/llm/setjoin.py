"""Jaccard join of word n-gram sets through parity sketches, exact.

A set is XOR-hashed: every token flips what its hash says, so two sketches differ only by the tokens that one
set has and the other has not, and their Hamming distance is at most the size of that symmetric difference.
A pair at the threshold differs in at most ``(s + t) * (100 - percent) / (100 + percent)`` tokens of its sizes
s and t. Two sketches are used that way:

* In a band of sizes (powers of two, of the larger set) tokens are dealt by hash to parts, somewhat more of
  them than a pair of the band may differ in, and a part's sketch is the XOR of its tokens' hashes. By the
  pigeonhole a linked pair agrees on a part. A set sends its parts in a fixed order until it has sent one more
  non-empty part than it may differ in from any partner. Of a linked pair, let A be the set that stops first:
  one of its non-empty parts is untouched by the difference, and the other set has sent that part too. So
  empty parts, which all sets share, are never sent. A set whose parts do not suffice sends all of them and,
  for pairs of two such sets, its first tokens in hash order (the prefix filter).
* A dense sketch of two to four parity bits for each token (a power of two, 512 at least and ``WIDEST`` at most), whose Hamming
  distance is compared with what the pair may differ in before any tokens are. Sketches of two widths are compared after the wider
  one is folded, half onto half.

Whatever passes is verified on the whole token sets. Copies are folded first: a class is a distinct set (by a
128-bit hash), and a task sends the parts of a class once, packed. Of the classes that share a part, first all are
verified against the smallest alone. Only groups whose other members still fall into several components are
compared among themselves, cut into blocks of ``block`` classes whose pairs are separate tasks. Such a task first proposes
no more pairs than would join its components, of those that pass the dense sketch. Where all of these are links, no pair of the
task is left that could join components; where one is not, the task is repeated after the components are joined anew, and proposes
all pairs of different components that pass the sketch and were not verified yet. Tokens are 64-bit hashes.

Defined results: a null text or one without words has the empty set and is linked with nothing; repeated rows
and rows that repeat an id get a row each; a null id never becomes a component id while the component has
another; other columns are ignored; an empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.graph import components
from barloom.session import stage, stage_bucketed

NARROWEST, WIDEST = 1 << 9, 1 << 17
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)
FILTER_BITS = 1 << 26  # 8 MB at most, whatever the number of rows
FOLD = 1 << 17
FLUSH = 1 << 16
KEY_BYTES = 5  # of a part's key; parts that share one by chance cost a comparison, no more
MEMBER = "part long, hub binary, class binary"
PACKED = "bucket int, classes binary, counts binary, parts binary"


def _mixed(x: np.ndarray, by: int = MIX[2]) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * np.uint64(by)
    return x ^ x >> np.uint64(29)


def shingles(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; of all words if there are fewer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII white space count
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(size, len(words))
    n = len(words) - k + 1
    runs = np.full(n, k, np.uint64)
    for j in range(k):
        runs = _mixed(runs * np.uint64(MIX[0]) + hashes[j:j + n])
    return np.unique(runs)


def set_class(tokens: np.ndarray) -> bytes:
    """Equal for equal sets."""
    return xxhash.xxh3_128_digest(tokens.tobytes())


def width(size: int) -> int:
    """Bits of the dense sketch of a set; those of sets that may link are equal or one is twice the other."""
    return min(WIDEST, max(NARROWEST, 1 << (2 * size - 1).bit_length()))


def sketch(tokens: np.ndarray) -> np.ndarray:
    """Parity bits in whole numbers of 64: every token flips one."""
    bits = width(len(tokens))
    at = (_mixed(tokens, MIX[1]) % np.uint64(bits)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=bits) & 1).view(np.int64)


def folded(marks: np.ndarray) -> np.ndarray:
    """Sketches of half the width."""
    half = marks.shape[-1] // 2
    return marks[..., :half] ^ marks[..., half:]


def differing(total: int, percent: int) -> int:
    """How many tokens two linked sets of ``total`` tokens together may not share."""
    return total * (100 - percent) // (100 + percent)


def bands(size: int, percent: int) -> list[tuple[int, int, int]]:
    """Bands that a set of ``size`` tokens has partners in: number, parts, and the most it may differ in there."""
    found = []
    for band in (size.bit_length() - 1, size.bit_length()):
        low, high = 1 << band, (2 << band) - 1
        partner = min(high, size * 100 // percent)
        if partner >= low:
            most = differing(2 * high, percent)
            found.append((band, most + most // 8 + 3, differing(size + partner, percent)))
    return found


def part_keys(tokens: np.ndarray, percent: int) -> np.ndarray:
    """What a set sends: hashes of (band, part, sketch of the part), ``KEY_BYTES`` of each."""
    out, size, short = [], len(tokens), False
    for band, parts, most in bands(size, percent) if size else []:
        place = (_mixed(tokens + np.uint64(band + 1)) % np.uint64(parts)).astype(np.int64)
        sums = np.zeros(parts, np.uint64)
        np.bitwise_xor.at(sums, place, _mixed(tokens, MIX[0]))
        sent = np.flatnonzero(np.bincount(place, minlength=parts))[:most + 1]
        short |= len(sent) <= most
        out.append(_mixed(sums[sent] + sent.astype(np.uint64) * np.uint64(MIX[1]) + np.uint64(band + 1 << 32)))
    if short:
        out.append(_mixed(tokens[:size - -(-percent * size // 100) + 1] + np.uint64(MIX[1])))
    return np.unique(np.concatenate(out) & np.uint64((1 << 8 * KEY_BYTES) - 1)) if out else np.empty(0, np.uint64)


def _longs(names: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(names), np.int64).reshape(-1, 2)


def _binary(pairs: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(pairs, np.int64)
    offsets = np.arange(len(data) + 1, dtype=np.int32) * 16
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _marked(size: int) -> Callable:
    """Rows of documents with the size, class and dense sketch of their sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t.as_py(), size) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_class(s) for s in sets], pa.binary()),
                 pa.array([sketch(s) for s in sets], pa.list_(pa.int64()))], ["doc_id", "text_key", "n_shingles", "class", "sketch"])
    return run


def _folded(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[bytes, np.ndarray, str]]:
    """Class, tokens and text of the sets that the task has not had among its last ``FOLD`` classes."""
    had: set[bytes] = set()
    for batch in batches:
        for text in batch.column(0):
            text = text.as_py()
            tokens = shingles(text, size)
            name = set_class(tokens)
            if len(tokens) and name not in had:
                if len(had) >= FOLD:
                    had.clear()
                had.add(name)
                yield name, tokens, text


def _sent(size: int, percent: int, buckets: int) -> Callable:
    """The parts of sets, packed: for each bucket of keys the classes that have any, how many each has (in planes of bytes, as most
    are zero), and the keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, names, held = [], [], 0

        def flushed() -> pa.RecordBatch:
            parts, of = np.concatenate(keys), np.repeat(np.arange(len(names)), [len(k) for k in keys])
            bucket = (parts % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            parts, of, bucket = parts[order], of[order], bucket[order]
            new = np.ones(len(parts), bool)
            new[1:] = (of[1:] != of[:-1]) | (bucket[1:] != bucket[:-1])
            starts = np.flatnonzero(new)
            counts, owners = np.diff(np.append(starts, len(parts))).astype("<u4"), _longs(names)[of[starts]]
            hit, first = np.unique(bucket, return_index=True)
            raw, first_run = parts.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES], np.searchsorted(starts, first)
            return pa.RecordBatch.from_arrays(
                [pa.array(hit), *(pa.array([x.tobytes() for x in some], pa.binary()) for some in (
                    np.split(owners, first_run[1:]), (c.view(np.uint8).reshape(-1, 4).T for c in np.split(counts, first_run[1:])), np.split(raw, first[1:])))],
                ["bucket", "classes", "counts", "parts"])

        for name, tokens, _ in _folded(batches, size):
            keys.append(part_keys(tokens, percent))
            names.append(name)
            held += len(keys[-1])
            if held >= FLUSH:
                yield flushed()
                keys, names, held = [], [], 0
        if keys:
            yield flushed()
    return run


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each part and class of packed rows."""
    for batch in batches:
        for _, classes, counts, parts in zip(*(c.to_pylist() for c in batch.columns)):
            counts = np.ascontiguousarray(np.frombuffer(counts, np.uint8).reshape(4, -1).T).view("<u4").ravel()
            pairs = np.repeat(np.frombuffer(classes, np.int64).reshape(-1, 2), counts, axis=0)
            whole = np.zeros((len(pairs), 8), np.uint8)
            whole[:, :KEY_BYTES] = np.frombuffer(parts, np.uint8).reshape(-1, KEY_BYTES)
            yield pa.RecordBatch.from_arrays([pa.array(whole.view("<i8").ravel()), pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["part", "c1", "c2"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by part and class: the classes of every part that has several, with the smallest as hub."""
    last = np.empty((0, 3), np.int64)  # the hub of the part that a batch ends in, and its last row; that part goes on
    alone = True
    for batch in batches:
        rows = np.column_stack([c.to_numpy() for c in batch.columns])
        rows = np.concatenate([last[-1:], rows])
        new = np.ones(len(rows), bool)
        new[1:] = np.any(rows[1:] != rows[:-1], axis=1)
        rows = rows[new]
        first = np.ones(len(rows), bool)
        first[1:] = rows[1:, 0] != rows[:-1, 0]
        starts = np.flatnonzero(first)
        run = np.cumsum(first) - 1
        hubs = rows[starts]
        sizes = np.diff(np.append(starts, len(rows)))
        going_on = len(last) > 0
        if going_on:
            hubs[0] = last[0]
        several = sizes > 1
        if going_on and not alone:
            several[0] = True
        keep = several[run]
        if going_on and not alone:
            keep[0] = False  # that row has gone out with an earlier batch
        yield pa.RecordBatch.from_arrays([pa.array(rows[keep, 0]), _binary(hubs[run[keep], 1:]), _binary(rows[keep, 1:])],
                                         ["part", "hub", "class"])
        last = np.concatenate([hubs[-1:], rows[-1:]])
        alone = not several[-1]


def _row_filter(rows: DataFrame):
    """Bits of the hashes of ``rows(hash)``, of a fixed number, so that other rows can be left out unread."""
    slot = F.pmod("hash", F.lit(FILTER_BITS)) + 1  # buckets of 32,768 bits are numbered from 1, their bits from 0
    return rows.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))


def _row_hash(id_col: str, text_col: str):
    return F.xxhash64(F.col(id_col), F.xxhash64(text_col))


def _texts_of(docs: DataFrame, wanted: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """``class, text`` of at least the classes in ``wanted(hash)``, where ``hash`` is that of a row that has the set."""
    buckets = {r.bucket: bytes(r.bits) for r in _row_filter(wanted).collect()}  # FILTER_BITS at most
    bits = np.zeros((FILTER_BITS // 32768, 4096), np.uint8)
    for number, chunk in buckets.items():
        bits[number - 1] = np.frombuffer(chunk, np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(bits.ravel())

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def some() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                slot = np.mod(batch.column(0).to_numpy(), FILTER_BITS)
                hit = (shared.value[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1
                yield pa.RecordBatch.from_arrays([batch.column(1).filter(pa.array(hit.astype(bool)))], ["text"])

        names, texts, held = [], [], 0
        for name, tokens, text in _folded(some(), size):
            names.append(name)
            texts.append(text)
            held += len(tokens)
            if held >= FLUSH:
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(texts, pa.string())], ["class", "text"])
                names, texts, held = [], [], 0
        if names:
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(texts, pa.string())], ["class", "text"])

    given = docs.select(_row_hash(id_col, text_col).alias("hash"), F.col(text_col).alias("text"))
    return given.mapInArrow(pick, "class binary, text string")


def _plausible(edges: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The ``a, b`` of ``edges(a, b)`` that sizes and dense sketches allow."""
    def end(name: str) -> DataFrame:
        return classes.select(F.col("class").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("sketch").alias(f"s_{name}"))

    def as_wide_as(mine: str, other: str):
        half = F.size(other)
        return F.when(F.size(mine) > half, F.zip_with(F.slice(mine, F.lit(1), half), F.slice(mine, half + 1, half), lambda x, y: x.bitwiseXOR(y))).otherwise(F.col(mine))

    bits = F.zip_with(as_wide_as("s_a", "s_b"), as_wide_as("s_b", "s_a"), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    apart = F.aggregate(bits, F.lit(0), lambda total, n: total + n)  # null where the widths differ more, and so the sizes
    most = F.floor((F.col("n_a") + F.col("n_b")) * (100 - percent) / (100 + percent) + 1e-9)
    return edges.join(end("a"), "a").join(end("b"), "b").where((F.abs(F.col("n_a") - F.col("n_b")) <= most) & (apart <= most)).select("a", "b")


def _verified(edges: DataFrame, classes: DataFrame, docs: DataFrame, size: int, percent: int, block: int, id_col: str, text_col: str) -> DataFrame:
    """The ``a, b`` of distinct ``edges(a, b)`` whose token sets are similar enough.

    Texts travel, not tokens, which take more room: that of ``a`` once for every ``block`` of its edges, that of ``b`` once for
    each edge.
    """
    edges = stage(edges, "edges-to-verify")
    if edges.isEmpty():
        return edges
    counts = edges.groupBy("a").agg(F.ceil(F.count("*") / block).alias("blocks"))
    firsts = counts.select(F.col("a").alias("class"), "a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("salt"),
                           F.lit(None).cast("binary").alias("b"))
    seconds = edges.join(counts, "a").select(F.col("b").alias("class"), "a", F.pmod(F.xxhash64("b"), "blocks").alias("salt"), "b")
    needs = stage(firsts.unionByName(seconds), "texts-needed")
    wanted = needs.select("class").distinct().join(classes, "class").select("hash")
    rows = _texts_of(docs, wanted, size, id_col, text_col).join(needs, "class").select("a", "salt", "b", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.empty(0, np.uint64)
        for batch in batches:
            kept = []
            for i, (other, text) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3))):
                tokens = shingles(text.as_py(), size)
                if other is None:  # sorted first
                    own = tokens
                    continue
                at = np.minimum(np.searchsorted(own, tokens), len(own) - 1)
                both = int(np.count_nonzero(own[at] == tokens))
                if 100 * both >= percent * (len(own) + len(tokens) - both):
                    kept.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(kept, pa.int32())) for c in (0, 2)], ["a", "b"])

    sorted_rows = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return stage(sorted_rows.mapInArrow(run, "a binary, b binary"), "links")


def _spanning(labels: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Indices of pairs that join all sets that the pairs (x, y) join; ``labels`` are brought up to date."""
    chosen = []
    while len(at := np.flatnonzero(labels[x] != labels[y])):
        low, high = np.minimum(labels[x[at]], labels[y[at]]), np.maximum(labels[x[at]], labels[y[at]])
        _, first = np.unique(high, return_index=True)  # every set to one that is smaller: no circle comes about
        chosen.append(at[first])
        lead = np.arange(labels.max() + 1)
        lead[high[first]] = low[first]
        while not np.array_equal(up := lead[lead], lead):
            lead = up
        labels[:] = lead[labels]
    return np.concatenate(chosen) if chosen else np.empty(0, np.int64)


def _pairs_within(percent: int, spanning: bool) -> Callable:
    """Pairs of classes of one part (or two of its blocks), of different components, that sizes and dense sketches allow;
    with ``spanning`` only as many as it takes to join those components."""
    def compare(rows: list[tuple], i: int, j: int) -> Iterator[pa.RecordBatch]:
        own, names, roots, sizes, marks = zip(*rows)
        own, sizes, words = np.array(own), np.array(sizes, np.int64), np.array([len(m) for m in marks])
        roots = np.unique(np.array(roots, object), return_inverse=True)[1]
        for count in np.unique(words):  # sketches of one width, and of twice the width against them
            narrow, wide = np.flatnonzero(words == count), np.flatnonzero(words == 2 * count)
            table = np.array([marks[k] for k in narrow], np.int64).view(np.uint64)  # numpy counts the bits of absolute values
            yield from matched(names, sizes, roots, narrow[own[narrow] == i], narrow[own[narrow] == j], table[own[narrow] == i], table[own[narrow] == j], i == j)
            if len(wide):
                half = folded(np.array([marks[k] for k in wide], np.int64).view(np.uint64))
                yield from matched(names, sizes, roots, narrow[own[narrow] == i], wide[own[wide] == j], table[own[narrow] == i], half[own[wide] == j], False)
                if i != j:
                    yield from matched(names, sizes, roots, narrow[own[narrow] == j], wide[own[wide] == i], table[own[narrow] == j], half[own[wide] == i], False)

    def matched(names, sizes, roots, left, right, of_left, of_right, same) -> Iterator[pa.RecordBatch]:
        step = max(1, FLUSH // max(1, len(right)))
        for begin in range(0, len(left), step):
            some = left[begin:begin + step]
            most = (sizes[some, None] + sizes[right]) * (100 - percent) // (100 + percent)
            x, y = np.nonzero((np.abs(sizes[some, None] - sizes[right]) <= most) & (roots[some, None] != roots[right]))
            if same:
                x, y = x[some[x] < right[y]], y[some[x] < right[y]]
            part = max(1, (1 << 20) // max(1, of_right.shape[-1]))
            near = [x[:0].astype(bool)] + [np.bitwise_count(of_left[begin + x[k:k + part]] ^ of_right[y[k:k + part]]).sum(axis=1, dtype=np.int64)
                                           <= most[x[k:k + part], y[k:k + part]] for k in range(0, len(x), part)]
            near = np.concatenate(near)
            x, y = some[x[near]], right[y[near]]
            if spanning:
                kept = _spanning(roots, x, y)
                x, y = x[kept], y[kept]
            if len(x):
                a, b = ([names[k] for k in side] for side in (x.tolist(), y.tolist()))
                yield pa.RecordBatch.from_arrays([pa.array(list(map(min, a, b)), pa.binary()), pa.array(list(map(max, a, b)), pa.binary())], ["a", "b"])

    def of_task(rows: list[tuple], task: tuple | None) -> Iterator[pa.RecordBatch]:
        for found in compare(rows, *task[1:]) if len(rows) > 1 else ():
            yield pa.RecordBatch.from_arrays([*(pa.array([x] * found.num_rows, pa.int64()) for x in task), *found.columns], ["part", "i", "j", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for part, i, j, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (part, i, j) != now:
                    yield from of_task(held, now)
                    now, held = (part, i, j), []
                held.append(row)
        yield from of_task(held, now)
    return run


def _rooted(members: DataFrame, roots: DataFrame) -> DataFrame:
    return members.join(roots, members["class"] == roots.node, "left").withColumn("root", F.coalesce("root", "class")).drop("node")


def _open_groups(members: DataFrame, roots: DataFrame, block: int) -> DataFrame:
    """``part, class, blocks`` of the parts whose members, without the hub, are in different components; of parts with the same
    members (told apart by 128 bits) one alone."""
    others = members.where(F.col("class") != F.col("hub")).select("part", "class")
    placed = stage(_rooted(others, roots), "placed-members")
    groups = placed.groupBy("part").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.ceil(F.count("*") / block).alias("blocks"),
                                        F.bit_xor(F.xxhash64("class")).alias("x"), F.bit_xor(F.xxhash64("class", F.lit(1))).alias("y"))
    unsettled = groups.where(F.col("least") != F.col("most")).groupBy("blocks", "x", "y").agg(F.min("part").alias("part"))
    return stage(placed.select("part", "class").join(unsettled.select("part", "blocks"), "part"), "open-groups")


def _open_pairs(groups: DataFrame, tasks: DataFrame | None, roots: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """``part, i, j, a, b``: pairs still to be verified, of blocks i and j of a group's members and in different components.
    Without ``tasks(part, i, j)`` as many as would join the components of any two blocks, else all of those tasks."""
    own = F.pmod(F.xxhash64("class"), F.col("blocks"))
    rows = groups.select("part", "class", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("with"))
    rows = rows.select("part", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "own", "class")
    if tasks is not None:
        rows = rows.join(tasks, ["part", "i", "j"], "left_semi")
    rows = _rooted(rows, roots).join(classes.select("class", "n_shingles", "sketch"), "class")
    rows = rows.select("part", "i", "j", "own", "class", "root", "n_shingles", "sketch")
    sorted_rows = rows.repartition("part", "i", "j").sortWithinPartitions("part", "i", "j")
    return sorted_rows.mapInArrow(_pairs_within(percent, tasks is None), "part long, i long, j long, a binary, b binary")


def similar_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80,
                 block: int = 4096) -> DataFrame:
    """``doc_id, text_key, n_shingles, component_id`` for each row; rows link at a Jaccard similarity of ``percent`` in a hundred, 50 at least."""
    if not 50 <= percent <= 100:  # dense sketches of linked sets are compared at widths that differ by a factor of 2 at most
        raise ValueError("percent must be between 50 and 100")
    given = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()
    marked = stage(given.mapInArrow(_marked(size), f"doc_id {kind}, text_key long, n_shingles long, class binary, sketch array<long>"), "marked")
    classes = stage_bucketed(marked.where("n_shingles > 0").groupBy("class").agg(
        F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"), F.min("doc_id").alias("first_id"),
        F.min(F.xxhash64("doc_id", "text_key")).alias("hash")), ["class"], [], "set-classes")
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = docs.select(F.col(text_col).alias("text")).mapInArrow(_sent(size, percent, buckets), PACKED)
    rows = sent.repartitionById(buckets, F.col("bucket")).mapInArrow(_unpacked, "part long, c1 long, c2 long")
    members = stage(rows.sortWithinPartitions("part", "c1", "c2").mapInArrow(_shared, MEMBER), "members")
    tested = members.where(F.col("class") != F.col("hub")).select(F.col("hub").alias("a"), F.col("class").alias("b")).distinct()
    args = (classes, docs, size, percent, block, id_col, text_col)
    links = _verified(_plausible(tested, classes, percent), *args)
    roots = components(links)
    groups = _open_groups(members, roots, block)
    spanning = stage(_open_pairs(groups, None, roots, classes, percent), "spanning-pairs")
    more = _verified(spanning.select("a", "b").distinct(), *args)
    if not more.isEmpty():
        links = links.unionByName(more)
        roots = components(links)
    tasks = stage(spanning.join(more, ["a", "b"], "left_anti").select("part", "i", "j").distinct(), "open-tasks")
    if not tasks.isEmpty():
        rest = _open_pairs(groups, tasks, roots, classes, percent).select("a", "b").distinct().join(spanning, ["a", "b"], "left_anti")
        last = _verified(rest, *args)
        if not last.isEmpty():
            links = links.unionByName(last)
            roots = components(links)
    rooted = classes.join(roots, classes["class"] == roots.node, "left").select("class", "first_id", F.coalesce("root", "class").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    found = rooted.join(smallest, "root").select("class", "component_id")
    return marked.join(found, "class", "left").select(
        "doc_id", "text_key", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))

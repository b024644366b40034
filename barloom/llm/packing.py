"""Best-fit packing of token pieces into sequences by minimum bin slack.

Documents are tokenised and cut where the rows lie. Packing needs only how many pieces there are of each
length, at most ``capacity`` numbers, so the driver plans on that histogram: for each bin it takes the
longest length left and finds, by a subset-sum over bit sets of the lengths available, the fullest
combination that fits; the combination is used as often as the counts allow, so a plan is a list of
(combination, repeats) whose size depends on the capacity and not on the data. Pieces of equal length are
interchangeable: each finds its bin from its rank among them. Ranks are counted in hash buckets and shifted
by the sizes of earlier buckets, so a length that a third of all pieces share is ranked in many tasks.

Defined results: a null text is empty and gives the end id alone; repeated rows are separate pieces; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from barloom.session import stage

BUCKET_PIECES = 20_000


class Encoder:
    """Token ids of a byte-level BPE file, as the ``tokenizers`` library gives them.

    With ``ranks_path``, a file of the same vocabulary as ranks, ordinary text is encoded by ``tiktoken``,
    which gives the same ids several times faster; texts with the vocabulary's special tokens are not.
    """

    _made: dict[tuple, "Encoder"] = {}

    def __init__(self, path: str, ranks_path: str | None, pattern: str | None):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.special = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks_path:
            import base64

            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    @classmethod
    def of(cls, path: str, ranks_path: str | None, pattern: str | None) -> "Encoder":
        """One encoder for each Python worker."""
        key = (path, ranks_path, pattern)
        if key not in cls._made:
            cls._made[key] = cls(*key)
        return cls._made[key]

    def ids(self, text: str) -> np.ndarray:
        if self.fast and not any(s in text for s in self.special):
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4")
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4")


def public_vocabulary() -> dict:
    """The arguments of :class:`Encoder` for the installed 50k byte-level vocabulary."""
    import public_tokenizers as P

    return {"path": P.path("byte_bpe_50k.json"), "ranks_path": P.path("byte_bpe_50k.tiktoken"), "pattern": P.PATTERN}


def cut_points(total: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``total`` tokens; only the first may be shorter than the capacity."""
    first = total if total <= capacity else total % capacity or capacity
    return [(0, first)] + [(start, capacity) for start in range(first, total, capacity)]


def pieces(docs: DataFrame, vocabulary: dict, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024,
           end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """``doc_id, row, piece, start, length, ids_crc32[, ids]`` for each piece of each row's tokens.

    ``row`` numbers the rows of a task; it only spreads repeated rows over ranking buckets.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen = Encoder.of(**vocabulary), 0
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for at in range(batch.num_rows):
                ids = np.append(encoder.ids(batch.column(1)[at].as_py() or ""), np.uint32(end_id)).astype("<u4")
                for piece, (start, length) in enumerate(cut_points(len(ids), capacity)):
                    part = ids[start:start + length]
                    for column, value in zip(out, (at, seen + at, piece, start, length, zlib.crc32(part.tobytes()),
                                                   part.astype(np.int32) if with_ids else None)):
                        column.append(value)
            seen += batch.num_rows
            arrays = [batch.column(0).take(pa.array(out[0], pa.int64()))]
            arrays += [pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32())] + [pa.array(c, pa.int64()) for c in out[3:6]]
            arrays += [pa.array(out[6], pa.list_(pa.int32()))] if with_ids else []
            yield pa.RecordBatch.from_arrays(arrays, schema.fieldNames())

    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = T.StructType([given.schema["doc_id"], T.StructField("row", T.LongType()), T.StructField("piece", T.IntegerType()),
                           T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                           T.StructField("ids_crc32", T.LongType())]
                          + ([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []))
    return given.mapInArrow(run, schema)


def _fullest(lengths: list[int], counts: dict[int, int], capacity: int, slack: int = 0) -> dict[int, int]:
    """The combination of available lengths (ascending) that holds the longest and leaves the least slack.

    Of all combinations at most ``slack`` emptier than the fullest, the one with the longest pieces.
    """
    longest = lengths[-1]
    room, fits = capacity - longest, (1 << (capacity - longest + 1)) - 1
    usable = [(n, counts[n] - (n == longest)) for n in lengths if n <= room]
    reach, before = 1, []
    for n, count in usable:
        before.append(reach)
        left, step = min(count, room // n), 1
        while left:  # powers of two make every multiple up to the count
            take = min(step, left)
            reach |= reach << (n * take) & fits
            left, step = left - take, step * 2
    fullest = reach.bit_length() - 1
    chosen, targets = {longest: 1}, reach >> max(0, fullest - slack) << max(0, fullest - slack)
    for (n, count), smaller in zip(reversed(usable), reversed(before)):  # the longest first, as many as the rest allows
        for k in range(min(count, (targets.bit_length() - 1) // n), -1, -1):
            if targets >> (k * n) & smaller:
                break
        if k:
            chosen[n] = chosen.get(n, 0) + k
        targets = targets >> (k * n) & smaller
    return chosen


def _plan(histogram: dict[int, int], capacity: int, slack: int) -> list[tuple[dict[int, int], int]]:
    counts, made = {n: c for n, c in histogram.items() if c}, []
    while counts:
        chosen = _fullest(sorted(counts), counts, capacity, slack)
        times = min(counts[n] // k for n, k in chosen.items())
        made.append((chosen, times))
        for n, k in chosen.items():
            counts[n] -= k * times
            if not counts[n]:
                del counts[n]
    return made


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Combinations of lengths and how many bins each fills, until no piece is left.

    Always taking the fullest combination uses up the short pieces early, which can cost a bin in
    the end. So unless the plan already has as few bins as the tokens allow, plans that accept a
    little slack for longer pieces are made too, and the one with the fewest bins is taken.
    """
    fewest = -(-sum(n * c for n, c in histogram.items()) // capacity)
    best: list[tuple[dict[int, int], int]] = []
    for slack in (0, 1, 2, 4, 8, 16, 32, 64, capacity):
        made = _plan(histogram, capacity, slack)
        if not best or sum(t for _, t in made) < sum(t for _, t in best):
            best = made
        if sum(t for _, t in best) <= fewest:
            break
    return best


def _slots(made: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """For each length, rows of: first rank, pieces in a bin, first bin, place in the bin."""
    slots: dict[int, list] = {}
    used: dict[int, int] = {}
    bin_at = 0
    for chosen, times in made:
        place = 0
        for n in sorted(chosen, reverse=True):
            slots.setdefault(n, []).append((used.get(n, 0), chosen[n], bin_at, place))
            used[n] = used.get(n, 0) + chosen[n] * times
            place += n * chosen[n]
        bin_at += times
    return {n: np.array(rows, np.int64) for n, rows in slots.items()}


def pack(parts: DataFrame, capacity: int = 1024) -> DataFrame:
    """``parts`` (read several times, so stored) with ``sequence_id`` and ``offset`` added; ``length`` is 1 to ``capacity``."""
    total = parts.count()
    key = F.xxhash64("doc_id", "piece", "row")
    ranked_in = parts.withColumn("__bucket", F.pmod(key, F.lit(max(1, -(-total // BUCKET_PIECES)))))
    sizes = ranked_in.groupBy("length", "__bucket").agg(F.count("*").alias("__n"))
    histogram = {r.length: r.n for r in sizes.groupBy("length").agg(F.sum("__n").alias("n")).collect()}  # at most `capacity` rows
    if any(not 1 <= n <= capacity for n in histogram):
        raise ValueError(f"piece lengths must be 1 to {capacity}")
    slots = parts.sparkSession.sparkContext.broadcast(_slots(plan(histogram, capacity)))
    earlier = W.partitionBy("length").orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)  # a row for each bucket
    begins = sizes.select("length", "__bucket", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__begin"))
    within = W.partitionBy("length", "__bucket").orderBy("doc_id", "piece", "row")
    ranked = ranked_in.withColumn("__rank", F.row_number().over(within) - 1).join(begins, ["length", "__bucket"]).withColumn(
        "__rank", F.col("__rank") + F.col("__begin")).drop("__bucket", "__begin")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = dict(zip(batch.schema.names, batch.columns))
            length, rank = (table[c].to_numpy(zero_copy_only=False) for c in ("length", "__rank"))
            bins, offsets = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for n in np.unique(length):
                own = np.flatnonzero(length == n)
                slot = slots.value[int(n)]
                slot = slot[np.searchsorted(slot[:, 0], rank[own], "right") - 1]
                nth = rank[own] - slot[:, 0]
                bins[own], offsets[own] = slot[:, 2] + nth // slot[:, 1], slot[:, 3] + nth % slot[:, 1] * n
            names = [c for c in batch.schema.names if c != "__rank"]
            yield pa.RecordBatch.from_arrays([table[c] for c in names] + [pa.array(bins), pa.array(offsets)],
                                             names + ["sequence_id", "offset"])

    schema = T.StructType([f for f in ranked.schema if f.name != "__rank"]
                          + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, vocabulary: dict, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024,
                   end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack: a row for each piece."""
    parts = stage(pieces(docs, vocabulary, id_col, text_col, capacity, end_id, with_ids), "pieces")
    return pack(parts, capacity).drop("row")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids`` from packed pieces with ids; a group holds at most ``capacity`` tokens."""
    return packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p")).select(
        "sequence_id", F.flatten("p.ids").alias("ids"))

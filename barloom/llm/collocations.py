"""Collocations: word phrases that occur together far more often than their parts would by chance.

Phrases of one word, then of two, up to ``longest`` are counted one length after the other. A phrase can only
be common if its first and its last words but one are (Apriori), so candidates of a length come from the
common phrases of the length before:

1. Texts become runs of word numbers once, with a 0 for a rare word or a break; words are numbered per language, so
   a number stands for a word of a language and all languages are counted at once.
2. Every place whose two shorter phrases are common (in a bitmap of fixed size; a wrong bit only lets a place
   more through) adds to the count of its phrase's mark, a hash of 40 bits. Phrases that share a mark are counted together, so
   a phrase is never counted too low and no common one is lost.
3. The distinct phrases of well-filled marks whose shorter phrases are really common are the candidates. Tasks look for them
   through a bitmap of those marks and send what they find packed, a row for a bucket of marks; buckets are merged and their phrases
   looked up among the marks themselves, so that no more candidates come out than there are such marks, or hardly.
4. Candidates make double-array tries of at most ``shard`` phrases, which are broadcast one after the other. In a
   scan numpy moves the states of all places of a text block through the trie together, level by level,
   drops those without a transition and adds up the accepting states. Spark sums the counts of all tasks.

No pairs of phrases are made: candidates come from places of the text. What a broadcast or a task holds is
bounded by ``dictionary`` words, ``shard`` phrases or ``SLOTS`` bits; more words or candidates take more scans.

Scores are whole numbers in exact decimal arithmetic. Defined results: a null text has no words, a null language
is ``und``, repeated rows count again, a text without words adds nothing; other columns are ignored; an empty
table has no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from barloom.operators.windows import ordinal
from barloom.session import stage

#: breaks between pieces become new lines, tabs spaces
TABLE = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"\n" * 10 + b" ")
TOKEN = re.compile(rb"[^ \n]+|\n")
BREAK = b"\n"
SLOTS = 1 << 25  # as bits 4 MB
BLOCK = 1 << 16
FLUSH = 1 << 17
CHUNK = 1 << 12
MARKS = 1 << 40  # so many that phrases hardly share one
MIX = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def tokens(text: str) -> list[bytes]:
    """Words of a text, A-Z in lower case, and a ``BREAK`` between its pieces."""
    return TOKEN.findall(text.encode("utf-8", "surrogatepass").lower().translate(TABLE))


def word_counts(docs: DataFrame) -> DataFrame:
    """``lang, word, f`` of ``docs(lang, text)``; tasks fold their counts before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter[bytes]] = {}

        def flushed() -> Iterator[pa.RecordBatch]:
            for lang, counts in held.items():
                counts.pop(BREAK, None)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(counts), pa.string()), pa.array(counts.keys(), pa.binary()).cast(pa.string()),
                                                  pa.array(counts.values(), pa.int64())], ["lang", "word", "f"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.setdefault(lang, Counter()).update(tokens(text.as_py()))
                if sum(map(len, held.values())) >= FLUSH:
                    yield from flushed()
                    held.clear()
        yield from flushed()

    return docs.mapInArrow(run, "lang string, word string, f long").groupBy("lang", "word").agg(F.sum("f").alias("f"))


def _closed(ids: np.ndarray) -> np.ndarray:
    """Runs of zeros as one zero, none at the start and one at the end."""
    keep = ids != 0
    keep[1:] |= ids[:-1] != 0
    ids = ids[keep]
    return ids if not len(ids) or ids[-1] == 0 else np.append(ids, np.int32(0))


def encoded(docs: DataFrame, words: DataFrame, dictionary: int) -> DataFrame:
    """``ids``: blocks of word numbers (32 bits each) of all texts, 0 for a break or a word without a number.

    ``words(lang, word, id)`` are numbered from 1. They are broadcast ``dictionary`` words at a time; the words of
    later parts are found in further passes over the tokens.
    """
    spark, total = docs.sparkSession, words.count()
    parts = max(1, -(-total // dictionary))
    state = docs.select("lang", "text", F.lit(None).cast("binary").alias("ids"))
    for part in range(parts):
        known: dict[str, dict[bytes, int]] = {}
        chosen = words.where((F.col("id") > part * dictionary) & (F.col("id") <= (part + 1) * dictionary))
        for lang, word, number in zip(*(c.to_pylist() for c in chosen.select("lang", "word", "id").toArrow().columns)):
            known.setdefault(lang, {})[word.encode()] = number
        shared, last = spark.sparkContext.broadcast(known), part == parts - 1

        def numbers(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
            for lang, text, ids in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                find, words_ = shared.value.get(lang, {}).get, tokens(text.as_py())
                found = np.fromiter((find(w, 0) for w in words_), np.int32, len(words_))
                yield found if ids is None else found + np.frombuffer(ids, np.int32)

        def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x.tobytes() for x in numbers(batch)], pa.binary())],
                                                 ["lang", "text", "ids"])

        def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, size = [], 0
            for batch in batches:
                for ids in numbers(batch):
                    held.append(_closed(ids))
                    size += len(held[-1])
                    if size >= BLOCK:
                        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(held).tobytes()], pa.binary())], ["ids"])
                        held, size = [], 0
            if size:
                yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(held).tobytes()], pa.binary())], ["ids"])

        state = stage(state.mapInArrow(close, "ids binary") if last else state.mapInArrow(fill, "lang string, text string, ids binary"), "word-numbers")
    return state


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for ids in batch.column(0):
            yield np.frombuffer(ids.as_py(), np.int32)


def _places(x: np.ndarray, k: int) -> np.ndarray:
    """Where ``k`` words follow each other without a 0."""
    n = len(x) - k + 1
    whole = np.ones(max(0, n), bool)
    for j in range(k):
        whole &= x[j:j + n] != 0
    return np.flatnonzero(whole)


def marks(columns: list[np.ndarray]) -> np.ndarray:
    """The mark of each phrase, given its first words, second words and so on."""
    mark = np.full(len(columns[0]), len(columns), np.uint64)
    for c in columns:
        mark = (mark * np.uint64(MIX[0]) + c.astype(np.uint64)) * np.uint64(MIX[1])
        mark ^= mark >> np.uint64(31)
    return (mark % np.uint64(MARKS)).astype(np.int64)


def _has(bits: np.ndarray, mark: np.ndarray) -> np.ndarray:
    at = mark % SLOTS
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _safe(x: np.ndarray, k: int, common: np.ndarray | None) -> np.ndarray:
    """Places of ``k`` words whose two phrases of one word less may be common."""
    at = _places(x, k)
    if common is not None:
        for shift in (0, 1):
            at = at[_has(common, marks([x[at + shift + j] for j in range(k - 1)]))]
    return at


def _bitmap(found: DataFrame) -> np.ndarray:
    """The ``mark`` values of ``found`` as ``SLOTS`` bits."""
    place = F.pmod("mark", F.lit(SLOTS)) + 1  # buckets of 32,768 bits are numbered from 1, their bits from 0
    rows = found.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    bits = np.zeros((SLOTS // 32768, 4096), np.uint8)
    for row in rows.toLocalIterator():  # SLOTS / 32768 at most
        bits[row.bucket - 1] = np.frombuffer(bytes(row.bits), np.uint8)
    return bits.ravel()


def _filled_marks(texts: DataFrame, k: int, common, least: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flushed() -> pa.RecordBatch:
            at, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(at), pa.array(n.astype(np.int64))], ["mark", "n"])

        for x in _blocks(batches):
            at = _safe(x, k, common and common.value)
            held.append(marks([x[at + j] for j in range(k)]))
            size += len(at)
            if size >= 4 * FLUSH:
                yield flushed()
                held, size = [], 0
        if size:
            yield flushed()

    return texts.mapInArrow(run, "mark long, n long").groupBy("mark").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("mark")


def names(k: int, start: int = 1) -> list[str]:
    return [f"w{i}" for i in range(start, start + k)]


def _columns(rows: np.ndarray) -> list[pa.Array]:
    return [pa.array(np.ascontiguousarray(rows[:, j])) for j in range(rows.shape[1])]


def _distinct(rows: np.ndarray) -> np.ndarray:
    if not len(rows):
        return rows
    rows = rows[np.lexsort(rows.T[::-1])]
    new = np.ones(len(rows), bool)
    new[1:] = np.any(rows[1:] != rows[:-1], axis=1)
    return rows[new]


def candidates(texts: DataFrame, k: int, common: DataFrame, common_bits, least: int) -> DataFrame:
    """Numbered phrases of ``k`` words that may be common: ``id`` from 1 in word order, ``w1`` to ``wk``.

    ``common`` are the common phrases of a word less, ``common_bits`` their marks (not needed for single words, which
    have no number unless they are common).
    """
    spark = texts.sparkSession
    filled = stage(_filled_marks(texts, k, common_bits, least), "filled-marks")
    bits = spark.sparkContext.broadcast(_bitmap(filled))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((0, k), np.int32)

        def packed() -> pa.RecordBatch:
            bucket = marks(list(held.T)) % buckets
            rows = held[order := np.argsort(bucket, kind="stable")]
            hit, begin = np.unique(bucket[order], return_index=True)
            return pa.RecordBatch.from_arrays([pa.array(hit), pa.array([part.tobytes() for part in np.split(rows, begin[1:])][:len(hit)], pa.binary())],
                                              ["bucket", "phrases"])

        for x in _blocks(batches):
            at = _safe(x, k, common_bits and common_bits.value)
            rows = np.column_stack([x[at + j] for j in range(k)])
            held = np.concatenate([held, _distinct(rows[_has(bits.value, marks(list(rows.T)))])])
            if len(held) >= 4 * FLUSH:
                held = _distinct(held)
                if len(held) >= 2 * FLUSH:
                    yield packed()
                    held = held[:0]
        held = _distinct(held)
        yield packed()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, more, size = np.empty((0, k), np.int32), [], 0
        for batch in batches:
            for phrases in batch.column(1).to_pylist():
                more.append(np.frombuffer(phrases, np.int32).reshape(-1, k))
                size += len(more[-1])
                if size >= max(4 * FLUSH, len(held)):
                    held, more, size = _distinct(np.concatenate([held, *more])), [], 0
        held = _distinct(np.concatenate([held, *more]))
        yield pa.RecordBatch.from_arrays([*_columns(held), pa.array(marks(list(held.T)))], [*names(k), "mark"])

    found = texts.mapInArrow(run, "bucket long, phrases binary").repartition("bucket").mapInArrow(merge, ", ".join(f"{w} int" for w in names(k)) + ", mark long")
    found = found.join(filled, "mark", "left_semi").select(names(k))
    if k > 2:
        shorter = common.select(names(k - 1))
        found = found.join(shorter, names(k - 1), "left_semi").join(
            shorter.toDF(*names(k - 1, 2)), names(k - 1, 2), "left_semi")
    return stage(ordinal(found.select(names(k)), names(k), "id"), "candidates")


class Trie:
    """A double-array trie of sorted distinct phrases of one length.

    A word number is read as its bytes, the highest first, so that the children of a state lie within 256 cells and the
    arrays stay dense. From state s the byte c leads to ``base[s] + c`` if ``check`` there is s. States of the last level
    accept; ``phrase`` is the number of the accepted phrase. The root is state 0.
    """

    def __init__(self, rows: np.ndarray):
        n, self.words = rows.shape
        self.shifts = range(8 * (max(1, (int(rows.max(initial=0)).bit_length() + 7) // 8) - 1), -1, -8)
        rows = np.column_stack([rows[:, j] >> shift & 255 for j in range(self.words) for shift in self.shifts])
        k = rows.shape[1]
        self.size = n
        self.used = np.zeros(2 * n * k + 1024, bool)
        self.used[0] = True
        self.base = np.zeros(len(self.used), np.int32)
        self.check = np.full(len(self.used), -1, np.int32)
        self.free = 1
        owner, first = np.zeros(1, np.int64), np.zeros(1, np.int64)  # states of a level, and where their rows begin
        for level in range(k):
            new = np.zeros(n, bool)
            new[first] = True
            if n > 1:
                new[1:] |= rows[1:, level] != rows[:-1, level]
            begin = np.flatnonzero(new)  # rows where a child of this level begins
            parent = np.searchsorted(first, begin, "right") - 1
            owner, first = self._place(owner, parent, rows[begin, level].astype(np.int64), len(first)), begin
        self.phrase = np.full(len(self.used), -1, np.int32)
        self.phrase[owner] = np.arange(n)
        end = int(np.flatnonzero(self.used)[-1]) + 1
        self.base, self.check, self.phrase = self.base[:end], self.check[:end], self.phrase[:end]
        del self.used

    def _room(self, size: int) -> None:
        if size > len(self.used):
            more = max(size, 2 * len(self.used)) - len(self.used)
            self.used = np.append(self.used, np.zeros(more, bool))
            self.base = np.append(self.base, np.zeros(more, np.int32))
            self.check = np.append(self.check, np.full(more, -1, np.int32))

    def _place(self, owner: np.ndarray, parent: np.ndarray, label: np.ndarray, parents: int) -> np.ndarray:
        """States for the children of a level, the parents with most children first."""
        counts = np.bincount(parent, minlength=parents)
        begin = np.concatenate(([0], np.cumsum(counts)))
        state = np.empty(len(label), np.int64)
        for p in sorted(np.flatnonzero(counts > 1).tolist(), key=lambda p: -counts[p]):
            labels = label[begin[p]:begin[p + 1]]
            base = self._fit(labels)
            state[begin[p]:begin[p + 1]] = cells = base + labels
            self.base[owner[p]] = base
            self.used[cells] = True
            self.check[cells] = owner[p]
        single = np.flatnonzero(counts[parent] == 1)  # these fit anywhere
        if len(single):
            self._room(int(self.used.sum()) + len(single) + 1)
            cells = np.flatnonzero(~self.used)[:len(single)]
            state[single] = cells
            self.base[owner[parent[single]]] = cells - label[single]
            self.used[cells] = True
            self.check[cells] = owner[parent[single]]
        return state

    def _fit(self, labels: np.ndarray) -> int:
        """A base whose cells for all ``labels`` are free; beyond all used cells if none is found soon."""
        spread = labels - labels[0]
        self._room(self.free + 4096 + int(spread[-1]) + 1)
        at = self.free
        for _ in range(64):
            self._room(at + 256 + int(spread[-1]) + 1)
            open_ = at + np.flatnonzero(~self.used[at:at + 256])
            if len(open_) < 8 and at == self.free:
                self.free = at + 256  # nearly full: not looked at again but by single children
            if len(open_):
                fits = ~self.used[open_[:, None] + spread].any(axis=1)
                if fits.any():
                    return int(open_[np.argmax(fits)] - labels[0])
            at += 256
        end = int(np.flatnonzero(self.used)[-1]) + 1
        self._room(end + int(spread[-1]) + 1)
        return int(end - labels[0])

    def advance(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The accepting states that places ``at`` of the text reach, all places moved together level by level."""
        state = np.zeros(len(at), np.int64)
        for word in range(self.words):
            for shift in self.shifts:
                to = self.base[state] + (x[at + word] >> shift & 255)
                to[(to < 0) | (to >= len(self.check))] = 0
                alive = self.check[to] == state
                alive &= to != 0
                state, at = to[alive].astype(np.int64), at[alive]
        return state


def counted(texts: DataFrame, found: DataFrame, k: int, least: int, shard: int) -> DataFrame:
    """The common ones of the candidate phrases: ``w1`` to ``wk``, ``f``."""
    spark, total = texts.sparkSession, found.count()
    sums = None
    for begin in range(0, total, shard):
        part = found.where((F.col("id") > begin) & (F.col("id") <= begin + shard)).orderBy("id").select(names(k)).toArrow()
        trie = spark.sparkContext.broadcast(Trie(np.column_stack([c.to_numpy() for c in part.columns])))

        def run(batches: Iterator[pa.RecordBatch], trie=trie, begin=begin) -> Iterator[pa.RecordBatch]:
            machine = trie.value
            counts = np.zeros(-(-machine.size // CHUNK) * CHUNK, np.int64)
            for x in _blocks(batches):
                counts += np.bincount(machine.phrase[machine.advance(x, _places(x, k))], minlength=len(counts))
            chunks = counts.reshape(-1, CHUNK)
            hit = np.flatnonzero(chunks.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(hit * CHUNK + begin + 1), pa.array([chunks[i].tobytes() for i in hit], pa.binary())], ["first", "counts"])

        some = texts.mapInArrow(run, "first long, counts binary")
        sums = some if sums is None else sums.unionByName(some)
    if sums is None:
        return found.select(*names(k), F.lit(0).cast("long").alias("f")).limit(0)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.zeros(CHUNK, np.int64)

        def common() -> pa.RecordBatch:
            hit = np.flatnonzero(total >= least)
            return pa.RecordBatch.from_arrays([pa.array(hit + now), pa.array(total[hit])], ["id", "f"])

        for batch in batches:
            for first, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if first != now:
                    if now is not None:
                        yield common()
                    now, total = first, np.zeros(CHUNK, np.int64)
                total += np.frombuffer(counts, np.int64)
        if now is not None:
            yield common()

    common = sums.repartition("first").sortWithinPartitions("first").mapInArrow(add, "id long, f long")
    return stage(found.join(common, "id").select(*names(k), "f"), "common-phrases")


def _marks_of(phrases: DataFrame, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(marks([c.to_numpy() for c in batch.columns]))], ["mark"])

    return phrases.select(names(k)).mapInArrow(run, "mark long")


def common_phrases(texts: DataFrame, words: DataFrame, least: int, longest: int, shard: int) -> DataFrame:
    """``ids, f``: all phrases of up to ``longest`` words that occur at least ``least`` times, single words included."""
    level = words.select(F.col("id").cast("int").alias("w1"), "f")
    found, bits = level.select(F.array("w1").alias("ids"), "f"), None
    for k in range(2, longest + 1):
        level = counted(texts, candidates(texts, k, level, bits, least), k, least, shard)
        if level.isEmpty():
            break
        found = found.unionByName(level.select(F.array(*names(k)).alias("ids"), "f"))
        if k < longest:
            bits = texts.sparkSession.sparkContext.broadcast(_bitmap(_marks_of(level, k)))
    return stage(found, "phrases")


def _exact(*factors: Column) -> Column:
    product = factors[0].cast("decimal(38,0)")
    for f in factors[1:]:
        product = product * f.cast("decimal(38,0)")
    return product


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 100, longest: int = 5, scale: int = 1000,
                 inside: int = 100, top: int | None = 2000, dictionary: int = 500_000, shard: int = 250_000) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of 2 to ``longest`` words of each language (all, if None).

    A phrase that occurs ``a`` times among the language's ``n`` words, cut into parts that occur ``l`` and ``r`` times, has the
    score ``floor(scale * a * n / (l * r))`` of its worst cut. A phrase inside a longer one with at least
    ``inside`` hundredths of its occurrences is left out.
    """
    given = docs.where(F.col(text_col).isNotNull()).select(F.coalesce(lang_col, F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    counts = stage(word_counts(given), "word-counts")
    totals = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    words = stage(ordinal(counts.where(F.col("f") >= least), ["lang", "word"], "id"), "words")
    phrases = common_phrases(encoded(given, words, dictionary), words, least, longest, shard)

    size = F.size("ids")
    several = phrases.where(size > 1)
    cuts = several.select("ids", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.withColumns({"left": F.slice("ids", F.lit(1), F.col("k")), "right": F.slice("ids", F.col("k") + 1, size - F.col("k"))})
    parts = cuts.join(phrases.select(F.col("ids").alias("left"), F.col("f").alias("l")), "left").join(
        phrases.select(F.col("ids").alias("right"), F.col("f").alias("r")), "right")
    owners = words.select(F.col("id").cast("int").alias("first"), "lang").join(totals, "lang")
    parts = parts.withColumn("first", F.get("ids", F.lit(0))).join(owners, "first")
    parts = parts.withColumns({"above": _exact(F.lit(scale), F.col("a"), F.col("n")), "below": _exact(F.col("l"), F.col("r"))})
    scored = parts.groupBy("lang", "n", "ids", "a").agg(F.min(F.struct(F.expr("above div below").alias("score"), "k", "l", "r")).alias("cut"))

    length = F.col("part")
    within = several.where(size > 2).select("ids", "f", F.explode(F.sequence(F.lit(2), size - 1)).alias("part"))
    within = within.select("ids", "f", "part", F.explode(F.sequence(F.lit(1), size - length + 1)).alias("start"))
    within = within.select(F.slice("ids", F.col("start"), length).alias("ids"), "f").groupBy("ids").agg(F.max("f").alias("longer"))
    kept = scored.join(within, "ids", "left").where(F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("a")))

    spelled = kept.select("ids", F.posexplode("ids").alias("pos", "id")).join(words.select(F.col("id").cast("int").alias("id"), "word"), "id")
    spelled = spelled.groupBy("ids").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "word"))), lambda w: w.word), " ").alias("phrase"))
    rows = kept.join(spelled, "ids").select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(order).cast("long"))
    ranked = ranked if top is None else ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

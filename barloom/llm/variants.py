"""Spelling variants of a vocabulary, by composing finite-state machines.

The vocabulary is an acyclic acceptor A. With the transducer T of one edit (insert, delete or replace one code
point) the composition A . T . A accepts exactly the pairs of words that are one edit apart. Its states are
(p, e, q): a state of A on each side, and whether the edit has been made. Before the edit p = q, and that
state is named by the prefix read so far; after it both sides read the same letters.

The composition is enumerated by its initial states, each on its own. From the start, a state whose words have
more than ``block`` letters is opened in steps of 1, 1, 2, 4, 8 .. letters: the edits that leave it within the
step reach states after the edit, where the rest of both words is equal, so their pairs are a join on hashes
of what is left of a word without one letter (checked letter by letter); words that agree over the step go on
to the state named by their longer prefix. A state that is small enough is one unit of work: its words are made
into a minimised acceptor, and pairs are read off the composition of that acceptor with T and itself. The
number of steps is at most twice the logarithm of the longest word, every word sends a number of hashes that is
at most its length, and no unit of work exceeds ``block`` letters, however many words share a prefix. Each
pair is found at one state alone: the one named by the longest common prefix of its words.

Defined results: a null text has no words, a null id counts as an empty one, repeated rows count again, an
empty table has no words; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.session import stage

RUN = re.compile("[a-zÀ-ÿ]+")
FLUSH = 1 << 18
#: two primes below 2**31 and a base for each; a hash of letters has both remainders
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_000_003, 998_244_353)


def runs(text: str) -> list[str]:
    """Maximal runs of letters, A-Z in lower case."""
    return RUN.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))


def damaged(run: str, mark: int, every: int) -> str:
    """The run without one letter if ``every`` divides ``mark``."""
    if mark % every:
        return run
    at = mark % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 6, least: int = 5,
                every: int = 199) -> DataFrame:
    """``word, n``: words of at least ``shortest`` letters that occur at least ``least`` times.

    A run whose CRC-32, together with the id, is divisible by ``every`` loses a letter. Tasks fold their
    counts before the shuffle, ``FLUSH`` words at a time.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def flushed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                seed = zlib.crc32(f"{key.as_py() or ''}:".encode())
                for run, n in Counter(runs(text.as_py() or "")).items():
                    mark = zlib.crc32(run.encode(), seed)
                    word = damaged(run, mark, every) if mark % every == 0 else run
                    if len(word) >= shortest:
                        held[word] += n
                if len(held) >= FLUSH:
                    yield flushed()
                    held.clear()
        if held:
            yield flushed()

    given = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    found = given.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return found.where(F.col("n") >= least)


class Acceptor:
    """The minimal acyclic automaton of sorted distinct words; children have smaller numbers than parents, the root is last."""

    def __init__(self, words: Iterable[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        known: dict[tuple, int] = {}
        path: list[list] = [[{}, False, ""]]  # arcs, final, letter from its parent

        def close(depth: int) -> None:
            while len(path) > depth:
                arcs, final, letter = path.pop()
                name = (final, *arcs.items())
                at = known.get(name)
                if at is None:
                    at = known[name] = len(self.arcs)
                    self.arcs.append(arcs)
                    self.final.append(final)
                path[-1][0][letter] = at

        last = ""
        for word in words:
            shared = 0
            for a, b in zip(last, word):
                if a != b:
                    break
                shared += 1
            close(shared + 1)
            path.extend([{}, False, letter] for letter in word[shared:])
            path[-1][1] = True
            last = word
        close(1)
        self.root = len(self.arcs)
        self.arcs.append(path[0][0])
        self.final.append(path[0][1])

    def both(self, p: int, q: int) -> Iterator[str]:
        """What the states p and q both accept."""
        todo = [(p, q, "")]
        while todo:
            p, q, read = todo.pop()
            if self.final[p] and self.final[q]:
                yield read
            left, right = self.arcs[p], self.arcs[q]
            if len(left) > len(right):
                left, right = right, left
            for letter, to in left.items():
                other = right.get(letter)
                if other is not None:
                    todo.append((to, other, read + letter))

    def edits(self, state: int) -> list[tuple[str, str]]:
        """Pairs that the composition accepts from (state, no edit, state) with the edit on the first letter."""
        found = []
        arcs = list(self.arcs[state].items())
        for i, (a, p) in enumerate(arcs):
            for b, q in arcs[i + 1:]:
                found += [(a + rest, b + rest) for rest in self.both(p, q)]
            # one letter less; of a run of equal letters the last counts, so a pair comes once
            found += [(a + rest, rest) for rest in self.both(p, state) if not rest.startswith(a)]
        return found

    def pairs(self) -> Iterator[tuple[str, str]]:
        """All pairs of accepted words one edit apart, once each."""
        edits = [self.edits(state) for state in range(len(self.arcs))]
        useful = []
        for state, arcs in enumerate(self.arcs):
            useful.append(bool(edits[state]) or any(useful[to] for to in arcs.values()))
        todo = [(self.root, "")] if useful[self.root] else []
        while todo:
            state, read = todo.pop()
            for u, v in edits[state]:
                yield read + u, read + v
            todo += [(to, read + letter) for letter, to in self.arcs[state].items() if useful[to]]


def _by_state(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, int]]:
    """Words and counts of one state after the other, from batches sorted by state and word."""
    state, held = None, {}
    for batch in batches:
        for name, word, n in zip(*(c.to_pylist() for c in batch.columns)):
            if name != state:
                if held:
                    yield held
                state, held = name, {}
            held[word] = n
    if held:
        yield held


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for words in _by_state(batches):
        u, v = [], []
        for a, b in Acceptor(words).pairs():
            u.append(a)
            v.append(b)
            if len(u) == FLUSH:
                yield _pairs(u, v, words)
                u, v = [], []
        if u:
            yield _pairs(u, v, words)


def _pairs(u: list[str], v: list[str], n: dict[str, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array([n[w] for w in u], pa.int64()), pa.array(v),
                                       pa.array([n[w] for w in v], pa.int64())], ["u", "n_u", "v", "n_v"])


#: letters of the words in a batch of opened rows
OPENED_LETTERS = 1 << 24


def gap_hashes(word: str, begin: int, end: int) -> tuple[int, np.ndarray]:
    """A hash of the word, and of the word without its letter at each place from ``begin`` to ``end``."""
    letters = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.int64) + 1
    whole, gaps = 0, np.zeros(max(0, min(end, len(word)) - begin), np.int64)
    at = np.arange(begin, begin + len(gaps))
    for prime, base in zip(PRIMES, BASES):
        power = np.ones(len(letters), np.int64)
        have = 1
        while have < len(letters):  # powers by doubling
            more = min(have, len(letters) - have)
            power[have:have + more] = power[:more] * pow(base, have, prime) % prime
            have += more
        sums = np.concatenate(([0], np.cumsum(letters * power % prime))) % prime
        total = int(sums[-1])
        after = (total - sums[at + 1]) % prime * pow(base, -1, prime) % prime
        whole = whole << 31 | total
        gaps = gaps << 31 | (sums[at] + after) % prime
    return whole, gaps


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of words in opened states: the hash of each word, and of it without one letter of the step. A word comes once for
    each hash, so batches end by their letters: many long words together pass the 2 GB of an Arrow string column."""
    names = ["hash", "place", "word", "n", "step"]

    def rows(batch: pa.RecordBatch, hashes: list, places: list, at: list) -> pa.RecordBatch:
        taken = pa.array(np.concatenate(at))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(hashes).astype(np.int64)), pa.array(np.concatenate(places).astype(np.int32)),
             batch.column(0).take(taken), batch.column(1).take(taken), batch.column(3).take(taken)], names)

    for batch in batches:
        hashes, places, at, letters = [], [], [], 0
        for i, (word, begin, end) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 2, 3)))):
            whole, gaps = gap_hashes(word, begin, end)
            mine, where = np.append(gaps, whole), np.append(np.arange(begin, begin + len(gaps)), -1)
            most = max(1, OPENED_LETTERS // max(1, len(word)))
            for first in range(0, len(mine), most):
                part = mine[first:first + most]
                hashes.append(part)
                places.append(where[first:first + most])
                at.append(np.full(len(part), i))
                letters += len(part) * (len(word) + 1)
                if letters >= OPENED_LETTERS:
                    yield rows(batch, hashes, places, at)
                    hashes, places, at, letters = [], [], [], 0
        if hashes:
            yield rows(batch, hashes, places, at)


def near_pairs(vocabulary: DataFrame, block: int = 1 << 17) -> DataFrame:
    """``u, n_u, v, n_v``: all pairs of the distinct words of ``vocabulary(word, n)`` one edit apart, once each."""
    words = stage(vocabulary.select("word", "n"), "vocabulary")
    letters = words.agg(F.sum(F.length("word"))).first()[0] or 0
    tasks = max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-letters // block))  # small in bytes, long in work
    live, level = words.withColumn("state", F.lit("")), 0
    units, opened = [], []
    while True:
        sizes = stage(live.groupBy("state").agg(F.sum(F.length("word")).alias("letters"), F.count("*").alias("words")).where(
            F.col("words") > 1), "states")
        large = F.col("letters") > block
        units.append(live.join(sizes.where(~large), "state", "left_semi").select("state", "word", "n"))
        if sizes.where(large).isEmpty():
            break
        inside = live if not level else live.join(sizes.where(large), "state", "left_semi")
        end = max(1, 2 * level)
        opened.append(inside.select("word", "n", F.lit(level).alias("begin"), F.lit(end).alias("end")))
        live = stage(inside.where(F.length("word") >= end).select("word", "n", F.left("word", F.lit(end)).alias("state")), "live-words")
        level = end
    found = units[0]
    for unit in units[1:]:
        found = found.unionByName(unit)
    pairs = found.repartition(tasks, "state").sortWithinPartitions("state", "word").mapInArrow(_composed, "u string, n_u long, v string, n_v long")
    if not opened:
        return pairs
    rows = opened[0]
    for row in opened[1:]:
        rows = rows.unionByName(row)
    rows = stage(rows.repartition(tasks, "word").mapInArrow(_opened, "hash long, place int, word string, n long, step int"), "opened")
    gaps = rows.where("place >= 0").select("hash", "place", "step", F.col("word").alias("u"), F.col("n").alias("n_u"))
    others = gaps.select("hash", "place", "step", F.col("u").alias("v"), F.col("n_u").alias("n_v"))
    wholes = rows.where("place < 0").select("hash", "step", F.col("word").alias("v"), F.col("n").alias("n_v"))
    # a group has a word for each letter of the alphabet at most
    replaced = gaps.join(others, ["hash", "place", "step"]).where((F.col("u") < F.col("v")) & (_without("u") == _without("v")))
    shorter = gaps.join(wholes, ["hash", "step"]).where((_without("u") == F.col("v")) & (_letter("u") != _letter("v")))
    columns = ["u", "n_u", "v", "n_v"]
    return pairs.unionByName(replaced.select(columns)).unionByName(shorter.select(columns))


def _without(word: str):
    return F.concat(F.left(word, F.col("place")), F.substr(word, F.col("place") + 2))


def _letter(word: str):
    return F.substr(word, F.col("place") + 1, F.lit(1))


def variants(vocabulary: DataFrame, factor: int = 5, block: int = 1 << 17) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of ``vocabulary(word, n)``.

    ``form`` is the commonest near word (ties: the smallest) if it is ``factor`` times as common as the word,
    ``root`` the end of the chain of forms. Each form is ``factor`` times as common as the one before, which
    bounds the chain by a logarithm; it is followed by doubling.
    """
    words = stage(vocabulary.select("word", "n"), "words")
    pairs = stage(near_pairs(words, block), "near-pairs")
    both = pairs.select(F.col("u").alias("word"), F.col("v").alias("near"), F.col("n_v").alias("near_n")).unionByName(
        pairs.select(F.col("v").alias("word"), F.col("u").alias("near"), F.col("n_u").alias("near_n")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    common = -F.col("best.minus") >= factor * F.col("n")
    joined = stage(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(common, F.col("best.near")).alias("form"),
        F.when(common, -F.col("best.minus")).alias("form_n")), "forms")
    roots = stage(joined.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if roots.join(on, "root", "left_semi").isEmpty():
            break
        roots = stage(roots.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    return joined.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

"""Benchmark decontamination: find test n-grams in training text and remove spans or documents.

The test set is turned into distinct normalised word windows. Their hashes and lengths alone are broadcast, in
blocks of a fixed number of rows, so a broadcast never exceeds ``block_windows`` such pairs however large the test set is
and however many items share a window. Documents are split into words once per block, every window of a document is
hashed and looked up in the broadcast hash table. Hits are verified in a second read of the documents that have any: their
words at the hit are joined with the words of the window, and only then with the items that hold it. The
words of a document are never copied for each of its windows, so the work is linear in its length. Only
hits and one row per document are shuffled. Everything is SQL expressions.

Defined results: a null text has no words; an item or document without words never matches; repeated
rows each get their own result; items that repeat an id count once; a null item id is written ``null``.
Columns of the inputs other than the id and the text are carried by the ``remove_*`` functions and are
otherwise ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.columns import free_names
from barloom.session import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: the same words in a text whose capitals are still there
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, also where it is used for each element of an array."""
    return F.element_at(F.transform(F.array(value), use), 1)


def word_list(text: Column) -> Column:
    """The normalised words of a text."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BREAK), "")


def _starts(words: Column, length: int) -> Column:
    """Start positions of all windows of ``length`` words; empty for shorter texts."""
    last = F.size(words) - length
    return F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))


def _joint_hash(hashes: Column, at: Column, length: int) -> Column:
    """One hash for the ``length`` word hashes from ``at`` on."""
    return F.xxhash64(F.lit(length), *[F.get(hashes, at + k) for k in range(length)])


def _window_hashes(hashes: Column, length: int) -> Column:
    return F.transform(_starts(hashes, length), lambda at: _joint_hash(hashes, at, length))


def benchmark_windows(benchmark: DataFrame, n: int = 10, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item, gram, length, hash``: each window (its words) of each item once.

    An item of fewer than ``n`` words, but not none, is one window.
    """
    items = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"), word_list(F.col(text_col)).alias("words"))
    items = items.where(F.size("words") > 0).withColumn("length", F.least(F.size("words"), F.lit(n)))
    grams = items.select("item", "length", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("words") - F.col("length") + 1), lambda i: F.slice(F.col("words"), i, F.col("length")))).alias("gram"))
    hashes, joint = F.transform("gram", lambda w: F.xxhash64(w)), F.lit(None).cast("long")
    for k in range(1, n + 1):
        joint = F.when(F.col("length") == k, _joint_hash(hashes, F.lit(0), k)).otherwise(joint)
    return grams.distinct().withColumn("hash", joint)


def scan(docs: DataFrame, benchmark: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", block_windows: int = 500_000) -> DataFrame:
    """One row per document row: ``doc_id, text_key, n_words, hits, items``.

    ``hits`` are the sorted positions of words inside occurring windows, ``items`` the sorted ids of the
    items with occurring windows, ``text_key`` tells rows of one id with different texts apart.
    """
    grams = stage(benchmark_windows(benchmark, n, item_col, item_text_col), "benchmark-windows")
    windows = grams.select("hash", "length").distinct()
    total, lengths = windows.agg(F.count("*"), F.collect_set("length")).first()  # at most n lengths
    blocks = max(1, -(-total // block_windows))
    words = word_list(F.col(text_col))
    base = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.transform(words, lambda w: F.xxhash64(w)).alias("hashes"))
    found = None
    for block in range(blocks):
        part = windows.where(F.pmod(F.col("hash"), F.lit(blocks)) == block) if blocks > 1 else windows
        hits = _hits(base, part, sorted(lengths), count=block == 0)
        found = hits if found is None else found.unionByName(hits)
    # a repeated row repeats its hits, so its copies are folded together here and unfolded at the end
    merged = stage(found.groupBy("doc_id", "text_key").agg(
        F.max("n_words").alias("n_words"), F.sum("copies").alias("copies"), F.collect_set("hit").alias("found")), "found-windows")
    suspects = merged.where(F.size("found") > 0).select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"), "found")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key"))
    # keys alone first: where they are few enough to be broadcast, only the texts in question are shuffled
    read = texts.join(stage(suspects.select("id", "key"), "suspects"), same, "left_semi").join(suspects, same)
    there = let(word_list(F.col("text")), lambda w: F.transform("found", lambda h: F.struct(
        h.pos.alias("pos"), h.hash.alias("hash"), F.slice(w, h.pos + 1, h.length).alias("gram"))))
    claimed = read.select("id", "key", there.alias("there")).dropDuplicates(["id", "key"]).select("id", "key", F.inline("there"))
    real = stage(claimed.join(grams.select("hash", "gram").distinct(), ["hash", "gram"], "left_semi"), "verified-windows")
    spans = real.groupBy("id", "key").agg(F.collect_set(F.struct("pos", F.size("gram").alias("length"))).alias("spans"))
    holders = real.select("id", "key", "hash", "gram").distinct().join(grams, ["hash", "gram"])
    holders = holders.groupBy(F.col("id").alias("of_id"), F.col("key").alias("of_key")).agg(F.collect_set("item").alias("items"))
    verified = stage(spans.join(holders, F.col("id").eqNullSafe(F.col("of_id")) & (F.col("key") == F.col("of_key"))), "verified-documents")
    joined = merged.drop("found").join(verified, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key")), "left")
    places = F.transform("spans", lambda h: F.sequence(h.pos, h.pos + h.length - 1))
    return joined.select(
        "doc_id", "text_key", "n_words",
        F.coalesce(F.array_sort(F.array_distinct(F.flatten(places))), F.array().cast("array<int>")).alias("hits"),
        F.coalesce(F.array_sort("items"), F.array().cast("array<string>")).alias("items"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).drop("copy")


def _hits(base: DataFrame, windows: DataFrame, lengths: list[int], count: bool) -> DataFrame:
    """A row per window whose hash occurs, and with ``count`` one more row per document that counts it."""
    hashes = [_window_hashes(F.col("hashes"), k) for k in lengths]
    if count:
        hashes.append(F.array(F.lit(None).cast("long")))
    if not hashes:
        hashes = [F.array().cast("array<bigint>")]
    at = base.select("doc_id", "text_key", F.size("hashes").alias("size"), F.posexplode(F.concat(*hashes)).alias("at", "hash"))
    joined = at.join(F.broadcast(windows), "hash", "left" if count else "inner")
    # where in the joined list of windows a length begins
    begin, pos = F.lit(0), F.lit(None).cast("int")
    for k in lengths:
        pos = F.when(F.col("length") == k, F.col("at") - begin).otherwise(pos)
        begin = begin + F.greatest(F.col("size") - k + 1, F.lit(0))
    sentinel = F.col("hash").isNull()
    hit = F.when(F.col("length").isNotNull(), F.struct(pos.alias("pos"), "length", "hash"))
    return joined.where(F.col("length").isNotNull() | sentinel).select(
        "doc_id", "text_key", F.when(sentinel, F.col("size")).alias("n_words"),
        F.when(sentinel, F.lit(1)).otherwise(0).alias("copies"), hit.alias("hit"))


def remove_documents(docs: DataFrame, benchmark: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text",
                     **names) -> DataFrame:
    """The rows without any word inside an occurring window; all columns as they came."""
    of_id, of_key = free_names(docs, "id", "key")
    hit = stage(scan(docs, benchmark, n, id_col, text_col, **names).where(F.size("hits") > 0).select(
        F.col("doc_id").alias(of_id), F.col("text_key").alias(of_key)).distinct(), "hit-documents")  # its size is known before the join
    return docs.join(hit, (F.col(id_col).eqNullSafe(F.col(of_id))) & (F.xxhash64(text_col) == F.col(of_key)), "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text",
                 **names) -> DataFrame:
    """All rows, without the hit words and the break after each; texts without a hit stay as they are."""
    of_id, of_key, places = free_names(docs, "id", "key", "hits")
    hit = stage(scan(docs, benchmark, n, id_col, text_col, **names).where(F.size("hits") > 0).select(
        F.col("doc_id").alias(of_id), F.col("text_key").alias(of_key), F.col("hits").alias(places)).dropDuplicates([of_id, of_key]),
        "hit-documents")
    text = F.col(text_col)
    words, breaks = F.regexp_extract_all(text, F.lit(WORD), 0), F.split(text, WORD, -1)
    pieces = F.zip_with(words, F.slice(breaks, 2, F.size(breaks) - 1), lambda w, b: F.concat(w, b))
    kept = let(pieces, lambda p: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(p) - 1), F.col(places)), lambda i: F.get(p, i)), ""))
    cleaned = F.when(F.col(places).isNotNull(), F.concat(F.element_at(breaks, 1), kept)).otherwise(text)
    joined = docs.join(hit, (F.col(id_col).eqNullSafe(F.col(of_id))) & (F.xxhash64(text_col) == F.col(of_key)), "left")
    return joined.withColumn(text_col, cleaned).select(*[f"`{c}`" for c in docs.columns])

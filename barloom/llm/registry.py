"""Registered queries over the test tables and, where SQL can express the result, their oracle SQL."""

from __future__ import annotations

import secrets
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import (
    collocations, decontaminate, html_text, neighbours, packing, pii, quality, setjoin, simhash, substrings, toxicity, variants, warc,
)
from barloom.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sha256_hex(text):
    return F.sha2(F.encode(text, "UTF-8"), 256)


@query("op4_decontaminate", r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    g AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS gram
          FROM (SELECT item_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
                FROM (SELECT *, least(10, len(w)) AS k FROM b WHERE len(w) > 0))),
    lengths AS (SELECT DISTINCT k FROM g),
    h AS (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS gram
          FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM d, lengths WHERE len(w) >= k)),
    hits AS (SELECT h.doc_id, h.i, h.k, g.item_id FROM h JOIN g ON h.gram = g.gram AND h.k = g.k),
    covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit
                FROM (SELECT DISTINCT doc_id, unnest(generate_series(i, i + k - 1)) AS p FROM hits) GROUP BY doc_id),
    found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
              FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)""")
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test windows of ten words in all documents."""
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), n=10)
    return found.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), sha256_hex(F.array_join("items", ",")).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"))


@query("op9_simhash")
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of fingerprints that differ in at most four bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4, seed=42)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op6_packing")
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1,024 tokens."""
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), packing.public_vocabulary(), capacity=1024, end_id=2)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op10_quality")
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learned from the labelled ones that are not held out."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


@query("op5_substrings")
def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without windows of fifty words that an earlier document has."""
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), window=50, period=31)


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of all documents, learned from the labelled ones that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.severity(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query("op2_warc", """
    WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
    q AS (SELECT page_id, strlen(h) AS n, sha1(h) AS d, max(page_id) OVER (PARTITION BY h) AS m FROM p)
    SELECT page_id, n AS payload_bytes, d AS payload_digest,
           CASE WHEN n >= 1000 AND page_id < m THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN n >= 1000 AND page_id < m THEN m END AS refers_to
    FROM q""")
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as an archive and read back; a gap in it is an error."""
    path = scratch_path(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    found = warc.read_archive(spark, path, with_payload=False, max_member=None).where(F.when(F.col("kind") == "record", True).otherwise(
        F.raise_error(F.concat_ws(" ", F.lit("gap in"), "path", F.lit("at"), "offset", "reason")).cast("boolean")))
    return found.select(warc.page_id(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                        warc.page_id(F.col("refers_to")).alias("refers_to"))


@query("op1_neighbours")
def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector among all others."""
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(20)) == 0, k=20)


@query("op8_html")
def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    found = html_text.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


KEY_SETTING = "spark.barloom.surrogateKey"
_own_keys: dict[str, str] = {}


def surrogate_key(spark: SparkSession) -> str:
    """The secret that surrogates are made with, from the session's ``KEY_SETTING``. Where it is not set, a random one
    for the application, so that surrogates can be redone by nobody, and not by a later run either."""
    given = spark.conf.get(KEY_SETTING, None)
    application = spark.sparkContext.applicationId
    return given or _own_keys.setdefault(application, secrets.token_hex(16))


@query("op7_surrogates")
def op7_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced."""
    found = pii.replace(table(spark, sf_dir, "documents").select("doc_id", "text"), surrogate_key(spark), count_col="n_replaced")
    return found.select("doc_id", "text", "n_replaced")


@query("op11_variants", r"""
    WITH RECURSIVE t AS (
      SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, x: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)
                  ORDER BY i) AS tab FROM range(256) r(i)),
    r AS (SELECT doc_id, run, count(*) AS c
          FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                         '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL),
    b AS (SELECT run, c, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
                 lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)] ELSE [195, unicode(x) - 64] END)) AS bytes FROM r),
    h AS (SELECT run, c, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), CAST(bytes AS BIGINT[])),
                 lambda s, x: xor(s >> 8, tab[(xor(s, x) & 255) + 1])), 4294967295) AS h FROM b, t),
    v AS (SELECT word, CAST(sum(c) AS BIGINT) AS n
          FROM (SELECT CASE WHEN h % 199 = 0 THEN run[:h % len(run)] || run[h % len(run) + 2:] ELSE run END AS word, c FROM h)
          WHERE len(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
    g AS (SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest FROM (SELECT word, n, unnest(range(1, len(word) + 1)) AS i FROM v)),
    p AS (SELECT a.word, b.word AS near, b.n AS near_n FROM g a JOIN g b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
          UNION SELECT g.word, v.word, v.n FROM g JOIN v ON g.rest = v.word
          UNION SELECT v.word, g.word, g.n FROM g JOIN v ON g.rest = v.word),
    k AS (SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS near, max(near_n) AS near_n FROM p GROUP BY word),
    f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * n THEN near END AS form,
                 CASE WHEN near_n >= 5 * n THEN near_n END AS form_n FROM v LEFT JOIN k USING (word)),
    chain AS (SELECT word, word AS at FROM f UNION ALL SELECT chain.word, f.form FROM chain JOIN f ON f.word = chain.at WHERE f.form IS NOT NULL)
    SELECT f.word, f.form, chain.at AS root, f.n, f.n_near, f.form_n
    FROM f JOIN chain ON chain.word = f.word JOIN f e ON e.word = chain.at AND e.form IS NULL""")
def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every common word with the more common spelling it is one edit from, and the end of that chain."""
    vocabulary = variants.word_counts(table(spark, sf_dir, "documents"), shortest=6, least=5, every=199)
    return variants.variants(vocabulary, factor=5)


@query("op13_setjoin", r"""
    WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
          FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
    z AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS m FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
    e AS (SELECT a, b FROM p JOIN z x ON x.doc_id = a JOIN z y ON y.doc_id = b WHERE 100 * m >= 80 * (x.n + y.n - m)),
    r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
    SELECT d.doc_id, coalesce(max(n), 0) AS n_shingles, min(r.b) AS component_id
    FROM d JOIN r ON r.a = d.doc_id LEFT JOIN z ON z.doc_id = d.doc_id GROUP BY d.doc_id""")
def op13_setjoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of five words are alike by 0.8."""
    found = setjoin.similar_sets(table(spark, sf_dir, "documents"), size=5, percent=80)
    return found.select("doc_id", "n_shingles", "component_id")


@query("op12_collocations", r"""
    WITH w AS (SELECT coalesce(lang, 'und') AS lang, p, regexp_extract_all(p, '[^\x20\x09]+') AS w
               FROM (SELECT lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                            '[.,;:!?\x0A-\x0D]')) AS p FROM documents)),
    t AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
    g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
          FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 6) r(k) WHERE len(w) >= k)),
    f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
    c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS x FROM f WHERE k > 1),
    cut AS (SELECT lang, k, phrase, a, j, array_to_string(x[1:j], ' ') AS first, array_to_string(x[j + 1:k], ' ') AS rest
            FROM (SELECT *, unnest(range(1, k)) AS j FROM c)),
    s AS (SELECT c.lang, c.k, c.phrase, c.a, p.f AS l, q.f AS r, t.n, j,
                 CAST((1000 * CAST(c.a AS HUGEINT) * CAST(t.n AS HUGEINT)) // (CAST(p.f AS HUGEINT) * q.f) AS BIGINT) AS score
          FROM cut c JOIN f p ON p.lang = c.lang AND p.phrase = c.first AND p.k = c.j
          JOIN f q ON q.lang = c.lang AND q.phrase = c.rest AND q.k = c.k - c.j JOIN t ON t.lang = c.lang),
    best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
    inside AS (SELECT lang, array_to_string(x[i:i + m - 1], ' ') AS phrase, max(a) AS longer
               FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c)) GROUP BY ALL)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score
    FROM best LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a
    QUALIFY rank <= 2000""")
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phrases of each language whose words occur together most above chance."""
    return collocations.collocations(table(spark, sf_dir, "documents"), least=100, longest=5, scale=1000, inside=100, top=2000)

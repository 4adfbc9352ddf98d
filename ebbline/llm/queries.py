"""One query for each operator over its whole table, and DuckDB SQL where that can state the rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.llm import bpe, decontam, exact, hmm, langid, merkle, nbsvm, sharding, sigtree, simhash, substring, trie, urls
from ebbline.llm.common import held_out, numbered, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


@query()
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(texts(spark, sf_dir))


@query(r"""
WITH d AS (
  SELECT doc_id, coalesce(length(text), 0) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t
  FROM documents
), g AS (
  SELECT *, count(*) OVER (PARTITION BY t) AS group_size,
         first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id) AS keep_id
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM g
""")
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(texts(spark, sf_dir)).select("doc.doc_id", "keep_id", "group_size", "kept", "text_sha256")


WORDS = r"regexp_extract_all(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(f"""
WITH b AS (SELECT item_id, {WORDS.format("text")} AS w FROM benchmark),
n AS (SELECT item_id, w, least(10, len(w)) AS k FROM b WHERE len(w) > 0),
v AS (SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS s
      FROM (SELECT *, unnest(range(1, (len(w) - k + 2)::BIGINT)) AS i FROM n)),
d AS (SELECT doc_id, {WORDS.format("text")} AS w FROM documents),
p AS (SELECT d.doc_id, i, x.k, array_to_string(w[i : i + x.k - 1], ' ') AS s
      FROM d, (SELECT DISTINCT k FROM v) x, unnest(range(1, (len(w) - x.k + 2)::BIGINT)) AS u(i)),
h AS (SELECT p.doc_id, p.i, p.k, v.item_id FROM p JOIN v ON p.k = v.k AND p.s = v.s),
c AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM h) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
      FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
""")
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find_leaks(texts(spark, sf_dir), table(spark, sf_dir, "benchmark"), unnamed=True)
    items = F.array_join(F.array_sort(F.col("found.items").cast("array<string>")), ",")
    n_hit = decontam.hit_words(F.col("found.spans"))
    return found.select(
        "doc.doc_id", "found.n_words", n_hit.alias("n_hit"), F.size("found.items").cast("long").alias("n_items"),
        F.sha2(items, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


@query()
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.identify(docs).select("doc_id", "held_out", "lang_pred", "score")


@query(r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS s FROM d, unnest(range(1, (len(w) - 11)::BIGINT)) AS u(i)),
f AS (SELECT s, min(doc_id) AS least FROM p GROUP BY s HAVING min(doc_id) < max(doc_id)),
r AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j FROM p JOIN f USING (s) WHERE least < doc_id),
k AS (SELECT doc_id, j, w[j] AS word FROM d, unnest(range(1, (len(w) + 1)::BIGINT)) AS u(j)),
t AS (SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS kept, count(*) AS n FROM k ANTI JOIN r USING (doc_id, j) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)
""")
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(texts(spark, sf_dir)).select(
        "doc.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


@query()
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.Vocabulary.load(VOCABULARY, public_tokenizers.PATTERN)
    coded = bpe.decode(bpe.encode(texts(spark, sf_dir), vocabulary), vocabulary)
    return coded.select(
        "doc.doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op7_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return sharding.kd_shards(docs, shards=16).select(
        "doc.doc_id", "doc.size", "doc.text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query()
def op8_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(texts(spark, sf_dir)).select(
        "doc.doc_id", (~F.col("trains")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query()
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark, sf_dir)
    model = nbsvm.train(docs, table(spark, sf_dir, "labels"))
    scored = nbsvm.score(docs, model, ["doc_id"]).select("doc.doc_id", "score")
    return scored.select(
        "doc_id", held_out(4, 2).alias("held_out"), "score", (F.col("score") >= nbsvm.THRESHOLD).cast("int").alias("predicted")
    )


RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


@query(f"""
WITH u AS (
  SELECT page_id, coalesce(url, '') AS url, strpos(coalesce(url, ''), '://') AS pos FROM pages
), p AS (
  SELECT page_id, CASE WHEN pos > 0 THEN substr(url, pos + 3) ELSE '' END AS rest FROM u
), h AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's') AS path
  FROM p
), r(rh, rp, v) AS (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)}),
m AS (
  SELECT page_id, rh || rp AS rule, v, row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC) AS k
  FROM h JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
)
SELECT h.page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM h LEFT JOIN m ON h.page_id = m.page_id AND k = 1
""")
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return urls.judge(pages, rules).select("page.page_id", "host", "path", "rule", "verdict")


def crc_sql(value: str) -> str:
    """CRC-32 of a number's decimal digits in SQL: of each digit a row to add, then eight steps of the polynomial."""
    digits = f"flatten(list_transform(string_split({value}::VARCHAR, ''), lambda c: list_concat([ord(c)::BIGINT], [-1, -1, -1, -1, -1, -1, -1, -1])))"
    step = "CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END"
    return f"xor(list_reduce({digits}, lambda a, b: {step}, 4294967295::BIGINT), 4294967295)"


def field_sql(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"


LEAF_SQL = "sha256(" + " || ".join(map(field_sql, ("doc_id", "source", "lang", "n_chars{0}", "text"))) + ")"


@query(f"""
WITH RECURSIVE e AS (
  SELECT doc_id, lang, {LEAF_SQL.format("")} AS leaf,
         CASE WHEN {crc_sql("doc_id")} % 7 = 0 THEN {LEAF_SQL.format(" + 1")} ELSE {LEAF_SQL.format("")} END AS given
  FROM documents
), r AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM e
), t(lang, n, lvl, i, h) AS (
  SELECT lang, n, 0, i, leaf FROM r
  UNION ALL
  SELECT lang, n, lvl + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)) FROM t WHERE n > 1 << lvl GROUP BY lang, n, lvl, i // 2
), s AS (
  SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM t WHERE n <= 1 << lvl
), u(n, lvl, i, h) AS (
  SELECT n, 0, i, h FROM s
  UNION ALL
  SELECT n, lvl + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)) FROM u WHERE n > 1 << lvl GROUP BY n, lvl, i // 2
), top AS (SELECT h AS root FROM u WHERE n <= 1 << lvl),
a AS (SELECT r.*, s.h AS subroot, s.i AS si, s.n AS sn, root FROM r JOIN s ON r.lang IS NOT DISTINCT FROM s.lang, top),
f(doc_id, i, lang, lvl, now, path) AS (
  SELECT doc_id, i, lang, 0, given, '' FROM a
  UNION ALL
  SELECT f.doc_id, f.i, f.lang, f.lvl + 1, CASE WHEN f.i >> f.lvl & 1 = 0 THEN sha256(now || coalesce(t.h, '')) ELSE sha256(t.h || now) END, path || coalesce(t.h, '')
  FROM f JOIN a ON a.lang IS NOT DISTINCT FROM f.lang AND a.i = f.i
  LEFT JOIN t ON t.lang IS NOT DISTINCT FROM f.lang AND t.lvl = f.lvl AND t.i = xor(f.i >> f.lvl, 1) WHERE a.n > 1 << f.lvl
), g(lang, i, si, lvl, now, path) AS (
  SELECT a.lang, a.i, si, 0, now, path FROM f JOIN a ON a.lang IS NOT DISTINCT FROM f.lang AND a.i = f.i WHERE a.n <= 1 << lvl
  UNION ALL
  SELECT g.lang, g.i, g.si, g.lvl + 1, CASE WHEN g.si >> g.lvl & 1 = 0 THEN sha256(now || coalesce(u.h, '')) ELSE sha256(u.h || now) END, path || coalesce(u.h, '')
  FROM g LEFT JOIN u ON u.lvl = g.lvl AND u.i = xor(g.si >> g.lvl, 1) WHERE (SELECT count(*) FROM s) > 1 << g.lvl
)
SELECT a.doc_id, leaf, subroot, root, sha256(path) AS proof_sha256, now AS folded_root, now = root AS verified
FROM a JOIN g ON a.lang IS NOT DISTINCT FROM g.lang AND a.i = g.i AND sn <= 1 << lvl
""")
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")

    def leaf(n_chars):
        return merkle.row_digest([F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text")])

    tampers = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    rows = docs.select("doc_id", "lang", leaf(F.col("n_chars")).alias("digest"), F.when(tampers, leaf(F.col("n_chars") + 1)).alias("other"))
    proven = merkle.manifest(rows, "lang", "doc_id")
    again = merkle.folded(F.coalesce("row.other", "row.digest"), F.col("path"))
    return proven.select("row.doc_id", F.col("row.digest").alias("leaf"), "subroot", "root", merkle.path_digest(F.col("path")).alias("proof_sha256"), again.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root")
    )


@query(f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS k
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (SELECT conv_id, {crc_sql("conv_id")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM t)),
m AS (
  SELECT c.conv_id, 0 AS own, k, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 5 AND k <= h
  UNION ALL SELECT c.conv_id, 1, k, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND k > h
), p AS (
  SELECT conv_id, row_number() OVER w AS d, text, string_agg(sha256(strlen(role) || ':' || role || text), '' ORDER BY own, k) OVER w AS path FROM m WINDOW w AS (PARTITION BY conv_id ORDER BY own, k)
), a AS (
  SELECT conv_id, d, sha256(path) AS path, sha256(lag(path) OVER (PARTITION BY conv_id ORDER BY d)) AS above, strlen(text) AS size FROM p
  UNION ALL SELECT conv_id, 0, '', NULL, 0 FROM c
), e AS (SELECT conv_id, arg_max(path, d) AS path FROM a GROUP BY conv_id),
n AS (
  SELECT path, any_value(d) AS depth, any_value(CASE WHEN d = 1 THEN '' ELSE above END) AS above, min(conv_id) AS least, count(*) AS n, any_value(size) AS size FROM a GROUP BY path
), x AS (SELECT above AS path, count(*) AS children FROM n WHERE depth > 0 GROUP BY above),
g AS (SELECT path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ends FROM e GROUP BY path),
under AS (SELECT DISTINCT u.path AS top, a.path FROM a JOIN a u ON u.conv_id = a.conv_id AND u.d <= a.d),
s AS (
  SELECT top AS path, count(*) FILTER (children IS NULL) AS leaves, sum((n - 1) * size)::BIGINT AS saved FROM under JOIN n USING (path) LEFT JOIN x USING (path) GROUP BY top
)
SELECT n.least AS conv_id, n.depth::BIGINT AS depth, b.least AS parent_conv_id, n.n AS n_convs, coalesce(children, 0) AS n_children,
       leaves AS n_leaves, saved AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
FROM n LEFT JOIN n b ON n.above = b.path LEFT JOIN x ON x.path = n.path LEFT JOIN g ON g.path = n.path JOIN s ON s.path = n.path
""")
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return trie.trie(trie.rebuilt(rows))


@query(r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + least(5, len(w)) - 1], ' ') AS g FROM d, unnest(range(1, (len(w) - least(5, len(w)) + 2)::BIGINT)) AS u(i) WHERE len(w) > 0
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id JOIN n p ON p.doc_id = x.doc_id JOIN n q ON q.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))
), r AS (
  WITH RECURSIVE t(doc_id, reached) AS (SELECT doc_id, doc_id FROM d UNION SELECT t.doc_id, e.b FROM t JOIN e ON e.a = t.reached)
  SELECT doc_id, min(reached) AS component_id FROM t GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM r LEFT JOIN n USING (doc_id)
""")
def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = numbered(texts(spark, sf_dir), "texts")
    return sigtree.classes(docs).select("doc_id", F.col("n").alias("n_shingles"), "component_id")

"""The queries of this subpackage, each one operator over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewloom.session import materialize, settings
from . import (
    chat_format, contamination, embedding_dedup, html_extract, minhash_dedup, mixing, packing, quality_rules, sharding, spelling,
    url_filter, warc, whitening,
)

CHAT_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: All vectors of a label against each other, on the double values, and links of links by a recursive query.
EMBEDDING_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a)
LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a) USING (vec_id)
"""


@query("op1_embedding_dedup", EMBEDDING_SQL)
def op1(spark, sf_dir):
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op2_minhash_dedup")
def op2(spark, sf_dir):
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


#: verdict, host, path.
URL_RULES = [
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
]

URL_SQL = r"""
WITH u AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
v AS (
  SELECT page_id, url, regexp_extract(rest, '^[^/?#]*') AS raw,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM u),
w AS (
  SELECT page_id, url, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM v),
c AS (
  SELECT *, regexp_replace(regexp_replace(host, ':[0-9]+$', ''), '^(www|m)[.]', '')
            || regexp_replace(regexp_replace(path, '/$', ''), '[.]html?$', '') AS name FROM w),
toxic AS (
  SELECT DISTINCT name FROM c JOIN labels
  ON doc_id = try_cast(regexp_extract(path, '/([0-9]+)(?:[.]html?|/)?$', 1) AS BIGINT) WHERE toxic = 1),
rules(verdict, rule_host, rule_path) AS (VALUES
  ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
f AS (
  SELECT page_id, url, arg_max({'r': rule_host || rule_path, 'v': verdict}, length(rule_host || rule_path)) AS best
  FROM w JOIN rules ON (host = rule_host OR host LIKE '%.' || rule_host) AND starts_with(path, rule_path)
  GROUP BY page_id, url)
SELECT c.page_id, c.url, host, path, best.r AS rule,
       CASE WHEN best.v IS NOT NULL THEN best.v WHEN host <> '' AND name IN (SELECT name FROM toxic) THEN 'block'
            ELSE 'allow' END AS verdict
FROM c LEFT JOIN f ON c.page_id IS NOT DISTINCT FROM f.page_id AND c.url IS NOT DISTINCT FROM f.url
"""


def toxic_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """The urls of pages that show a document labelled toxic; its number ends their path."""
    number = F.regexp_extract(url_filter.path_of(F.col("url")), r"/([0-9]+)(?:\.html?|/)?$", 1).try_cast("long")
    toxic = labels.filter("toxic = 1").select(F.col("doc_id").alias("_doc")).distinct()
    return pages.select("url", number.alias("_doc")).join(toxic, "_doc").select("url")


@query("op3_url_filter", URL_SQL)
def op3(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(pages, URL_RULES, toxic_pages(pages, table(spark, sf_dir, "labels")))


@query("op4_virtual_slots")
def op4(spark, sf_dir):
    """Law ``bytes``: the map is made from the slots' bytes. ``grown_to`` is the shard in version 2 of the map."""
    records = table(spark, sf_dir, "documents").select(
        "doc_id", sharding.record_bytes().alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    placed = sharding.assign(materialize(records, "records"), 24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "grown_to")


@query("op5_tag_path_ratios")
def op5(spark, sf_dir):
    found = html_extract.extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


QUALITY_SQL = r"""
WITH w AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
n AS (
  SELECT doc_id, source, text, words, len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols FROM w),
x AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM n),
y AS (
  SELECT doc_id, i, word || ' ' || lead(word) OVER z || ' ' || lead(word, 2) OVER z || ' ' || lead(word, 3) OVER z
         || ' ' || lead(word, 4) OVER z || ' ' || lead(word, 5) OVER z || ' ' || lead(word, 6) OVER z
         || ' ' || lead(word, 7) OVER z AS eight
  FROM x WINDOW z AS (PARTITION BY doc_id ORDER BY i)),
p AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, eight) AS times FROM y WHERE eight IS NOT NULL),
r AS (
  SELECT doc_id, count(DISTINCT word)::BIGINT AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS word FROM p WHERE times > 1) GROUP BY doc_id),
l AS (
  SELECT doc_id, source, raw, lower(trim(regexp_replace(raw, '[\x20\x09-\x0D]+', ' ', 'g'))) AS line
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS raw FROM n)
  WHERE regexp_matches(raw, '[^\x20\x09-\x0D]')),
u AS (SELECT doc_id, (count(*) - count(DISTINCT raw))::BIGINT AS n_dup_lines FROM l GROUP BY doc_id),
e AS (
  SELECT l.doc_id, l.source, md5(n.text) AS t, line, ('0x' || substr(md5(line), 1, 15))::BIGINT AS h, string_split(line, ' ') AS w
  FROM l JOIN n USING (doc_id)),
i AS (
  SELECT * EXCLUDE w, len(w)::BIGINT AS words, 'h3' || array_to_string(w[:3], ' ') AS h3, 'h8' || array_to_string(w[:8], ' ') AS h8,
         't3' || array_to_string(w[greatest(len(w) - 3, 0) + 1:], ' ') AS t3,
         't8' || array_to_string(w[greatest(len(w) - 8, 0) + 1:], ' ') AS t8 FROM e),
s AS (SELECT source, line FROM i GROUP BY source, line HAVING count(DISTINCT t) >= 20),
a AS (SELECT DISTINCT i.source, unnest([h3, h8, t3, t8]) AS x
      FROM i JOIN s ON i.source IS NOT DISTINCT FROM s.source AND i.line = s.line),
o AS (
  SELECT i.*, s.line IS NOT NULL AS shared, EXISTS (
           SELECT 1 FROM a WHERE a.source IS NOT DISTINCT FROM i.source AND a.x = CASE WHEN words >= 16 THEN h8 ELSE h3 END)
         OR EXISTS (
           SELECT 1 FROM a WHERE a.source IS NOT DISTINCT FROM i.source AND a.x = CASE WHEN words >= 16 THEN t8 ELSE t3 END) AS alike
  FROM i LEFT JOIN s ON i.source IS NOT DISTINCT FROM s.source AND i.line = s.line),
q AS (
  SELECT source, t, coalesce(sum(words) FILTER (WHERE NOT shared), 0) AS own,
         coalesce(sum(words) FILTER (WHERE NOT shared AND alike), 0) AS edited,
         list(DISTINCT line) FILTER (WHERE shared) AS held, list_sort(list(DISTINCT h) FILTER (WHERE shared))[:3]::VARCHAR AS least
  FROM o GROUP BY source, t),
z AS (
  SELECT source, unnest(held) AS line, CASE WHEN own = 0 THEN least WHEN edited >= 0.5::DOUBLE * own THEN '' ELSE t END AS copy
  FROM q WHERE held IS NOT NULL),
c AS (SELECT source, line FROM z GROUP BY source, line HAVING count(DISTINCT copy) >= 20),
g AS (
  SELECT doc_id, sum(words)::BIGINT AS removed_words
  FROM i JOIN c ON i.source IS NOT DISTINCT FROM c.source AND i.line = c.line GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
       coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(removed_words, 0) AS removed_words,
       n_words < 20 OR 100 * coalesce(n_repeat_words, 0) > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * coalesce(n_repeat_words, 0) > 30 * n_words)
         AND coalesce(removed_words, 0) <= 0.7::DOUBLE * n_words AS kept
FROM n LEFT JOIN r USING (doc_id) LEFT JOIN u USING (doc_id) LEFT JOIN g USING (doc_id)
"""


@query("op6_line_frequency", QUALITY_SQL)
def op6(spark, sf_dir):
    return quality_rules.judge(table(spark, sf_dir, "documents")).drop("text_hash", "host_key", "removed")


@query("op7_best_fit_packing")
def op7(spark, sf_dir):
    cut = packing.pieces(table(spark, sf_dir, "documents"), TOKENIZER)
    slim = materialize(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces")
    return packing.pack(slim)


@query("op9_systematic_mix", mixing.SQL)
def op9(spark, sf_dir):
    slim = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.n_words().alias("words"))
    mix = mixing.mix(materialize(slim, "sizes"), F.col("words"))
    return mix.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")


@query("op8_prefix_trees")
def op8(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(
        [(-1, turn, role, "</s>[INST] ok [/INST]") for turn, role in enumerate(("user", "assistant"))], turns.schema)
    talks = materialize(chat_format.conversations(turns.unionByName(probe)), "conversations")
    with settings(spark, chat_format.AT_ONCE):
        packed = materialize(chat_format.sequences(talks, CHAT_TOKENIZER), "sequences")
        read = materialize(chat_format.read_back(packed, CHAT_TOKENIZER), "read-back")
    return talks.select("conv_id", "content").join(read, "content").drop("content")


@query("op10_warc")
def op10(spark, sf_dir):
    archives = warc.write_archives(warc.with_originals(table(spark, sf_dir, "pages")))
    return warc.read_archives(spark, archives, payloads=False).drop("url")


@query("op13_winnowing", contamination.SQL)
def op13(spark, sf_dir):
    found = contamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


#: crc32 bit by bit, keys of every word with one character left out, and the forms followed by a recursive query.
SPELLING_SQL = r"""
WITH RECURSIVE r AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL),
x AS (SELECT run, n, hex(coalesce(doc_id::VARCHAR, '') || ':' || run) AS bytes FROM r),
h AS (
  SELECT run, n, xor(4294967295, list_reduce(
    [4294967295] || list_transform(range(0, (length(bytes) // 2)::BIGINT), lambda k: ('0x' || substr(bytes, 2 * k + 1, 2))::BIGINT),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, 3988292384 * (y & 1))))) AS crc FROM x),
w AS (
  SELECT CASE WHEN crc % 199 = 0 THEN substr(run, 1, crc % length(run)) || substr(run, crc % length(run) + 2) ELSE run END AS word,
         sum(n)::BIGINT AS n FROM h GROUP BY 1),
v AS (SELECT word, n FROM w WHERE length(word) >= 6 AND n >= 5),
k AS (
  SELECT word, n, substr(word, i + 2) || '$' || substr(word, 1, i) AS key, true AS cut
  FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM v)
  UNION ALL
  SELECT word, n, substr(word, i + 1) || '$' || substr(word, 1, i), false
  FROM (SELECT word, n, unnest(range(0, length(word) + 1)) AS i FROM v)),
p AS (SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS near_n FROM k a JOIN k b ON a.key = b.key AND a.word <> b.word AND (a.cut OR b.cut)),
f AS (
  SELECT word, any_value(n) AS n, count(*)::BIGINT AS n_near, max(near_n) AS best_n,
         arg_min(near, {'m': -near_n, 'w': near}) AS best FROM p GROUP BY word),
g AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 5 * v.n THEN best END AS form,
         CASE WHEN best_n >= 5 * v.n THEN best_n END AS form_n FROM v LEFT JOIN f USING (word)),
z(word, root, form) AS (
  SELECT word, word, form FROM g
  UNION ALL
  SELECT z.word, g.word, g.form FROM z JOIN g ON z.form = g.word)
SELECT g.word, g.form, z.root, g.n, g.n_near, g.form_n FROM g JOIN z ON g.word = z.word AND z.form IS NULL
"""


def misspelt(doc_id, run, every: int = 199):
    """``run`` without one of its code points where the checksum of ``<doc_id>:<run>`` can be divided by ``every``."""
    crc = F.crc32(F.concat(doc_id, F.lit(":"), run).cast("binary"))
    at = (crc % F.char_length(run)).cast("int")
    return F.when(crc % every == 0, F.concat(
        F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))).otherwise(run)


@query("op12_permuterm", SPELLING_SQL)
def op12(spark, sf_dir):
    return spelling.variants(spelling.vocabulary(table(spark, sf_dir, "documents"), misspelt))


@query("op11_spectrum_slicing")
def op11(spark, sf_dir):
    return whitening.whitened(table(spark, sf_dir, "embeddings"))

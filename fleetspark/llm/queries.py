"""The registered queries of this subpackage with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .decontamination import contamination
from .html_extract import extract_text
from .near_dedup import near_duplicates
from .nearest import nearest
from .packing import pack
from .periodic_runs import periodic_runs
from .prefix_trie import prefix_trie
from .quality_classifier import score_quality
from .quality_rules import quality_rules
from .sharding import shard_by_bytes
from .substring_dedup import remove_repeats
from .toxicity import score_toxicity
from .warc import round_trip

N_SHARDS = 40


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contiguous shards 0 to 39 of nearly equal bytes."""
    placed = shard_by_bytes(table(spark, sf_dir, "documents"), N_SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins of 2048 words, no two documents of one source or, by op8's links, of one group of near copies in a bin."""
    return pack(table(spark, sf_dir, "documents"), near=(2, 80))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"), keep_columns=("url",))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules(table(spark, sf_dir, "documents"))
    return found.drop("longest_repeat")


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's shingles are of two words."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = round_trip(table(spark, sf_dir, "pages"))
    return back.select(F.col("page").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of the conversations after the contract's rebuild."""
    return prefix_trie(table(spark, sf_dir, "conversations"), share=(20, 4))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of at least 24 words and three periods, in texts of which a tenth are made periodic."""
    found = periodic_runs(table(spark, sf_dir, "documents"), planted=True)
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), "id % 20 = 0")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_sharding, op2_packing, op3_toxicity, op4_decontamination, op5_substring_dedup, op6_html_extraction, op7_quality_rules,
        op8_near_dedup, op9_quality_classifier, op10_warc, op11_prefix_trie, op12_periodic_runs, op13_nearest, pipeline,
    )
    return {f.__name__: f for f in own}


_WORD = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_SQL = f"""
WITH RECURSIVE bits(i, k, c) AS (
  SELECT i, 0, i FROM range(256) r(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8
), crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
raw AS (
  SELECT doc_id, (strlen(coalesce(text, '')) + 16)::BIGINT AS size,
         list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT) AS b
  FROM documents
), d AS (
  SELECT doc_id, size,
         xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) AS crc
  FROM raw, crc
), p AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id, crc)::BIGINT AS upto, (sum(size) OVER ())::BIGINT AS total FROM d
), s AS (SELECT *, ({N_SHARDS} * (2 * upto - size) // (2 * total))::INT AS shard FROM p)
SELECT doc_id, size, crc AS text_crc32, 'bytes' AS law, shard,
       (row_number() OVER (PARTITION BY shard ORDER BY doc_id, crc) - 1)::BIGINT AS slot, NULL::INT AS grown_shard
FROM s
"""

OP11_SQL = f"""
WITH RECURSIVE bits(i, k, c) AS (
  SELECT i, 0, i FROM range(256) r(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8
), crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
own AS (
  SELECT conv_id, list(md5(coalesce(role, '') || chr(31) || coalesce(text, '')) ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k,
         list(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS w
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), shared AS (
  SELECT own.*, conv_id - conv_id % 20 AS base, CASE WHEN conv_id % 20 = 0 THEN 0 ELSE xor(list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) % 4 END AS h
  FROM own, crc
), built AS (
  SELECT a.conv_id, list_concat(coalesce(b.k, [])[1:a.h], a.k[a.h + 1:]) AS k, list_concat(coalesce(b.w, [])[1:a.h], a.w[a.h + 1:]) AS w
  FROM shared a LEFT JOIN own b ON b.conv_id = a.base
), place AS (
  SELECT conv_id, d, md5(array_to_string(k[1:d], ',')) AS g, md5(array_to_string(k[1:d - 1], ',')) AS up, w[d] AS words, len(k) = d AS ends
  FROM (SELECT *, unnest(range(0, len(k) + 1)) AS d FROM built)
), node AS (
  SELECT g, d, min(conv_id) AS conv_id, any_value(up) AS up, any_value(words) AS words, count(*) AS n,
         string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends) AS members
  FROM place GROUP BY g, d
), kids AS (SELECT up AS g, count(*) AS n FROM node WHERE d > 0 GROUP BY up),
above AS (
  SELECT md5(array_to_string(k[1:unnest(range(0, d + 1))], ',')) AS g, leaf, saved
  FROM (SELECT built.k, node.d, (kids.n IS NULL)::INT AS leaf, (node.n - 1) * coalesce(words, 0) AS saved
        FROM node JOIN built USING (conv_id) LEFT JOIN kids ON kids.g = node.g)
), total AS (SELECT g, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM above GROUP BY g)
SELECT node.conv_id, node.d::BIGINT AS depth, CASE WHEN node.d > 0 THEN p.conv_id END AS parent_conv_id, node.n AS n_convs,
       coalesce(kids.n, 0)::BIGINT AS n_children, n_leaves, saved_tokens, sha256(coalesce(node.members, '')) AS ends_sha256
FROM node JOIN total USING (g) LEFT JOIN kids ON kids.g = node.g LEFT JOIN node p ON p.g = node.up AND p.d = node.d - 1
"""

OP4_SQL = f"""
WITH item AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM benchmark),
item_window AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM item WHERE len(w) > 0)
),
doc AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM documents),
len AS (SELECT DISTINCT n FROM item_window),
doc_window AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, len WHERE len(w) >= n)
),
found AS (SELECT doc_id, i, n, item_id FROM doc_window JOIN item_window USING (n, g)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s COLLATE "C") AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, (coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w)) AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP5_SQL = f"""
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM doc WHERE len(w) >= 50)
),
least AS (SELECT g, min(doc_id) AS first FROM win GROUP BY g HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN least USING (g) WHERE first < doc_id),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM doc),
kept AS (
  SELECT word.doc_id, string_agg(x, ' ' ORDER BY word.p) AS t, count(*) AS n
  FROM word ANTI JOIN gone ON word.doc_id = gone.doc_id AND word.p = gone.p GROUP BY word.doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)
"""

OP7_SQL = f"""
WITH doc AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
win AS (
  SELECT doc_id, k, i, md5(array_to_string(w[i:i + k - 1], ' ')) AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM doc, (VALUES (3), (10), (201)) s(k) WHERE len(w) >= k)
),
often AS (SELECT doc_id, k, g FROM win GROUP BY ALL HAVING count(*) > 1),
part AS (
  SELECT doc_id, k, count(DISTINCT p) AS n
  FROM (SELECT doc_id, k, unnest(range(i, i + k)) AS p FROM win JOIN often USING (doc_id, k, g)) GROUP BY doc_id, k
),
line AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM doc),
dup AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM line WHERE regexp_matches(l, '{_WORD}') GROUP BY doc_id),
f AS (
  SELECT doc.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
         coalesce(a.n, 0)::BIGINT AS n_repeat_words, coalesce(b.n, 0)::BIGINT AS covered_words, c.n IS NOT NULL AS long_repeat
  FROM doc LEFT JOIN dup USING (doc_id)
  LEFT JOIN part a ON a.doc_id = doc.doc_id AND a.k = 3
  LEFT JOIN part b ON b.doc_id = doc.doc_id AND b.k = 10
  LEFT JOIN part c ON c.doc_id = doc.doc_id AND c.k = 201
), g AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, covered_words, base_failed,
       NOT base_failed AND 100 * covered_words <= 50 * n_words AND NOT long_repeat AS kept
FROM g
"""

OP8_SQL = f"""
WITH RECURSIVE doc AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 1], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM doc WHERE len(w) > 0)
),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM shingle a JOIN shingle b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * m >= 80 * (x.n + y.n - m)
),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(a, b) AS (SELECT a, b FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a),
root AS (SELECT a AS doc_id, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id,
       doc_id = least(doc_id, coalesce(b, doc_id)) AS kept
FROM doc LEFT JOIN size USING (doc_id) LEFT JOIN root USING (doc_id)
"""

OP10_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, upper(sha1(coalesce(html, ''))) AS h FROM pages),
d AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda k: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, (k // 8) * 10 + 1, 10))::BIGINT >> (35 - 5 * (k % 8))) & 31)::INT + 1, 1)), '') AS payload_digest
  FROM p
), m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id < top THEN top END AS refers_to
FROM m
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_sharding": OP1_SQL, "op4_decontamination": OP4_SQL, "op5_substring_dedup": OP5_SQL, "op7_quality_rules": OP7_SQL,
        "op8_near_dedup": OP8_SQL, "op10_warc": OP10_SQL, "op11_prefix_trie": OP11_SQL,
    }

"""Queries of the training-data operators and, where SQL can say it, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import (chat_format, collocations, decontaminate, embed_dedup, html_render, importance, kd_shards, lang_kn,
                            ngram_join, packing, quality_gbt, suffix_dedup, url_templates)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompt and masked completions of the preference pairs of every conversation."""
    pairs = chat_format.format_pairs(*chat_format.reply_pairs(table(spark, sf_dir, "conversations")))
    return pairs.withColumnRenamed("pair_id", "conv_id")


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingle sets have a Jaccard similarity of 0.85 or more."""
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"), k=4, threshold=(85, 100))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of vectors with a cosine of 0.9 or more."""
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op4_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes."""
    return kd_shards.shard(table(spark, sf_dir, "documents"), shards=16)


#: Teaching rows of the quality classifier and of the language models.
QUALITY_LEARN = "pmod(crc32(cast(doc_id as string)), 3) <> 1"
LANGUAGE_LEARN = "pmod(crc32(cast(doc_id as string)), 4) <> 2"


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the rows not held out."""
    return quality_gbt.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), QUALITY_LEARN)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in every document."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all documents' pieces in sequences of at most 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


#: Verdicts that come before the method's.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op8_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url.  A page shows the document whose number
    ends its path, so it is labelled with that document's quality."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    number = F.expr("try_cast(regexp_extract(url, '/([0-9]{1,18})([.]html|/)?([?#].*)?$', 1) as bigint)")
    good = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.avg("quality").alias("good"))
    labels = pages.select("page_id", number.alias("doc_id")).join(good, "doc_id").select("page_id", "good")
    return url_templates.judge(pages, labels, URL_RULES)


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of every page."""
    return html_render.extract(table(spark, sf_dir, "pages"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows not held out."""
    return lang_kn.identify(table(spark, sf_dir, "documents"), LANGUAGE_LEARN)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight and score of every document by its likeness to the benchmark, and the tenth that is drawn."""
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), longest=1, buckets=10000,
                               share=(10, 100), min_words=20, seed="2024").select("doc_id", "n_features", "weight", "score", "rank")


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 phrases of 2 to 5 words of each language whose words occur together most."""
    return collocations.collocations(table(spark, sf_dir, "documents"), longest=5, least=100, top=2000)


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without the 400-byte strings that occur twice."""
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=400, keep_first=False)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_chat_format, op2_ngram_jaccard, op3_embedding_near_dedup, op4_kd_shards, op5_quality_classifier,
                            op6_decontamination, op7_best_fit_packing, op8_url_templates, op9_html_text, op10_language_id, op11_importance_resampling,
                            op12_phrase_collocations, op13_suffix_dedup)
}

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_CHAT = r"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text, role AS r
               FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
ends AS (SELECT conv_id, max(turn) FILTER (r = 'assistant') AS last FROM turns GROUP BY conv_id),
upto AS (SELECT * FROM turns JOIN ends USING (conv_id) WHERE turn <= last),
other AS (SELECT conv_id, max(last) AS turn, 'assistant' AS role,
                 CASE WHEN count(*) FILTER (turn < last AND r = 'assistant') > 0
                      THEN arg_max(text, (turn, text)) FILTER (turn < last AND r = 'assistant')
                      ELSE coalesce(arg_max(text, (turn, text)) FILTER (turn < last AND r = 'user'), '') END AS text
          FROM upto GROUP BY conv_id),
sides AS (SELECT conv_id, 'c' AS side, turn, role, text FROM upto UNION ALL
          SELECT conv_id, 'r', turn, role, text FROM upto WHERE turn < last UNION ALL
          SELECT conv_id, 'r', turn, role, text FROM other),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id, side ORDER BY turn, role, text) AS place FROM sides),
c AS (SELECT * FROM placed WHERE side = 'c'), r AS (SELECT * FROM placed WHERE side = 'r'),
differ AS (SELECT conv_id, min(place) AS place FROM
             (SELECT conv_id, place, c.role = r.role AND c.text = r.text AS same FROM c FULL JOIN r USING (conv_id, place))
           WHERE same IS NOT TRUE GROUP BY conv_id),
sizes AS (SELECT conv_id, count(*) AS n FROM c GROUP BY conv_id),
cut AS (SELECT conv_id, coalesce(place - 1, n) AS k FROM sizes LEFT JOIN differ USING (conv_id)),
shown AS (SELECT *, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS piece,
                 length('<|im_start|>' || role || chr(10)) AS head FROM placed JOIN cut USING (conv_id)),
spans AS (SELECT *, sum(length(piece)) OVER (PARTITION BY conv_id, side ORDER BY place) AS ends
          FROM shown WHERE place > k)
SELECT conv_id, CAST(k AS INTEGER) AS n_prompt,
       coalesce((SELECT string_agg(piece, '' ORDER BY place) FROM shown s WHERE s.conv_id = t.conv_id AND side = 'c' AND place <= s.k), '') AS prompt,
       coalesce(max(all_pieces) FILTER (side = 'c'), '') AS chosen, coalesce(max(all_pieces) FILTER (side = 'r'), '') AS rejected,
       coalesce(max(mask) FILTER (side = 'c'), '') AS chosen_mask, coalesce(max(mask) FILTER (side = 'r'), '') AS rejected_mask
FROM cut t LEFT JOIN (
    SELECT conv_id, side, string_agg(piece, '' ORDER BY place) AS all_pieces,
           string_agg(CAST(CAST(ends - length(piece) + head AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(ends AS BIGINT) AS VARCHAR), ',' ORDER BY place)
               FILTER (role = 'assistant') AS mask
    FROM spans GROUP BY conv_id, side) USING (conv_id)
GROUP BY conv_id, k
"""

_JACCARD = r"""
WITH RECURSIVE split AS (SELECT doc_id, regexp_extract_all(LOWERED, '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: w[i:i + 3])
                                             WHEN len(w) > 0 THEN [w] ELSE [] END) AS s FROM split),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach(id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT id, b FROM reach JOIN links ON other = a)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN (SELECT id, min(other) AS component_id FROM reach GROUP BY id) ON id = d.doc_id
""".replace("LOWERED", _LOWER.format("text"))

_COSINE = """
WITH RECURSIVE usable AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
          WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
reach(id, other) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT id, b FROM reach JOIN links ON other = a),
named AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN named ON id = vec_id LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) ON a = vec_id
"""

_WINDOWS = r"""
WITH split AS (SELECT doc_id, regexp_extract_all(LOWERED, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT item_id, row_number() OVER () AS item_row, regexp_extract_all(LOWERED, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
          FROM benchmark WHERE item_id IS NOT NULL),
wanted AS (SELECT item_id, item_row, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS word, w FROM items WHERE len(w) > 0),
patterns AS (SELECT item_id, item_row, word, w[word:word + 12] AS s, len(w[word:word + 12]) AS size FROM wanted),
lengths AS (SELECT DISTINCT size FROM patterns),
places AS (SELECT doc_id, size, w, unnest(range(1, len(w) - size + 2)) AS place FROM split, lengths WHERE len(w) >= size),
found AS (SELECT doc_id, place, p.size, item_id, item_row, word
          FROM places p JOIN patterns x ON p.size = x.size AND w[place:place + p.size - 1] = x.s),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(place, place + size)) AS p FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY doc_id),
runs AS (SELECT doc_id, min(place) AS begin_at, max(place) - min(place) + max(size) AS words
         FROM (SELECT *, place - row_number() OVER (PARTITION BY doc_id, item_row, place - word ORDER BY place) AS island FROM found)
         GROUP BY doc_id, item_row, place - word, island),
best AS (SELECT doc_id, max(words) AS longest, arg_min(begin_at, (-words, begin_at)) - 1 AS longest_at FROM runs GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated,
       CAST(coalesce(longest, 0) AS BIGINT) AS longest, CAST(longest_at AS BIGINT) AS longest_at
FROM split LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id) LEFT JOIN best USING (doc_id)
""".replace("LOWERED", _LOWER.format("coalesce(text, '')"))

_IMPORTANCE = r"""
WITH RECURSIVE steps(i, k, c) AS (
    SELECT i, 0, CAST(i AS BIGINT) FROM range(256) r(i) UNION ALL
    SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8),
texts AS (SELECT 'd' AS side, row_number() OVER () AS r, text FROM documents UNION ALL
          SELECT 'b', row_number() OVER (), text FROM benchmark),
words AS (SELECT side, r, unnest(regexp_extract_all(LOWERED, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM texts),
vocabulary AS (SELECT w, hex(encode(w)) AS h FROM (SELECT DISTINCT w FROM words)),
codes AS (SELECT w, list_transform(range(0, length(h) // 2), lambda i: CAST(
              16 * (instr('0123456789ABCDEF', h[2 * i + 1]) - 1) + instr('0123456789ABCDEF', h[2 * i + 2]) - 1 AS BIGINT)) AS b FROM vocabulary),
buckets AS (SELECT w, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], b),
                lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket FROM codes, crc),
found AS (SELECT side, r, bucket FROM words JOIN buckets USING (w)),
sums AS (SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM found GROUP BY bucket),
whole AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM sums),
gains AS (SELECT bucket, CAST(floor(1000 * ln((CAST(t AS DOUBLE) + 1) * (CAST(s_all AS DOUBLE) + 10000)
              / ((CAST(s AS DOUBLE) + 1) * (CAST(t_all AS DOUBLE) + 10000)))) AS BIGINT) AS gain FROM sums, whole),
weights AS (SELECT r, count(*) AS n, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight
            FROM found JOIN gains USING (bucket) WHERE side = 'd' GROUP BY r),
scored AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
               (CAST('0x' || substr(sha256('2024:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
           FROM (SELECT doc_id, row_number() OVER () AS r FROM documents) LEFT JOIN weights USING (r)),
placed AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
                  10 * count(*) FILTER (n_features >= 20) OVER () // 100 AS draw FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= draw THEN place END AS rank FROM placed
""".replace("LOWERED", _LOWER.format("coalesce(text, '')"))

_PHRASES = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(LOWERED, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split),
grams AS (SELECT lang, w[i:i + k - 1] AS g FROM places, range(1, 6) sizes(k) WHERE i + k - 1 <= len(w)),
counts AS (SELECT lang, g, count(*) AS f FROM grams GROUP BY lang, g),
sizes AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE len(g) = 1 GROUP BY lang),
candidates AS (SELECT lang, g, f AS a FROM counts WHERE len(g) > 1 AND f >= 100),
cuts AS (SELECT lang, g, a, unnest(range(1, len(g))) AS k FROM candidates),
scores AS (SELECT c.lang, c.g, c.a, k, x.f AS l, y.f AS r, n,
                  CAST((1000::HUGEINT * c.a * n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
           FROM cuts c JOIN sizes USING (lang) JOIN counts x ON x.lang = c.lang AND x.g = c.g[1:k]
           JOIN counts y ON y.lang = c.lang AND y.g = c.g[k + 1:len(c.g)]),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inner_parts AS (SELECT lang, g[i:j] AS g, max(a) AS longer
                FROM (SELECT lang, g, a, i, unnest(range(i + 1, len(g) + 1)) AS j FROM (SELECT *, unnest(range(1, len(g))) AS i FROM candidates))
                WHERE j - i + 1 < len(g) GROUP BY ALL),
kept AS (SELECT o.*, array_to_string(o.g, ' ') AS phrase FROM lowest o LEFT JOIN inner_parts p ON p.lang = o.lang AND p.g = o.g
         WHERE NOT coalesce(100 * longer >= 100 * a, false))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000
""".replace("LOWERED", _LOWER.format("coalesce(text, '')"))

_REPEATS = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
sized AS (SELECT *, length(h) // 2 AS n FROM d),
blocks AS (SELECT r, k, substr(h, 2 * k + 1, 1200) AS h FROM (SELECT r, h, unnest(range(0, n - 399, 200)) AS k FROM sized)),
starts AS (SELECT r, k + p AS p, md5(substr(h, 2 * p + 1, 800)) AS m
           FROM (SELECT *, unnest(range(0, least(200, length(h) // 2 - 399))) AS p FROM blocks)),
hits AS (SELECT r, p FROM starts WHERE m IN (SELECT m FROM starts GROUP BY m HAVING count(*) > 1)),
marked AS (SELECT r, p, CASE WHEN p - lag(p) OVER w <= 400 THEN 0 ELSE 1 END AS new FROM hits WINDOW w AS (PARTITION BY r ORDER BY p)),
runs AS (SELECT r, min(p) AS a, max(p) + 400 AS b FROM
           (SELECT r, p, sum(new) OVER (PARTITION BY r ORDER BY p) AS run FROM marked) GROUP BY r, run),
ends AS (SELECT r, a, b FROM runs UNION ALL SELECT r, n, n FROM sized),
gaps AS (SELECT r, a, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a, b), 0) AS since FROM ends),
kept AS (SELECT r, string_agg(substr(h, CAST(2 * since + 1 AS BIGINT), CAST(2 * (a - since) AS BIGINT)), '' ORDER BY a, since) AS h
         FROM gaps JOIN d USING (r) GROUP BY r),
removed AS (SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans FROM runs GROUP BY r)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(kept.h)) AS kept_sha256
FROM sized JOIN kept USING (r) LEFT JOIN removed USING (r)
"""

ORACLE: dict[str, str] = {
    "op1_chat_format": _CHAT,
    "op2_ngram_jaccard": _JACCARD,
    "op3_embedding_near_dedup": _COSINE,
    "op6_decontamination": _WINDOWS,
    "op11_importance_resampling": _IMPORTANCE,
    "op12_phrase_collocations": _PHRASES,
    "op13_suffix_dedup": _REPEATS,
}

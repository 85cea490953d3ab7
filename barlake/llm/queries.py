"""One query per operator of this package, each over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from barlake.llm import bpe, collocations, content_sort, huffman, jaccard, pack, ppm, quality, sketches, toxicity, url_tree, warc, whiten
from barlake.llm.common import named_table

Query = Callable[[SparkSession, str], DataFrame]
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def llm_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def llm_statements() -> dict[str, str]:
    return dict(_SQL)


@query
def op1_binary_packing(spark, sf_dir):
    return pack.piece_digests(pack.pack_documents(named_table(spark, sf_dir, "documents"), WORD_TOKENIZER))


@query
def op2_warc_archive(spark, sf_dir):
    return warc.record_digests(warc.archived_pages(named_table(spark, sf_dir, "pages")))


_SQL["op2_warc_archive"] = r"""
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes FROM pages
), g AS (
    SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY html) ELSE page_id END AS response
    FROM p
)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> response THEN response END AS refers_to
FROM g
"""


@query
def op3_noisy_channel_toxicity(spark, sf_dir):
    return toxicity.score_documents(named_table(spark, sf_dir, "documents"), named_table(spark, sf_dir, "labels"))


@query
def op4_content_sort(spark, sf_dir):
    return content_sort.equal_texts(named_table(spark, sf_dir, "documents"))


_SQL["op4_content_sort"] = r"""
WITH d AS (
    SELECT doc_id, length(coalesce(text, '')) AS n,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
    FROM documents
), g AS (
    SELECT *, first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id,
           count(*) OVER (PARTITION BY norm) AS group_size
    FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""


@query
def op5_segment_tree_bpe(spark, sf_dir):
    return bpe.encoding_digests(
        bpe.encode_documents(named_table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)
    )


@query
def op6_light_heavy_jaccard(spark, sf_dir):
    return jaccard.linked_groups(named_table(spark, sf_dir, "documents"))


_SQL["op6_light_heavy_jaccard"] = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, [x FOR x IN regexp_split_to_array(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+')
               IF x <> ''] AS words
    FROM documents
), s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
        ELSE [array_to_string(words[i:i + 2], ' ') FOR i IN range(1, len(words) - 1)] END) AS shingle
    FROM w WHERE len(words) > 0
), n AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY 1, 2
), link AS (
    SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 90 * (x.n + y.n - common)
), reach AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.other
), least AS (
    SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id FROM least LEFT JOIN n USING (doc_id)
"""


@query
def op7_lookup_sketches(spark, sf_dir):
    return sketches.fingerprints(named_table(spark, sf_dir, "documents"))


URL_RULES = (
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
)


@query
def op8_path_templates(spark, sf_dir):
    return url_tree.judge_pages(named_table(spark, sf_dir, "pages"), URL_RULES)


_SQL["op8_path_templates"] = r"""
WITH u AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
    SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw_host, rest FROM u
), parts AS (
    SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path FROM h
), ruled AS (
    SELECT *, regexp_replace(path, '[0-9]+', '#', 'g') AS shape,
           CASE WHEN ('.' || host) LIKE '%.www.example.com' AND path LIKE '/en/%' THEN 'www.example.com/en/'
                WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/en/%' THEN 'example.com/en/'
                WHEN ('.' || host) LIKE '%.net' AND path LIKE '/es/%' THEN 'net/es/'
                WHEN ('.' || host) LIKE '%.net' AND path LIKE '/fr/%' THEN 'net/fr/'
                WHEN ('.' || host) LIKE '%.com' AND path LIKE '/%' THEN 'com/' END AS rule FROM parts
), judged AS (
    SELECT *, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 0 WHEN rule IS NOT NULL THEN 1 END AS label FROM ruled
), leaves AS (
    SELECT host, shape, count(*) AS pages, coalesce(sum(label), 0) AS blocked,
           [x FOR x IN string_split(shape, '/') IF x <> ''] AS seg FROM judged GROUP BY host, shape
), l0 AS (
    SELECT *, coalesce(seg[1], '') AS s1, coalesce(seg[2], '') AS s2, array_to_string(seg[3:], '/') AS s3 FROM leaves
), l1 AS (
    SELECT * REPLACE (CASE WHEN count(DISTINCT s1) OVER w >= 16 AND count(DISTINCT s1) OVER w > 0.5 * sum(pages) OVER w
                           THEN '*' ELSE s1 END AS s1) FROM l0 WINDOW w AS (PARTITION BY host)
), l2 AS (
    SELECT * REPLACE (CASE WHEN count(DISTINCT s2) OVER w >= 16 AND count(DISTINCT s2) OVER w > 0.5 * sum(pages) OVER w
                           THEN '*' ELSE s2 END AS s2) FROM l1 WINDOW w AS (PARTITION BY host, s1)
), l3 AS (
    SELECT * REPLACE (CASE WHEN count(DISTINCT s3) OVER w >= 16 AND count(DISTINCT s3) OVER w > 0.5 * sum(pages) OVER w
                           THEN '*' ELSE s3 END AS s3) FROM l2 WINDOW w AS (PARTITION BY host, s1, s2)
), sums AS (
    SELECT *, sum(pages) OVER a AS n0, sum(blocked) OVER a AS b0, sum(pages) OVER b AS n1, sum(blocked) OVER b AS b1,
           sum(pages) OVER c AS n2, sum(blocked) OVER c AS b2, sum(pages) OVER d AS n3, sum(blocked) OVER d AS b3
    FROM l3 WINDOW a AS (PARTITION BY host), b AS (PARTITION BY host, s1), c AS (PARTITION BY host, s1, s2),
                   d AS (PARTITION BY host, s1, s2, s3)
), named AS (
    SELECT *, CASE
        WHEN abs(b3 / n3 - (b2 + 1.0) / (n2 + 2.0)) >=
             1.96 * sqrt((b2 + 1.0) / (n2 + 2.0) * (1.0 - (b2 + 1.0) / (n2 + 2.0)) / n3) THEN concat_ws('/', host, s1, s2, s3)
        WHEN abs(b2 / n2 - (b1 + 1.0) / (n1 + 2.0)) >=
             1.96 * sqrt((b1 + 1.0) / (n1 + 2.0) * (1.0 - (b1 + 1.0) / (n1 + 2.0)) / n2) THEN concat_ws('/', host, s1, s2, '**')
        WHEN abs(b1 / n1 - (b0 + 1.0) / (n0 + 2.0)) >=
             1.96 * sqrt((b0 + 1.0) / (n0 + 2.0) * (1.0 - (b0 + 1.0) / (n0 + 2.0)) / n1) THEN concat_ws('/', host, s1, '**')
        ELSE concat_ws('/', host, '**') END AS template FROM sums
), pure AS (
    SELECT host, shape, template, sum(blocked) OVER t AS evidence,
           (sum(blocked) OVER t + 4.0 * (SELECT sum(blocked) / sum(pages) FROM leaves)) / (sum(pages) OVER t + 4.0) AS purity
    FROM named WINDOW t AS (PARTITION BY template)
)
SELECT page_id, host, path, rule,
       CASE WHEN label = 1 THEN 'block' WHEN label = 0 THEN 'allow'
            WHEN purity >= 0.5 AND evidence > 0 THEN 'block' ELSE 'allow' END AS verdict,
       template
FROM judged JOIN pure USING (host, shape)
"""


@query
def op9_partial_matching(spark, sf_dir):
    return ppm.score_documents(named_table(spark, sf_dir, "documents"))


@query
def op10_huffman_ids(spark, sf_dir):
    return huffman.id_digests(huffman.coded_roundtrip(named_table(spark, sf_dir, "documents"), WORD_TOKENIZER))


@query
def op11_son_collocations(spark, sf_dir):
    return collocations.collocations(named_table(spark, sf_dir, "documents"))


_SQL["op11_son_collocations"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), w AS (
    SELECT lang, [x FOR x IN regexp_split_to_array(piece, '[\x20\x09]+') IF x <> ''] AS words FROM pieces
), spans AS (
    SELECT lang, words, unnest(range(1, 6)) AS size FROM w WHERE len(words) > 0
), grams AS (
    SELECT lang, size, unnest([array_to_string(words[i:i + size - 1], ' ') FOR i IN range(1, len(words) - size + 2)]) AS phrase
    FROM spans WHERE len(words) >= size
), f AS (
    SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100
), total AS (
    SELECT lang, sum(len(words))::BIGINT AS n FROM w GROUP BY lang
), cand AS (
    SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS words FROM f WHERE size > 1
), cuts AS (
    SELECT *, unnest(range(1, size)) AS k FROM cand
), scored AS (
    SELECT c.lang, c.size, c.phrase, c.a, k, x.f AS l, y.f AS r, n,
           (1000::HUGEINT * c.a * n // (x.f::HUGEINT * y.f))::BIGINT AS score
    FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[1:k], ' ')
                JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.words[k + 1:], ' ')
                JOIN total t ON t.lang = c.lang
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), shorter AS (
    SELECT *, unnest(range(2, size)) AS m FROM cand
), inner_phrases AS (
    SELECT lang, a, unnest([array_to_string(words[i:i + m - 1], ' ') FOR i IN range(1, size - m + 2)]) AS phrase FROM shorter
), outer_most AS (
    SELECT lang, phrase, max(a) AS o FROM inner_phrases GROUP BY ALL
), ranked AS (
    SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, s.a DESC, s.phrase) AS rank
    FROM lowest s LEFT JOIN outer_most o USING (lang, phrase) WHERE o IS NULL OR 100 * o < 100 * s.a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""


@query
def op12_quality_cascade(spark, sf_dir):
    return quality.judge_documents(named_table(spark, sf_dir, "documents")).drop("stopped_by")


_SQL["op12_quality_cascade"] = r"""
WITH t AS (
    SELECT doc_id, coalesce(text, '') AS text FROM documents
), s AS (
    SELECT doc_id, text, [x FOR x IN regexp_split_to_array(text, '[\x20\x09-\x0D]+') IF x <> ''] AS words,
           [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines,
           length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols
    FROM t
), windows AS (
    SELECT doc_id, i, words[i:i + 2] AS w FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM s WHERE len(words) >= 3)
), twice AS (
    SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1
), covered AS (
    SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id
), m AS (
    SELECT doc_id, text, len(words) AS n_words, word_chars, n_symbols, len(lines) AS n_lines,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
           len([x FOR x IN words IF regexp_matches(x, '\p{L}')]) AS lettered
    FROM s LEFT JOIN covered USING (doc_id)
), b AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 100 * n_dup_lines > 50 * n_lines
            OR word_chars < 2 * n_words OR word_chars > 20 * n_words
            OR 100 * length(regexp_replace(text, '[^0-9]', '', 'g')) > 30 * word_chars
            OR 2 * length(regexp_replace(text, '\P{Lu}', '', 'g')) > length(regexp_replace(text, '\P{L}', '', 'g'))
            OR 2 * lettered < n_words) AS kept
FROM b
"""


@query
def op13_qd_whitening(spark, sf_dir):
    return whiten.whitened_rows(named_table(spark, sf_dir, "embeddings"))

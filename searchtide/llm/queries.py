"""The corpus queries by name, and their SQL where SQL can express them."""

from pyspark.sql import functions as F

from searchtide.llm import (
    graph,
    jaccard,
    kdtree,
    language,
    lexical,
    mixing,
    packing,
    secret_scan,
    sharding,
    templates,
    toxicity,
    url_filter,
    whitening,
)
from searchtide.llm.common import read


def word_tokenizer() -> str:
    """Where the public word tokenizer's file is; the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _asked():
    return F.col("vec_id") % 100 == 0


QUERIES = {
    "op1_url_filter": lambda s, d: url_filter.filtered_crawl(read(s, d, "pages")),
    "op2_kd_tree": lambda s, d: kdtree.top_k(read(s, d, "embeddings"), _asked()),
    "op3_pruned_graph": lambda s, d: graph.nearest(read(s, d, "embeddings"), _asked()),
    "op4_packing": lambda s, d: packing.pack(read(s, d, "documents"), word_tokenizer()),
    "op5_ngram_jaccard": lambda s, d: jaccard.digest(read(s, d, "documents")),
    "op6_toxicity": lambda s, d: toxicity.scored(read(s, d, "documents"), read(s, d, "labels")),
    "op7_language_id": lambda s, d: language.predicted(read(s, d, "documents")),
    "op8_secret_scan": lambda s, d: secret_scan.digest(read(s, d, "documents")),
    "op9_mixing": lambda s, d: mixing.mixed_digest(read(s, d, "documents")),
    "op10_sharding": lambda s, d: sharding.shard_digest(read(s, d, "documents")),
    "op11_templates": lambda s, d: templates.digest(read(s, d, "pages")),
    "op12_lexical": lambda s, d: lexical.ranked(read(s, d, "documents"), read(s, d, "benchmark")),
    "op13_whitening": lambda s, d: whitening.whiten(read(s, d, "embeddings")),
}

_HEX = "CAST('0x' || substr({0}, {1}, {2}) AS BIGINT)".format

_URL_TIME = (
    "TIMESTAMP '2024-01-01' + to_hours(CAST(" + _HEX("digest", "{at}", 6) + " % (24 * 365) AS INTEGER))"
)

_URL_SQL = f"""
WITH pages_ AS (
    SELECT page_id, url,
      nullif(rtrim(lower(regexp_extract(url,
        '^[A-Za-z][A-Za-z0-9+.\\-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '.'), '') AS host,
      list_filter(string_split(lower(regexp_extract(url,
        '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*(/[^?#]*)', 1)), '/'), lambda p: p <> '') AS parts,
      md5(concat_ws('/', page_id, url)) AS digest
    FROM pages
), captures AS (
    SELECT page_id, url, host, parts, {_URL_TIME.format(at=1)} AS fetched_at FROM pages_
), patterns AS (
    SELECT DISTINCT unnest([host,
      CASE WHEN len(string_split(host, '.')) > 2
        THEN array_to_string(string_split(host, '.')[-2:], '.') END,
      host || '/' || nullif(split_part(lower(regexp_extract(url,
        '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*(/[^?#]*)', 1)), '/', 2), '')]) AS pattern
    FROM pages_
), listed AS (
    SELECT pattern, md5(pattern) AS digest FROM patterns WHERE pattern IS NOT NULL
), entries AS (
    SELECT 'list-' || substr(digest, 32, 1) AS list, pattern,
      CASE WHEN substr(digest, 31, 1) < '4' THEN 'allow' ELSE 'block' END AS action,
      unnest([true, false, true]) AS added,
      unnest([{", ".join(_URL_TIME.format(at=a) for a in (1, 7, 13))}]) AS since
    FROM listed
), per_time AS (
    SELECT list, pattern, action, since, bool_and(added) AS added FROM entries GROUP BY ALL
), valid AS (
    SELECT *, lead(since) OVER (PARTITION BY list, pattern ORDER BY since) AS until FROM per_time
), keys AS (
    SELECT DISTINCT page_id, url, fetched_at, unnest(list_distinct(list_concat(
      list_transform(range(1, len(string_split(host, '.')) + 1),
        lambda n: array_to_string(string_split(host, '.')[-n:], '.')),
      list_transform(range(1, len(parts) + 1),
        lambda n: host || '/' || array_to_string(parts[1:n], '/'))))) AS pattern
    FROM captures
), judged AS (
    SELECT k.page_id, k.url, count(*) AS n_active,
      max((length(k.pattern), action = 'block', k.pattern, list)) AS best
    FROM keys k JOIN valid v ON k.pattern = v.pattern AND v.added
      AND fetched_at >= since AND (until IS NULL OR fetched_at < until)
    GROUP BY k.page_id, k.url
)
SELECT c.page_id, c.url, c.fetched_at, coalesce(best[2], false) AS blocked,
  best[3] AS pattern, best[4] AS list, coalesce(n_active, 0) AS n_active
FROM captures c LEFT JOIN judged USING (page_id, url)
"""

_MIX_SQL = f"""
WITH RECURSIVE counted AS (
    SELECT doc_id, source, coalesce('s:' || source, 'n') AS key,
      md5('0/' || coalesce(CAST(doc_id AS VARCHAR), '-')) AS digest,
      coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\r\\f\\x0B]+')), 0) AS n_tokens
    FROM documents
), sources AS (
    SELECT key, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM counted GROUP BY key
), base AS (
    SELECT sum(tokens) AS all_tokens,
      list(ln(tokens / (SELECT sum(tokens) FROM sources)) ORDER BY tokens) AS logs
    FROM sources WHERE tokens > 0
), probe AS (
    SELECT 0 AS step, CAST(0 AS DOUBLE) AS low, CAST(1 AS DOUBLE) AS high
    UNION ALL
    SELECT step + 1,
      CASE WHEN ok THEN (low + high) / 2 ELSE low END,
      CASE WHEN ok THEN high ELSE (low + high) / 2 END
    FROM (
      SELECT step, low, high,
        ln(list_sum(list_transform(logs, lambda x: exp((low + high) / 2 * x))))
          - (low + high) / 2
            * list_sum(list_transform(logs, lambda x: exp((low + high) / 2 * x) * x))
            / list_sum(list_transform(logs, lambda x: exp((low + high) / 2 * x)))
          >= 0.999 * ln(len(logs)) - 1e-12 AS ok
      FROM probe, base WHERE step < 30)
), even AS (
    SELECT CASE WHEN
        -list_sum(list_transform(logs, lambda x: exp(x) * x)) >= 0.999 * ln(len(logs)) - 1e-12
      THEN 1.0 ELSE low END AS power
    FROM probe, base WHERE step = 30
), limited AS (
    SELECT 0 AS step, CAST(0 AS DOUBLE) AS low, CAST(1 AS DOUBLE) AS high
    UNION ALL
    SELECT step + 1,
      CASE WHEN ok THEN low ELSE (low + high) / 2 END,
      CASE WHEN ok THEN (low + high) / 2 ELSE high END
    FROM (
      SELECT step, low, high, exp(((low + high) / 2 - 1) * list_min(logs))
          / list_sum(list_transform(logs, lambda x: exp((low + high) / 2 * x))) <= 16 + 1e-12 AS ok
      FROM limited, base WHERE step < 30)
), rare AS (
    SELECT CASE WHEN exp(-list_min(logs)) / len(logs) <= 16 + 1e-12 THEN 0.0 ELSE high END AS power
    FROM limited, base WHERE step = 30
), chosen AS (
    SELECT all_tokens, logs, greatest(even.power, rare.power) AS power FROM base, even, rare
), weights AS (
    SELECT key, tokens, exp(power * ln(tokens / all_tokens))
        / list_sum(list_transform(logs, lambda x: exp(power * x))) AS weight,
      CAST(floor(weight * all_tokens + 0.001) AS BIGINT) AS quota
    FROM sources, chosen WHERE tokens > 0
), planned AS (
    SELECT key, round(weight, 9) AS weight, tokens, quota // tokens AS epochs,
      quota % tokens AS rest, greatest(1, CAST(ceil(tokens / 100000) AS BIGINT)) AS n_blocks
    FROM weights
    UNION ALL SELECT key, 0.0, 0, 1, 0, 1 FROM sources WHERE tokens = 0
), placed AS (
    SELECT c.*, weight, epochs, rest, {_HEX("digest", 1, 8)} % n_blocks AS block
    FROM counted c JOIN planned USING (key)
), blocks AS (
    SELECT key, block, epochs, rest, CAST(sum(n_tokens) AS BIGINT) AS block_tokens
    FROM placed GROUP BY ALL
), per_epoch AS (
    SELECT *, md5(concat_ws('/', '0', epoch, key, block)) AS turn
    FROM (SELECT *, unnest(range(0, epochs + 1)) AS epoch FROM blocks)
), ranked AS (
    SELECT *, row_number() OVER w AS block_rank,
      rest - (sum(block_tokens) OVER w - block_tokens) AS left_
    FROM per_epoch WINDOW w AS (PARTITION BY key, epoch ORDER BY turn, block)
), uses AS (
    SELECT key, block, epoch, block_rank,
      CASE WHEN epoch = epochs AND block_tokens > left_ THEN left_ END AS cut
    FROM ranked WHERE epoch < epochs OR left_ > 0
), used AS (
    SELECT p.*, epoch, block_rank, cut,
      sum(n_tokens) OVER (PARTITION BY key, block, epoch ORDER BY digest
        RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS reached
    FROM placed p JOIN uses USING (key, block)
)
SELECT doc_id, source, n_tokens, weight, epoch, block,
  CAST(block_rank AS INTEGER) AS block_rank
FROM used WHERE cut IS NULL OR reached <= cut
"""

_TOP_SQL = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
      CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (
      PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM scored
)
SELECT * FROM ranked WHERE rank <= 10
"""

_TERMS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    " '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
)

_LEXICAL_SQL = f"""
WITH words AS (
    SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS terms
    FROM documents WHERE text IS NOT NULL
), docs AS (
    SELECT row, doc_id, CAST(len(terms) AS BIGINT) AS n, terms FROM words WHERE len(terms) > 0
), total AS (
    SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_all FROM docs
), asked AS (
    SELECT row_number() OVER () AS item, item_id, unnest(list_distinct({_TERMS})) AS term
    FROM benchmark WHERE text IS NOT NULL
), counted AS (
    SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM docs)
    WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weighed AS (
    SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * df + 1))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM counted GROUP BY term), total
), impacts AS (
    SELECT row, doc_id, term,
      w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_all))) AS impact
    FROM counted JOIN weighed USING (term) JOIN docs USING (row), total
), scored AS (
    SELECT item, item_id, row, doc_id, CAST(sum(impact) AS BIGINT) AS score
    FROM asked JOIN impacts USING (term) GROUP BY ALL
), ranked AS (
    SELECT item_id, CAST(row_number() OVER (
      PARTITION BY item ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank, doc_id, score
    FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 10
"""

ORACLE_SQL = {
    "op1_url_filter": _URL_SQL,
    "op2_kd_tree": _TOP_SQL,
    "op9_mixing": _MIX_SQL,
    "op12_lexical": _LEXICAL_SQL,
}

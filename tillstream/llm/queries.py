"""Contract queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ann, conversation_repair, language_id, line_dedup, minhash, mixing, packing, quality_rules, simhash,
               token_count, url_filter, warc, whitening)
from .common import sql_list, table, written

def token_file(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public vocabulary file (never copied into this repository)."""
    import public_tokenizers

    return public_tokenizers.path(name)


WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of the host list and the pattern rules on every page's URL.

    The pattern rules are data: next to the fixed list, one rule for every
    directory and number that the pages' paths begin with (thousands), of
    which those of a hundredth block.
    """
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    return url_filter.judge_urls(pages, rule_table=directory_rules(pages)).select(
        "page_id", "host", "path", "rule", "verdict", "pattern")


def directory_rules(pages: DataFrame) -> DataFrame:
    """Rules ``*/directory/number^`` (at the end of a word) for the paths of ``pages``."""
    _, path = url_filter.url_parts(F.col("url"))
    begins = F.regexp_extract(path, "^/[A-Za-z]+/[0-9]+", 0)
    text = F.concat(F.lit("*"), F.col("begins"), F.lit("^"))
    return (pages.select(begins.alias("begins")).where("begins <> ''").distinct()
            .select(text.alias("text"), text.alias("pattern"),
                    F.when(F.crc32(F.col("begins").cast("binary")) % 100 == 0, "block").otherwise("allow").alias("action"),
                    F.lit(1).alias("tier")))


def _op1_sql() -> str:
    rules = ", ".join(f"('{r.text}', '{r.regex[4:]}', '{r.action}', {r.tier})"
                      for r in (*url_filter.HOST_RULES, *url_filter.PATTERN_RULES))
    return rf"""
WITH RECURSIVE parts AS (
  SELECT page_id, row_number() OVER () AS rid,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
split AS (
  SELECT page_id, rid,
         translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1), '{url_filter.UPPER}', '{url_filter.LOWER}') AS host,
         regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path
  FROM parts),
begins AS (SELECT DISTINCT regexp_extract(path, '^/[A-Za-z]+/[0-9]+') AS b FROM split),
bits AS (
  SELECT b, 0 AS i, 4294967295::UBIGINT AS crc FROM begins WHERE b <> ''
  UNION ALL
  SELECT b, i + 1, list_reduce([xor(crc, ascii(b[i + 1])::UBIGINT), 1, 2, 3, 4, 5, 6, 7, 8]::UBIGINT[],
                               lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)
  FROM bits WHERE i < length(b)),
rules(txt, rx, action, tier) AS (
  VALUES {rules}
  UNION ALL
  SELECT '*' || b || '^', '.*' || b || '(?:^|$|[^A-Za-z0-9])',
         CASE WHEN xor(crc, 4294967295::UBIGINT) % 100 = 0 THEN 'block' ELSE 'allow' END, 1
  FROM bits WHERE i = length(b)),
hits AS (
  SELECT rid, tier, txt, action,
         row_number() OVER (PARTITION BY rid, tier ORDER BY length(txt) DESC, txt DESC) AS k
  FROM split JOIN rules ON regexp_matches(host || path, rx, 's'))
SELECT page_id, host, path, h.txt AS rule, coalesce(h.action, p.action, 'allow') AS verdict, p.txt AS pattern
FROM split
LEFT JOIN (SELECT * FROM hits WHERE tier = 0 AND k = 1) h USING (rid)
LEFT JOIN (SELECT * FROM hits WHERE tier = 1 AND k = 1) p USING (rid)
"""


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives, normalised, and read back by the index."""
    return warc.store_and_read(table(spark, sf_dir, "pages"), "page_id", "url", "html")


OP2_SQL = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest, row_number() OVER () AS rid
  FROM pages),
f AS (
  SELECT *, first_value(rid) OVER w AS first_rid, first_value(page_id) OVER w AS first_page,
         payload_bytes >= {warc.REVISIT_BYTES} AND page_id IS NOT NULL AS large
  FROM p WINDOW w AS (PARTITION BY payload_digest, page_id IS NULL ORDER BY page_id, rid))
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN large AND rid <> first_rid THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN large AND rid <> first_rid THEN first_page END AS refers_to
FROM f
"""


OP3_COLUMNS = ("doc_id", *quality_rules.STATS, "base_failed", "kept",
               *quality_rules.MORE_STATS, "failed_rules")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of the quality rules for every document."""
    return quality_rules.judge(table(spark, sf_dir, "documents", "doc_id", "text")).select(*OP3_COLUMNS)


def quality_sql(source: str = "documents") -> str:
    """The statistics and verdict as SQL over a table with doc_id and text."""
    w = quality_rules.WINDOW
    checks = []
    for t in quality_rules.THRESHOLDS:
        ratio = f"({t.numerator} / nullif({t.denominator}, 0))"
        tests = ([f"{ratio} < {t.low}"] if t.low is not None else []) \
            + ([f"{ratio} > {t.high}"] if t.high is not None else [])
        checks.append(f"CASE WHEN coalesce({' OR '.join(tests)}, FALSE) THEN '{t.name}' END")
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body, {WORDS} AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM {source}),
places AS (SELECT rid, i, array_to_string(ws[i:i + {w - 1}], ' ') AS win
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - {w - 2})) AS i FROM d WHERE len(ws) >= {w})),
twice AS (
  SELECT rid, i FROM (
    SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS n FROM places) WHERE n > 1),
covered AS (
  SELECT rid, sum(least({w}, coalesce(nxt - i, {w}))) AS n
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM twice) GROUP BY rid),
stats AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words,
         length(array_to_string(ws, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(body, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
         len(list_filter(ws, lambda x: x IN ({sql_list(quality_rules.STOP_FORMS)})))::BIGINT AS n_stop_words,
         len(ls)::BIGINT AS n_lines,
         len(list_filter(ls, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]')))::BIGINT AS n_bullet_lines,
         len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$')))::BIGINT AS n_ellipsis_lines
  FROM d LEFT JOIN covered USING (rid)),
judged AS (
  SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
         concat_ws(',', {', '.join(checks)}) AS failed_rules
  FROM stats)
SELECT doc_id, {', '.join(quality_rules.STATS)}, base_failed,
       (NOT base_failed AND failed_rules = '') AS kept,
       {', '.join(quality_rules.MORE_STATS)}, failed_rules
FROM judged
"""


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without the line chunks that occur before it."""
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text"))


def line_dedup_sql(source: str = "documents") -> str:
    """Chunks by the same rolling hash, compared by their whole text."""
    w, d = line_dedup.WINDOW, line_dedup.DIVISOR
    rolled = " + ".join(f"coalesce(lag(h, {k}) OVER lines, 0) * {pow(line_dedup.BASE, k, line_dedup.PRIME)}"
                        for k in range(w))
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text FROM {source}),
lines AS (
  SELECT rid, doc_id, generate_subscripts(ls, 1) AS i, unnest(ls) AS line
  FROM (SELECT rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM d)),
hashed AS (
  SELECT *, ('0x' || substr(md5(line), 1, 7))::BIGINT AS h,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n_words FROM lines),
cut AS (
  SELECT rid, doc_id, i, line, n_words,
         CASE WHEN (i >= {w} AND ({rolled}) % {line_dedup.PRIME} % {d} = 0) OR n_words >= {line_dedup.OWN_WORDS}
                   OR coalesce(lead(n_words) OVER lines >= {line_dedup.OWN_WORDS}, FALSE) THEN 1 ELSE 0 END AS last
  FROM hashed WINDOW lines AS (PARTITION BY rid ORDER BY i)),
numbered AS (
  SELECT *, coalesce(sum(last) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk
  FROM cut),
chunks AS (
  SELECT rid, doc_id, chunk, string_agg(line, chr(10) ORDER BY i) AS body, count(*) AS n,
         sum(n_words) AS n_words, count(*) FILTER (WHERE regexp_matches(line, '[^ 	-
]')) AS worded
  FROM numbered GROUP BY rid, doc_id, chunk),
firsts AS (
  SELECT *, min(doc_id) OVER (PARTITION BY body) AS first_doc,
         row_number() OVER (PARTITION BY rid, body ORDER BY chunk) AS k
  FROM chunks),
flagged AS (
  SELECT *, worded > 0 AND (k > 1 OR (first_doc IS NOT NULL AND doc_id IS DISTINCT FROM first_doc)) AS flag
  FROM firsts),
kept AS (
  SELECT rid, sum(n) AS n_lines, coalesce(sum(n) FILTER (WHERE gone), 0) AS n_removed_lines,
         coalesce(string_agg(body, chr(10) ORDER BY chunk) FILTER (WHERE NOT gone), '') AS body
  FROM (SELECT *, flag AND (worded >= {line_dedup.MIN_LINES} OR n_words >= {line_dedup.MIN_WORDS}
                            OR coalesce(lag(flag) OVER beside, FALSE) OR coalesce(lead(flag) OVER beside, FALSE)) AS gone
        FROM flagged WINDOW beside AS (PARTITION BY rid ORDER BY chunk))
  GROUP BY rid)
SELECT doc_id, CASE WHEN text IS NULL THEN NULL ELSE body END AS text,
       n_lines::BIGINT AS n_lines, n_removed_lines::BIGINT AS n_removed_lines
FROM d JOIN kept USING (rid)
"""


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"), token_file())


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, and when it first does."""
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    sized = written(docs.select("doc_id", "source", mixing.n_words(F.col("text")).alias("size"),
                                F.md5(F.col("text").cast("binary")).alias("text_md5")), "sized")
    planned = written(mixing.plan(sized, apart="text_md5"), "planned")
    return mixing.by_position(planned).select("doc_id", "size", "source_size", "target", "taken", "position")


def _time_sql(share: str, weight: str) -> str:
    cases = []
    for w, knots in mixing.SCHEDULES.items():
        of = ""
        for t0, before, factor, slope in reversed(mixing.pieces_of(knots)):
            at = f"({t0}::DOUBLE + 2 * ({share} - {before}::DOUBLE) / ({factor}::DOUBLE + sqrt({factor * factor}::DOUBLE + {2 * slope}::DOUBLE * ({share} - {before}::DOUBLE))))"
            of += f" WHEN {share} >= {before}::DOUBLE THEN {at}"
        cases.append(f"WHEN {weight} = {w} THEN CASE{of} END")
    return f"CASE {' '.join(cases)} END"


def _op6_sql() -> str:
    n, r = len(mixing.WEIGHTS), mixing.MOST_REPEATS
    taken = " + ".join(f"greatest(0, least(size, need - ({e} * source_size + start)))" for e in range(r))
    return f"""
WITH RECURSIVE sized AS (SELECT doc_id, source, len({WORDS})::BIGINT AS size, coalesce(md5(text), 'null') AS apart FROM documents),
sources AS (
  SELECT source, source_size, [{', '.join(map(str, mixing.WEIGHTS))}][((k - 1) % {n}) + 1] AS weight
  FROM (SELECT source, sum(size)::BIGINT AS source_size,
               row_number() OVER (ORDER BY source COLLATE "binary" NULLS LAST) AS k
        FROM sized GROUP BY source)),
level AS (
  SELECT 0 AS step, (SELECT sum(source_size)::BIGINT / sum(weight)::BIGINT FROM sources) AS level
  UNION ALL
  SELECT step + 1, (SELECT (sum(source_size) - coalesce(sum({r} * source_size) FILTER (WHERE {r} * source_size < weight * level.level), 0))::BIGINT
                           / (sum(weight) FILTER (WHERE NOT {r} * source_size < weight * level.level))::BIGINT FROM sources)
  FROM level WHERE step < 30),
aims AS (
  SELECT source, source_size, weight,
         least(({r} * source_size)::DOUBLE, weight * (SELECT level FROM level WHERE step = 30)) AS target
  FROM sources),
placed AS (
  SELECT s.*, a.source_size, a.weight, a.target, floor(a.target + 0.5)::BIGINT AS need,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY md5(coalesce(s.doc_id::VARCHAR, 'null') || ':' || s.apart), s.doc_id, s.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized s JOIN aims a ON s.source IS NOT DISTINCT FROM a.source),
shares AS (SELECT *, ({taken})::BIGINT AS taken, start / nullif(need, 0) AS share FROM placed)
SELECT doc_id, size, source_size, target, taken,
       CASE WHEN taken > 0 THEN {_time_sql('share', 'weight')} END AS position
FROM shares
"""


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most probable language of every page; text models from a sample of the documents."""
    languages, model = language_id.train(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))
    return language_id.identify(table(spark, sf_dir, "pages"), languages, model)


def op8_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20 nearest vectors found of every vector whose id is divisible by 20."""
    return ann.search(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), lambda i: i % 20 == 0)


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 3-word shingles, 2 bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram tokens of every document, with the score of its best segmentation."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return (docs.withColumn("counted", token_count.token_count(F.col("text"), token_file("piece_bpe_32k.model")))
            .select("doc_id", "counted.*"))


def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document: 4-word shingles, similarity 0.8."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest audit and digest of the repaired rows of every damaged conversation."""
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    audits, repaired = conversation_repair.repair(conversation_repair.damage(rows))
    return conversation_repair.of_every(rows, audits, conversation_repair.digests(repaired))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every usable vector, fitted on all of them."""
    return whitening.whiten(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


QUERIES = {
    "op1_url_filters": op1_url_filters,
    "op2_warc": op2_warc,
    "op3_quality_rules": op3_quality_rules,
    "op4_line_dedup": op4_line_dedup,
    "op5_packing": op5_packing,
    "op6_source_mixing": op6_source_mixing,
    "op7_language_id": op7_language_id,
    "op8_ann_search": op8_ann_search,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_token_counts": op10_token_counts,
    "op11_minhash_near_dedup": op11_minhash_near_dedup,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_embedding_whitening": op13_embedding_whitening,
}

ORACLE = {
    "op1_url_filters": _op1_sql(),
    "op2_warc": OP2_SQL,
    "op3_quality_rules": quality_sql(),
    "op4_line_dedup": line_dedup_sql(),
    "op6_source_mixing": _op6_sql(),
}

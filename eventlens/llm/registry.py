"""The registered queries of this subpackage and their DuckDB statements.

Each query applies one operator, with its production parameters, to its whole table.
Where SQL can not express an operator (`op1`, `op2`, `op4`, `op9` and `op10` at whole
tables, `op8` for its checksum), `tests/llm` holds the query against brute force.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventlens.llm import (
    bpe, decontamination, hamming, licenses, merkle, mixing, ngram_join, prefix_trie, quality, sharding, statements,
    substring, suffix, warc)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup_summary(_table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "failed_rules")


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs, carry=["doc_id"]).select("row.doc_id", "size", "source_size", "target", "taken")


NEAREST = 10


def op7_hamming_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return hamming.top_k(vectors, vectors.filter("vec_id % 50 = 0"), NEAREST)


SHARDS = 8


def op8_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    placed = sharding.shard_rows(docs, sharding.equal(SHARDS), sharding.equal(SHARDS + 1))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(_table(spark, sf_dir, "documents"))
    return found.withColumn("n_matches", F.size("matches").cast("long")).drop("matches")


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = ngram_join.component_ids(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "n_shingles", "component_id")


def op3_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = warc.archive_pages(spark, _table(spark, sf_dir, "pages"))
    return warc.resolve(warc.read_records(spark, archive, payloads=False))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.dedup_summary(_table(spark, sf_dir, "documents"))


TOKENIZER = "word_bpe_49k.json"


def op10_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_digests(docs, public_tokenizers.path(TOKENIZER))


def op11_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = decontamination.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return leaks.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(_table(spark, sf_dir, "conversations"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_manifest(_table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {f.__name__: f for f in (
        op1_license_scan, op2_ngram_join, op3_warc_revisits, op4_substring_dedup, op5_quality_rules, op6_source_mixing, op7_hamming_top_k, op8_rendezvous_sharding,
        op9_suffix_dedup, op10_bpe_codec, op11_benchmark_decontamination, op12_prefix_trie, op13_merkle_manifest)}


_SPACE = r"[\x20\x09-\x0D]+"

_OP5 = rf"""
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '{_SPACE}'), lambda w: w <> '') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
         row_number() OVER () AS r
  FROM documents),
grams AS (
  SELECT r, i, list_aggregate(ws[i:i+4], 'string_agg', ' ') AS g
  FROM (SELECT r, ws, unnest(generate_series(1, len(ws) - 4)) AS i FROM words WHERE len(ws) >= 5)),
found AS (SELECT r, i FROM grams QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
repeats AS (
  SELECT r, sum(least(5, step)) AS n
  FROM (SELECT r, coalesce(i - lag(i) OVER (PARTITION BY r ORDER BY i), 5) AS step FROM found) GROUP BY r),
counted AS (
  SELECT doc_id, len(ws) AS n_words, coalesce(length(list_aggregate(ws, 'string_agg', '')), 0) AS word_chars,
         length(text) - length(regexp_replace(text, '{quality.SYMBOLS}', '', 'g')) AS n_symbols,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
         len(ls) AS n_lines, length(text) - length(regexp_replace(text, '\p{{Lu}}', '', 'g')) AS n_upper,
         len(list_distinct(list_filter(ws, lambda w: list_contains({sorted(set(quality.STOP_WORDS))!r}, w)))) AS n_stop,
         coalesce(len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i-1])), 0) AS n_echo
  FROM words LEFT JOIN repeats USING (r)),
ratios AS (
  SELECT *, n_repeat_words / nullif(n_words, 0) AS repeat_ratio, word_chars / nullif(n_words, 0) AS mean_word_length,
         n_echo / nullif(n_words, 0) AS echo_ratio, n_symbols / nullif(n_words, 0) AS symbol_ratio,
         CASE WHEN n_words >= {quality.STOP_FROM} THEN n_stop END AS stop_words,
         n_upper / nullif(word_chars, 0) AS upper_ratio, n_dup_lines / nullif(n_lines, 0) AS dup_line_ratio,
         n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
  FROM counted),
failed AS (
  SELECT *, concat_ws(',', {", ".join(
      f"CASE WHEN {' OR '.join([f'{r.measure} < {r.low}'] * (r.low is not None) + [f'{r.measure} > {r.high}'] * (r.high is not None))} THEN '{r.name}' END"
      for r in quality.RULES)}) AS failed_rules
  FROM ratios)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed_rules = '' AS kept, failed_rules
FROM failed
"""

_COUNT = rf"len(list_filter(string_split_regex(coalesce(text, ''), '{_SPACE}'), lambda w: w <> ''))"

_OP6 = f"""
WITH docs AS (
  SELECT doc_id, source, {_COUNT} AS size, md5(concat('{mixing.SEED}:', coalesce(doc_id::VARCHAR, 'null'))) AS o
  FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
weighed AS (
  SELECT *, ({list(map(float, mixing.WEIGHTS))})[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1]::DOUBLE AS w
  FROM sizes),
levels AS (
  SELECT *, (sum(source_size) OVER () * {mixing.SHARE}::DOUBLE - {mixing.REPEAT} * coalesce(sum(source_size) OVER b, 0))
            / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level
  FROM weighed
  WINDOW b AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
aimed AS (
  SELECT source, source_size, coalesce(least(({mixing.REPEAT} * source_size)::DOUBLE, lev * w), {mixing.REPEAT} * source_size) AS target
  FROM (SELECT *, max(CASE WHEN {mixing.REPEAT} * source_size > level * w THEN level END) OVER () AS lev FROM levels)),
source_seats AS (SELECT round(sum(target) / {mixing.BLOCK_WORDS})::BIGINT AS seats FROM aimed),
source_bids AS (
  SELECT source, target / (2 * i + 1) AS quotient, i
  FROM (SELECT source, target, unnest(range(0, (target / {mixing.BLOCK_WORDS})::BIGINT + 100)) AS i FROM aimed WHERE target > 0)),
source_quota AS (
  SELECT source, count(*) AS quota
  FROM (SELECT * FROM source_bids QUALIFY row_number() OVER (ORDER BY quotient DESC, source NULLS LAST, i)
          <= (SELECT seats FROM source_seats)) GROUP BY source),
placed AS (
  SELECT d.*, a.source_size, a.target, coalesce(q.quota, 0) AS quota,
         ('0x' || o[1:8])::BIGINT % greatest(1, ceil(a.source_size / {mixing.SHARD_WORDS}))::BIGINT AS shard
  FROM docs d JOIN aimed a ON d.source IS NOT DISTINCT FROM a.source
  LEFT JOIN source_quota q ON d.source IS NOT DISTINCT FROM q.source),
shards AS (SELECT source, shard, sum(size) AS shard_size, any_value(quota) AS quota FROM placed GROUP BY source, shard),
shard_quota AS (
  SELECT source, shard, count(*) AS quota
  FROM (SELECT source, shard, quota, shard_size / (2 * i + 1) AS quotient, i
        FROM (SELECT *, unnest(range(0, quota)) AS i FROM shards WHERE shard_size > 0)
        QUALIFY row_number() OVER (PARTITION BY source ORDER BY quotient DESC, shard, i) <= quota)
  GROUP BY source, shard),
words AS (
  SELECT s.source, s.shard, shard_size,
         least(coalesce(q.quota, 0) * {mixing.BLOCK_WORDS}, {mixing.REPEAT} * shard_size) AS words
  FROM shards s LEFT JOIN shard_quota q ON s.source IS NOT DISTINCT FROM q.source AND s.shard = q.shard),
laid AS (
  SELECT p.*, shard_size, words, coalesce(sum(size) OVER (
           PARTITION BY p.source, p.shard ORDER BY o, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM placed p JOIN words w ON p.source IS NOT DISTINCT FROM w.source AND p.shard = w.shard)
SELECT doc_id, size, source_size, target,
       CASE WHEN shard_size = 0 THEN 0
            ELSE words // shard_size * size + greatest(0, least(size, words % shard_size - start)) END::BIGINT AS taken
FROM laid
"""

_KEY = "coalesce(doc_id::VARCHAR, 'null')"


def _best_shard(n: int) -> str:
    score = f"-ln((('0x' || md5(concat({_KEY}, ':', s))[1:13])::BIGINT::DOUBLE + 0.5) / {2**52}::DOUBLE)"
    return f"(SELECT arg_min(s, {score}) FROM range({n}) t(s))::INT"


# CRC-32 by its definition: the table from the reflected polynomial, then a fold over the bytes.
_OP8 = f"""
WITH RECURSIVE steps AS (
  SELECT b AS byte, b AS c, 0 AS k FROM range(256) t(b)
  UNION ALL
  SELECT byte, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
lookup AS (SELECT list(c ORDER BY byte) AS crc FROM steps WHERE k = 8),
docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
summed AS (
  SELECT doc_id, len(h) // 2 + 1 AS size,
         xor(list_reduce(list_prepend(4294967295, list_transform(range(0, len(h) // 2), lambda i: ('0x' || h[2*i+1:2*i+2])::BIGINT)),
             lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM docs, lookup)
SELECT doc_id, size, text_crc32, 'key' AS law, {_best_shard(SHARDS)} AS shard,
       row_number() OVER (PARTITION BY {_best_shard(SHARDS)}
                          ORDER BY md5(concat({_KEY}, ':', text_crc32)), doc_id, size) - 1 AS slot,
       {_best_shard(SHARDS + 1)} AS grown_shard
FROM summed
"""


_OP7 = f"""
WITH codes AS (
  SELECT DISTINCT vec_id, list_aggregate(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), 'string_agg', '')::BIT AS code
  FROM embeddings),
pairs AS (
  SELECT q.vec_id AS query_id, r.vec_id AS neighbor_id, bit_count(xor(q.code, r.code))::BIGINT AS distance
  FROM codes q JOIN codes r ON q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank, neighbor_id, distance
FROM pairs QUALIFY rank <= {NEAREST}
"""

_OP3 = f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (
  SELECT *, CASE WHEN payload_bytes >= {warc.MIN_BYTES} THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to
FROM firsts
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_warc_revisits": _OP3, "op7_hamming_top_k": _OP7, "op5_quality_rules": _OP5, "op6_source_mixing": _OP6, "op8_rendezvous_sharding": _OP8,
            "op11_benchmark_decontamination": statements.OP11, "op12_prefix_trie": statements.OP12,
            "op13_merkle_manifest": statements.OP13}

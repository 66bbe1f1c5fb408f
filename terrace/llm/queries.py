"""The registered queries of this subpackage and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import dart_minhash, exact_dedup, html_density, merkle, mixing, periodic, piece_codec, probe_ann, quality_rules, secret_scan, sharding, simple8b, token_counts
from terrace.llm.common import whole_text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Temperature mixing of the sources, at most two passes over any, none cut below one."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op2_digest_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact dedup through a history of digests."""
    return exact_dedup.dedup(table(spark, sf_dir, "documents"))


def op3_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards over fixed virtual slots, and the shard after one more is added."""
    return sharding.shard(table(spark, sf_dir, "documents"), 8)


def tokenizer(name: str) -> str:
    """The place of a public tokenizer's file, which every machine of the cluster has."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op4_piece_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece ids with source spans, and the decoded texts."""
    return piece_codec.encode_documents(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op5_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of the pages by composite text density."""
    return html_density.extract(table(spark, sf_dir, "pages"))


def op6_overlap_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts with overlapping chunks for huge documents."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op7_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes by DartMinHash."""
    return dart_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_randomness_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets by fixed patterns and by tests of randomness."""
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op9_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules with host verdicts."""
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op10_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids written as Simple-8b blocks and read back."""
    return simple8b.round_trip(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op11_multiprobe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every 20th, by multiprobe p-stable hashing."""
    return probe_ann.search(table(spark, sf_dir, "embeddings"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words, and the words left when each is cut to one period."""
    docs = table(spark, sf_dir, "documents")
    edited = docs.select("doc_id", periodic.looped(F.col("doc_id"), whole_text()).alias("text"))
    return periodic.digests(periodic.detect(edited))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves, subroots by language, root and proofs of the documents."""
    return merkle.prove(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_temperature_mix": op1_temperature_mix,
    "op2_digest_history": op2_digest_history,
    "op3_virtual_slots": op3_virtual_slots,
    "op4_piece_offsets": op4_piece_offsets,
    "op5_text_density": op5_text_density,
    "op6_overlap_counts": op6_overlap_counts,
    "op7_dart_minhash": op7_dart_minhash,
    "op8_randomness_battery": op8_randomness_battery,
    "op9_host_quality": op9_host_quality,
    "op10_simple8b": op10_simple8b,
    "op11_multiprobe": op11_multiprobe,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE: dict[str, str] = {
    "op1_temperature_mix": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS tokens FROM documents),
s AS (SELECT source, sum(tokens)::BIGINT AS n FROM d GROUP BY source),
ns AS (SELECT list(n::DOUBLE) AS l, sum(n)::DOUBLE AS t FROM s WHERE n > 0),
b AS (
  SELECT 0 AS i, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi
  UNION ALL
  SELECT i + 1, CASE WHEN bad THEN (lo + hi) / 2 ELSE lo END, CASE WHEN bad THEN hi ELSE (lo + hi) / 2 END
  FROM (
    SELECT b.*, list_max(list_transform(l, lambda x: pow(x / t, (lo + hi) / 2) / x))
      / list_min(list_transform(l, lambda x: pow(x / t, (lo + hi) / 2) / x)) > 2.0 AS bad
    FROM b, ns WHERE i < 30)),
a AS (SELECT round(hi, 6) AS a FROM b WHERE i = 30),
p AS (SELECT sum(pow(n / t, a)) AS z, min(pow(n / t, a) / n) AS least FROM s, ns, a WHERE n > 0),
g AS (
  SELECT source, n, greatest(n, round(pow(n / t, a) / z * (z / least))::BIGINT) AS budget, greatest(1, ceil(floor(z / least) / 1048576)) AS nb
  FROM s, ns, a, p),
e AS (SELECT *, CASE WHEN n > 0 THEN budget // n ELSE 1 END AS whole, CASE WHEN n > 0 THEN budget % n ELSE 0 END AS rest FROM g),
x AS (
  SELECT doc_id, d.source, tokens, e.whole, e.rest, e.budget, e.nb, unnest(range(0, (e.whole + (e.rest > 0)::INT)::BIGINT)) AS pass
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source),
y AS (SELECT *, ('0x' || substr(md5('0:' || pass || ':' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT AS h FROM x),
c AS (
  SELECT *, coalesce(sum(tokens) OVER (PARTITION BY source ORDER BY pass, h, doc_id, tokens
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM y)
SELECT doc_id, source, tokens AS n_tokens, pass, CASE WHEN budget > 0 THEN least(floor(before / budget * nb), nb - 1) ELSE 0 END::BIGINT AS block,
  ('0x' || substr(md5('0:block:' || pass || ':' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT AS block_order
FROM c WHERE pass < whole OR before < budget""",
    "op2_digest_history": r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h,
    row_number() OVER () AS r FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
  first_value(r) OVER w = r AS kept, h AS text_sha256
FROM d WINDOW w AS (PARTITION BY h ORDER BY n DESC, doc_id NULLS LAST, r)""",
    "op9_host_quality": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, t, doc_id, source, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d),
win AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1),
cover AS (SELECT r, count(DISTINCT i + o) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS o) GROUP BY r),
ln AS (SELECT r, count(*) AS n, count(*) - count(DISTINCT x) AS dup
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (
  SELECT w.r, doc_id, source, len(words)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(ln.dup, 0)::BIGINT AS n_dup_lines, coalesce(ln.n, 0) AS n_lines, coalesce(cover.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN cover ON w.r = cover.r LEFT JOIN ln ON w.r = ln.r),
f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR n_symbols > 0.1 * n_words OR n_dup_lines > 0.3 * n_lines
     OR word_chars < 2 * n_words OR word_chars > 14 * n_words)::INT AS bad
  FROM m),
h AS (SELECT source, count(*)::DOUBLE AS n, sum(bad)::DOUBLE AS k FROM f GROUP BY source),
p AS (SELECT sum(k) / sum(n) AS mean, sum(k * k / n) / sum(n) - (sum(k) / sum(n)) ^ 2 AS v FROM h),
q AS (SELECT mean, CASE WHEN v > 0 THEN least(greatest(mean * (1 - mean) / v - 1, 10), 10000) ELSE 10000 END AS weight FROM p),
refused AS (SELECT source FROM h, q
  WHERE (k + weight * mean) / (n + weight) >= least(greatest(mean + 3 * sqrt(mean * (1 - mean) / (weight + 1)), 0.5), 0.9))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  EXISTS (SELECT 1 FROM refused WHERE refused.source IS NOT DISTINCT FROM f.source) AS host_refused,
  NOT base_failed AND NOT EXISTS (SELECT 1 FROM refused WHERE refused.source IS NOT DISTINCT FROM f.source) AS kept
FROM f""",
    "op13_merkle_manifest": r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, lang, n_chars,
    CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END
      || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
      || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS head,
    CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS tail
  FROM documents),
bits AS (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) AS t FROM (SELECT unnest(range(0, 256))::BIGINT AS i)),
crc AS (SELECT list(t ORDER BY i) AS t FROM bits),
x AS (
  SELECT d.*, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: xor(a // 256, t[1 + xor(a % 256, b)])), 4294967295) AS c
  FROM d, crc),
leaf AS (
  SELECT r, doc_id, coalesce('v' || lang, '') AS g, sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END || tail) AS h,
    sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen((n_chars + (CASE WHEN c % 7 = 0 THEN 1 ELSE 0 END))::VARCHAR) || ':' || (n_chars + (CASE WHEN c % 7 = 0 THEN 1 ELSE 0 END)) END || tail) AS changed
  FROM x),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h, r) - 1 AS pos FROM leaf),
up AS (
  SELECT 0 AS level, g, pos, h FROM placed
  UNION ALL
  SELECT level + 1, g, pos // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM up
  WHERE (level, g) IN (SELECT (level, g) FROM up GROUP BY level, g HAVING count(*) > 1) GROUP BY level, g, pos // 2),
sub AS (SELECT g, arg_max(h, level) AS h, row_number() OVER (ORDER BY g) - 1 AS pos FROM up GROUP BY g),
whole AS (
  SELECT 0 AS level, pos, h FROM sub
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM whole WHERE (SELECT count(*) FROM whole) > 1 GROUP BY level, pos // 2),
beside AS (
  SELECT p.r, 0 AS part, u.level, u.h FROM placed p JOIN up u ON u.g = p.g AND u.pos = xor(p.pos >> u.level, 1)
  UNION ALL
  SELECT p.r, 1, w.level, w.h FROM placed p JOIN sub s ON s.g = p.g JOIN whole w ON w.pos = xor(s.pos >> w.level, 1)),
proof AS (SELECT r, string_agg(h, '' ORDER BY part, level) AS siblings FROM beside GROUP BY r),
fold AS (
  SELECT r, g, pos, 0 AS level, changed AS node FROM placed
  UNION ALL
  SELECT f.r, f.g, f.pos, f.level + 1, sha256(CASE WHEN u.h IS NULL THEN node WHEN (f.pos >> f.level) % 2 = 1 THEN u.h || node ELSE node || u.h END)
  FROM fold f JOIN (SELECT g, max(level) AS top FROM up GROUP BY g) t ON t.g = f.g AND f.level < t.top
  LEFT JOIN up u ON u.g = f.g AND u.level = f.level AND u.pos = xor(f.pos >> f.level, 1)),
fold2 AS (
  SELECT r, s.pos, 0 AS level, node FROM (SELECT r, any_value(g) AS g, arg_max(node, level) AS node FROM fold GROUP BY r) f JOIN sub s ON s.g = f.g
  UNION ALL
  SELECT f.r, f.pos, f.level + 1, sha256(CASE WHEN w.h IS NULL THEN node WHEN (f.pos >> f.level) % 2 = 1 THEN w.h || node ELSE node || w.h END)
  FROM fold2 f JOIN (SELECT max(level) AS top FROM whole) t ON f.level < t.top LEFT JOIN whole w ON w.level = f.level AND w.pos = xor(f.pos >> f.level, 1)),
ends AS (SELECT r, arg_max(node, level) AS folded_root FROM fold2 GROUP BY r),
root AS (SELECT arg_max(h, level) AS root FROM whole)
SELECT doc_id, placed.h AS leaf, sub.h AS subroot, root.root, sha256(coalesce(siblings, '')) AS proof_sha256, folded_root, folded_root = root.root AS verified
FROM placed JOIN sub ON sub.g = placed.g JOIN ends ON ends.r = placed.r LEFT JOIN proof ON proof.r = placed.r, root""",
}

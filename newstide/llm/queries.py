"""The registered queries of this folder, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from newstide.llm.common import read_table
from newstide.llm.decontaminate import leak_digest
from newstide.llm.html_text import extract_text
from newstide.llm.importance import resample_digest
from newstide.llm.mixing import mix_digest
from newstide.llm.ngram_join import join_digest
from newstide.llm.packing import packing_digest
from newstide.llm.periodic_runs import run_digest
from newstide.llm.pii import find_pii
from newstide.llm.quality import quality_digest
from newstide.llm.secret_scan import scan_secrets
from newstide.llm.sharding import shard_digest
from newstide.llm.suffix_dedup import repeat_digest
from newstide.llm.warc import warc_digest

Query = Callable[[SparkSession, str], DataFrame]


def op1_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return join_digest(read_table(spark, folder, "documents"))


def op2_weak_pii(spark: SparkSession, folder: str) -> DataFrame:
    return find_pii(read_table(spark, folder, "documents"))


def op3_layout_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract_text(read_table(spark, folder, "pages"))


def op4_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mix_digest(read_table(spark, folder, "documents"))


def op5_virtual_slots(spark: SparkSession, folder: str) -> DataFrame:
    return shard_digest(read_table(spark, folder, "documents"))


def op6_warc_members(spark: SparkSession, folder: str) -> DataFrame:
    return warc_digest(read_table(spark, folder, "pages"))


def op7_benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return leak_digest(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


def op8_layered_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return scan_secrets(read_table(spark, folder, "documents"))


def op9_robust_outliers(spark: SparkSession, folder: str) -> DataFrame:
    return quality_digest(read_table(spark, folder, "documents"))


def op10_suffix_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeat_digest(read_table(spark, folder, "documents"))


def op11_bit_sliced_weights(spark: SparkSession, folder: str) -> DataFrame:
    return resample_digest(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


def op12_word_runs(spark: SparkSession, folder: str) -> DataFrame:
    return run_digest(read_table(spark, folder, "documents"))


def op13_stock_packing(spark: SparkSession, folder: str) -> DataFrame:
    from public_tokenizers import path  # vocabulary files are not part of the library

    return packing_digest(read_table(spark, folder, "documents"), path("byte_bpe_50k.json"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_ngram_jaccard,
        op2_weak_pii,
        op3_layout_text,
        op4_source_mix,
        op5_virtual_slots,
        op6_warc_members,
        op7_benchmark_leaks,
        op8_layered_secrets,
        op9_robust_outliers,
        op10_suffix_repeats,
        op11_bit_sliced_weights,
        op12_word_runs,
        op13_stock_packing,
    )
}

MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    (('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, '-')), 1, 13))::BIGINT + 0.5::DOUBLE)
      / 4503599627370496.0::DOUBLE AS u,
    greatest(0.05::DOUBLE, length(regexp_replace(coalesce(text, ''), '[#*$%&|<>{}0-9]+', '', 'g'))::DOUBLE
      / greatest(length(coalesce(text, '')), 1)) AS quality
  FROM documents
), keyed AS (
  SELECT *, 1::DOUBLE - pow(u, 1::DOUBLE / quality) AS v FROM sized
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    CASE ((row_number() OVER (ORDER BY encode(source) NULLS LAST)) - 1) % 3
      WHEN 0 THEN 3::DOUBLE WHEN 1 THEN 1::DOUBLE ELSE 2::DOUBLE END AS w
  FROM keyed GROUP BY source
), filled AS (
  SELECT *, 2::DOUBLE * source_size AS most,
    row_number() OVER fill AS turn,
    (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2::DOUBLE * source_size) OVER before, 0::DOUBLE))
      / (sum(w) OVER () - coalesce(sum(w) OVER before, 0::DOUBLE)) AS level
  FROM sources
  WINDOW fill AS (ORDER BY 2::DOUBLE * source_size / w, encode(source) NULLS LAST),
    before AS (ORDER BY 2::DOUBLE * source_size / w, encode(source) NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levelled AS (
  SELECT *, min_by(level, CASE WHEN most / w > level THEN turn END) OVER () AS at_level FROM filled
), goals AS (
  SELECT source, source_size, coalesce(least(most, at_level * w), most) AS target FROM levelled
), planned AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM goals
), run AS (
  SELECT k.doc_id, k.source, k.size, p.source_size, p.target, p.epochs,
    p.target - p.epochs * p.source_size AS rest,
    sum(k.size) OVER (PARTITION BY k.source ORDER BY k.v, k.doc_id) AS ahead
  FROM keyed k JOIN planned p ON k.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, source, size, source_size, target,
  (size * (epochs + CASE WHEN ahead - size / 2.0::DOUBLE <= rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM run
"""

WARC_SQL = """
WITH paid AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
    sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), first AS (
  SELECT *, CASE WHEN payload_bytes >= 1000
    THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS kept FROM paid
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN kept IS NULL OR kept = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN kept <> page_id THEN kept END AS refers_to
FROM first
"""

LEAK_SQL = r"""
WITH doc_words AS (
  SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w
  FROM documents
), item_words AS (
  SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w
  FROM benchmark
), doc_sets AS (
  SELECT doc_id, unnest(CASE WHEN len(w) >= 5
    THEN [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM doc_words
), item_sets AS (
  SELECT DISTINCT item_id, unnest(CASE WHEN len(w) >= 5
    THEN [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM item_words
), sizes AS (
  SELECT item_id, count(*) AS n FROM item_sets GROUP BY item_id
), met AS (
  SELECT doc_id, item_id, count(DISTINCT s) AS shared FROM item_sets JOIN doc_sets USING (s) GROUP BY ALL
)
SELECT doc_id, item_id, n::INTEGER AS item_shingles, shared::INTEGER AS shared
FROM met JOIN sizes USING (item_id) WHERE 5 * shared >= 4 * n
"""

JOIN_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4
    THEN [array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)]
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM split
), sizes AS (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), met AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM met JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * k >= 85 * (x.n + y.n - k)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, min(r.b) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN reach r ON r.a = d.doc_id
GROUP BY d.doc_id, s.n
"""

REPEAT_SQL = """
WITH bytes AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), strings AS (
  SELECT doc_id, i, substr(x, 2 * i + 1, 100) AS s
  FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2 - 49)) AS i FROM bytes)
), firsts AS (
  SELECT s, min(doc_id) AS first FROM strings GROUP BY s
), hits AS (
  SELECT doc_id, i FROM strings JOIN firsts USING (s) WHERE first < doc_id
), edges AS (
  SELECT doc_id, i, CASE WHEN i - lag(i) OVER w <= 50 THEN 0 ELSE 1 END AS new
  FROM hits WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), runs AS (
  SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM edges
), spans AS (
  SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM runs GROUP BY doc_id, run
), gaps AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER w, 0) AS before, lead(a) OVER w AS next
  FROM spans WINDOW w AS (PARTITION BY doc_id ORDER BY a)
), removed AS (
  SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans,
    string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a)
      || max(CASE WHEN next IS NULL THEN substr(x, 2 * b + 1) END) AS kept
  FROM gaps JOIN bytes USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, (length(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM bytes LEFT JOIN removed USING (doc_id)
"""

# The checksum of a string of hexadecimal digits' bytes, from the table its rule gives.
_CODES_CTE = r"""codes AS (
  SELECT list(c ORDER BY n) AS table_ FROM (
    SELECT n, list_reduce([n::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
      lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS n))
)"""


def _crc32_sql(digits: str) -> str:
    return f"""xor(list_reduce(list_concat([4294967295::BIGINT],
      [('0x' || substr({digits}, 2 * i + 1, 2))::BIGINT FOR i IN range(0, length({digits}) // 2)]),
      lambda c, b: xor(c >> 8, table_[(xor(c, b) & 255) + 1])), 4294967295)"""


IMPORTANCE_SQL = f"""
WITH {_CODES_CTE}, texts AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark
), split AS (
  SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM texts
), grams AS (
  SELECT side, id, unnest(list_concat(w, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))],
    [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)])) AS g FROM split
), counted AS (
  SELECT side, id, g, count(*) AS n FROM grams GROUP BY ALL
), spelled AS (
  SELECT g, hex(encode(g)) AS x FROM (SELECT DISTINCT g FROM counted)
), hashed AS (
  SELECT g, {_crc32_sql('x')} % 10000 AS bucket
  FROM spelled, codes
), buckets AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 'b'), 0)::DOUBLE AS t
  FROM counted JOIN hashed USING (g) GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain
  FROM buckets
), weights AS (
  SELECT id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
  FROM counted JOIN hashed USING (g) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id
), scored AS (
  SELECT id AS doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || id), 1, 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296::DOUBLE)))::BIGINT AS score
  FROM split LEFT JOIN weights USING (id) WHERE side = 'd'
), placed AS (
  SELECT *, CASE WHEN n_words >= 20 THEN row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) END AS place,
    count(*) FILTER (n_words >= 20) OVER () AS fit
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 5 * fit // 100 THEN place END::BIGINT AS rank FROM placed
"""

RUN_SQL = f"""
WITH {_CODES_CTE}, split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w, hex(encode(doc_id::VARCHAR)) AS x
  FROM documents
), shaped AS (
  SELECT doc_id, w, len(w) AS n, {_crc32_sql('x')} AS h FROM split, codes
), placed AS (
  SELECT *, (h // 10) % n AS a, 1 + (n - (h // 10) % n) // (3 + (h // 10) % 8) AS p FROM shaped
), moved AS (
  SELECT doc_id, CASE WHEN h % 10 = 0 AND n > 0
    THEN [CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END FOR i IN range(0, n)] ELSE w END AS w
  FROM placed
), grams AS (
  SELECT doc_id, n, i, array_to_string(w[i + 1:i + 16], ' ') AS g
  FROM (SELECT doc_id, w, len(w) AS n, unnest(range(0, len(w) - 15)) AS i FROM moved)
), pairs AS (
  SELECT a.doc_id, a.i, b.i - a.i AS p FROM grams a JOIN grams b ON a.doc_id = b.doc_id AND a.g = b.g
  WHERE b.i > a.i AND 3 * (b.i - a.i) <= a.n
), islands AS (
  SELECT doc_id, p, i, i - row_number() OVER (PARTITION BY doc_id, p ORDER BY i) AS island FROM pairs
), stretches AS (
  SELECT doc_id, p, min(i) AS start, count(*) + 15 + p AS length FROM islands GROUP BY doc_id, p, island
), runs AS (
  SELECT doc_id, start, length, min(p) AS period FROM stretches WHERE length >= 24 AND length >= 3 * p GROUP BY ALL
), listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines,
    first(struct_pack(start, length, period) ORDER BY length::DOUBLE / period DESC, start, period) AS top
  FROM runs GROUP BY doc_id
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS i FROM moved
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, top.start::BIGINT AS start, top.length::BIGINT AS length,
  top.period::BIGINT AS period, (1000 * top.length // top.period)::BIGINT AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM documents LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

ORACLES: dict[str, str] = {
    "op1_ngram_jaccard": JOIN_SQL,
    "op4_source_mix": MIX_SQL,
    "op6_warc_members": WARC_SQL,
    "op7_benchmark_leaks": LEAK_SQL,
    "op10_suffix_repeats": REPEAT_SQL,
    "op11_bit_sliced_weights": IMPORTANCE_SQL,
    "op12_word_runs": RUN_SQL,
}

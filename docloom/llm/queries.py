"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.chat import chat_digest
from docloom.llm.decontamination import contamination_digest
from docloom.llm.filter_audit import audit
from docloom.llm.jaccard import jaccard_components
from docloom.llm.language_id import language_report
from docloom.llm.line_dedup import line_digest
from docloom.llm.nearest import nearest
from docloom.llm.packing import pack, vocabulary_path
from docloom.llm.piece_encoding import encode_texts
from docloom.llm.shared import table
from docloom.llm.sharding import shard_documents
from docloom.llm.url_filter import judge
from docloom.llm.vector_codes import compress, with_label_error
from docloom.llm.wrappers import main_text

#: A conversation whose texts hold the template's control strings.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op1_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_report(spark, table(spark, sf_dir, "documents"))


def op2_nearest_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark, table(spark, sf_dir, "embeddings"))


def op3_order_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), vocabulary_path())


def op4_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = main_text(spark, table(spark, sf_dir, "pages"), carry=["page_id", "url"])
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_digest(spark, table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "block_score")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_digest(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark, table(spark, sf_dir, "documents"))


def op9_stratified_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), n_shards=40)


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["conv_id", "turn", "role", "text"]
    logged = table(spark, sf_dir, "conversations").select(*columns)
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    return chat_digest(logged.unionByName(extra))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = compress(spark, table(spark, sf_dir, "embeddings"))
    rows = with_label_error(spark, made.codes)
    return rows.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(made.digest()).alias("codebooks_sha256"))


def op13_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = encode_texts(table(spark, sf_dir, "documents"), vocabulary_path("piece_bpe_32k.model"))
    digest = lambda x: F.sha2(x.cast("binary"), 256)
    return made.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), digest(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"), digest(F.col("decoded")).alias("decoded_sha256"), "agrees",
    )


OP10_SQL = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, CASE WHEN role = 'assistant' THEN 8 ELSE 14 END
    + length(replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'), chr(10), '&#10;'))
    + length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;')) AS n FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(n)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


OP5_SQL = """
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM docs
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), owned AS (
  SELECT *, length(key) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY key) AS lost FROM keyed
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM owned GROUP BY doc_id
"""


OP7_SQL = r"""
WITH item AS (
  SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark WHERE item_id IS NOT NULL
), item_window AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS wide,
    array_to_string(ws[p:p + least(len(ws), 10) - 1], ' ') AS win
  FROM item, LATERAL (SELECT unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS p) WHERE len(ws) > 0
), doc AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM documents
), wide AS (SELECT DISTINCT wide FROM item_window), place AS (
  SELECT doc_id, p, wide, array_to_string(ws[p:p + wide - 1], ' ') AS win
  FROM doc, wide, LATERAL (SELECT unnest(range(1, len(ws) - wide + 2)) AS p)
), hit AS (
  SELECT DISTINCT doc_id, p, wide, item_id FROM place JOIN item_window USING (wide, win)
), words AS (
  SELECT doc_id, count(DISTINCT p + k) AS n_hit
  FROM hit, LATERAL (SELECT unnest(range(0, wide)) AS k) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


#: crc32 by half bytes, low half first: the 16 fixed values are the polynomial 0xEDB88320 applied to each.
OP9_SQL = r"""
WITH slim AS (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(text, '') AS body FROM documents
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY substr(md5('17:' || coalesce(doc_id::VARCHAR, '')), 1, 15)) AS r,
    count(*) OVER (PARTITION BY source) AS size_of FROM slim
), placed AS (
  SELECT *, row_number() OVER (ORDER BY (2 * r - 1)::DOUBLE / (2.0::DOUBLE * size_of), source) - 1 AS spot, count(*) OVER () AS n FROM ranked
), nibble AS (
  SELECT doc_id, string_split(hex(encode(body)), '') AS h FROM slim
), checked AS (
  SELECT doc_id, xor(4294967295, list_reduce(list_prepend(4294967295,
    [strpos('0123456789ABCDEF', h[i + 2 * (i % 2) - 1]) - 1 FOR i IN range(1, len(h) + 1) IF len(h) > 1]),
    lambda crc, b: xor(crc >> 4, [0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, 3988292384, 4027552580,
      3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108][1 + (xor(crc, b) & 15)]))) AS crc FROM nibble
)
SELECT doc_id, strlen(body) + 16 AS size, crc AS text_crc32, 'rows' AS law, (spot * 40 // n)::INT AS shard,
  spot - (spot * 40 // n * n + 39) // 40 AS slot, NULL::INT AS grown_shard
FROM placed JOIN checked USING (doc_id)
"""


OP11_SQL = r"""
WITH doc AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), lowest AS (SELECT coalesce(text, '') AS t, min(doc_id) AS least_id FROM documents GROUP BY 1), said AS (
  SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS bad FROM labels GROUP BY 1
), masked AS (
  SELECT part, (len(ws) < 200)::INT + 2 * (100 * len(list_distinct(ws)) < 50 * len(ws))::INT
    + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(doc_id > least_id, false)::INT AS mask,
    coalesce(good, false) AS good, coalesce(bad, false) AS bad
  FROM doc JOIN lowest USING (t) LEFT JOIN said USING (doc_id)
), counted AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE bad) AS bad FROM masked GROUP BY ALL
), letter AS (SELECT unnest(range(5)) AS k), orders AS (
  SELECT [a.k, b.k, c.k, d.k, e.k] AS ks FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5
), steps AS (
  SELECT list_reduce(list_transform(ks, lambda k: 'ABCDE'[k + 1]), lambda x, y: x || y) AS filter_order, step, ks[step] AS k,
    coalesce(list_sum(list_transform(ks[1:step - 1], lambda k: 1 << k)), 0)::INT AS before
  FROM orders, (SELECT unnest(range(1, 6)) AS step)
), figures AS (
  SELECT part, filter_order, step, k,
    coalesce(sum(n) FILTER (WHERE mask & (before | (1 << k)) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (WHERE mask & before = 0 AND mask & (1 << k) <> 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (WHERE mask & before <> 0 AND mask & (1 << k) <> 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (WHERE mask = 1 << k), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (WHERE mask & before = 0 AND mask & (1 << k) <> 0), 0)::BIGINT AS good_lost,
    coalesce(sum(bad) FILTER (WHERE mask & before = 0 AND mask & (1 << k) <> 0), 0)::BIGINT AS toxic_lost
  FROM counted, steps GROUP BY ALL
)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, k))::BIGINT AS shapley FROM figures
"""


def _op12_sql(rounds: int = 6) -> str:
    """Lloyd's rounds one after another: b holds a round's entries, a its nearest ones."""
    nearest = """a{r} AS MATERIALIZED (
  SELECT rid, p, e, d FROM (SELECT rid, p, e, sum((v - c) * (v - c))::BIGINT AS d FROM comp JOIN b{r} USING (p, pos) GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY rid, p ORDER BY d, e) = 1
)"""
    renewed = """b{next} AS MATERIALIZED (
  SELECT p, e, pos, coalesce((s - (s % n + n) % n) // n, c) AS c FROM b{r} LEFT JOIN (
    SELECT p, e, pos, sum(v)::BIGINT AS s, count(*) AS n FROM comp JOIN a{r} USING (rid, p) GROUP BY ALL) USING (p, e, pos)
)"""
    steps = ",\n".join(f"{nearest.format(r=r)},\n{renewed.format(r=r, next=r + 1)}" for r in range(rounds))
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label, embedding, len(embedding) // 8 AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), comp AS MATERIALIZED (
  SELECT rid, i // w AS p, i % w AS pos, floor(4096 * embedding[i + 1]::DOUBLE)::BIGINT AS v
  FROM kept, LATERAL (SELECT unnest(range(len(embedding))) AS i)
), b0 AS (SELECT p, rid - 1 AS e, pos, v AS c FROM comp WHERE rid <= 16),
{steps},
{nearest.format(r=rounds)}, coded AS (
  SELECT rid, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY rid
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(c::BIGINT::VARCHAR, ',' ORDER BY p, e, pos)) FROM b{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (rid)
"""


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_mixture": op1_language_mixture,
        "op2_nearest_products": op2_nearest_products,
        "op3_order_packing": op3_order_packing,
        "op4_html_wrappers": op4_html_wrappers,
        "op5_line_dedup": op5_line_dedup,
        "op6_url_filter": op6_url_filter,
        "op7_decontamination": op7_decontamination,
        "op8_jaccard_join": op8_jaccard_join,
        "op9_stratified_sharding": op9_stratified_sharding,
        "op10_chat_format": op10_chat_format,
        "op11_filter_audit": op11_filter_audit,
        "op12_vector_codes": op12_vector_codes,
        "op13_piece_encoding": op13_piece_encoding,
    }


def llm_oracle_sql() -> dict[str, str]:
    return {"op5_line_dedup": OP5_SQL, "op7_decontamination": OP7_SQL, "op9_stratified_sharding": OP9_SQL, "op10_chat_format": OP10_SQL, "op11_filter_audit": OP11_SQL, "op12_vector_codes": _op12_sql()}

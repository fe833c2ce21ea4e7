"""Registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffa.llm import exact_dedup, language_id, license_scan, lm, merkle, mixing, quality, sentencepiece_codec, simhash, topk, toxicity, vector_codes, warc
from tariffa.llm.common import fold, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 4) == 2
    model = language_id.learn(docs.filter(~held_out))
    found = language_id.predicted(model)
    return docs.select("doc_id", held_out.alias("held_out"), found.alias("found")).select(
        "doc_id", "held_out", "found.lang_pred", "found.score"
    )


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.deduplicate(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


OP2_SQL = """
SELECT doc_id, max(doc_id) OVER copies AS keep_id, count(*) OVER copies AS group_size,
       doc_id = max(doc_id) OVER copies AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW copies AS (PARTITION BY coalesce(text, ''))
"""


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix(table(spark, sf_dir, "documents"))
    return plan.taken().select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = fold("doc_id", 10)
    part = F.when(rest == 0, lm.OTHER).when(rest == 1, lm.HELD).otherwise(lm.RETAINED)
    docs = table(spark, sf_dir, "documents")
    return lm.score(docs, part).withColumn("held_out", rest == 0).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = sentencepiece_codec.read_model(sentencepiece_codec.MODEL)
    found = sentencepiece_codec.encoded(model)
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), found.alias("found")).select(
        "doc_id",
        F.size("found.ids").cast("long").alias("n_tokens"),
        F.col("found.ids").alias("token_ids"),
        (F.col("found.decoded") == F.col("text")).alias("round_trip"),
        "found.parity",
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return license_scan.scan(docs, license_scan.known_licenses(spark))


def _op6_sql() -> str:
    known = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in license_scan.KNOWN.items())
    return f"""
WITH known AS (
  SELECT sha256({license_scan.canonical_sql("body")}) AS known_digest, min(license_id) AS license_id
  FROM (VALUES {known}) AS licenses(license_id, body)
  GROUP BY 1
), digests AS (
  SELECT doc_id, sha256({license_scan.canonical_sql("text")}) AS text_digest FROM documents
)
SELECT doc_id, text_digest, license_id FROM digests LEFT JOIN known ON text_digest = known_digest
"""


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return docs.select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), toxicity.score(model).alias("score")
    ).withColumn("predicted", toxicity.verdict("score"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.search(vectors, vectors.filter(F.col("vec_id") % 50 == 0), 5)


OP8_SQL = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS score
  FROM usable q JOIN usable c ON c.vec_id <> q.vec_id
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 5
"""


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), simhash.as_hex("fingerprint").alias("fingerprint"), F.col("component").alias("component_id")
    )


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(table(spark, sf_dir, "pages")).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


OP10_SQL = """
WITH digests AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hexed FROM pages
), placed AS (
  SELECT *, min(page_id) OVER (PARTITION BY body) AS first_id FROM digests
)
SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((CAST('0x' || substr(hexed, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS INTEGER)
               >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31), 1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM placed
"""


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.encode(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def _op11_sql(rounds: int = vector_codes.ROUNDS) -> str:
    def nearest(book: str) -> str:
        # the smallest distance * 64 + number gives both, ties to the smaller number
        return f"""
SELECT vec_id, label, p, any_value(v) AS v, min(d * 64 + e) % 64 AS e, min(d * 64 + e) // 64 AS d FROM (
  SELECT vec_id, label, p, k.v, e, list_sum(list_transform(range(1, len(k.v) + 1), lambda i: (k.v[i] - b.v[i]) * (k.v[i] - b.v[i])))::BIGINT AS d
  FROM parts k JOIN {book} b USING (p)
) GROUP BY vec_id, label, p"""

    steps = []
    for n in range(rounds):
        steps.append(f"near{n} AS MATERIALIZED ({nearest(f'book{n}')})")
        steps.append(f"""book{n + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM book{n} b LEFT JOIN (
    SELECT p, e, list(mean ORDER BY i) AS v FROM (
      SELECT p, e, i, (sum(v[i]) - ((sum(v[i]) % count(*)) + count(*)) % count(*)) // count(*) AS mean
      FROM near{n}, range(1, (SELECT max(len(v)) FROM parts) + 1) AS places(i) GROUP BY p, e, i
    ) GROUP BY p, e
  ) m USING (p, e))""")
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT vec_id, label, p, list_slice(w, CAST(1 + p * (len(w) // 16) AS BIGINT), CAST((p + 1) * (len(w) // 16) AS BIGINT)) AS v
  FROM kept, range(16) AS positions(p)
), book0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, v FROM parts
  WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 64)
), {", ".join(steps)}, final AS MATERIALIZED ({nearest(f"book{rounds}")}
), coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM final GROUP BY vec_id, label
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
FROM coded
"""


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered, change = fold("doc_id", 2) == 0, F.regexp_replace("text", "\n", "")
    found = merkle.manifest(table(spark, sf_dir, "documents"), tampered, change)
    return found.withColumnRenamed("id", "doc_id")


# crc32 has no function in SQL: the table of its 256 remainders by rule (fixed polynomial 0xEDB88320), then byte by byte
_CRC32 = """list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda acc, b: xor(acc >> 8, remainders[CAST(xor(acc, b) & 255 AS INTEGER) + 1]))"""
_FIELD = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
_LEAF = "sha256({})"
_FIELDS = ("doc_id", "source", "lang", "n_chars")


def _leaf_sql(text: str) -> str:
    return _LEAF.format(" || ".join(_FIELD.format(f) for f in (*_FIELDS, text)))


OP12_SQL = f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda r, k: CASE WHEN r & 1 = 1 THEN xor(r >> 1, CAST(3988292384 AS BIGINT)) ELSE r >> 1 END)) AS remainders
), leaves AS MATERIALIZED (
  SELECT doc_id, source, coalesce('v' || source, 'n') AS grp, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos,
         count(*) OVER (PARTITION BY source) AS n, {_leaf_sql("text")} AS leaf,
         CASE WHEN xor({_CRC32}, 4294967295) % 2 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")} END AS changed
  FROM documents, crc
), tree AS (
  SELECT grp, 0 AS level, pos, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT grp, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM tree WHERE n > 1
  GROUP BY grp, level, pos // 3, n
), tops AS MATERIALIZED (
  SELECT grp, level AS height, digest AS subroot, row_number() OVER (ORDER BY encode(grp)) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1
), upper AS (
  SELECT 0 AS level, pos, n, subroot AS digest FROM tops
  UNION ALL
  SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM upper WHERE n > 1 GROUP BY level, pos // 3, n
), ways AS (
  SELECT l.doc_id, l.grp, l.leaf, l.changed, l.pos, h.level
  FROM leaves l JOIN tops USING (grp), range(100) AS h(level) WHERE h.level < tops.height
), steps AS (
  SELECT w.doc_id, w.level, coalesce(string_agg(t.digest, '' ORDER BY t.pos) FILTER (t.pos < w.pos // pow(3, w.level)::BIGINT), '') AS before,
         coalesce(string_agg(t.digest, '' ORDER BY t.pos) FILTER (t.pos > w.pos // pow(3, w.level)::BIGINT), '') AS after
  FROM ways w JOIN tree t ON t.grp = w.grp AND t.level = w.level AND t.pos // 3 = w.pos // pow(3, w.level + 1)::BIGINT
  GROUP BY w.doc_id, w.level
), upper_ways AS (
  SELECT l.doc_id, tops.height, tops.pos, h.level FROM leaves l JOIN tops USING (grp), range(100) AS h(level)
  WHERE h.level < (SELECT max(level) FROM upper)
), all_steps AS MATERIALIZED (
  SELECT * FROM steps
  UNION ALL
  SELECT w.doc_id, w.height + w.level, coalesce(string_agg(u.digest, '' ORDER BY u.pos) FILTER (u.pos < w.pos // pow(3, w.level)::BIGINT), ''),
         coalesce(string_agg(u.digest, '' ORDER BY u.pos) FILTER (u.pos > w.pos // pow(3, w.level)::BIGINT), '')
  FROM upper_ways w JOIN upper u ON u.level = w.level AND u.pos // 3 = w.pos // pow(3, w.level + 1)::BIGINT
  GROUP BY w.doc_id, w.height, w.level
), folded AS (
  SELECT doc_id, 0 AS level, coalesce(changed, leaf) AS digest FROM leaves
  UNION ALL
  SELECT f.doc_id, f.level + 1, sha256(s.before || f.digest || s.after) FROM folded f JOIN all_steps s USING (doc_id, level)
), proofs AS (
  SELECT doc_id, sha256(string_agg(before || after, '' ORDER BY level)) AS proof_sha256, max(level) AS last FROM all_steps GROUP BY doc_id
)
SELECT l.doc_id, l.leaf, tops.subroot, (SELECT digest FROM upper WHERE n = 1) AS root,
       coalesce(proof_sha256, sha256('')) AS proof_sha256, f.digest AS folded_root,
       f.digest = (SELECT digest FROM upper WHERE n = 1) AS verified
FROM leaves l JOIN tops USING (grp) LEFT JOIN proofs USING (doc_id)
JOIN folded f ON f.doc_id = l.doc_id AND f.level = coalesce(proofs.last + 1, 0)
"""


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 3) == 1
    model = quality.learn(docs, table(spark, sf_dir, "labels"), ~held_out)
    found = docs.select("doc_id", held_out.alias("held_out"), quality.score(model).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_language_id, op2_exact_dedup, op3_mixing, op4_lm_scoring, op5_sentencepiece, op6_license_scan, op7_toxicity, op8_topk, op9_simhash, op10_warc, op11_vector_codes, op12_merkle, op13_quality)}


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_dedup": OP2_SQL, "op6_license_scan": _op6_sql(), "op8_topk": OP8_SQL, "op10_warc": OP10_SQL, "op11_vector_codes": _op11_sql(), "op12_merkle": OP12_SQL}

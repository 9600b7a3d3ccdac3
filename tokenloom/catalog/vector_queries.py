"""Vector tables: quantization, merges, lookups, inventories."""

from pyspark.sql import functions as F

from tokenloom.catalog import tables as t
from tokenloom.catalog.registry import query, r6
from tokenloom.functions.vectors import fitting_group_size, rms_norm
from tokenloom.operators import vectors as V
from tokenloom.operators.corpus import pretokenize_bytes

WIDTH = 64
GROUP = fitting_group_size(WIDTH, 16)

SQL_GROUPS = f"""{t.SQL_WEIGHTS},
cells AS (
  SELECT name, vec_id, unnest(list_transform(vec, lambda x: CAST(x AS DOUBLE))) AS w,
         generate_subscripts(vec, 1) - 1 AS i FROM weights),
scales AS (SELECT name, vec_id, i // {GROUP} AS group_id, max(abs(w)) / 127.0::DOUBLE AS scale FROM cells GROUP BY ALL),
quantized AS (
  SELECT c.name, c.vec_id, s.group_id, c.i, c.w, s.scale,
         CASE WHEN s.scale = 0 THEN 0 ELSE round_even(c.w / s.scale, 0) END AS q
  FROM cells c JOIN scales s ON s.name = c.name AND s.vec_id = c.vec_id AND s.group_id = c.i // {GROUP}),
q_groups AS (
  SELECT name, vec_id, group_id, any_value(scale) AS scale, max(abs(q * scale - w)) AS max_error,
         string_agg(CAST(CAST(q AS INTEGER) AS VARCHAR), ',' ORDER BY i) AS codes FROM quantized GROUP BY ALL)"""


def groups(spark, sf):
    return V.quantize_q80(t.weights(spark, sf), ["name", "vec_id"], GROUP)


@query(
    "quantize_q80",
    f"""WITH {SQL_GROUPS} SELECT vec_id, CAST(group_id AS INTEGER) AS group_id, round(scale, 6) AS scale, codes,
      round(max_error, 9) AS max_error FROM q_groups""",
)
def quantize_q80(spark, sf):
    return groups(spark, sf).select(
        "vec_id",
        "group_id",
        r6(F.col("scale").cast("double")).alias("scale"),
        F.array_join(F.col("codes").cast("array<string>"), ",").alias("codes"),
        F.round("max_error", 9).alias("max_error"),
    )


@query(
    "quant_error_report",
    f"""WITH {SQL_GROUPS} SELECT name, round(max(max_error), 9) AS max_error,
      round(max(max(max_error)) OVER (), 9) AS overall_max_error FROM q_groups GROUP BY name""",
)
def quant_error_report(spark, sf):
    report = V.quant_error_report(groups(spark, sf))
    return report.select(
        "name", F.round("max_error", 9).alias("max_error"), F.round("overall_max_error", 9).alias("overall_max_error")
    )


@query(
    "rms_norm",
    """WITH cells AS (
      SELECT vec_id, unnest(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) AS v,
             generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)
    SELECT vec_id, CAST(i AS INTEGER) AS i, round(v / sqrt(avg(v * v) OVER (PARTITION BY vec_id) + 1e-5)
      * (1 + i / 64.0::DOUBLE), 6) AS v FROM cells""",
)
def rms(spark, sf):
    weight = F.transform(F.sequence(F.lit(0), F.lit(WIDTH - 1)), lambda i: F.lit(1.0) + i / F.lit(64.0))
    normed = rms_norm(F.col("embedding"), weight)
    rows = t.table(spark, sf, "embeddings").select("vec_id", F.posexplode(normed).alias("i", "v"))
    return rows.withColumn("v", r6("v"))


@query(
    "embedding_lookup",
    f"""WITH {t.SQL_ROLLOUTS}, tokens AS (
      SELECT rollout_id, unnest(response_ids) AS id, generate_subscripts(response_ids, 1) - 1 AS pos FROM rollouts)
    SELECT rollout_id, CAST(pos AS INTEGER) AS pos, CAST(id AS INTEGER) AS id,
      round(CAST(e.embedding[1] AS DOUBLE), 6) AS first FROM tokens JOIN embeddings e ON e.vec_id = tokens.id""",
)
def embedding_lookup(spark, sf):
    vectors = t.table(spark, sf, "embeddings").select(F.col("vec_id").cast("int").alias("id"), "embedding")
    found = V.embedding_lookup(t.rollout_rows(spark, sf), vectors, ["rollout_id"], "response_ids")
    first = r6(F.element_at("embedding", 1).cast("double"))
    return found.select("rollout_id", "pos", "id", first.alias("first"))


@query(
    "key_diff",
    f"""WITH {t.SQL_TOKENS}, used AS (SELECT DISTINCT unnest(ids) AS id FROM token_docs),
    have AS (SELECT vec_id AS id FROM embeddings)
    SELECT CAST(id AS BIGINT) AS id, 'missing' AS status FROM used WHERE id NOT IN (SELECT id FROM have)
    UNION ALL SELECT id, 'unexpected' FROM have WHERE id NOT IN (SELECT id FROM used)""",
)
def key_diff(spark, sf):
    """Ids the corpus uses against ids that have a vector."""
    used = pretokenize_bytes(t.corpus(spark, sf)).select(F.explode("ids").alias("id"))
    used = used.select(F.col("id").cast("long").alias("id"))
    have = t.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"))
    return V.key_diff(have, used, "id")


@query(
    "merge_vector_shards",
    f"""WITH {t.SQL_WEIGHTS},
    bounds AS (SELECT name, min(part) AS lo, max(part) AS hi FROM weights GROUP BY name),
    known AS (SELECT w.*, lo, hi, (w.ndim = 1 OR lo = hi) AS single,
      (starts_with(name, 'tok_embeddings.') OR ends_with(name, '.feed_forward.w2.weight')) AS wide
      FROM weights w JOIN bounds USING (name)),
    merged AS (
      SELECT name, ndim, row_idx, vec FROM known WHERE single AND part = lo
      UNION ALL SELECT name, ndim, row_idx, flatten(list(vec ORDER BY part)) FROM known WHERE NOT single AND wide
        GROUP BY ALL
      UNION ALL SELECT name, ndim, row_number() OVER (PARTITION BY name ORDER BY part, row_idx) - 1, vec FROM known
        WHERE NOT single AND NOT wide)
    SELECT name, ndim, row_idx, len(vec) AS width,
      round(list_sum(list_transform(vec, lambda x: CAST(x AS DOUBLE))), 6) AS total,
      round(CAST(vec[1] AS DOUBLE), 6) AS first, round(CAST(vec[len(vec)] AS DOUBLE), 6) AS last FROM merged""",
)
def merge_vector_shards(spark, sf):
    merged = V.merge_vector_shards(t.weights(spark, sf).drop("vec_id"))
    total = F.aggregate(F.col("vec").cast("array<double>"), F.lit(0.0), lambda acc, x: acc + x)
    return merged.select(
        "name",
        "ndim",
        "row_idx",
        F.size("vec").cast("long").alias("width"),
        r6(total).alias("total"),
        r6(F.element_at("vec", 1).cast("double")).alias("first"),
        r6(F.element_at("vec", -1).cast("double")).alias("last"),
    )


@query(
    "parameter_inventory",
    f"""WITH {t.SQL_WEIGHTS}, tensors AS (SELECT name, max(ndim) AS ndim, sum(len(vec)) AS n FROM weights GROUP BY name)
    SELECT ndim >= 2 AS decayed, count(*) AS tensors, CAST(sum(n) AS BIGINT) AS elements FROM tensors GROUP BY ndim >= 2""",
)
def parameter_inventory(spark, sf):
    return V.parameter_inventory(t.weights(spark, sf))

"""Next-token counts, score vectors, filtering and sampling."""

from pyspark.sql import functions as F

from tokenloom.catalog import tables as t
from tokenloom.catalog.registry import query, r6
from tokenloom.functions import scores as P
from tokenloom.functions.rollout import kl_penalty, sample_length
from tokenloom.operators import scoring as Q

TEMPERATURE = 0.6
TOP_K = 10
TOP_P = 0.9


@query(
    "next_token_counts",
    f"""WITH {t.SQL_COUNTS} SELECT context, next, cnt,
      CAST(sum(cnt) OVER (PARTITION BY context) AS BIGINT) AS context_cnt,
      round(ln(cnt / (sum(cnt) OVER (PARTITION BY context))::DOUBLE), 6) AS logp FROM counts_all""",
)
def next_token_counts(spark, sf):
    return Q.next_token_counts(t.examples(spark, sf)).withColumn("logp", r6("logp"))


@query(
    "context_entropy",
    f"""WITH {t.SQL_COUNTS} SELECT context, CAST(sum(cnt) AS BIGINT) AS context_cnt,
      round(ln(sum(cnt) + 259) - sum((cnt + 1) * ln(cnt + 1)) / (sum(cnt) + 259), 6) AS entropy
      FROM counts_all GROUP BY context""",
)
def context_entropy(spark, sf):
    counts = Q.next_token_counts(t.examples(spark, sf))
    return Q.context_stats(counts, t.BYTE_VOCAB).withColumn("entropy", r6("entropy"))


SQL_LONG = f"""{t.SQL_LOGITS},
entries AS (SELECT row_id, label, unnest(logits) AS s, generate_subscripts(logits, 1) - 1 AS token FROM score_vectors)"""

SQL_LOGP = f"""{SQL_LONG},
tops AS (SELECT row_id, max(s) AS top FROM entries GROUP BY row_id),
norms AS (SELECT row_id, any_value(top) + ln(sum(exp(s - top))) AS norm FROM entries JOIN tops USING (row_id) GROUP BY row_id),
logps AS (SELECT row_id, label, token, s, s - norm AS logp FROM entries JOIN norms USING (row_id))"""

# Softmax after temperature, optionally after the top-k filter.
SQL_PROBS = f"""{SQL_LONG},
cut AS (SELECT *, rank() OVER (PARTITION BY row_id ORDER BY s DESC) AS rk FROM entries),
kept AS (SELECT row_id, token, s / 0.6::DOUBLE AS s FROM cut WHERE rk <= {TOP_K}),
tops AS (SELECT row_id, max(s) AS top FROM kept GROUP BY row_id),
weights AS (SELECT row_id, token, exp(s - top) AS w FROM kept JOIN tops USING (row_id)),
probs AS (SELECT row_id, token, w / sum(w) OVER (PARTITION BY row_id) AS p FROM weights)"""

SQL_NUCLEUS = f"""{SQL_PROBS},
ranked AS (
  SELECT row_id, token, p, row_number() OVER w - 1 AS rank,
         coalesce(sum(p) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS preceding_mass
  FROM probs WINDOW w AS (PARTITION BY row_id ORDER BY p DESC, token)),
nucleus AS (
  SELECT row_id, token, rank, p / sum(p) OVER (PARTITION BY row_id) AS p FROM ranked
  WHERE preceding_mass <= 0.9::DOUBLE)"""


def sql_uniform(seed: int) -> str:
    return (
        f"CAST(CAST('0x' || substr(md5('{seed}|' || row_id), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0::DOUBLE"
    )


def rows(spark, sf):
    return t.score_vectors(spark, sf)


def long(df, column, *key):
    return df.select("row_id", *key, F.posexplode(column).alias("token", "v"))


@query("log_softmax", f"WITH {SQL_LOGP} SELECT row_id, token, round(logp, 6) AS logp FROM logps")
def log_softmax(spark, sf):
    return long(rows(spark, sf), P.log_softmax(F.col("logits"))).select("row_id", "token", r6("v").alias("logp"))


@query(
    "logprobs_from_logits",
    f"WITH {SQL_LOGP} SELECT row_id, label, round(logp, 6) AS logp FROM logps WHERE token = label",
)
def logprobs_from_logits(spark, sf):
    logp = P.logprobs_from_logits(F.col("logits"), F.col("label"))
    return rows(spark, sf).select("row_id", "label", r6(logp).alias("logp"))


@query(
    "gather_label",
    f"WITH {SQL_LONG} SELECT row_id, round(s, 6) AS score FROM entries WHERE token = label",
)
def gather_label(spark, sf):
    return rows(spark, sf).select("row_id", r6(P.gather_label(F.col("logits"), F.col("label"))).alias("score"))


@query(
    "cross_entropy",
    f"""WITH {SQL_LOGP}, targets AS (SELECT row_id, logp FROM logps WHERE token = label AND label <> 3)
    SELECT round(avg(-logp), 6) AS loss, count(*) AS targets FROM targets""",
)
def cross_entropy(spark, sf):
    """Label 3 plays the ignored target."""
    target = F.when(F.col("label") == 3, -1).otherwise(F.col("label"))
    loss = P.token_loss(F.col("logits"), target)
    return Q.mean_loss(rows(spark, sf), loss).withColumn("loss", r6("loss"))


@query("entropy", f"WITH {SQL_LOGP} SELECT row_id, round(-sum(exp(logp) * logp), 6) AS entropy FROM logps GROUP BY row_id")
def entropy(spark, sf):
    return rows(spark, sf).select("row_id", r6(P.entropy(F.col("logits"))).alias("entropy"))


@query(
    "top_k_filter",
    f"""WITH {SQL_LONG}, cut AS (SELECT *, rank() OVER (PARTITION BY row_id ORDER BY s DESC) AS rk FROM entries)
    SELECT row_id, token, round(s, 6) AS score FROM cut WHERE rk <= {TOP_K}""",
)
def top_k_filter(spark, sf):
    kept = long(rows(spark, sf), P.top_k_filter(F.col("logits"), TOP_K)).where(F.col("v") > float("-inf"))
    return kept.select("row_id", "token", r6("v").alias("score"))


@query(
    "temperature_softmax",
    f"""WITH {SQL_LONG}, tops AS (SELECT row_id, max(s) AS top FROM entries GROUP BY row_id),
    weights AS (SELECT row_id, token, exp((s - top) / 0.6::DOUBLE) AS w FROM entries JOIN tops USING (row_id))
    SELECT row_id, token, round(w / sum(w) OVER (PARTITION BY row_id), 6) AS p FROM weights""",
)
def temperature_softmax(spark, sf):
    return long(rows(spark, sf), P.softmax(F.col("logits"), TEMPERATURE)).select("row_id", "token", r6("v").alias("p"))


def filtered_probs():
    return P.softmax(P.top_k_filter(F.col("logits"), TOP_K), TEMPERATURE)


@query("top_p_filter", f"WITH {SQL_NUCLEUS} SELECT row_id, token, round(p, 6) AS p FROM nucleus")
def top_p_filter(spark, sf):
    kept = rows(spark, sf).select("row_id", F.explode(P.nucleus(filtered_probs(), TOP_P)).alias("e"))
    return kept.select("row_id", "e.token", r6("e.p").alias("p"))


@query(
    "nucleus_cutoff",
    f"""WITH {SQL_NUCLEUS} SELECT row_id, token, rank, round(p, 6) AS p, round(preceding_mass, 6) AS preceding_mass,
      preceding_mass <= 0.9::DOUBLE AS kept FROM ranked""",
)
def nucleus_cutoff(spark, sf):
    ranked = Q.nucleus_cutoff(rows(spark, sf), ["row_id"], filtered_probs(), TOP_P)
    # Entries the top-k filter banned have probability 0.
    return ranked.where(F.col("p") > 0).select(
        "row_id", "token", "rank", r6("p").alias("p"), r6("preceding_mass").alias("preceding_mass"), "kept"
    )


@query(
    "sample_categorical",
    f"""WITH {SQL_LONG}, tops AS (SELECT row_id, max(s) AS top FROM entries GROUP BY row_id),
    weights AS (SELECT row_id, token, exp((s - top) / 0.6::DOUBLE) AS w FROM entries JOIN tops USING (row_id)),
    masses AS (SELECT row_id, token, sum(w) OVER (PARTITION BY row_id ORDER BY token) / sum(w) OVER (PARTITION BY row_id)
      AS mass FROM weights)
    SELECT row_id, min(token) AS token FROM masses WHERE mass > {sql_uniform(7)} GROUP BY row_id""",
)
def sample_categorical(spark, sf):
    token = P.sample_categorical(P.softmax(F.col("logits"), TEMPERATURE), P.draw_uniform(7, F.col("row_id")))
    return rows(spark, sf).select("row_id", token.cast("long").alias("token"))


@query(
    "greedy",
    f"WITH {SQL_LONG} SELECT row_id, CAST(min_by(token, (-s, token)) AS INTEGER) AS token FROM entries GROUP BY row_id",
)
def greedy(spark, sf):
    return rows(spark, sf).select("row_id", P.greedy(F.col("logits")).alias("token"))


@query(
    "decode_step",
    f"""WITH {SQL_NUCLEUS}, masses AS (
      SELECT row_id, token, rank, sum(p) OVER (PARTITION BY row_id ORDER BY rank) AS mass FROM nucleus),
    drawn AS (
      SELECT row_id, arg_min(token, rank) AS token FROM masses WHERE mass > {sql_uniform(11)} GROUP BY row_id),
    best AS (SELECT row_id, min_by(token, (-s, token)) AS token FROM entries GROUP BY row_id)
    SELECT row_id, CAST(drawn.token AS INTEGER) AS token, CAST(best.token AS INTEGER) AS greedy_token
    FROM drawn JOIN best USING (row_id)""",
)
def decode_step(spark, sf):
    uniform = P.draw_uniform(11, F.col("row_id"))
    token = P.decode_step(F.col("logits"), uniform, TEMPERATURE, TOP_K, TOP_P)
    best = P.decode_step(F.col("logits"), uniform, 0)
    return rows(spark, sf).select("row_id", token.alias("token"), best.alias("greedy_token"))


@query(
    "kl_penalty_full",
    f"""WITH {SQL_LOGP}, other AS (
      SELECT row_id, token, -logits[token + 1] AS s FROM score_vectors CROSS JOIN range(64) r(token)),
    other_norm AS (SELECT row_id, ln(sum(exp(s))) AS norm FROM other GROUP BY row_id),
    refs AS (SELECT row_id, token, s - norm AS ref FROM other JOIN other_norm USING (row_id))
    SELECT row_id, round(sum(exp(logp) * (logp - ref)), 6) AS kl FROM logps JOIN refs USING (row_id, token)
    GROUP BY row_id""",
)
def kl_penalty_full(spark, sf):
    """The reference policy has the negated scores."""
    policy = P.log_softmax(F.col("logits"))
    reference = P.log_softmax(F.transform("logits", lambda x: -x))
    scored = rows(spark, sf).select("row_id", policy.alias("lp"), reference.alias("ref"))
    return scored.select("row_id", r6(kl_penalty(F.col("lp"), F.col("ref"), "full")).alias("kl"))


@query(
    "sample_lengths",
    """SELECT event_id, CAST(30 + CAST('0x' || substr(md5('5|' || event_id), 1, 13) AS BIGINT) % 170 AS INTEGER) AS length
    FROM events""",
)
def sample_lengths(spark, sf):
    return t.table(spark, sf, "events").select("event_id", sample_length(30, 200, 5, F.col("event_id")).alias("length"))


# A space (byte 32, id 35) plays the end token of the generated part.
END = 35


@query(
    "truncate_at_eos",
    f"""WITH {t.SQL_ROLLOUTS}, cut AS (
      SELECT rollout_id, query_ids, response_ids, list_position(response_ids, {END}) AS e FROM rollouts)
    SELECT rollout_id, array_to_string(CASE WHEN e > 0 THEN response_ids[1:e] ELSE response_ids END, ',') AS answer,
      array_to_string(list_concat(query_ids, CASE WHEN e > 0 THEN response_ids[1:e] ELSE response_ids END), ',') AS echoed
    FROM cut""",
)
def truncate_at_eos(spark, sf):
    from tokenloom.catalog.registry import text
    from tokenloom.functions.rollout import concat_prompt_response

    rolled = t.rollout_rows(spark, sf)
    tokens = concat_prompt_response(F.col("query_ids"), F.col("response_ids"))
    size = F.size("query_ids")
    return rolled.select(
        "rollout_id",
        text(P.truncate_at_end(tokens, size, END)).alias("answer"),
        text(P.truncate_at_end(tokens, size, END, echo=True)).alias("echoed"),
    )


@query(
    "prompt_protect",
    f"""WITH {t.SQL_ROLLOUTS}, cells AS (
      SELECT rollout_id, query_ids, response_ids, unnest(range(greatest(len(query_ids), len(response_ids)))) AS pos
      FROM rollouts)
    SELECT rollout_id, pos, coalesce(query_ids[pos + 1], response_ids[pos + 1]) AS token FROM cells""",
)
def prompt_protect(spark, sf):
    """Responses are laid over the prompts from position 0; prompt tokens stay."""
    both = F.arrays_zip(F.col("query_ids").alias("prompt"), F.col("response_ids").alias("proposed"))
    cells = t.rollout_rows(spark, sf).select("rollout_id", F.posexplode(both).alias("pos", "c"))
    return cells.select(
        "rollout_id",
        F.col("pos").cast("long").alias("pos"),
        P.prompt_protect(F.col("c.prompt"), F.col("c.proposed")).alias("token"),
    )

"""Sources, text functions and token documents."""

from pyspark.sql import functions as F

from tokenloom.catalog import tables as t
from tokenloom.catalog.registry import query, r6, text
from tokenloom.functions.rollout import clip_by_value, length_reward
from tokenloom.functions.text import add_bos_eos, byte_tokenize, strip_text
from tokenloom.operators import corpus as C
from tokenloom.plans.staging import MOVED_BY_TASKS, new_folder
from tokenloom.sources import shards as S

STORIES_PER_FILE = 64


#: Files of waves are read as a whole; others stay as they are, as a reader may split them.
COMPRESSED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def write_story_files(spark, sf, wave=None, path=None):
    """JSON-array files of at most 64 stories, one folder per file, named by source and block; of one ``wave`` of three if named."""
    story = F.to_json(F.struct(F.col("text").alias("story"), F.col("source").alias("source")))
    block = F.floor(F.col("doc_id") / F.lit(20 * STORIES_PER_FILE)).cast("string")
    path = path or new_folder(spark, "stories")
    chosen = F.lit(True) if wave is None else F.pmod(F.xxhash64("file"), F.lit(3)) == wave
    (
        t.table(spark, sf, "documents")
        .select(F.concat_ws("-", "source", F.lpad(block, 8, "0")).alias("file"), "doc_id", story.alias("story"))
        .where(chosen)
        .groupBy("file")
        .agg(F.array_sort(F.collect_list(F.struct("doc_id", "story"))).alias("stories"))
        .select("file", F.concat(F.lit("["), F.array_join("stories.story", ","), F.lit("]")).alias("value"))
        .write.mode("append")
        .options(**MOVED_BY_TASKS, **({} if wave is None else COMPRESSED))
        .partitionBy("file")
        .text(path)
    )
    return path


SQL_FILES = """files AS (
  SELECT source || '-' || lpad(CAST(doc_id // 1280 AS VARCHAR), 8, '0') AS file, doc_id, text, source FROM documents),
stories AS (SELECT file, row_number() OVER (PARTITION BY file ORDER BY doc_id) - 1 AS doc_pos, text AS story, source
  FROM files)"""


def file_name():
    return F.regexp_extract("shard", r"file=([^/]+)/", 1)


def read_stories(spark, sf):
    path = write_story_files(spark, sf)
    return S.read_shards(spark, f"{path}/*").withColumn("shard", file_name())


@query("read_shards", f"WITH {SQL_FILES} SELECT file AS shard, doc_pos, story, source FROM stories")
def read_shards(spark, sf):
    return read_stories(spark, sf).select("shard", "doc_pos", "story", "source")


@query(
    "shard_manifest",
    f"""WITH {SQL_FILES}, names AS (SELECT DISTINCT file FROM stories)
    SELECT file AS shard, row_number() OVER (ORDER BY file) - 1 AS shard_id, count(*) OVER () AS num_shards FROM names""",
)
def shard_manifest(spark, sf):
    """From the listing of the files; no story is read."""
    return S.list_shards(spark, f"{write_story_files(spark, sf)}/*", file_name())


@query(
    "preview",
    f"WITH {t.SQL_CORPUS} SELECT shard_id, doc_pos, text FROM corpus WHERE shard_id = 0 ORDER BY doc_pos LIMIT 30",
)
def preview(spark, sf):
    return S.preview(t.corpus(spark, sf))


@query(
    "write_text_sample",
    f"""WITH {t.SQL_CORPUS}, clean AS (SELECT shard_id, {t.SQL_STRIP} AS text FROM corpus)
    SELECT CAST(sum(length(text) - length(replace(text, chr(10), '')) + 1) AS BIGINT) AS lines,
      round(sum(octet_length(encode(text)) + 1) / 1048576.0::DOUBLE, 6) AS size_mb
    FROM clean WHERE shard_id < 10""",
)
def write_text_sample(spark, sf):
    docs = t.corpus(spark, sf).withColumn("text", strip_text(F.col("text")))
    report = S.write_text_sample(docs, C.VOCAB_SHARDS, new_folder(spark, "sample"))
    return report.withColumn("size_mb", r6("size_mb"))


@query(
    "token_shards_round_trip",
    f"""WITH {t.SQL_TOKENS} SELECT 'tok259' AS vocab, shard_id, doc_pos, array_to_string(ids, ',') AS ids,
    CAST(len(ids) AS INTEGER) AS n_tokens FROM token_docs""",
)
def token_shards_round_trip(spark, sf):
    path = new_folder(spark, "token_shards")
    S.write_token_shards(C.pretokenize_bytes(t.corpus(spark, sf)), "tok259", path)
    return S.read_token_shards(spark, path, "custom", 259).drop("block", "block_start").withColumn("ids", text("ids"))


@query("materialize_once", f"WITH {t.SQL_TOKENS} SELECT shard_id, doc_pos, len(ids) AS n_tokens FROM token_docs")
def materialize_once(spark, sf):
    sizes = C.pretokenize_bytes(t.corpus(spark, sf)).select(
        "shard_id", "doc_pos", F.col("n_tokens").cast("long").alias("n_tokens")
    )
    path = new_folder(spark, "once")
    S.materialize_once(sizes, path)
    return S.materialize_once(sizes.withColumn("n_tokens", F.lit(-1).cast("long")), path)


@query("strip_text", f"WITH {t.SQL_CORPUS} SELECT doc_pos, {t.SQL_STRIP} AS text FROM corpus")
def strip(spark, sf):
    return t.corpus(spark, sf).select("doc_pos", strip_text(F.col("text")).alias("text"))


@query(
    "first_shards",
    f"WITH {t.SQL_CORPUS} SELECT shard_id, count(*) AS docs, CAST(sum(length(text)) AS BIGINT) AS chars FROM corpus WHERE shard_id < 10 GROUP BY shard_id",
)
def first_shards(spark, sf):
    return (
        C.first_shards(t.corpus(spark, sf))
        .groupBy("shard_id")
        .agg(F.count(F.lit(1)).alias("docs"), F.sum(F.length("text").cast("long")).alias("chars"))
    )


@query(
    "split_train_test",
    f"WITH {t.SQL_CORPUS} SELECT doc_pos, shard_id, CASE WHEN shard_id > 0 THEN 'train' ELSE 'test' END AS split FROM corpus",
)
def split_train_test(spark, sf):
    return C.split_train_test(t.corpus(spark, sf)).select("doc_pos", "shard_id", "split")


@query("take_split_val", f"WITH {t.SQL_CORPUS} SELECT doc_pos, text FROM corpus WHERE shard_id = 0")
def take_split_val(spark, sf):
    return C.take_split(t.corpus(spark, sf), "val").select("doc_pos", "text")


@query(
    "byte_tokenize",
    f"WITH {t.SQL_CORPUS} SELECT doc_pos, array_to_string({t.sql_bytes('text')}, ',') AS ids FROM corpus",
)
def bytes_(spark, sf):
    return t.corpus(spark, sf).select("doc_pos", text(byte_tokenize(F.col("text"))).alias("ids"))


@query(
    "add_bos_eos",
    f"WITH {t.SQL_CORPUS} SELECT doc_pos, array_to_string(list_concat([1], {t.sql_bytes('text')}, [2]), ',') AS ids FROM corpus",
)
def bos_eos(spark, sf):
    ids = add_bos_eos(byte_tokenize(F.col("text")), bos=True, eos=True)
    return t.corpus(spark, sf).select("doc_pos", text(ids).alias("ids"))


@query(
    "check_token_range",
    f"""WITH {t.SQL_TOKENS}, longer AS (
      SELECT shard_id, doc_pos, list_append(ids, CAST(doc_pos * 1000 - 3000 AS INTEGER)) AS ids FROM token_docs)
    SELECT shard_id, doc_pos FROM longer WHERE list_min(ids) < 0 OR list_max(ids) > 65535""",
)
def check_token_range(spark, sf):
    """Token documents that each got one id more, some of them out of range."""
    docs = C.pretokenize_bytes(t.corpus(spark, sf))
    more = F.array((F.col("doc_pos") * 1000 - 3000).cast("int"))
    return C.check_token_range(docs.withColumn("ids", F.concat("ids", more))).select("shard_id", "doc_pos")


@query(
    "pretokenize",
    f"WITH {t.SQL_TOKENS} SELECT shard_id, doc_pos, array_to_string(ids, ',') AS ids, CAST(len(ids) AS INTEGER) AS n_tokens FROM token_docs",
)
def pretokenize(spark, sf):
    return C.pretokenize_bytes(t.corpus(spark, sf)).withColumn("ids", text("ids"))


@query(
    "shard_stats",
    f"""WITH {t.SQL_TOKENS}, sizes AS (
      SELECT shard_id, len(ids) AS n, len(list_filter(ids, lambda i: i = 1)) AS b FROM token_docs)
    SELECT shard_id, CAST(sum(n) AS BIGINT) AS tokens, count(*) AS docs, CAST(sum(b) AS BIGINT) AS bos_tokens,
      round(sum(n) / sum(b)::DOUBLE, 6) AS avg_seq_len FROM sizes GROUP BY shard_id""",
)
def shard_stats(spark, sf):
    stats = C.shard_stats(C.pretokenize_bytes(t.corpus(spark, sf)))
    return stats.withColumn("avg_seq_len", r6("avg_seq_len"))


@query(
    "pad_batch",
    f"""WITH msgs AS (SELECT conv_id AS batch_id, turn, {t.sql_bytes('text')} AS ids FROM conversations),
    longest AS (SELECT batch_id, max(len(ids)) AS m FROM msgs GROUP BY batch_id)
    SELECT batch_id, turn,
      array_to_string(list_concat(ids, list_transform(range(m - len(ids)), lambda i: 0)), ',') AS input_ids,
      array_to_string(list_transform(range(m), lambda i: CASE WHEN i < len(ids) THEN 1 ELSE 0 END), ',')
        AS attention_mask
    FROM msgs JOIN longest USING (batch_id)""",
)
def pad_batch(spark, sf):
    ids = byte_tokenize(F.col("text"))
    rows = t.table(spark, sf, "conversations").select(F.col("conv_id").alias("batch_id"), "turn", ids.alias("input_ids"))
    rows = rows.withColumn("attention_mask", F.array_repeat(F.lit(1), F.size("input_ids")))
    padded = C.pad_batch(rows)
    return padded.select(
        "batch_id", "turn", text("input_ids").alias("input_ids"), text("attention_mask").alias("attention_mask")
    )


@query(
    "length_reward",
    f"WITH {t.SQL_TOKENS} SELECT doc_pos, round(-abs(200 - len(ids)) / 100.0::DOUBLE, 6) AS reward FROM token_docs",
)
def length_rewards(spark, sf):
    docs = C.pretokenize_bytes(t.corpus(spark, sf))
    return docs.select("doc_pos", r6(length_reward(F.col("n_tokens"))).alias("reward"))


@query(
    "clip_by_value",
    "SELECT event_id, greatest(least(value, 40.0::DOUBLE), 10.0::DOUBLE) AS clipped, "
    "greatest(least(value, 10.0::DOUBLE), 40.0::DOUBLE) AS crossed FROM events",
)
def clip(spark, sf):
    v, low, high = F.col("value"), F.lit(10.0), F.lit(40.0)
    return t.table(spark, sf, "events").select(
        "event_id", clip_by_value(v, low, high).alias("clipped"), clip_by_value(v, high, low).alias("crossed")
    )

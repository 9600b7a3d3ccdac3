"""Vocabulary training, encoding, decoding."""

from pyspark.sql import functions as F

from tokenloom.catalog import tables as t
from tokenloom.catalog.registry import query, text
from tokenloom.functions.text import strip_text
from tokenloom.operators import corpus as C
from tokenloom.operators import vocab as V

VOCAB_SIZE = 512
MARK = V.SPACE

SQL_WORDS = f"""{t.SQL_CORPUS},
clean AS (SELECT shard_id, doc_pos, {t.SQL_STRIP} AS text FROM corpus),
lines AS (
  SELECT unnest(regexp_extract_all('{MARK}' || replace(replace(text, ' ', '{MARK}'), chr(10), chr(10) || '{MARK}'),
    '[\\n\\x01\\x02]|[0-9０-９]|{MARK}*[^{MARK}0-9０-９\\n\\x01\\x02]+|{MARK}+')) AS word
  FROM clean WHERE length(text) > 0),
words AS (SELECT word, count(*) AS cnt FROM lines WHERE word NOT IN (chr(10), chr(1), chr(2)) GROUP BY word)"""

SQL_CHARS = f"""{SQL_WORDS},
chars AS (
  SELECT ch, CAST(sum(cnt) AS BIGINT) AS cnt
  FROM (SELECT unnest(regexp_extract_all(word, '(?s).')) AS ch, cnt FROM words) GROUP BY ch)"""

# The vocabulary without merges: special tokens, bytes, characters by frequency.
SQL_CHAR_VOCAB = f"""{SQL_CHARS},
vocab AS (
  SELECT 0 AS id, '<unk>' AS piece, 0 AS score, 'unk' AS kind UNION ALL SELECT 1, '<s>', 0, 'bos'
  UNION ALL SELECT 2, '</s>', 0, 'eos'
  UNION ALL SELECT b + 3, '<0x' || upper(lpad(to_base(b, 16), 2, '0')) || '>', 0, 'byte' FROM range(256) r(b)
  UNION ALL SELECT 258 + row_number() OVER (ORDER BY cnt DESC, ch), ch,
    1 - row_number() OVER (ORDER BY cnt DESC, ch), 'char' FROM chars)"""


def clean(spark, sf):
    return t.corpus(spark, sf).withColumn("text", strip_text(F.col("text")))


def training_words(spark, sf, shards=None):
    """Words of the whole corpus, or of its first ``shards``."""
    docs = clean(spark, sf)
    return V.word_counts(docs if shards is None else C.first_shards(docs, shards))


@t.derived
def trained(spark, sf):
    return V.train_bpe(training_words(spark, sf), VOCAB_SIZE)


@t.derived
def char_vocabulary(spark, sf):
    """A vocabulary whose size leaves no room for merges."""
    words = V.staged(training_words(spark, sf), "words")
    chars = V.char_inventory(words).count()
    return V.train_bpe(words, V.FIRST_FREE_ID + chars, written=True)


@query("word_counts", f"WITH {SQL_WORDS} SELECT word, cnt FROM words")
def word_counts(spark, sf):
    return training_words(spark, sf)


@query(
    "char_inventory",
    f"""WITH {SQL_CHARS} SELECT ch, cnt,
      coalesce(sum(cnt) OVER (ORDER BY cnt DESC, ch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
        < sum(cnt) OVER () * 0.999::DOUBLE AS kept FROM chars""",
)
def char_inventory(spark, sf):
    return V.char_inventory(training_words(spark, sf), 0.999)


SQL_PAIRS = f"""{SQL_WORDS},
symbols AS (SELECT cnt, string_split(word, '') AS s FROM words),
pairs AS (
  SELECT s[i] AS l, s[i + 1] AS r, CAST(sum(cnt) AS BIGINT) AS cnt
  FROM (SELECT cnt, s, unnest(range(1, len(s))) AS i FROM symbols) GROUP BY ALL)"""


@query("pair_counts", f'WITH {SQL_PAIRS} SELECT l AS "left", r AS "right", cnt FROM pairs')
def pair_counts(spark, sf):
    return V.pair_counts(V.with_symbols(training_words(spark, sf)))


@query(
    "bpe_step",
    f"""WITH {SQL_PAIRS}, best AS (SELECT l, r FROM pairs ORDER BY cnt DESC, length(l || r), l || r, l LIMIT 1),
    first_symbols AS (SELECT word, cnt, array_to_string(list_transform(
      string_split(word, ''), lambda c: chr(1) || c || chr(2)), '') AS symbols FROM words)
    SELECT word, cnt, replace(symbols, chr(1) || l || chr(2) || chr(1) || r || chr(2), chr(1) || l || r || chr(2))
      AS symbols FROM first_symbols CROSS JOIN best""",
)
def bpe_step(spark, sf):
    """One merge of the most frequent pair."""
    words = V.staged(V.with_symbols(training_words(spark, sf)), "symbols")
    best = V.best_pairs(words, 1).first()
    return V.bpe_step(words, best["left"], best["right"])


def _sql_trained(words: str) -> str:
    """Merges learned from the CTE ``words`` (word, cnt), one a round of the recursion, as many as the vocabulary has room for."""
    return f"""rounds AS (
  SELECT 0 AS k, word, cnt, array_to_string(list_transform(string_split(word, ''), lambda c: chr(1) || c || chr(2)), '')
    AS symbols, '' AS l, '' AS r FROM {words} WHERE length(word) > 1
  UNION ALL
  SELECT k + 1, word, cnt, replace(symbols, chr(1) || b.l || chr(2) || chr(1) || b.r || chr(2), chr(1) || b.l || b.r || chr(2)), b.l, b.r
  FROM rounds CROSS JOIN (
    SELECT l, r FROM (
      SELECT s[i] AS l, s[i + 1] AS r, sum(cnt) AS n FROM (
        SELECT cnt, s, unnest(range(1, len(s))) AS i FROM (
          SELECT cnt, string_split(substr(symbols, 2, length(symbols) - 2), chr(2) || chr(1)) AS s FROM rounds WHERE cnt > 0))
      GROUP BY ALL)
    ORDER BY n DESC, length(l || r), l || r, l LIMIT 1) b
  WHERE k < {VOCAB_SIZE} - {V.FIRST_FREE_ID} - (SELECT count(*) FROM chars)),
merges AS (SELECT k - 1 AS rank, any_value(l) AS l, any_value(r) AS r FROM rounds WHERE k > 0 GROUP BY k),
pieces AS (
  SELECT 0 AS part, rank AS ord, l || r AS piece, 'merge' AS kind FROM merges
  UNION ALL SELECT 1, row_number() OVER (ORDER BY cnt DESC, ch), ch, 'char' FROM chars),
vocab AS (
  SELECT 0 AS id, '<unk>' AS piece, 0 AS score, 'unk' AS kind UNION ALL SELECT 1, '<s>', 0, 'bos'
  UNION ALL SELECT 2, '</s>', 0, 'eos'
  UNION ALL SELECT b + 3, '<0x' || upper(lpad(to_base(b, 16), 2, '0')) || '>', 0, 'byte' FROM range(256) r(b)
  UNION ALL SELECT 258 + row_number() OVER (ORDER BY part, ord), piece, 1 - row_number() OVER (ORDER BY part, ord), kind FROM pieces)"""


SQL_TRAINED = f"RECURSIVE {SQL_CHARS},\n{_sql_trained('words')}"

# Words to encode go through the same merges with a count of 0, so they have no say in them.
SQL_ENCODED = f"""RECURSIVE {SQL_CHARS},
texts AS (
  SELECT shard_id, doc_pos, CASE WHEN length(text) = 0 THEN [] ELSE regexp_extract_all('{MARK}' || replace(text, ' ', '{MARK}'),
    '[\\n\\x01\\x02]|[0-9０-９]|{MARK}*[^{MARK}0-9０-９\\n\\x01\\x02]+|{MARK}+') END AS ws FROM clean),
places AS (SELECT shard_id, doc_pos, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM texts),
all_words AS (
  SELECT word, CAST(sum(cnt) AS BIGINT) AS cnt FROM (
    SELECT word, cnt FROM words UNION ALL SELECT DISTINCT word, 0 FROM places) GROUP BY word),
{_sql_trained('all_words')},
symbols AS (
  SELECT word, string_split(substr(symbols, 2, length(symbols) - 2), chr(2) || chr(1)) AS s
  FROM rounds WHERE k = (SELECT max(k) FROM rounds) UNION ALL SELECT word, [word] FROM all_words WHERE length(word) = 1),
coded AS (
  SELECT word, flatten(list(CASE WHEN v.id IS NOT NULL THEN [CAST(v.id AS INTEGER)] ELSE {t.sql_bytes('sym')} END ORDER BY i)) AS ids
  FROM (SELECT word, unnest(s) AS sym, generate_subscripts(s, 1) AS i FROM symbols) x
  LEFT JOIN vocab v ON v.piece = x.sym AND v.kind IN ('char', 'merge') GROUP BY word),
encoded AS (
  SELECT t.shard_id, t.doc_pos, list_concat([1], coalesce(e.ids, [])) AS ids FROM texts t LEFT JOIN (
    SELECT shard_id, doc_pos, flatten(list(ids ORDER BY i)) AS ids FROM places JOIN coded USING (word) GROUP BY ALL) e
  USING (shard_id, doc_pos))"""


@query("train_bpe", f"WITH {SQL_TRAINED} SELECT CAST(id AS INTEGER) AS id, piece, CAST(score AS FLOAT) AS score, kind FROM vocab")
def train_bpe(spark, sf):
    """The trained vocabulary; the twin merges one pair at a time and holds as long as no merge spells a known piece."""
    return trained(spark, sf).vocab


@query("train_bpe_merges", f'WITH {SQL_TRAINED} SELECT CAST(rank AS INTEGER) AS rank, l AS "left", r AS "right" FROM merges')
def train_bpe_merges(spark, sf):
    return trained(spark, sf).merges


@query("char_vocabulary", f"WITH {SQL_CHAR_VOCAB} SELECT CAST(id AS INTEGER) AS id, piece, CAST(score AS FLOAT) AS score, kind FROM vocab")
def char_vocab(spark, sf):
    return char_vocabulary(spark, sf).vocab


@query(
    "encode_chars",
    f"""WITH {SQL_CHAR_VOCAB},
    marked AS (SELECT shard_id, doc_pos, CASE WHEN length(text) > 0 THEN '{MARK}' || replace(text, ' ', '{MARK}') ELSE '' END AS m FROM clean),
    pos AS (
      SELECT shard_id, doc_pos, unnest(regexp_extract_all(m, '(?s).')) AS ch,
             generate_subscripts(regexp_extract_all(m, '(?s).'), 1) AS i FROM marked),
    coded AS (
      SELECT shard_id, doc_pos, i, CASE WHEN v.id IS NOT NULL THEN [v.id] ELSE {t.sql_bytes('pos.ch')} END AS ids
      FROM pos LEFT JOIN vocab v ON v.piece = pos.ch AND v.kind = 'char')
    SELECT m.shard_id, m.doc_pos, array_to_string(list_concat([1], coalesce(c.ids, [])), ',') AS ids
    FROM marked m LEFT JOIN (
      SELECT shard_id, doc_pos, flatten(list(ids ORDER BY i)) AS ids FROM coded GROUP BY ALL) c
    USING (shard_id, doc_pos)""",
)
def encode_chars(spark, sf):
    """Encoding with the vocabulary without merges: characters where known, bytes elsewhere."""
    encoded = C.pretokenize(t.corpus(spark, sf), lambda d: V.encode_corpus(d, char_vocabulary(spark, sf)))
    return encoded.select("shard_id", "doc_pos", text("ids").alias("ids"))


@query(
    "encode_corpus",
    f"""WITH {SQL_ENCODED} SELECT shard_id, doc_pos, array_to_string(ids, ',') AS ids, CAST(len(ids) AS INTEGER) AS n_tokens
    FROM encoded""",
)
def encode_corpus(spark, sf):
    """Encoding with the trained vocabulary; the twin replays its merges on all words of the texts."""
    encoded = C.pretokenize(t.corpus(spark, sf), lambda d: V.encode_corpus(d, trained(spark, sf)))
    return encoded.select("shard_id", "doc_pos", text("ids").alias("ids"), "n_tokens")


@query("decode_corpus", f"WITH {t.SQL_CORPUS} SELECT shard_id, doc_pos, {t.SQL_STRIP} AS text FROM corpus")
def decode_corpus(spark, sf):
    """Text to trained tokens and back."""
    vocabulary = trained(spark, sf)
    encoded = V.encode_corpus(clean(spark, sf), vocabulary, bos=True, eos=True)
    return V.decode_corpus(encoded, vocabulary.vocab).select("shard_id", "doc_pos", "text")


@query(
    "vocab_lookup",
    f"""WITH {SQL_CHAR_VOCAB}, bytes AS (
      SELECT doc_pos, unnest({t.sql_bytes('text')}) AS id FROM clean), used AS (
      SELECT id, count(*) AS n FROM bytes GROUP BY id)
    SELECT CAST(id AS INTEGER) AS id, n, piece, kind FROM used JOIN vocab USING (id)""",
)
def vocab_lookup(spark, sf):
    ids = C.pretokenize_bytes(t.corpus(spark, sf), bos=False).select(F.explode("ids").alias("id"))
    used = ids.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return V.vocab_lookup(used, char_vocabulary(spark, sf).vocab).select("id", "n", "piece", "kind")


@query(
    "export_vocab",
    f"""WITH {SQL_CHAR_VOCAB}, shown AS (
      SELECT id, score, CASE WHEN id = 1 THEN chr(10) || '<s>' || chr(10) WHEN id = 2 THEN chr(10) || '</s>' || chr(10)
        ELSE replace(piece, '{MARK}', ' ') END AS display FROM vocab)
    SELECT CAST(id AS INTEGER) AS id, display, CAST(score AS FLOAT) AS score,
      CAST(octet_length(encode(display)) AS INTEGER) AS byte_length,
      CAST(max(octet_length(encode(display))) OVER () AS INTEGER) AS max_byte_length FROM shown""",
)
def export_vocab(spark, sf):
    return V.export_vocab(char_vocabulary(spark, sf).vocab)

"""Registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from murmur.llm import bpe, chat, langid, mih, packing, phrases, pieces, pii, pivots, secrets, sharding, simhash, spelling
from murmur.llm.frames import table


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mih.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.with_control_case(table(spark, sf_dir, "conversations"))
    return chat.chat_digests(turns, bpe.public_path())


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), bpe.public_path())


def op4_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.largest_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find_pii(docs, pii.learn(docs))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_of("fingerprint").alias("fingerprint"), "component_id")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_documents(table(spark, sf_dir, "documents"), bpe.public_path())


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_documents(table(spark, sf_dir, "documents"), pieces.public_path())


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_neighbours, op2_chat_formatting, op3_packing, op4_products, op5_sharding, op6_pii, op7_secrets, op8_language,
        op9_simhash, op10_bpe, op11_sentencepiece, op12_collocations, op13_spelling,
    )
}
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ENDS = "/?s>|/?INST\\]|/?OUT\\]|/?ROLE\\]|\\|endoftext\\|>|\\|startoftext\\|>"
_CONVERSATIONS = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
e AS (
  SELECT *, regexp_replace(text, '([<\\[])(\\\\*)({_ENDS})', '\\1\\\\\\2\\3', 'g') AS written,
    regexp_replace(role, '([<\\[])(\\\\*)({_ENDS})', '\\1\\\\\\2\\3', 'g') AS called FROM t
)"""

#: The others can't be told in SQL: tokenizers, trained models, hashes that it lacks, results
#: that may miss some neighbours. Their tests hold them against plain versions.
ORACLE = {
    "op2_chat_formatting": _CONVERSATIONS + """
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, sha256(text))) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, sha256(text)) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(written) + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 9 ELSE 17 + length(called) END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id""",
    "op4_products": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.w, v.w)::BIGINT AS score
  FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5""",
    "op12_collocations": f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda x: x <> '') AS words FROM pieces),
begun AS (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS pos FROM w, range(1, 5) AS s(size)),
g AS (
  SELECT lang, size, array_to_string(words[pos:pos + size - 1], ' ') AS phrase, count(*)::HUGEINT AS f FROM begun
  GROUP BY ALL HAVING count(*) >= 30
),
cuts AS (
  SELECT g.lang, g.phrase, g.size, g.f AS a, x.f AS l, y.f AS r, k, 2000000 * g.f // (x.f + y.f) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k, string_split(phrase, ' ') AS words FROM g WHERE size > 1) g
  JOIN g x ON x.lang = g.lang AND x.phrase = array_to_string(g.words[1:k], ' ')
  JOIN g y ON y.lang = g.lang AND y.phrase = array_to_string(g.words[k + 1:], ' ')
),
c AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, array_to_string(words[pos:pos + m - 1], ' ') AS phrase, max(a) AS most
  FROM (SELECT *, unnest(range(1, size - m + 2)) AS pos FROM (SELECT *, unnest(range(2, size)) AS m, string_split(phrase, ' ') AS words FROM c))
  GROUP BY ALL
),
kept AS (SELECT c.* FROM c LEFT JOIN inside i ON i.lang = c.lang AND i.phrase = c.phrase WHERE i.most IS NULL OR 100 * i.most < 80 * c.a),
n AS (SELECT lang, sum(len(words)) AS n FROM w GROUP BY lang)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
  a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n.n::BIGINT AS n, score::BIGINT AS score
FROM kept JOIN n ON n.lang = kept.lang
QUALIFY row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) <= 2000""",
    "op13_spelling": f"""
WITH t AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i: CASE c & 1 WHEN 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS step
),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, 'null') AS doc, unnest(regexp_extract_all({_LOWER}, '[a-zÀ-ÿ]+')) AS run FROM documents
),
bytes AS (SELECT doc, run, count(*) AS n, hex(encode(doc || ':' || run)) AS hex FROM runs GROUP BY doc, run),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_transform(range(1, length(hex), 2), lambda i: ('0x' || substr(hex, i, 2))::BIGINT),
    lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1]), 4294967295::BIGINT)) AS h
  FROM bytes, t
),
thinned AS (
  SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run) + 2)::BIGINT) ELSE run END AS word FROM hashed
),
w AS (SELECT word, sum(n)::BIGINT AS n FROM thinned WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
less AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT *, unnest(range(0, length(word))) AS i FROM w)),
near AS (
  SELECT x.word, y.word AS near, y.n FROM less x JOIN less y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word AND length(x.word) = length(y.word)
  UNION SELECT x.word, y.word, y.n FROM less x JOIN w y ON x.rest = y.word
  UNION SELECT y.word, x.word, x.n FROM less x JOIN w y ON x.rest = y.word
),
best AS (SELECT word, count(*) OVER (PARTITION BY word) AS n_near, near, n FROM near QUALIFY row_number() OVER (PARTITION BY word ORDER BY n DESC, near) = 1),
told AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best.n >= 2 * w.n THEN near END AS form, CASE WHEN best.n >= 2 * w.n THEN best.n END AS form_n
  FROM w LEFT JOIN best ON best.word = w.word
),
roots AS (
  WITH RECURSIVE r AS (
    SELECT word, word AS root FROM told UNION ALL SELECT r.word, told.form FROM r JOIN told ON told.word = r.root WHERE told.form IS NOT NULL
  )
  SELECT r.word, r.root FROM r JOIN told ON told.word = r.root WHERE told.form IS NULL
)
SELECT told.word, form, root, n, n_near, form_n FROM told JOIN roots ON roots.word = told.word""",
}

"""One query for each operator, over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm import (chat, codec, exact, hardneg, lattice, linededup, mixing, ngramjoin, prefix, quality, sharding,
                            spelling, tokencount)
from ledgermill.llm.common import table
from ledgermill.session import stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


SHARDS = 16


@query
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents over shards 0 to 15 by doc_id; the shard each would have with one more."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.expr("CAST(coalesce(octet_length(text), 0) + 1 AS BIGINT)").alias("size"),
        F.expr("crc32(CAST(coalesce(text, '') AS BINARY))").alias("text_crc32"),
        F.lit("key").alias("law"))
    placed = sharding.assign(docs, "doc_id", [(i, 1.0) for i in range(SHARDS)], grown=(SHARDS, 1.0))
    return sharding.number(placed, "shard", "doc_id", placed.columns)


@query
def op6_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text and the text they decode to, as digests."""
    out = codec.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.withColumnRenamed("id", "doc_id").drop("same")


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text and whether it is over 2,048."""
    out = tokencount.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.withColumnRenamed("id", "doc_id")


def _draw(key: str, salt: str) -> str:
    return f"CAST('0x' || substr(md5(coalesce('k' || {key}, 'null') || '/' || {salt}), 1, 13) AS BIGINT)"


# CRC-32 is folded over the bytes with a table of 256 remainders, made by its rule.
_REMAINDERS = """remainders AS (
  SELECT list(list_reduce(list_prepend(i, range(8)),
                          lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) AS r(i))"""


def _crc32(text: str) -> str:
    return f"""xor(4294967295, list_reduce(
           list_prepend(CAST(4294967295 AS BIGINT),
             list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: CAST('0x' || x AS BIGINT))),
           lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])))"""


SQL["op1_sharding"] = f"""
WITH {_REMAINDERS},
docs AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size, 'key' AS law,
         {_crc32("coalesce(text, '')")} AS text_crc32
  FROM documents, remainders),
bids AS (
  SELECT *, list_transform(range({SHARDS} + 1), lambda s: {{'score':
           ln(({_draw("doc_id", "s")} + 0.5) / 4503599627370496.0), 'tie': -s}}) AS b
  FROM docs),
placed AS (
  SELECT doc_id, size, text_crc32, law,
         CAST(-list_max(b[1:{SHARDS}]).tie AS INTEGER) AS shard, CAST(-list_max(b).tie AS INTEGER) AS grown_shard
  FROM bids)
SELECT *, row_number() OVER (PARTITION BY shard ORDER BY {_draw("doc_id", "'slot'")},
                             doc_id, size, text_crc32) - 1 AS slot
FROM placed
"""


@query
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row that stays for each document, found by the stateful stream."""
    out = exact.dedup(spark, f"{sf_dir}/documents.parquet")
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                      F.lower(F.hex("digest")).alias("text_sha256"))


SQL["op7_exact_dedup"] = """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
         sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
  FROM documents),
r AS (
  SELECT *, row_number() OVER w AS place, first(doc_id) OVER w AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM r
"""


@query
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return (docs.select("doc_id", quality.held_out().alias("held_out"), quality.score(model).alias("score"))
                .withColumn("predicted", F.expr("CAST(score >= 0.5 AS INT)")))


@query
def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted and read back, and one whose texts are full of control strings."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    planted = spark.sql(f"""SELECT -7L AS conv_id, turn, role, '{said}' AS text
                            FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)""")
    out = chat.read_back(chat.format_turns(rows.unionByName(planted)))
    return out.withColumnRenamed("conv", "conv_id")


# Control strings and strings that look escaped get a backslash more, others stay as they are.
_CONTROL = r"([<\[])(\\*)(s>|/s>|/?INST\]|</?SYS>>|<NONE>>|<ROLE( [0-9a-f]+)*>>)"
SQL["op3_chat_format"] = rf"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, turn, role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(turn, role)),
r AS (
  SELECT *, length(regexp_replace(text, '{_CONTROL}', '\1\\\2\3', 'g'))
            + 4 + CASE role WHEN 'user' THEN 7 WHEN 'assistant' THEN 8 WHEN 'system' THEN 8 END AS chars
  FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id
"""


@query
def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at a cosine of 0.95."""
    out = lattice.near_duplicates(table(spark, sf_dir, "embeddings"))
    return out.withColumnRenamed("id", "vec_id")


@query
def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 4-word shingles have a Jaccard similarity of 0.85 or more."""
    return ngramjoin.link(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


# The rarest-first prefix filter gives every pair that can reach the threshold.
SQL["op8_ngram_join"] = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))) END AS sh
  FROM w),
t AS MATERIALIZED (SELECT doc_id, len(sh) AS n, unnest(sh) AS t FROM s),
f AS (SELECT t, count(*) AS df FROM t GROUP BY t),
o AS (SELECT doc_id, n, t, row_number() OVER (PARTITION BY doc_id ORDER BY df, t) AS place FROM t JOIN f USING (t)),
p AS MATERIALIZED (SELECT * FROM o WHERE place <= n - ((n * 85 + 99) // 100) + 1),
c AS (SELECT DISTINCT x.doc_id AS a, y.doc_id AS b FROM p AS x JOIN p AS y ON x.t = y.t AND x.doc_id < y.doc_id
      WHERE least(x.n, y.n) * 100 >= greatest(x.n, y.n) * 85),
v AS (SELECT a, b, len(list_intersect(x.sh, y.sh)) AS i, len(x.sh) + len(y.sh) AS total
      FROM c JOIN s AS x ON x.doc_id = a JOIN s AS y ON y.doc_id = b),
l AS MATERIALIZED (SELECT a, b FROM v WHERE 100 * i >= 85 * (total - i)),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS reach FROM s UNION SELECT e.b, r.reach FROM r JOIN e ON e.a = r.doc_id)
SELECT doc_id, len(sh) AS n_shingles, (SELECT min(reach) FROM r WHERE r.doc_id = s.doc_id) AS component_id FROM s
"""


@query
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampling probability of every document for tempered source, language and topic shares, and whether it is kept."""
    measured = stage(mixing.measure(table(spark, sf_dir, "documents")), "mix-documents")
    chances = mixing.probabilities(measured)
    return (measured.join(chances, ["source", "lang", "topic"])
                    .select(F.col("id").alias("doc_id"), "source", "lang", "topic", "tokens",
                            F.round("probability", 6).alias("probability"), mixing.below("id", "probability").alias("kept")))


def _sweep(cells: str) -> str:
    """One sweep over the margins: the weights of each value are made to sum to its target."""
    for m in ("source", "lang", "topic"):
        cells = f"""(SELECT k, source, lang, topic, tokens, before, w * t_{m} / sum(w) OVER (PARTITION BY {m}) AS w,
  t_source, t_lang, t_topic FROM {cells})"""
    return cells


_TOPIC = "CASE " + " ".join(
    "WHEN " + " OR ".join(f"contains(coalesce(text, ''), '{m}')" for m in marks) + f" THEN '{name}'"
    for name, marks in mixing.TOPICS) + " ELSE 'prose' END"
SQL["op2_mixing"] = f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang, {_TOPIC} AS topic,
         greatest(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')), 1) AS tokens
  FROM documents),
g AS (SELECT source, lang, topic, CAST(sum(tokens) AS DOUBLE) AS tokens FROM d GROUP BY ALL),
""" + ",\n".join(f"""s_{m} AS (SELECT {m}, pow(sum(tokens), {mixing.POWER}) AS p FROM g GROUP BY {m}),
t_{m} AS (SELECT {m}, p / sum(p) OVER () AS t_{m} FROM s_{m})""" for m in ("source", "lang", "topic")) + f""",
c AS (
  SELECT 0 AS k, source, lang, topic, tokens, tokens / sum(tokens) OVER () AS w, t_source, t_lang, t_topic, 1e0 AS moved
  FROM g JOIN t_source USING (source) JOIN t_lang USING (lang) JOIN t_topic USING (topic)
  UNION ALL
  SELECT k + 1, source, lang, topic, tokens, w, t_source, t_lang, t_topic, max(abs(w / before - 1)) OVER ()
  FROM {_sweep(f"(SELECT *, w AS before FROM c WHERE moved > 1e-10 AND k < {mixing.SWEEPS})")}),
p AS (SELECT source, lang, topic, (w / tokens) / max(w / tokens) OVER () AS probability FROM c WHERE k = (SELECT max(k) FROM c))
SELECT doc_id, source, lang, topic, tokens, round(probability, 6) AS probability,
       ({_draw("doc_id", "'mix'")} + 0.5) / 4503599627370496.0 < probability AS kept
FROM d JOIN p USING (source, lang, topic)
"""


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line that is not blank: the first occurrence of its group, and whether it is kept."""
    out = linededup.whole_groups(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.col("pos").alias("line_no"), F.col("group_id").alias("group_doc_id"),
                      F.col("group_pos").alias("group_line_no"), "kept")


# One run in so many is planted as a misspelling.
MISSPELT = 97


@query
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form and root of every frequent word, with the planted misspellings."""
    runs = spelling.runs(table(spark, sf_dir, "documents"))
    return spelling.variants(spelling.words(spelling.misspelt(runs, MISSPELT)))


SQL["op11_spelling"] = f"""
WITH RECURSIVE {_REMAINDERS},
r AS (
  SELECT doc_id, run, count(*) AS k FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{spelling.UPPER}', '{spelling.LOWER}'), '{spelling.RUNS}')) AS run
    FROM documents) GROUP BY ALL),
h AS (SELECT run, k, {_crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM r, remainders),
w AS MATERIALIZED (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % {MISSPELT} = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, k FROM h)
  WHERE length(word) >= {spelling.LEAST_LENGTH} GROUP BY word HAVING sum(k) >= {spelling.LEAST_COUNT}),
d AS MATERIALIZED (
  SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
p AS MATERIALIZED (
  SELECT a.word, b.word AS near, b.n AS near_n FROM d AS a JOIN d AS b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT d.word, w.word, w.n FROM d JOIN w ON d.rest = w.word
  UNION SELECT w.word, d.word, d.n FROM d JOIN w ON d.rest = w.word),
b AS MATERIALIZED (
  SELECT w.word, any_value(w.n) AS n, count(near) AS n_near, first(near ORDER BY near_n DESC, near) AS best, max(near_n) AS best_n
  FROM w LEFT JOIN p USING (word) GROUP BY w.word),
f AS MATERIALIZED (
  SELECT word, n, n_near, CASE WHEN best_n >= {spelling.RATIO} * n THEN best END AS form,
         CASE WHEN best_n >= {spelling.RATIO} * n THEN best_n END AS form_n FROM b),
g AS (SELECT word, word AS root FROM f UNION ALL SELECT g.word, f.form FROM g JOIN f ON f.word = g.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, g.root, f.n, f.n_near, f.form_n
FROM f JOIN g USING (word) JOIN f AS e ON e.word = g.root WHERE e.form IS NULL
"""


@query
def op12_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text by ranks and the bytes they decode to, as digests."""
    out = prefix.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.withColumnRenamed("id", "doc_id").drop("same")


ANCHORS = 50
RELABELLED = "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives of every anchor and positive; one label in seven is moved on."""
    return hardneg.mine(table(spark, sf_dir, "embeddings").withColumn("label", F.expr(RELABELLED)), every=ANCHORS)


SQL["op13_hard_negatives"] = f"""
WITH e AS MATERIALIZED (
  SELECT vec_id, {RELABELLED} AS label, list_transform(embedding, lambda x: floor({hardneg.SCALE} * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM e AS a JOIN e AS b ON a.vec_id % {ANCHORS} = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {hardneg.POSITIVES})
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND {hardneg.LOWEST} * positive_score <= 100 * score AND 100 * score <= {hardneg.HIGHEST} * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER w <= {hardneg.NEGATIVES}
"""

"""The registered queries of the training-data operators, with the SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inventrace.llm import chat, exact, lines, mixing, negatives, packing, pieces, quality, rules, simhash, suffix, tokenfile, whitening
from inventrace.llm.common import documents, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"'[^\x20\x09-\x0D]+'"


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all documents takes from each, in the order of their first training position."""
    docs = documents(spark, sf_dir)
    sized = docs.select("doc_id", "source", mixing.words(F.col("text")).alias("size"))
    planned = mixing.plan(sized, size=F.col("size"))
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda total, c: total + c.words)
    rows = planned.select("doc.doc_id", "size", "source_size", "target", taken.alias("taken"), F.get(F.col("copies"), F.lit(0)).position.alias("at"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(n, F.col("at").asc_nulls_last(), "doc_id").sortWithinPartitions(F.col("at").asc_nulls_last(), "doc_id").drop("at")


ORACLE_SQL["op1_mixing_sources"] = f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_WORD}))::BIGINT AS size,
           md5(coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight, 3.0::DOUBLE * source_size AS cap FROM s),
l AS (SELECT *, ((SELECT sum(source_size)::DOUBLE FROM s) - coalesce(sum(cap) OVER b, 0)) / ((SELECT sum(weight) FROM w) - coalesce(sum(weight) OVER b, 0)) AS level
      FROM w WINDOW b AS (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(cap, (SELECT max(level) FROM l) * weight) AS target FROM l),
p AS (SELECT d.*, source_size, target, round(target)::BIGINT AS goal,
      coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS st
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (greatest(least(size, goal - st), 0) + greatest(least(size, goal - st - source_size), 0) + greatest(least(size, goal - st - 2 * source_size), 0))::BIGINT AS taken
FROM p
"""


@query
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, by a model of the labels that are not held out."""
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(quality.labelled(docs, labels))
    scored = quality.score(docs, model, keep=["doc_id"])
    return scored.select(
        "row.doc_id",
        quality.held_out(F.col("row.doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.PASS_SCORE).cast("int").alias("predicted"),
    )


@query
def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts hold control strings, formatted and read back."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = F.lit("\\### Assistant: </turn> ok")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    return chat.read_back(chat.format_conversations(turns.unionByName(extra)))


@query
def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each document's ids lie in the token files, and their checksum, read from the files."""
    with open(public_tokenizers.path("word_bpe_49k.json")) as f:
        definition = f.read()
    return tokenfile.round_trip(documents(spark, sf_dir), definition)


@query
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that repeat 50-byte strings of documents with smaller ids."""
    return suffix.repeated_spans(documents(spark, sf_dir)).drop("removed")


@query
def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule measures of every document, with the verdict of its source."""
    return rules.host_rules(documents(spark, sf_dir)).select("doc_id", *rules.MEASURES, "base_failed", "kept")


ORACLE_SQL["op7_quality_rules"] = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, regexp_extract_all(t, {_WORD}) AS ws FROM d),
win AS (SELECT rid, i, list_slice(ws, i, i + 4) AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) > 4)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT i + k) AS n FROM rep, range(0, 5) AS r(k) GROUP BY rid),
lin AS (SELECT rid, count(*) - count(DISTINCT line) AS n
        FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
m AS (SELECT d.rid, doc_id, source, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
      length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(lin.n, 0)::BIGINT AS n_dup_lines,
      coalesce(cov.n, 0)::BIGINT AS n_repeat_words FROM d JOIN w USING (rid) LEFT JOIN lin USING (rid) LEFT JOIN cov USING (rid)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
h AS (SELECT source, count(*) AS n, sum(base_failed::BIGINT)::DOUBLE AS f FROM b GROUP BY source),
s AS (SELECT sum(n)::DOUBLE AS n, sum(f) AS f, count(*) AS hosts, sum(f * f / n) AS q FROM h),
p AS (SELECT *, least(greatest((f + 0.5) / (n + 1), 1e-6), 1 - 1e-6) AS mean FROM s),
k AS (SELECT mean, greatest(mean * (1 - mean) / greatest(q / n - (f / n) * (f / n) - mean * (1 - mean) * hosts / n, mean * (1 - mean) * 1e-4) - 1, 1.0) AS strength FROM p),
v AS (SELECT source, (f + mean * strength) / (n + strength) > 0.5 AS host_failed FROM h, k)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT host_failed AS kept
FROM b JOIN v ON b.source IS NOT DISTINCT FROM v.source
"""


@query
def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text and the text that they decode to."""
    model = pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    encoded = pieces.encode(documents(spark, sf_dir), model, keep=["doc_id"]).select("row.doc_id", "ids")
    return pieces.decode(encoded, model).select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), "decoded")


@query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the runs of lines that occur earlier."""
    found = lines.line_dedup(documents(spark, sf_dir))
    return found.select("doc_id", "text", "line_dedup.n_lines", "line_dedup.removed_lines")


ORACLE_SQL["op9_line_dedup"] = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
a AS (SELECT rid, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
o AS (SELECT *, len(regexp_extract_all(line, {_WORD})) AS n, row_number() OVER (PARTITION BY rid ORDER BY pos) AS i FROM a WHERE regexp_matches(line, {_WORD})),
x AS (SELECT *, lead(line) OVER r AS l1, lead(line, 2) OVER r AS l2, lead(n) OVER r AS n1, lead(pos) OVER r AS p1, lead(pos, 2) OVER r AS p2
      FROM o WINDOW r AS (PARTITION BY rid ORDER BY i)),
u AS (SELECT rid, doc_id, i, 3 AS len, [line, l1, l2] AS k, [pos, p1, p2] AS ps FROM x WHERE l2 IS NOT NULL
      UNION ALL SELECT rid, doc_id, i, 1, [line], [pos] FROM x WHERE n >= 50
      UNION ALL SELECT rid, doc_id, i, 2, [line, l1], [pos, p1] FROM x WHERE l1 IS NOT NULL AND n < 50 AND n1 < 50 AND n + n1 >= 50),
f AS (SELECT *, first_value(doc_id) OVER w AS fd, first_value(i) OVER w AS fi FROM u WINDOW w AS (PARTITION BY k ORDER BY doc_id, i)),
g AS (SELECT DISTINCT rid, unnest(ps) AS pos FROM f WHERE CASE WHEN doc_id = fd THEN i >= fi + len ELSE true END),
k AS (SELECT rid, string_agg(line, chr(10) ORDER BY pos) AS text FROM a ANTI JOIN g USING (rid, pos) GROUP BY rid),
c AS (SELECT rid, count(*) AS n FROM g GROUP BY rid)
SELECT doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text, coalesce(len(ls), 0)::BIGINT AS n_lines, coalesce(c.n, 0)::BIGINT AS removed_lines
FROM d LEFT JOIN k USING (rid) LEFT JOIN c USING (rid)
"""


@query
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact groups of all documents: the lower half of the id range is the sealed snapshot, the upper half arrives."""
    docs = documents(spark, sf_dir)
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    middle = ((low or 0) + (high or 0)) // 2
    return exact.exact_dedup(docs, F.col("doc_id") > middle)


ORACLE_SQL["op10_exact_dedup"] = f"""
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, {_LOWER} AS t FROM documents) WINDOW g AS (PARTITION BY t)
"""


@query
def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 ids, and the checksum of each piece's ids."""
    with open(public_tokenizers.path("byte_bpe_50k.json")) as f:
        definition = f.read()
    pieces_ = stored(packing.tokenize(documents(spark, sf_dir).select("doc_id", "text"), definition), "pieces")
    # Ranks need no ids, so only their checksums are shuffled.
    placed = packing.place(pieces_.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return placed.select("row.doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector against all vectors, one label in seven moved on by one."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 50 == 0)


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four leading whitened components of every vector."""
    found = whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    deviation = F.expr("try_cast(deviation AS bigint)").alias("deviation")
    return found.select("row.vec_id", "component", "n", deviation, "whitened", "explained", "identity_error")

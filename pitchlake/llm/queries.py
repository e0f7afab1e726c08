"""The registered queries of the training-data operators: thin digests over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.llm import bpe, jaccard, lattice, line_crf, mixing, neighbours, packing, periods, pii, tools, toxicity, urls, whitening

#: Where vocabulary files are; a parameter of the operators themselves.
BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, urls.fit(pages))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model, vocabulary = mixing.fit(docs)
    return mixing.score(docs, model, vocabulary)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), lambda i: F.pmod(i, F.lit(20)) == 0)


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "kept")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op8_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tools.link(*tools.calls_of(table(spark, sf_dir, "conversations")))


def op9_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return whitening.whiten(rows, whitening.fit(rows)).withColumn("deviation", F.col("deviation").try_cast("long"))


def planted(docs: DataFrame) -> DataFrame:
    """Documents with the contract's periodic tails: in one of ten, words from ``a`` on repeat those of one period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"))
    words = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    docs = docs.withColumn("w", words).withColumn("n", F.size("w"))
    hit = F.coalesce(F.col("n") > 0, F.lit(False))
    docs = docs.withColumn("a", F.when(hit, F.col("g") % F.col("n")))
    docs = docs.withColumn("p", F.when(hit, 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))))
    made = F.transform("w", lambda x, i: F.when(i < F.col("a"), x).otherwise(F.get("w", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    return docs.select("doc_id", F.when(hit, F.array_join(made, " ")).otherwise(F.col("text")).alias("text"))


def op12_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_of_runs(periods.find(planted(table(spark, sf_dir, "documents"))))


def digest_of_runs(found: DataFrame) -> DataFrame:
    """The contract's columns of found runs; the longest run, of equal ones the first, then that of the least period."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("brief"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    text = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    out = found.withColumn("best", best)
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.back")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.brief")).alias("period"),
        F.floor(F.lit(1000) * F.col("best.length") / -F.col("best.brief")).alias("exponent_milli"), F.sha2(text, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_crf.judge(docs, line_crf.fit(docs, table(spark, sf_dir, "labels")))


QUERIES = {f.__name__: f for f in (op1_url_filter, op2_packing, op3_mixing, op4_bpe, op5_neighbours, op6_jaccard, op7_toxicity, op8_tool_calls, op9_lattice, op10_pii, op11_whitening, op12_periods, op13_line_crf)}

#: DuckDB SQL where SQL can express the whole result.
ORACLE_SQL = {
    "op8_tool_calls": """
WITH RECURSIVE c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text, contains(coalesce(text, ''), chr(10)) AS many, contains(coalesce(text, ''), ',') AS comma FROM conversations),
made AS (
  SELECT conv_id, turn, 'c' || conv_id || '-' || turn AS call_id, 'reply' AS tool,
    CASE WHEN many AND turn >= 2 THEN 'c' || conv_id || '-' || (turn - 2) WHEN NOT many THEN 'c' || conv_id || '-' || (turn + 2) END AS dep, text, comma FROM c WHERE role = 'user'
  UNION ALL SELECT conv_id, turn, 'c' || conv_id || '-' || (turn + 1), 'configure', NULL, text, NULL FROM c WHERE role = 'system'),
calls AS (SELECT *, row_number() OVER (PARTITION BY conv_id, call_id ORDER BY turn, tool, text) AS place,
  CASE tool WHEN 'reply' THEN '{' || CASE WHEN dep IS NULL THEN '' ELSE '"after":' || to_json(dep)::VARCHAR || ',' END || '"text":' || to_json(text)::VARCHAR || ',"turn":' || CASE WHEN comma THEN turn::VARCHAR ELSE '"' || turn || '"' END || '}' ELSE 'null' END AS arguments,
  CASE WHEN tool = 'configure' THEN 'not JSON; unknown tool' WHEN NOT comma THEN 'turn is no integer' ELSE '' END AS wrong FROM made),
results AS (SELECT *, row_number() OVER (PARTITION BY conv_id, call_id ORDER BY turn, content) AS place FROM (
  SELECT conv_id, turn, 'c' || conv_id || '-' || CASE WHEN NOT comma THEN turn - 3 WHEN many THEN turn - 1 ELSE turn + 1 END AS call_id, text AS content FROM c WHERE role = 'assistant')),
one AS (SELECT * FROM calls WHERE place = 1),
walk AS (SELECT conv_id, call_id AS start, call_id AS node, turn, dep, 0 AS steps FROM one
  UNION ALL SELECT w.conv_id, w.start, o.call_id, o.turn, o.dep, w.steps + 1 FROM walk w JOIN one o ON w.conv_id = o.conv_id AND w.dep = o.call_id WHERE w.steps < 40),
ends AS (SELECT conv_id, start AS call_id, max(steps) >= 40 AS cyclic, max(turn) AS order_turn, arg_max(steps, turn) AS order_depth FROM walk GROUP BY ALL),
both_ AS (SELECT coalesce(o.conv_id, r.conv_id) AS conv_id, coalesce(o.call_id, r.call_id) AS call_id, o.tool, o.turn AS call_turn, r.turn AS result_turn,
    CASE WHEN o.call_id IS NULL THEN 'orphan' WHEN r.call_id IS NULL THEN 'unanswered' WHEN r.turn <= o.turn THEN 'before its call' ELSE 'linked' END AS status,
    CASE WHEN o.call_id IS NULL THEN '' ELSE concat_ws('; ', nullif(o.wrong, ''), CASE WHEN o.dep IS NOT NULL AND d.call_id IS NULL THEN 'no call ' || o.dep END) END AS errors,
    CASE WHEN NOT e.cyclic THEN e.order_turn END AS order_turn, CASE WHEN NOT e.cyclic THEN e.order_depth END AS order_depth, o.arguments, r.content
  FROM one o FULL JOIN (SELECT * FROM results WHERE place = 1) r ON o.conv_id = r.conv_id AND o.call_id = r.call_id
  LEFT JOIN one d ON o.conv_id = d.conv_id AND o.dep = d.call_id LEFT JOIN ends e ON o.conv_id = e.conv_id AND o.call_id = e.call_id
  UNION ALL SELECT conv_id, call_id, tool, turn, NULL, 'repeated call', wrong, NULL, NULL, arguments, NULL FROM calls WHERE place > 1
  UNION ALL SELECT conv_id, call_id, NULL, NULL, turn, 'repeated result', '', NULL, NULL, NULL, content FROM results WHERE place > 1)
SELECT conv_id, call_id, tool, call_turn, result_turn, status, errors, order_turn, CAST(order_depth AS INT) AS order_depth,
  '{"arguments":' || coalesce(arguments, 'null') || ',"id":' || to_json(call_id)::VARCHAR || ',"result":' || coalesce(to_json(content)::VARCHAR, 'null') || ',"tool":' || coalesce(to_json(tool)::VARCHAR, 'null') || '}' AS record
FROM both_
""",
}

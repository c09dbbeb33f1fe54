"""The registered ``opN_*`` queries: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat import SCHEMA_COLUMNS, conversation_calls, link_tool_calls
from .embedding_forest import embedding_near_duplicates
from .hmm import hmm_scores
from .language import held_out, predict_language, train_language_model
from .line_templates import drop_template_lines
from .media import text_media
from .mixing import mix_sources
from .ngram_join import ngram_jaccard_components
from .packing import pack_documents
from .token_count import token_counts

# The tools that plain transcripts call, and what their arguments must be.
TRANSCRIPT_SCHEMAS = [
    ("reply", "role", "string", True, 4.0, 4.0),
    ("reply", "text", "string", True, 1.0, 4000.0),
    ("reply", "turn", "integer", True, 0.0, None),
    ("setup", "role", "string", True, 6.0, 6.0),
    ("setup", "text", "string", True, 1.0, None),
    ("setup", "turn", "integer", True, 0.0, 0.0),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def op2_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = hmm_scores(docs, ~held_out("doc_id", 7, 2))
    return out.withColumn("held_out", held_out("doc_id", 7, 2))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_media(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = train_language_model(docs.filter(~held_out("doc_id", 3, 1)).select("text", "lang"))
    out = predict_language(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", "score")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_embedding_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_near_duplicates(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op8_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_template_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.length("text").cast("long").alias("n_chars_left"), F.md5("text").alias("text_md5"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = conversation_calls(_table(spark, sf_dir, "conversations"))
    return link_tool_calls(calls, results, spark.createDataFrame(TRANSCRIPT_SCHEMAS, SCHEMA_COLUMNS))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_components(_table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_hmm_scores": op2_hmm_scores,
    "op3_packing": op3_packing,
    "op4_media": op4_media,
    "op5_language": op5_language,
    "op6_token_counts": op6_token_counts,
    "op7_embedding_forest": op7_embedding_forest,
    "op8_line_templates": op8_line_templates,
    "op9_chat": op9_chat,
    "op10_ngram_jaccard": op10_ngram_jaccard,
}

_COMPONENTS = """reach(node, comp) USING KEY (node) AS (SELECT a, a FROM both_ways
  UNION SELECT l.b, min(r.comp) FROM reach r JOIN both_ways l ON l.a = r.node LEFT JOIN recurring.reach o ON o.node = l.b WHERE r.comp < o.comp GROUP BY l.b)"""

ORACLE_SQL: dict[str, str] = {
    "op7_embedding_forest": f"""WITH RECURSIVE good AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE embedding IS NOT NULL AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y ON x.vec_id <> y.vec_id AND list_cosine_similarity(x.v, y.v) >= 0.9),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT vec_id, vec_id FROM good), {_COMPONENTS}
SELECT e.vec_id, count(l.b) AS n_links, any_value(coalesce(r.comp, e.vec_id)) AS component_id, any_value(coalesce(r.comp, e.vec_id)) = e.vec_id AS kept
FROM embeddings e LEFT JOIN links l ON l.a = e.vec_id LEFT JOIN reach r ON r.node = e.vec_id GROUP BY e.vec_id""",
    "op9_chat": """WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
c AS (SELECT *, concat(conv_id, ':', turn) AS call_id, turn // 2 - row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS island FROM t WHERE role IN ('user', 'system')),
d AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn % 2, island ORDER BY turn) - 1 AS depth FROM c),
r AS (SELECT concat(conv_id, ':', turn - 1) AS call_id, any_value(conv_id) AS conv_id, count(*) AS n_results, min(turn) AS result_turn, arg_min(text, (turn, text)) AS content FROM t WHERE role IS NULL OR role NOT IN ('user', 'system') GROUP BY 1),
e AS (SELECT d.*, r.n_results, r.result_turn, r.content, concat_ws('; ', CASE WHEN text = '' OR (role = 'user' AND length(text) > 4000) THEN 'text: range' END, CASE WHEN turn < 0 OR (role = 'system' AND turn > 0) THEN 'turn: range' END) AS errors FROM d LEFT JOIN r ON r.call_id = d.call_id)
SELECT conv_id, turn, call_id, 'call' AS kind, depth, coalesce(n_results, 0) AS n_results, result_turn, errors = '' AS valid, errors,
  concat('{"arguments":{"role":"', role, '","text":', to_json(text), ',"turn":', turn, '},"id":"', call_id, '","name":"', CASE role WHEN 'user' THEN 'reply' ELSE 'setup' END, '","result":', coalesce(CAST(to_json(content) AS VARCHAR), 'null'), '}') AS json FROM e
UNION ALL SELECT conv_id, result_turn, call_id, 'orphan', 0, n_results, result_turn, FALSE, 'no call', concat('{"arguments":null,"id":"', call_id, '","name":null,"result":', to_json(content), '}') FROM r WHERE call_id NOT IN (SELECT call_id FROM c)""",
    "op10_ngram_jaccard": f"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS s FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 4))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
both_words AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM both_words p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * k >= 80 * (x.n + y.n - k)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT doc_id, doc_id FROM documents), {_COMPONENTS}
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.comp AS component_id FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN reach r ON r.node = d.doc_id""",
}

"""The registered query of each corpus operator, with its SQL where SQL can express it."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, bagminhash, byte_bpe, crf, decontaminate, doubling, lexical, lm, pieces_bpe, topk, toxicity, warc
from . import line_dedup as _lines
from .common import fold


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = crf.fit(docs.select("doc_id", "text", "lang"), fold("doc_id", 4) != 2)
    out = crf.label(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "runs")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return _lines.line_dedup(docs).select("doc_id", "text", "n_lines", "n_removed")


def op3_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    back = pieces_bpe.decode(pieces_bpe.encode(docs))
    return back.select("doc_id", F.size("piece_ids").cast("long").alias("n_pieces"), "piece_ids", F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lm.score(_table(spark, sf_dir, "documents"), fold("doc_id", 5) != 1)
    return out.select("doc_id", (fold("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    index = toxicity.fit(docs, _table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2)
    out = toxicity.score(docs, index)
    return out.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted", "evidence")


def op7_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.classes(_table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = doubling.substring_dedup(_table(spark, sf_dir, "documents"), 13)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.round_trip(_table(spark, sf_dir, "pages"))
    checked = F.when(F.col("error").isNull(), F.col("payload_bytes")).otherwise(F.raise_error(F.concat(F.lit("WARC record "), "record_id", F.lit(": "), "error")).cast("long"))
    return back.select("page_id", checked.alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(_table(spark, sf_dir, "documents")).withColumnRenamed("groups", "groups_sha256")


def op12_byte_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    back = byte_bpe.decode(byte_bpe.encode(docs).select("doc_id", "ids"))
    digest = back.mapInArrow(_ids_digest, "doc_id long, n_tokens long, ids_sha256 string, decoded string")
    return digest.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def _ids_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        flat = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4")
        ends = ids.value_lengths().to_numpy(zero_copy_only=False).cumsum()
        digest = [hashlib.sha256(flat[a:b]).hexdigest() for a, b in zip([0, *ends[:-1]], ends, strict=True)] if len(ids) else []
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids.value_lengths().cast(pa.int64()), pa.array(digest, pa.string()), batch.column("decoded")], ["doc_id", "n_tokens", "ids_sha256", "decoded"])


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), 10)


QUERIES = {
    "op1_language": op1_language,
    "op2_line_dedup": op2_line_dedup,
    "op3_piece_codec": op3_piece_codec,
    "op4_exact_top_k": op4_exact_top_k,
    "op5_lm_score": op5_lm_score,
    "op6_toxicity": op6_toxicity,
    "op7_bagminhash": op7_bagminhash,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_decontamination": op9_decontamination,
    "op10_warc": op10_warc,
    "op11_alignment": op11_alignment,
    "op12_byte_codec": op12_byte_codec,
    "op13_lexical": op13_lexical,
}

ORACLE = {
    "op2_line_dedup": """
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
w AS (SELECT doc_id, i, ls[i] AS a, ls[i + 1] AS b, ls[i + 2] AS c FROM (SELECT doc_id, ls, unnest(range(1, len(ls) - 1)) AS i FROM d)),
v AS (SELECT * FROM w WHERE NOT (trim(a) = '' AND trim(b) = '' AND trim(c) = '')),
f AS (SELECT *, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, i) AS n FROM v),
g AS (SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS i FROM f WHERE n > 1),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i FROM d),
k AS (SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) AS text, count(*) AS n FROM l LEFT JOIN g ON l.doc_id = g.doc_id AND l.i = g.i WHERE g.i IS NULL GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text, coalesce(len(d.ls), 0)::BIGINT AS n_lines, (coalesce(len(d.ls), 0) - coalesce(k.n, 0))::BIGINT AS n_removed
FROM d LEFT JOIN k ON d.doc_id = k.doc_id""",
    "op4_exact_top_k": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op8_substring_dedup": """
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
w AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM d)),
f AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS first FROM w),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM f WHERE doc_id > first),
l AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM d),
k AS (SELECT l.doc_id, string_agg(l.word, ' ' ORDER BY l.i) AS s, count(*) AS n FROM l LEFT JOIN g ON l.doc_id = g.doc_id AND l.i = g.i WHERE g.i IS NULL GROUP BY l.doc_id)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, (len(d.ws) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(k.s, '')) AS kept_sha256 FROM d LEFT JOIN k ON d.doc_id = k.doc_id""",
    "op10_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, ''))::BIGINT AS n FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS last FROM p)
SELECT page_id, n AS payload_bytes, sha1(h) AS payload_digest, CASE WHEN n >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id <> last THEN last END AS refers_to FROM m""",
    "op13_lexical": """
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM documents),
p AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
d AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM p GROUP BY doc_id),
a AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM d),
f AS (SELECT term, count(*) AS df FROM p GROUP BY term),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
w AS (SELECT q.item_id, q.term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM q JOIN f USING (term), a),
s AS (SELECT item_id, p.doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))::BIGINT AS score FROM w JOIN p USING (term) JOIN d USING (doc_id), a GROUP BY ALL),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10""",
}

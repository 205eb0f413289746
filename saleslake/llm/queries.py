"""The operators over the test tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslake.llm import dominance, language, lines, negatives, packing, periods, quality, scoring, segmentation, token_scan, warc
from saleslake.llm.multi_index import near_vectors
from saleslake.llm.shared import small_batches, store, table, tokenizer_file, whole_text, word_list
from saleslake.llm.simhash import simhash_groups
from saleslake.session import work_dir


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
    return packing.described(pieces)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "llm-warc") + "/archives"
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(spark, folder, payloads=False).drop("url")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted in flat files that are written first."""
    end_id = 49407  # the tokenizer's end of text
    files, places = token_scan.write_flat_files(
        table(spark, sf_dir, "documents"), work_dir(spark, "llm-flat"), tokenizer_file("word_bpe_49k.json"), end_id
    )
    lengths = token_scan.document_lengths(files, end_id)
    found = token_scan.placed_lengths(places, lengths)
    return found.select(F.col("id").alias("doc_id"), F.col("tokens").alias("n_tokens"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = language.identified(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return docs.select("doc_id", f"{docs.columns[-1]}.*")


def _segmentations(docs: DataFrame, keys: list[str]) -> DataFrame:
    """Sampled segmentations of every row, read back by decoding. What is shown of them is written at once,
    as a Python worker's batches are small only while it is."""
    model = tokenizer_file("piece_bpe_32k.model")
    back = segmentation.decoded(segmentation.sampled(docs, model, keys), model)
    shown = back.select(
        *keys,
        "sample",
        F.size("ids").cast("long").alias("n_pieces"),
        F.crc32(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary")).alias("ids_crc32"),
        F.md5("decoded").alias("decoded_md5"),
        "log_prob",
        "inclusion",
    )
    with small_batches(docs.sparkSession):
        return store(shown, "segmentations")


def op6_sentencepiece_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every document, whole."""
    return _segmentations(table(spark, sf_dir, "documents"), ["doc_id"])


def op6_sentencepiece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every turn."""
    return _segmentations(table(spark, sf_dir, "conversations"), ["conv_id", "turn"])


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = lines.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", f"{docs.columns[-1]}.*", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0").select("doc_id")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality.judged(docs, trusted_ids(spark, sf_dir))
    return judged.select("doc_id", f"{judged.columns[-1]}.*")


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    hexed = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return groups.withColumn("fingerprint", hexed)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.scored(table(spark, sf_dir, "documents"))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = dominance.pack(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
    return pieces.drop("ids")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels of some rows are shifted first, so that near rows of other labels exist."""
    vectors = table(spark, sf_dir, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors.withColumn("label", shifted), F.col("id") % 50 == 0)


def with_periods(docs: DataFrame) -> DataFrame:
    """Documents of which a tenth, told by the crc32 of their id, repeats a stretch to its end."""
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    h = F.crc32(ident.cast("binary"))
    chosen = docs.withColumn("h", h).withColumn("w", F.when(F.col("h") % 10 == 0, word_list(whole_text())))
    n, g = F.size("w"), F.floor(F.col("h") / 10)
    sized = chosen.withColumn("n", n).withColumn("a", F.when(F.col("n") > 0, g % F.col("n")).cast("int"))
    rest = F.col("n") - F.col("a")
    sized = sized.withColumn("p", (1 + F.floor(rest / (3 + g % 8))).cast("int"))
    stretch = F.slice("w", F.col("a") + 1, F.col("p"))
    times = F.ceil(F.col("n") / F.col("p")).cast("int")
    repeated = F.slice(F.flatten(F.array_repeat(stretch, times)), F.lit(1), F.col("n") - F.col("a"))
    text = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), repeated), " ")
    return sized.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periods.collapsed(with_periods(table(spark, sf_dir, "documents").select("doc_id", "text")))
    runs = F.col("periods.runs")
    best = F.array_max(F.transform(runs, lambda r: F.struct(r.length.alias("l"), -r.start, -r.period, r.alias("run"))))
    run = F.col("best.run")
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return docs.withColumn("best", best).select(
        "doc_id",
        F.size(runs).cast("long").alias("n_runs"),
        run.start.alias("start"),
        run.length.alias("length"),
        run.period.alias("period"),
        F.floor(1000 * run.length / run.period).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("periods.text").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES = {f.__name__: f for f in (op1_embedding_near_dedup, op2_packing, op3_warc, op4_token_counts, op5_language_id, op6_sentencepiece_documents, op6_sentencepiece_sampling, op7_line_dedup, op8_quality_rules, op9_simhash_near_dedup, op10_lm_scoring, op11_best_fit_packing, op12_hard_negatives, op13_periodic_runs)}

_LINES = """
line AS (
    SELECT doc_id, i, x, trim(x, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS s
    FROM (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS x,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
        FROM documents
    )
),
full_line AS (
    SELECT doc_id, i, s, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k
    FROM line WHERE s <> ''
),
win AS (
    SELECT doc_id, k, [s, lead(s, 1) OVER w, lead(s, 2) OVER w] AS key, lead(k, 2) OVER w AS last
    FROM full_line WINDOW w AS (PARTITION BY doc_id ORDER BY k)
),
later AS (
    SELECT doc_id, k
    FROM (
        SELECT doc_id, k, row_number() OVER (PARTITION BY key ORDER BY doc_id, k) AS n
        FROM win WHERE last IS NOT NULL
    ) WHERE n > 1
),
gone AS (
    SELECT DISTINCT f.doc_id, f.i
    FROM full_line f JOIN later l ON f.doc_id = l.doc_id AND f.k BETWEEN l.k AND l.k + 2
)"""

ORACLE_SQL: dict[str, str] = {
    "op1_embedding_near_dedup": """
WITH RECURSIVE usable AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
link AS (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.93
),
reach(a, b) AS (
    SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
),
component AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM link WHERE link.a = c.vec_id) AS n_links, component_id,
       vec_id = component_id AS kept
FROM component c""",
    "op3_warc": """
WITH page AS (
    SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS digest FROM pages
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY digest ORDER BY page_id DESC) AS r,
           max(page_id) OVER (PARTITION BY digest) AS response FROM page
)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND r > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND r > 1 THEN response END AS refers_to
FROM ranked""",
    "op12_hard_negatives": """
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
),
pair AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
           list_inner_product(a.v, b.v)::BIGINT AS score
    FROM usable a JOIN usable b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
),
positive AS (
    SELECT anchor_id, id, score FROM pair WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.id AS positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id))::INTEGER AS rank,
       n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positive p JOIN pair n ON n.anchor_id = p.anchor_id AND NOT n.same
 AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3""",
    "op7_line_dedup": f"""
WITH {_LINES}
SELECT d.doc_id,
       (SELECT count(*) FROM full_line f WHERE f.doc_id = d.doc_id) AS n_lines,
       (SELECT count(*) FROM gone g WHERE g.doc_id = d.doc_id) AS n_removed,
       md5(coalesce((
           SELECT string_agg(l.x, chr(10) ORDER BY l.i) FROM line l
           WHERE l.doc_id = d.doc_id
             AND NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = l.doc_id AND g.i = l.i)
       ), '')) AS text_md5
FROM documents d""",
}

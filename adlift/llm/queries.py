"""Registered queries of the operators and of the pipeline, with DuckDB SQL where it can say the same."""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlift.llm import (
    bloom_urls,
    bpe_monoid,
    html_suffix,
    lang_nb,
    merkle_log,
    rp_forest,
    simhash,
    slot_negatives,
    stream_dedup,
    vector_pack,
    warc_index,
    weak_pii,
    weak_quality,
)
from adlift.session import configure

# The contract's rules (host, path, verdict) and SimHash parameters.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]
SHINGLE, DISTANCE = 3, 3
COSINE = 0.93
# Hosts whose canonical URLs make up the block list that the URL query applies.
LISTED_HOSTS = "casino|pills|xxx|warez"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_files() -> dict[str, str]:
    """Paths of the public vocabulary files; parameters of the token operators."""
    import public_tokenizers

    return {"json": public_tokenizers.path("byte_bpe_50k.json"), "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"),
            "multi": public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "pattern": public_tokenizers.PATTERN}


def op1_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_suffix.extract_main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op2_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc_index.archive_captures(table(spark, sf_dir, "pages"))
    return warc_index.resolve_revisits(index).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_quality.judge(table(spark, sf_dir, "documents"))


def pack(docs: DataFrame) -> DataFrame:
    f = tokenizer_files()
    return vector_pack.pack_documents(docs, f["json"], f["ranks"], f["pattern"])


def op4_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op5_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_dedup.judge(table(spark, sf_dir, "documents")).withColumnRenamed("digest", "text_sha256")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    host, _ = bloom_urls.split_url(F.col("url"))
    urls = bloom_urls.distinct_urls(pages)
    return bloom_urls.judge_urls(pages, rules, urls.where(host.rlike(LISTED_HOSTS)), urls)


def op7_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = weak_pii.find(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *[f"n_{k}" for k in weak_pii.BASE], F.sha2("base", 256).alias("base_sha256"), "spans")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(table(spark, sf_dir, "documents"), SHINGLE, DISTANCE)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = tokenizer_files()
    return bpe_monoid.round_trip_digests(table(spark, sf_dir, "documents"), f["multi"], f["pattern"])


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0).alias("held_out")
    model = lang_nb.train(docs.where(~held_out).select("lang", "text"))
    return lang_nb.classify(docs, model, held_out)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return slot_negatives.mine(rows, F.col("vec_id") % 50 == 0, noisy)


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp_forest.near_duplicates(table(spark, sf_dir, "embeddings"), COSINE)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_log.manifest(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = str(Path(__file__).resolve().parents[2])
    if root not in sys.path:
        sys.path.insert(0, root)
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_html_main_text, op2_warc_index, op3_quality_votes, op4_vector_packing, op5_stream_dedup, op6_url_filter,
    op7_pii_spans, op8_simhash, op9_bpe_round_trip, op10_language, op11_hard_negatives, op12_embedding_dedup,
    op13_merkle_manifest, pipeline)}

def _merkle_sql() -> str:
    """Levels by recursion; leaves and the roots of languages go through the same statements."""
    def field(c, more=""):
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode(CAST({c}{more} AS VARCHAR))) || ':' || CAST({c}{more} AS VARCHAR) END"

    def leaf(more):
        return "sha256(" + " || ".join(field(c, more if c == "n_chars" else "") for c in merkle_log.FIELDS) + ")"

    # DuckDB has no crc32: the reflected polynomial 0xEDB88320, bit by bit over the id's digits.
    crc = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
        lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
            lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END))"""

    def tree(name, source):
        return f"""
        {name}(g, lvl, j, n, h) AS (
          SELECT g, 0, i, n, h FROM {source}
          UNION ALL
          SELECT g, lvl + 1, j // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY j)) FROM {name} WHERE n > 1
          GROUP BY g, lvl, n, j // 2)"""

    def folded(name, source, tree):
        return f"""
        {name}(id, g, lvl, j, n, h) AS (
          SELECT id, g, 0, i, n, used FROM {source}
          UNION ALL
          SELECT f.id, f.g, f.lvl + 1, f.j // 2, (f.n + 1) // 2,
                 sha256(CASE WHEN x.h IS NULL THEN f.h WHEN f.j % 2 = 1 THEN x.h || f.h ELSE f.h || x.h END)
          FROM {name} f LEFT JOIN {tree} x ON x.g = f.g AND x.lvl = f.lvl AND x.j = xor(f.j, 1::BIGINT)
          WHERE f.n > 1)"""

    return f"""
        WITH RECURSIVE d AS (
          SELECT doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS g, {leaf("")} AS h,
                 CASE WHEN xor({crc}, 4294967295::BIGINT) % 7 = 0 THEN {leaf(" + 1")} ELSE {leaf("")} END AS used
          FROM documents),
        t AS (
          SELECT *, row_number() OVER () AS id, CAST(row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS BIGINT) AS i,
                 CAST(count(*) OVER (PARTITION BY g) AS BIGINT) AS n FROM d),
        {tree("nodes", "t")},
        s AS (
          SELECT '' AS g, g AS lang_key, h, CAST(row_number() OVER (ORDER BY g) - 1 AS BIGINT) AS i, CAST(count(*) OVER () AS BIGINT) AS n
          FROM nodes WHERE n = 1),
        {tree("tops", "s")},
        {folded("low", "t", "nodes")},
        lowest AS (SELECT low.id, '' AS g, s.i, s.n, low.h AS used FROM low JOIN s ON s.lang_key = low.g WHERE low.n = 1),
        {folded("high", "lowest", "tops")},
        sibs AS (
          SELECT t.id, x.lvl, x.h FROM t JOIN nodes x ON x.g = t.g AND x.j = xor(t.i >> x.lvl, 1::BIGINT)
          UNION ALL
          SELECT t.id, 100 + x.lvl, x.h FROM t JOIN s ON s.lang_key = t.g JOIN tops x ON x.j = xor(s.i >> x.lvl, 1::BIGINT)),
        proofs AS (SELECT id, sha256(string_agg(h, '' ORDER BY lvl)) AS proof_sha256 FROM sibs GROUP BY id)
        SELECT t.doc_id, t.h AS leaf, s.h AS subroot, r.h AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256,
               high.h AS folded_root, high.h = r.h AS verified
        FROM t JOIN s ON s.lang_key = t.g JOIN (SELECT h FROM tops WHERE n = 1) r ON true
        JOIN high ON high.id = t.id AND high.n = 1 LEFT JOIN proofs ON proofs.id = t.id"""


ORACLE: dict[str, str] = {
    "op2_warc_index": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha256(html) AS payload_digest FROM p),
        f AS (SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY 1)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN first_id IS NULL OR first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN first_id <> page_id THEN first_id END AS refers_to
        FROM d LEFT JOIN f USING (payload_digest)""",
    "op5_stream_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op6_url_filter": f"""
        WITH p AS (
          SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
          FROM pages),
        rules(rhost, rpath, rverdict) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
        listed AS (SELECT DISTINCT host || path AS u FROM p WHERE regexp_matches(host, '{LISTED_HOSTS}')),
        best AS (
          SELECT page_id, host, path, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
                 arg_max(rverdict, length(rhost || rpath)) AS verdict
          FROM p JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
          GROUP BY 1, 2, 3)
        SELECT p.page_id, p.host, p.path, best.rule,
               coalesce(best.verdict, CASE WHEN u IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
        FROM p LEFT JOIN best USING (page_id, host, path) LEFT JOIN listed ON p.host || p.path = u AND u <> ''""",
    "op11_hard_negatives": """
        WITH e AS (
          SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                 list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
          FROM embeddings
          WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
          SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_inner_product(a.q, r.q) AS BIGINT) AS score
          FROM e a JOIN e r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id),
        p AS (
          SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id,
               CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 3""",
    "op12_embedding_dedup": f"""
        WITH RECURSIVE v AS (
          SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
          WHERE label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        l AS (
          SELECT a.vec_id, b.vec_id AS other FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
          WHERE list_inner_product(a.v, b.v) / (sqrt(list_inner_product(a.v, a.v)) * sqrt(list_inner_product(b.v, b.v))) >= {COSINE}),
        reach(vec_id, other) AS (
          SELECT vec_id, vec_id FROM embeddings
          UNION SELECT reach.vec_id, l.other FROM reach JOIN l ON reach.other = l.vec_id),
        c AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id)
        SELECT e.vec_id, (SELECT count(*) FROM l WHERE l.vec_id = e.vec_id) AS n_links, c.component_id,
               e.vec_id = c.component_id AS kept
        FROM embeddings e JOIN c USING (vec_id)""",
    "op13_merkle_manifest": _merkle_sql(),
}

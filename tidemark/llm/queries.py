"""The operators as queries over the given tables, with the columns their contracts name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import byte_bpe, chunk_dedup, decontaminate, kmeans_tree, merkle, personal_data, quality, run_index, simhash, token_files, toxicity, warc, whitening
from tidemark.llm.shared import reachable, shared_folder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: DuckDB SQL where it can express a query; the others are held against brute force in ``tests/llm``.
SQL: dict[str, str] = {}


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        reachable(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of whole texts in seekable files, read back from them."""
    folder = shared_folder(spark, "token-files")
    manifest = token_files.write(table(sf_dir, "documents", spark), vocabulary("word_bpe_49k.json"), folder)
    return token_files.digests(manifest)


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of whole texts by matched clauses."""
    return toxicity.scores(table(sf_dir, "documents", spark), table(sf_dir, "labels", spark))


@query
def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in whole texts: fixed patterns and what the field adds."""
    return personal_data.find(table(sf_dir, "documents", spark))


@query
def op4_run_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without the 400-byte strings that stand elsewhere too; how much stands there in shorter ones."""
    found = run_index.dedup(table(sf_dir, "documents", spark))
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
        F.aggregate("repeated", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_repeated"),
    )


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of whole texts, learnt from positives and unlabelled text."""
    return quality.scores(table(sf_dir, "documents", spark), table(sf_dir, "labels", spark))


@query
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of whole texts by the rank file, and the bytes they decode to."""
    import public_tokenizers

    ranks, pattern = vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = byte_bpe.encode(table(sf_dir, "documents", spark), ranks, pattern)
    return byte_bpe.decode(encoded, ranks, pattern).select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op7_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its bytes in chunks that stand elsewhere too, what dedup removes of them, and what is left."""
    found = chunk_dedup.dedup(table(sf_dir, "documents", spark))
    return found.select(
        "doc_id", "n_repeated", "n_removed", F.size("spans").cast("long").alias("n_spans"), "n_bytes", F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of documents that match benchmark items within the error budget."""
    return decontaminate.matches(table(sf_dir, "documents", spark), table(sf_dir, "benchmark", spark))


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of three-word shingles, linked at two or fewer differing bits."""
    found = simhash.near_duplicates(table(sf_dir, "documents", spark))
    return found.select("doc_id", F.lpad(F.lower(F.hex("f0")), 16, "0").alias("fingerprint"), "component_id")


@query
def op10_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty nearest rows found for every twentieth vector."""
    return kmeans_tree.search(table(sf_dir, "embeddings", spark), every=20, k=20)


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors whitened by the components of their exact scatter."""
    return whitening.whiten(table(sf_dir, "embeddings", spark))


@query
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves, roots and proofs of all documents; a third of them tampered with."""
    return merkle.manifest(table(sf_dir, "documents", spark))


def _merkle_sql() -> str:
    def leaf(text: str) -> str:
        parts = [f"CAST({text if c == 'text' else c} AS VARCHAR)" for c in merkle.FIELDS]
        return "sha256(" + " || ".join(f"coalesce(strlen({p}) || ':' || {p}, '-')" for p in parts) + ")"

    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    # crc32 (reflected polynomial 0xEDB88320), bit by bit over the digits of doc_id
    shift = "list_reduce(list_concat([xor(c, ascii(d))], range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    digits = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))"
    crc = f"xor(list_reduce(list_concat([4294967295::BIGINT], {digits}), lambda c, d: {shift.replace('ascii(d)', 'd')}), 4294967295)"
    return f"""
WITH RECURSIVE d AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n,
    row_number() OVER (ORDER BY lang NULLS FIRST, doc_id NULLS FIRST, leaf) AS id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS k
  FROM (SELECT doc_id, lang, {leaf("text")} AS leaf,
    CASE WHEN {crc} % 3 = 0 THEN {leaf(f"translate(text, '{upper}', '{upper.lower()}')")} ELSE {leaf("text")} END AS altered FROM documents)
), up AS (
  SELECT k, 0 AS lvl, pos, n, leaf AS h FROM d
  UNION ALL
  SELECT k, lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY k, lvl, pos // 8, n
), sub AS (SELECT k, lvl AS height, h AS subroot, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (
  SELECT 0 AS lvl, k AS pos, n, subroot AS h FROM sub
  UNION ALL
  SELECT lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY lvl, pos // 8, n
), step AS (  -- siblings of every node on the way up, left and right
  SELECT a.k, a.lvl, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
    coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM up a JOIN up b ON a.k = b.k AND a.lvl = b.lvl AND a.pos // 8 = b.pos // 8 WHERE a.n > 1 GROUP BY a.k, a.lvl, a.pos
), topstep AS (
  SELECT a.lvl, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
    coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM top a JOIN top b ON a.lvl = b.lvl AND a.pos // 8 = b.pos // 8 WHERE a.n > 1 GROUP BY a.lvl, a.pos
), path AS (
  SELECT d.id, s.lvl, s.l, s.r FROM d JOIN step s ON s.k = d.k AND s.pos = d.pos // CAST(pow(8, s.lvl) AS BIGINT)
  UNION ALL
  SELECT d.id, s.height + t.lvl, t.l, t.r FROM d JOIN sub s ON s.k = d.k JOIN topstep t ON t.pos = d.k // CAST(pow(8, t.lvl) AS BIGINT)
), fold AS (
  SELECT id, 0 AS lvl, altered AS h FROM d
  UNION ALL
  SELECT f.id, f.lvl + 1, sha256(p.l || f.h || p.r) FROM fold f JOIN path p ON p.id = f.id AND p.lvl = f.lvl
), folded AS (SELECT id, arg_max(h, lvl) AS h FROM fold GROUP BY id),
proof AS (SELECT id, string_agg(l || r, '' ORDER BY lvl) AS p FROM path GROUP BY id)
SELECT d.doc_id, d.leaf, s.subroot, t.h AS root, sha256(coalesce(p.p, '')) AS proof_sha256, f.h AS folded_root, f.h = t.h AS verified
FROM d JOIN sub s ON s.k = d.k JOIN folded f ON f.id = d.id LEFT JOIN proof p ON p.id = d.id, (SELECT h FROM top WHERE n = 1) t
"""


SQL["op12_merkle"] = _merkle_sql()


@query
def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as they come back from web archives written for them."""
    found = warc.archived(table(sf_dir, "pages", spark))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL["op13_warc"] = f"""
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS html, row_number() OVER (PARTITION BY coalesce(html, '') ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST) AS place,
    first_value(page_id) OVER (PARTITION BY coalesce(html, '') ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST) AS top
  FROM pages
), r AS (SELECT *, CAST(strlen(html) AS BIGINT) AS payload_bytes, strlen(html) >= {warc.LEAST} AND place > 1 AS again FROM p)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN top END AS refers_to
FROM r
"""

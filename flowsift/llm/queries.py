"""Registered queries of the operators in this package: the columns asked for, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.llm import langid, pii, secrets, toxicity
from flowsift.llm.collocations import collocations, frequent_phrases, strongest, word_totals
from flowsift.llm.decontaminate import leaked_passages
from flowsift.llm.merkle import merkle_manifest, row_digest
from flowsift.llm.minhash import near_duplicates
from flowsift.llm.packing import Limits, pack_sequences
from flowsift.llm.substring import remove_repeated
from flowsift.llm.token_files import read_token_files, write_token_files
from flowsift.llm.topk import top_k
from flowsift.llm.warc import archive_round_trip
from flowsift.session import materialize, scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _span_digest(found: DataFrame, kinds: list[str], is_base: Callable[[Column], Column]) -> DataFrame:
    """Counts and digest of the base spans, and all spans as text."""
    base = F.filter("spans", is_base)
    of = lambda k: F.size(F.filter(base, lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    digest = F.sha2(secrets.span_text(base), 256).alias("base_sha256")
    return found.select("doc_id", *[of(k) for k in kinds], digest, secrets.span_text(F.col("spans")).alias("spans"))


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), k=3, percent=85)


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return _span_digest(pii.find_personal_data(docs, pii.train_pii_model(docs)), pii.KINDS, lambda x: ~x["added"])


def op3_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaked_passages(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = langid.identify(docs.select("doc_id", "text"), langid.train_language_model(docs))
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op6_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = archive_round_trip(_table(spark, sf_dir, "pages"))
    told = materialize(captures.select("capture_id", "page_id", "response"), "captures")
    first = told.where("response.type = 'response'").select(F.col("capture_id").alias("refers_id"), F.col("page_id").alias("refers_to"))
    wanted = told.withColumn("refers_id", F.col("response.refers_to"))
    return wanted.join(first, "refers_id", "left").select(
        "page_id",
        "response.payload_bytes",
        "response.payload_digest",
        F.col("response.type").alias("record_type"),
        "refers_to",
    )


def op7_toxic_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score_severity(docs, toxicity.train_severity_model(docs, _table(spark, sf_dir, "labels")))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated(_table(spark, sf_dir, "documents"), window=35)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_digest(secrets.find_secrets(_table(spark, sf_dir, "documents")), secrets.BASE, lambda x: x["kind"].isin(secrets.BASE))


def op10_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_sequences(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), limits=Limits(4096, 512, 4096))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    with_text = lambda text: row_digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], text)
    leaf = with_text(F.col("text"))
    tampered = with_text(F.replace("text", F.lit("\n"), F.lit("")))
    claim = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, tampered).otherwise(leaf)
    proofs = merkle_manifest(docs, "doc_id", "source", leaf, claim)
    return proofs.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = collocations(frequent_phrases(docs, longest=5, least=100), word_totals(docs))
    ranked = strongest(scored, 2000)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    write_token_files(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_minhash_near_dedup,
        op2_personal_data,
        op3_benchmark_leaks,
        op4_exact_top_k,
        op5_language_id,
        op6_warc_transactions,
        op7_toxic_severity,
        op8_substring_dedup,
        op9_secret_scan,
        op10_vector_packing,
        op11_merkle_manifest,
        op12_phrase_collocations,
        op13_token_files,
    )
}
ORACLES = {
    "op4_exact_top_k": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
          WHERE vec_id IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
          SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.v, v.v)::BIGINT AS score
          FROM (SELECT * FROM v WHERE vec_id % 20 = 0) q JOIN v ON q.vec_id <> v.vec_id AND len(q.v) = len(v.v)
        )
        SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
        FROM s QUALIFY rank <= 20""",
    "op6_warc_transactions": """
        WITH p AS (
          SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages
        ), g AS (
          SELECT *, max(page_id) OVER (PARTITION BY n, d) AS top,
                 row_number() OVER (PARTITION BY n, d ORDER BY page_id DESC NULLS LAST) > 1 AS again
          FROM p
        )
        SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
               CASE WHEN n >= 1000 AND top IS NOT NULL AND again THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND top IS NOT NULL AND again THEN top END AS refers_to
        FROM g""",
    "op11_merkle_manifest": r"""
        WITH RECURSIVE field_texts AS (
          SELECT doc_id, source, CAST(doc_id AS VARCHAR) AS a, source AS b, lang AS c, CAST(n_chars AS VARCHAR) AS d, text AS e,
                 list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
                   lambda crc, x: list_reduce(list_prepend(xor(crc, x), [0::UBIGINT, 1, 2, 3, 4, 5, 6, 7]),
                     lambda v, _: xor(v >> 1, (v & 1) * 3988292384::UBIGINT))) & 1 = 1 AS is_even,
          FROM documents
        ), rows AS (
          SELECT doc_id, source,
                 coalesce(strlen(a) || ':' || a, '-') || coalesce(strlen(b) || ':' || b, '-') || coalesce(strlen(c) || ':' || c, '-')
                   || coalesce(strlen(d) || ':' || d, '-') AS head,
                 e, CASE WHEN is_even THEN replace(e, chr(10), '') ELSE e END AS t
          FROM field_texts
        ), leaves AS (
          SELECT doc_id, source, sha256(head || coalesce(strlen(e) || ':' || e, '-')) AS leaf,
                 sha256(head || coalesce(strlen(t) || ':' || t, '-')) AS claim
          FROM rows
        ), placed AS (
          SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves
        ), lower_nodes(source, level, pos, h, n) AS (
          SELECT source, 0, pos, leaf, count(*) OVER (PARTITION BY source) FROM placed
          UNION ALL
          SELECT source, any_value(level) + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), any_value(n + 2) // 3
          FROM lower_nodes WHERE n > 1 GROUP BY source, pos // 3
        ), subroots AS (
          SELECT source, h AS subroot, level AS height, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
          FROM lower_nodes WHERE n = 1
        ), upper_nodes(level, pos, h, n) AS (
          SELECT 0, pos, subroot, n FROM subroots
          UNION ALL
          SELECT any_value(level) + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), any_value(n + 2) // 3
          FROM upper_nodes WHERE n > 1 GROUP BY pos // 3
        ), upper_path AS (
          SELECT s.source, list({'l': b.l, 'r': b.r} ORDER BY u.level) AS path
          FROM subroots s JOIN upper_nodes u ON u.n > 1 AND u.pos = s.pos // (3 ** u.level)::BIGINT,
          LATERAL (SELECT coalesce(string_agg(x.h, '' ORDER BY x.pos) FILTER (x.pos < u.pos), '') AS l,
                          coalesce(string_agg(x.h, '' ORDER BY x.pos) FILTER (x.pos > u.pos), '') AS r
                   FROM upper_nodes x WHERE x.level = u.level AND x.pos // 3 = u.pos // 3) b
          GROUP BY s.source
        ), lower_sides AS (
          SELECT u.source, u.level, u.pos,
                 coalesce(string_agg(x.h, '' ORDER BY x.pos) FILTER (x.pos < u.pos), '') AS l,
                 coalesce(string_agg(x.h, '' ORDER BY x.pos) FILTER (x.pos > u.pos), '') AS r
          FROM lower_nodes u JOIN lower_nodes x ON x.source IS NOT DISTINCT FROM u.source AND x.level = u.level AND x.pos // 3 = u.pos // 3
          WHERE u.n > 1 GROUP BY u.source, u.level, u.pos
        ), lower_path AS (
          SELECT p.source, p.pos, list({'l': b.l, 'r': b.r} ORDER BY b.level) AS path
          FROM placed p JOIN lower_sides b ON b.source IS NOT DISTINCT FROM p.source AND b.pos = p.pos // (3 ** b.level)::BIGINT
          GROUP BY p.source, p.pos
        ), paths AS (
          SELECT p.doc_id, p.leaf, p.claim, s.subroot, (SELECT h FROM upper_nodes WHERE n = 1) AS root,
                 list_concat(coalesce(lp.path, []), coalesce(up.path, [])) AS path
          FROM placed p JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source
          LEFT JOIN lower_path lp ON lp.source IS NOT DISTINCT FROM p.source AND lp.pos = p.pos
          LEFT JOIN upper_path up ON up.source IS NOT DISTINCT FROM p.source
        ), folded AS (
          SELECT doc_id, leaf, subroot, root, sha256(coalesce(list_reduce(list_prepend('', list_transform(path, lambda p: p.l || p.r)), lambda x, y: x || y), '')) AS proof_sha256,
                 list_reduce(list_prepend(claim, list_transform(path, lambda p: p.l || ' ' || p.r)),
                   lambda x, y: sha256(split_part(y, ' ', 1) || x || split_part(y, ' ', 2))) AS folded_root
          FROM paths
        )
        SELECT *, folded_root = root AS verified FROM folded""",
    "op12_phrase_collocations": r"""
        WITH pieces AS (
          SELECT coalesce(lang, 'und') AS lang,
                 unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
          FROM documents
        ), cut AS (
          SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
        ), totals AS (
          SELECT lang, sum(len(w))::BIGINT AS n FROM cut GROUP BY lang
        ), occurrences AS (
          SELECT lang, k.words, w, unnest(range(1, (len(w) - k.words + 2)::BIGINT)) AS i FROM cut, (SELECT unnest([1, 2, 3, 4, 5]) AS words) k
          WHERE len(w) >= k.words
        ), f AS (
          SELECT lang, words, array_to_string(w[i:i + words - 1], ' ') AS phrase, count(*) AS f FROM occurrences GROUP BY ALL HAVING count(*) >= 100
        ), c AS (
          SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE words > 1
        ), cuts AS (
          SELECT c.*, unnest(range(1, words)) AS k FROM c
        ), scored AS (
          SELECT cuts.lang, cuts.phrase, words, a, k, x.f AS l, y.f AS r, n, (a::HUGEINT * n * 1000 // (x.f::HUGEINT * y.f))::BIGINT AS score
          FROM cuts JOIN totals USING (lang)
          JOIN (SELECT lang, phrase, f FROM f) x ON x.lang = cuts.lang AND x.phrase = array_to_string(w[1:k], ' ')
          JOIN (SELECT lang, phrase, f FROM f) y ON y.lang = cuts.lang AND y.phrase = array_to_string(w[k + 1:], ' ')
        ), best AS (
          SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ), inner_parts AS (
          SELECT lang, a, unnest(list_transform(range(0, 25), lambda i: CASE WHEN i // 5 + i % 5 < words AND i % 5 < words - 1
                   THEN array_to_string(w[i // 5 + 1:i // 5 + 1 + i % 5], ' ') END)) AS phrase
          FROM c
        ), around AS (
          SELECT lang, phrase, max(a) AS widest FROM inner_parts WHERE phrase IS NOT NULL GROUP BY lang, phrase
        ), kept AS (
          SELECT b.* FROM best b LEFT JOIN around o ON o.lang = b.lang AND o.phrase = b.phrase WHERE widest IS NULL OR 100 * widest < 100 * a
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM kept QUALIFY rank <= 2000""",
}

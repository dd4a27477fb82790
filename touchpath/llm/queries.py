"""One query per operator: it reads its whole tables, applies the operator and derives the digest columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchpath.llm import common, exact_dedup, filter_audit, langid, lexical_packing, minhash, mixing, packing, passage_dedup, pii, secret_scan, spotsigs, suffix_dedup, whitening


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_duplicates(common.documents(spark, sf_dir, "doc_id", "text"))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op8_suffix_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.drop_repeated_bytes(common.documents(spark, sf_dir, "doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir, "doc_id", "source", "text")
    sized = common.stash(docs.select("doc_id", "source", common.count_words("text").alias("size")), "sized")
    out = mixing.mix(sized)
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack_documents(common.documents(spark, sf_dir, "doc_id", "text"))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op1_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.beside_next(common.documents(spark, sf_dir, "doc_id", "text"))


def op2_automaton_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = passage_dedup.drop_repeated_passages(common.documents(spark, sf_dir, "doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir, "doc_id", "text", "lang")
    out = langid.identify(docs.select("doc_id", "text"), langid.fit(docs))
    return out.select("doc_id", (~langid.learns(F.col("doc_id"))).alias("held_out"), "lang_pred", "score", "rejected")


def op4_minhash_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = minhash.link_components(common.documents(spark, sf_dir, "doc_id", "text"), shingle_words=2)
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


#: Stands for the caller's secret in the registered query.
PSEUDONYM_KEY = "registered-query"


def op5_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(common.documents(spark, sf_dir, "doc_id", "text"), PSEUDONYM_KEY)


def op6_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir, "doc_id", "text", "source")
    out = secret_scan.scan(docs.select("doc_id", "text", F.col("doc_id").alias("repository"), F.col("source").alias("owner")))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(secret_scan.written(F.col("base")), 256).alias("base_sha256"),
                      secret_scan.written(F.col("all")).alias("spans"), "n_live", "n_examples")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir, "doc_id", "text", "source").withColumnRenamed("source", "part")
    return filter_audit.audit_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_packing.pack_documents(common.documents(spark, sf_dir, "doc_id", "text"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"), "embedding")
    each = out.select("row.vec_id", "n", F.col("deviation").cast("long").alias("deviation"), "identity_error", "explained",
                      F.posexplode("whitened").alias("at", "whitened"))
    return each.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened", F.get("explained", F.col("at")).alias("explained"), "identity_error")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_spotsigs, op2_automaton_passages, op3_language_id, op4_minhash_hamming, op5_feistel_pseudonyms, op6_secret_ownership, op7_best_fit_packing, op8_suffix_sort, op9_entropy_mixing, op10_exact_dedup,
                              op11_filter_audit, op12_lexical_packing, op13_whitening)
}

ORACLES: dict[str, str] = {
    "op2_automaton_passages": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        starts AS (SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS h
                   FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 49)) AS i FROM w)),
        found AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS first_doc FROM starts) WHERE doc_id > first_doc),
        pos AS (SELECT doc_id, unnest(generate_series(1, len(words))) AS i, unnest(words) AS word FROM w),
        marked AS (SELECT pos.doc_id, pos.i, word,
                          count(found.i) OVER (PARTITION BY pos.doc_id ORDER BY pos.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) > 0 AS gone
                   FROM pos LEFT JOIN found ON pos.doc_id = found.doc_id AND pos.i = found.i),
        per AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept
                FROM marked GROUP BY doc_id)
        SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM w LEFT JOIN per ON w.doc_id = per.doc_id
    """,
    "op4_minhash_hamming": r"""
        WITH RECURSIVE w AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x20\x09-\x0D]+') AS words FROM documents),
        shingles AS (
          SELECT DISTINCT doc_id, words[i] || ' ' || words[i + 1] AS s
          FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 1)) AS i FROM w)
          UNION ALL SELECT doc_id, words[1] FROM w WHERE len(words) = 1),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        links AS (
          SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL)
          JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
        edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach(node, goal) AS (SELECT DISTINCT a, a FROM edges UNION SELECT reach.node, edges.b FROM reach JOIN edges ON reach.goal = edges.a),
        least AS (SELECT node, min(goal) AS component_id FROM reach GROUP BY node)
        SELECT w.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, w.doc_id) AS component_id,
               coalesce(component_id, w.doc_id) = w.doc_id AS kept
        FROM w LEFT JOIN sizes ON w.doc_id = sizes.doc_id LEFT JOIN least ON w.doc_id = least.node
    """,
    "op8_suffix_sort": r"""
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
        starts AS (SELECT doc_id, i, md5(substring(x, 2 * i - 1, 400)) AS h
                   FROM (SELECT doc_id, x, unnest(generate_series(1, len(x) // 2 - 199)) AS i FROM d)),
        found AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY h) AS n FROM starts) WHERE n > 1),
        pos AS (SELECT doc_id, i, substring(x, 2 * i - 1, 2) AS b FROM (SELECT doc_id, x, unnest(generate_series(1, len(x) // 2)) AS i FROM d)),
        marked AS (SELECT pos.doc_id, pos.i, b,
                          count(found.i) OVER (PARTITION BY pos.doc_id ORDER BY pos.i ROWS BETWEEN 199 PRECEDING AND CURRENT ROW) > 0 AS gone
                   FROM pos LEFT JOIN found ON pos.doc_id = found.doc_id AND pos.i = found.i),
        edged AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM marked),
        per AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE opens) AS n_spans,
                       string_agg(b, '' ORDER BY i) FILTER (WHERE NOT gone) AS kept
                FROM edged GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(kept, ''))) AS kept_sha256
        FROM d LEFT JOIN per ON d.doc_id = per.doc_id
    """,
    "op10_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, d AS text_sha256
        FROM (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS d
              FROM documents)
        WINDOW g AS (PARTITION BY d)
    """,
    "op11_filter_audit": r"""
        WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS x FROM documents),
        w AS (SELECT *, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY x) AS first FROM t),
        l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
        f AS (SELECT part, [len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words),
                            100 * len(regexp_replace(x, '[^A-Z]', '', 'g')) > 5 * len(x), regexp_matches(x, '[#$%&*|]'),
                            coalesce(w.doc_id > first, false)] AS fails,
                     coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
              FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
        c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM f GROUP BY ALL),
        k AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
        orders AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM k a, k b, k c, k d, k e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
        runs AS (SELECT c.*, o, list_position(list_transform(o, lambda i: fails[i]), true) AS gone FROM c, orders),
        steps AS (SELECT part, o, step,
                         sum(n) FILTER (WHERE gone IS NULL OR gone > step) AS kept, sum(n) FILTER (WHERE gone = step) AS removed,
                         sum(n) FILTER (WHERE gone < step AND fails[o[step]]) AS redundant,
                         sum(n) FILTER (WHERE fails[o[step]] AND len(list_filter(fails, lambda v: v)) = 1) AS unique_fails,
                         sum(good) FILTER (WHERE gone = step) AS good_lost, sum(toxic) FILTER (WHERE gone = step) AS toxic_lost
                  FROM runs, (SELECT i AS step FROM k) GROUP BY part, o, step)
        SELECT part, array_to_string(list_transform(o, lambda i: substr('ABCDE', i, 1)), '') AS filter_order, step,
               coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
               coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
               (sum(coalesce(removed, 0)) OVER (PARTITION BY part, o[step]))::BIGINT AS shapley
        FROM steps
    """,
}

"""The queries of this subpackage: one ``opN_<name>`` for each operator, run
with production parameters over its whole table, and DuckDB SQL for those
that SQL expresses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, langid, mixing, packing, perplexity, quality, sharding, simhash, substring, tokenfile, topk, variants, warc
from .common import scratch_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return add


_WORDS = r"coalesce(regexp_extract_all(text, '[^ \t\n\x0B\f\r]+'), []::VARCHAR[])"


_QUALITY = rf"""WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS t, {_WORDS} AS ws FROM documents),
    f AS (SELECT doc_id, lang, ws, len(ws)::BIGINT AS n_words, coalesce(length(array_to_string(ws, '')), 0)::BIGINT AS word_chars, length(t) AS chars,
                 len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(regexp_extract_all(t, '\p{{Lu}}')) AS upper,
                 len(regexp_extract_all(t, '[0-9]')) AS digits,
                 len(regexp_extract_all(t, '[!\x22\x27()+,\-./:;=?@\[\\\]^_`{{}}~]')) AS punct,
                 list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS lines FROM d),
    v AS (SELECT doc_id, unnest(list_transform(generate_series(1, len(ws) - 4), lambda i: {{'i': i, 'k': array_to_string(ws[i:i + 4], ' ')}})) AS s
          FROM d WHERE len(ws) >= 5),
    twice AS (SELECT doc_id, s.k AS k FROM v GROUP BY 1, 2 HAVING count(*) > 1),
    rep AS (SELECT doc_id, count(DISTINCT i + j)::BIGINT AS n FROM (SELECT v.doc_id, v.s.i AS i FROM v JOIN twice t ON t.doc_id = v.doc_id AND t.k = v.s.k),
            (SELECT unnest(range(5)) AS j) GROUP BY doc_id),
    tok AS (SELECT doc_id, lang, unnest(ws) AS word FROM d),
    common AS (SELECT * FROM (SELECT lang, lower(word) AS word, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, lower(word)) AS k
               FROM tok GROUP BY 1, 2) WHERE k <= 24),
    hit AS (SELECT doc_id, k, count(*) AS n FROM tok JOIN common c ON c.lang = tok.lang AND c.word = lower(tok.word) GROUP BY 1, 2),
    bins AS (SELECT doc_id, k, n FROM hit UNION ALL
             SELECT f.doc_id, 25, n_words - coalesce(h.n, 0) FROM f LEFT JOIN (SELECT doc_id, sum(n) AS n FROM hit GROUP BY 1) h ON h.doc_id = f.doc_id),
    cls AS (SELECT doc_id, lang, unnest([n_symbols, upper, digits, punct, chars - word_chars, word_chars - n_symbols - upper - digits - punct]) AS n,
                   unnest([1, 2, 3, 4, 5, 6]) AS k FROM f),
    every AS (SELECT 'word' AS kind, f.doc_id, f.lang, g.k, coalesce(b.n, 0) AS n FROM f CROSS JOIN (SELECT unnest(range(1, 26)) AS k) g
              LEFT JOIN bins b ON b.doc_id = f.doc_id AND b.k = g.k UNION ALL SELECT 'char', doc_id, lang, k, n FROM cls),
    ref AS (SELECT kind, lang, k, sum(n)::DOUBLE / nullif(sum(sum(n)) OVER (PARTITION BY kind, lang), 0) AS q FROM every GROUP BY 1, 2, 3),
    pq AS (SELECT e.kind, e.doc_id, coalesce(e.n::DOUBLE / nullif(sum(e.n) OVER (PARTITION BY e.kind, e.doc_id), 0), 0) AS p, coalesce(q, 0) AS q
           FROM every e JOIN ref r ON r.kind = e.kind AND r.lang = e.lang AND r.k = e.k),
    js AS (SELECT doc_id, kind, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
                  + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2, 0)) AS dist FROM pq GROUP BY 1, 2),
    rules AS (SELECT f.doc_id, n_words, word_chars, n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
                 coalesce(rep.n, 0)::BIGINT AS n_repeat_words, n_words < 10 OR 100 * coalesce(rep.n, 0) > 20 * n_words AS base_failed,
                 (chars >= 200 AND c.dist > 0.25) OR (n_words >= 50 AND w.dist > 0.45) AS strange
          FROM f LEFT JOIN rep ON rep.doc_id = f.doc_id JOIN js c ON c.doc_id = f.doc_id AND c.kind = 'char' JOIN js w ON w.doc_id = f.doc_id AND w.kind = 'word')"""


@_query(
    "op1_distribution_divergence",
    f"""{_QUALITY}
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT strange AS kept FROM rules""",
)
def op1_distribution_divergence(spark, sf_dir):
    found = quality.judged(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@_query("op2_warc")
def op2_warc(spark, sf_dir):
    path = scratch_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    return warc.page_index(warc.read(spark, path, with_payload=False))


@_query("op3_kneser_ney")
def op3_kneser_ney(spark, sf_dir):
    """Trusted are the documents that are labelled of good quality and not toxic."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    trusted = table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0").select("doc_id")
    return perplexity.classify(docs, trusted, folds=perplexity.FOLDS).withColumnRenamed("id", "doc_id")


@_query(
    "op4_poisson_mixing",
    """WITH RECURSIVE s AS (SELECT coalesce(source, '') AS source, sum(coalesce(length(text), 0))::DOUBLE AS size FROM documents GROUP BY 1),
        r AS (SELECT source, sqrt(size) / (SELECT sum(sqrt(size)) FROM s) * (SELECT sum(size) FROM s) / nullif(size, 0) AS rate FROM s),
        pmf(source, rate, k, logp) AS (SELECT source, rate, 0, -rate FROM r WHERE rate > 0 UNION ALL
            SELECT source, rate, k + 1, logp + ln(rate / (k + 1)) FROM pmf WHERE k < ceil(rate + 12 * sqrt(rate) + 40)),
        cdf AS (SELECT source, k, sum(exp(logp)) OVER (PARTITION BY source ORDER BY k ROWS UNBOUNDED PRECEDING) AS c FROM pmf),
        u AS (SELECT *, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, '')) || '|1'), 1, 13))::BIGINT / 4503599627370496.0 AS draw
              FROM documents),
        n AS (SELECT u.doc_id, u.source, u.text, CASE WHEN r.rate IS NULL THEN 1 ELSE
                     (SELECT count(*) FROM cdf WHERE cdf.source = coalesce(u.source, '') AND cdf.c <= u.draw) END AS n
              FROM u JOIN r ON r.source = coalesce(u.source, ''))
        SELECT doc_id, source, text, unnest(generate_series(1, n))::INTEGER AS copy FROM n WHERE n > 0""",
)
def op4_poisson_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.replicated(docs).select("doc_id", "source", "text", "copy")


@_query(
    "op5_pivot_topk",
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
                  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
                    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, o.vec_id, list_sum(list_transform(list_zip(q.v, o.v), lambda p: p[1] * p[2]))::BIGINT AS score
              FROM v q JOIN v o ON q.vec_id % 50 = 0 AND q.vec_id <> o.vec_id),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
)
def op5_pivot_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.search(vectors, vectors.where("vec_id % 50 = 0"))


@_query("op6_best_fit_packing")
def op6_best_fit_packing(spark, sf_dir):
    return packing.packed(table(spark, sf_dir, "documents").select("doc_id", "text"))


@_query("op7_language_id")
def op7_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", langid.held_out(F.col("doc_id")).alias("held_out"))
    model = langid.learn(docs.where("NOT held_out"))
    return langid.predict(docs, model, ["doc_id", "held_out"])


@_query("op8_token_file")
def op8_token_file(spark, sf_dir):
    path = scratch_path(spark, "token-file")
    tokenfile.write(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return tokenfile.read(spark, path).withColumnRenamed("id", "doc_id")


@_query(
    "op9_substring_dedup",
    f"""WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
        p AS (SELECT doc_id, unnest(list_transform(generate_series(1, len(ws) - 12),
                     lambda i: {{'i': i, 'k': array_to_string(ws[i:i + 12], ' ')}})) AS s FROM w WHERE len(ws) >= 13),
        m AS (SELECT s.k AS k, min(doc_id) AS lo FROM p GROUP BY 1),
        r AS (SELECT p.doc_id, p.s.i AS i FROM p JOIN m ON p.s.k = m.k WHERE p.doc_id > m.lo),
        c AS (SELECT DISTINCT doc_id, i + j AS pos FROM r, (SELECT unnest(range(13)) AS j)),
        t AS (SELECT doc_id, generate_subscripts(ws, 1) AS pos, unnest(ws) AS word FROM w),
        k AS (SELECT t.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY t.pos) AS kept
              FROM t LEFT JOIN c ON c.doc_id = t.doc_id AND c.pos = t.pos WHERE c.pos IS NULL GROUP BY t.doc_id)
        SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM w LEFT JOIN k ON k.doc_id = w.doc_id""",
)
def op9_substring_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.remove_repeated(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


@_query("op10_simhash_dedup")
def op10_simhash_dedup(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), simhash.hexadecimal(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id"))


@_query("op11_spelling_variants")
def op11_spelling_variants(spark, sf_dir):
    """Of the runs of the documents, about one in 199 is misspelled first."""
    words = variants.vocabulary(table(spark, sf_dir, "documents").select("doc_id", "text"), one_in=199)
    return variants.grouped(words).select("word", "form", "root", "n", "n_near", "form_n")


@_query("op12_hash_tree_shards")
def op12_hash_tree_shards(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = sharding.placed(docs, sharding.even_tree(16), sharding.even_tree(17), columns=["doc_id"])
    return found.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def _clustering_sql() -> str:
    """Ten rounds and the last assignment, written out. A centroid is one row for
    each component; an empty cluster keeps its components."""
    assign = """SELECT vec_id, cluster, distance FROM (
                    SELECT v.row, v.vec_id, c.cluster, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS distance,
                           row_number() OVER (PARTITION BY v.row ORDER BY sum((v.x - c.x) * (v.x - c.x)), c.cluster) AS k
                    FROM parts v JOIN {0} c ON c.d = v.d GROUP BY v.row, v.vec_id, c.cluster) WHERE k = 1"""
    sql = """WITH v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
                  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        parts AS MATERIALIZED (SELECT row, vec_id, unnest(generate_series(1, 64)) AS d, unnest(v) AS x FROM v),
        c0 AS MATERIALIZED (SELECT cluster, unnest(generate_series(1, 64)) AS d, unnest(v) AS x FROM (
              SELECT v, (row_number() OVER (ORDER BY sha256('3:' || vec_id::VARCHAR), v) - 1)::INTEGER AS cluster FROM v) WHERE cluster < 8)"""
    for k in range(10):
        sql += f""",
        a{k} AS MATERIALIZED ({assign.format(f"c{k}").replace("SELECT vec_id, cluster, distance", "SELECT row, cluster", 1)}),
        c{k + 1} AS MATERIALIZED (SELECT c.cluster, c.d, coalesce(n.x, c.x) AS x FROM c{k} c LEFT JOIN (
              SELECT a.cluster, p.d, ((sum(p.x) - ((sum(p.x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS x
              FROM a{k} a JOIN parts p ON p.row = a.row GROUP BY 1, 2) n ON n.cluster = c.cluster AND n.d = c.d)"""
    return f"""{sql},
        a AS MATERIALIZED ({assign.format("c10")}),
        told AS (SELECT cluster, sha256(string_agg(x::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM c10 GROUP BY 1)
        SELECT vec_id, a.cluster, distance, (sum(distance) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia,
               (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256 FROM a JOIN told ON told.cluster = a.cluster"""


@_query("op13_centroid_tables", _clustering_sql())
def op13_centroid_tables(spark, sf_dir):
    return centroids.clustered(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")).withColumnRenamed("id", "vec_id")

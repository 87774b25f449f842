"""Registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from keyweave.llm import context_mixing, quality, toxicity
from keyweave.llm.embedding_lsh import near_vectors
from keyweave.llm.exact_dedup import exact_duplicates
from keyweave.llm.fill_middle import fill_in_middle, restored
from keyweave.llm.line_dedup import drop_recurring_lines
from keyweave.llm.minhash import near_duplicates
from keyweave.llm.mixing import Targets, mixture
from keyweave.llm.packing import pack_documents
from keyweave.llm.pii_crf import personal_data
from keyweave.llm.token_counts import token_counts
from keyweave.llm.wht_clustering import centroid_clusters

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
COUNTING_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
TOKEN_LIMIT = 512
#: Shares of the kept tokens that mixing aims at: every source alike.
TARGETS = Targets(source={f"src{i}": 1.0 for i in range(20)}, lang={"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15},
                  topic={"prose": 0.85, "contact": 0.05, "legal": 0.05, "table": 0.05})
KEEP = 0.5


def _read(spark, d, table):
    return spark.read.parquet(f"{d}/{table}.parquet")


def op1_exact_dedup(spark, d):
    return exact_duplicates(_read(spark, d, "documents"))


def op2_toxicity(spark, d):
    docs, fold = _read(spark, d, "documents"), toxicity.held_out(F.col("doc_id"))
    return toxicity.scored(docs, toxicity.train(docs, _read(spark, d, "labels"), learn_from=~fold), fold)


def op3_packing(spark, d):
    return pack_documents(_read(spark, d, "documents"), TOKENIZER, with_ids=False)


def op4_pii(spark, d):
    return personal_data(_read(spark, d, "documents"))


def op5_line_dedup(spark, d):
    return drop_recurring_lines(_read(spark, d, "documents").select("doc_id", "text"))


def op6_minhash(spark, d):
    return near_duplicates(_read(spark, d, "documents"), width=3, threshold=85)


def op7_context_mixing(spark, d):
    return context_mixing.scored(_read(spark, d, "documents"), context_mixing.held_out(F.col("doc_id")))


def op8_quality(spark, d):
    return quality.quality_scores(_read(spark, d, "documents"), _read(spark, d, "labels"), quality.held_out(F.col("doc_id")))


def op9_embedding_lsh(spark, d):
    return near_vectors(_read(spark, d, "embeddings"), cosine=0.95)


def op10_mixing(spark, d):
    return mixture(_read(spark, d, "documents"), TARGETS, KEEP)


def op11_token_counts(spark, d):
    return token_counts(_read(spark, d, "documents"), COUNTING_TOKENIZER).withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op12_wht_clustering(spark, d):
    found = centroid_clusters(_read(spark, d, "embeddings"))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2(F.concat_ws(",", "centroid"), 256).alias("centroid_sha256"))


def op13_fill_in_middle(spark, d):
    made = fill_in_middle(_read(spark, d, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_packing": op3_packing,
    "op4_pii": op4_pii,
    "op5_line_dedup": op5_line_dedup,
    "op6_minhash": op6_minhash,
    "op7_context_mixing": op7_context_mixing,
    "op8_quality": op8_quality,
    "op9_embedding_lsh": op9_embedding_lsh,
    "op10_mixing": op10_mixing,
    "op11_token_counts": op11_token_counts,
    "op12_wht_clustering": op12_wht_clustering,
    "op13_fill_in_middle": op13_fill_in_middle,
}


def _clustering_sql(rounds: int = 10) -> str:
    """Lloyd's rounds one after another: distances of every vector to the list of centroids, then means by component."""
    def assigned(k: int) -> str:
        return f"""a{k} AS MATERIALIZED (SELECT vec_id, e, CAST(list_position(d, list_min(d)) - 1 AS INTEGER) AS cluster, CAST(list_min(d) AS BIGINT) AS distance FROM (
            SELECT vec_id, e, list_transform((SELECT list(e ORDER BY c) FROM c{k}), lambda q: list_sum(list_transform(range(1, 65),
            lambda i: (e[i] - q[i]) * (e[i] - q[i])))) AS d FROM v))"""

    parts = ["""v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
             """c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c, e FROM (SELECT * FROM v ORDER BY sha256('3:' || vec_id) LIMIT 8))"""]
    for k in range(rounds):
        parts += [assigned(k), f"""m{k} AS (SELECT cluster, list(x ORDER BY i) AS e FROM (SELECT cluster, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS x FROM (
            SELECT cluster, i, sum(x) AS s, count(*) AS n FROM (SELECT cluster, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM a{k}) GROUP BY ALL)) GROUP BY cluster)""",
                  f"c{k + 1} AS MATERIALIZED (SELECT c, coalesce(m.e, o.e) AS e FROM c{k} o LEFT JOIN m{k} m ON m.cluster = o.c)"]
    return f"""WITH {", ".join([*parts, assigned(rounds)])}
        SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
            sha256(array_to_string(c.e, ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} c ON c.c = cluster"""


SQL = {
    "op1_exact_dedup": """SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
            doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op5_line_dedup": r"""WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM documents),
        words AS (SELECT doc_id, line, list_filter(regexp_split_to_array(raw, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM lines),
        marked AS (SELECT *, len(w) AS n, list_transform(w, lambda x: regexp_matches(x, '[0-9@]|://')) AS v FROM words WHERE len(w) > 0),
        tokens AS (SELECT *, len(list_filter(v, lambda x: x)) AS k, list_transform(range(1, n + 1), lambda i: CASE WHEN v[i] THEN '<*>' ELSE w[i] END) AS t FROM marked),
        cut AS (SELECT doc_id, line, size AS n, 1 AS m, [whole] AS lead, [whole] AS pieces, [size] AS consts FROM (
                SELECT *, CASE WHEN n < 3 AND strlen(whole) >= 64 THEN 10 ELSE n END AS size FROM (
                SELECT *, array_to_string(w, ' ') AS whole FROM tokens WHERE n < 3 OR k > 0 AND n - k < 0.7::DOUBLE * n))
            UNION ALL SELECT doc_id, line, n, least(n, 8) AS m, t[1:3] AS lead,
            list_transform(range(0, least(n, 8)), lambda i: array_to_string(t[i * n // least(n, 8) + 1 : (i + 1) * n // least(n, 8)], ' ')) AS pieces,
            CASE WHEN k > 0 THEN list_transform(range(0, least(n, 8)), lambda i: len(list_filter(v[i * n // least(n, 8) + 1 : (i + 1) * n // least(n, 8)], lambda x: NOT x))) END AS consts
            FROM tokens WHERE n >= 3 AND (k = 0 OR n - k >= 0.7::DOUBLE * n)),
        least AS (SELECT greatest(5, CAST(ceil(0.01::DOUBLE * count(*)) AS BIGINT)) AS bare FROM documents),
        kinds AS (SELECT n, m, lead, pieces, min(consts) AS consts, count(DISTINCT doc_id) AS docs, min(doc_id) AS low, max(doc_id) AS high, min(row(doc_id, line)) AS first, list(DISTINCT doc_id) AS ids
            FROM cut GROUP BY n, m, lead, pieces),
        pairs AS (SELECT *, pieces[place + 1 : place + 2] AS pair FROM (SELECT *, unnest(range(0, m, 2)) AS place FROM kinds)),
        heads AS (SELECT n, lead, place, pair, min(first) AS keeper, arg_min(pieces, first) AS head FROM pairs GROUP BY ALL),
        members AS (SELECT p.*, keeper FROM pairs p JOIN heads USING (n, lead, place, pair)
            WHERE list_sum(list_transform(range(0, m), lambda i: CASE WHEN pieces[i + 1] = head[i + 1] THEN coalesce(consts[i + 1], (i + 1) * n // m - i * n // m) ELSE 0 END)) >= 0.7::DOUBLE * n),
        recurring AS (SELECT n, lead, place, pair FROM (SELECT n, lead, place, pair, unnest(ids) AS id FROM members) GROUP BY ALL
            HAVING count(DISTINCT id) >= CASE WHEN n >= 10 THEN 2 WHEN n >= 3 THEN 5 ELSE (SELECT bare FROM least) END),
        found AS (SELECT n, lead, pieces, min(keeper) AS keeper FROM (SELECT n, lead, pieces, keeper FROM members JOIN recurring USING (n, lead, place, pair)
            UNION ALL SELECT n, lead, pieces, first FROM kinds WHERE docs >= CASE WHEN n >= 10 THEN 2 WHEN n >= 3 THEN 5 ELSE (SELECT bare FROM least) END AND low < high) GROUP BY n, lead, pieces),
        gone AS (SELECT doc_id, line FROM cut JOIN found USING (n, lead, pieces) WHERE row(doc_id, line) <> keeper)
        SELECT l.doc_id, coalesce(string_agg(raw, chr(10) ORDER BY l.line) FILTER (g.line IS NULL), '') AS text, count(g.line) AS n_lines_dropped
        FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.line = g.line GROUP BY l.doc_id""",
    "op9_embedding_lsh": """WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
        reach AS (SELECT vec_id, vec_id AS other FROM v UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a),
        least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id)
        SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM least""",
    "op12_wht_clustering": _clustering_sql(),
    "op13_fill_in_middle": """WITH drawn AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS h FROM documents),
        numbers AS (SELECT *, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3,
            CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM drawn),
        cuts AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b, CASE
            WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
            WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbers),
        parts AS (SELECT *, substring(text, 1, a) AS p, substring(text, a + 1, b - a) AS m, substring(text, b + 1, n - b) AS s FROM cuts)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
            sha256(text) AS restored_sha256 FROM parts""",
}

"""One query per operator over its whole table, and the SQL that gives the same rows where there is one."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import align, boilerplate, collocation, decontaminate, exact, packing, quality, secrets, simhash, suffix, topk, toxicity, warc
from stratalake.llm.common import arrow_rows, remove, ship, stage, tidy_shuffles
from stratalake.llm.labelled import fold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _judged(scores: DataFrame, held_out) -> DataFrame:
    # A row without an id is in no fold that may be learned from.
    return scores.select("doc_id", F.coalesce(held_out, F.lit(True)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op1_quality")
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels, fold("doc_id", 3) != 1)
    return _judged(quality.score(docs, model), fold("doc_id", 3) == 1)


@query("op2_packing")
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer, ranks = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken"))
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer, ranks)


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    network = toxicity.fit(docs, labels, fold("doc_id", 5) != 0)
    return _judged(toxicity.score(docs, network), fold("doc_id", 5) == 0)


@query("op4_suffix_dedup")
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query(
    "op5_exact_dedup",
    """
    WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS h FROM documents),
         g AS (SELECT h, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY h)
    SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, d.h AS text_sha256
    FROM d JOIN g USING (h)
    """,
)
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.duplicates(table(spark, sf_dir, "documents"))


@query("op6_warc")
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"))


@query(
    "op7_line_dedup",
    """
    WITH l AS (SELECT doc_id, coalesce(source, '') AS site,
                      unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                      unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
               FROM documents),
         s AS (SELECT trim(line, ' ') AS bare, min(row(doc_id, pos)) AS first
               FROM l WHERE trim(line, ' ') <> '' GROUP BY 1 HAVING count(DISTINCT site) >= 10),
         m AS (SELECT l.doc_id, l.pos, l.line, s.bare IS NOT NULL AND row(l.doc_id, l.pos) <> s.first AS gone
               FROM l LEFT JOIN s ON trim(l.line, ' ') = s.bare),
         k AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
                      coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept FROM m GROUP BY doc_id)
    SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE k.n_lines END AS n_lines, k.n_removed, sha256(k.kept) AS kept_sha256
    FROM documents d JOIN k ON d.doc_id = k.doc_id
    """,
)
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = boilerplate.remove_boilerplate(table(spark, sf_dir, "documents"))
    return cleaned.select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def _of_kind(kind: str, span):
    return span["kind"] == kind


@query("op8_secrets")
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    count = {f"n_{kind}": F.size(F.filter("base", partial(_of_kind, kind))).cast("long") for kind, *_ in secrets.KINDS}
    return found.select(
        "doc_id",
        *[c.alias(n) for n, c in count.items()],
        F.sha2(secrets.written(F.col("base")), 256).alias("base_sha256"),
        secrets.written(F.concat("base", "added")).alias("spans"),
    )


@query(
    "op9_decontamination",
    r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
         b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
         n AS (SELECT DISTINCT least(10, len(w)) AS n FROM b WHERE len(w) > 0),
         bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i + 1 : i + n], ' ') AS win
                FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(len(w) - least(10, len(w)) + 1)) AS i FROM b WHERE len(w) > 0)),
         dw AS (SELECT doc_id, i, n, array_to_string(w[i + 1 : i + n], ' ') AS win
                FROM (SELECT doc_id, w, n.n, unnest(range(len(w) - n.n + 1)) AS i FROM d, n WHERE len(w) >= n.n)),
         h AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
         c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
         t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                      string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM h GROUP BY doc_id)
    SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
           sha256(coalesce(t.items, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
    """,
)
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", F.size("covered").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("covered") > 0).alias("contaminated"),
    )


@query("op10_simhash")
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


@query(
    "op11_collocations",
    r"""
    WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
         w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
         g AS (SELECT lang, n, array_to_string(w[i + 1 : i + n], ' ') AS phrase
               FROM (SELECT lang, w, s.n, unnest(range(len(w) - s.n + 1)) AS i FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS n) s WHERE len(w) >= s.n)),
         f AS (SELECT lang, n, phrase, count(*) AS f FROM g GROUP BY ALL),
         t AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE n = 1 GROUP BY lang),
         c AS (SELECT lang, n AS size, phrase, f AS a FROM f WHERE n >= 2 AND f >= 100),
         k AS (SELECT *, array_to_string(string_split(phrase, ' ')[1 : k], ' ') AS first, array_to_string(string_split(phrase, ' ')[k + 1 : size], ' ') AS rest
               FROM (SELECT *, unnest(range(1, size)) AS k FROM c)),
         s AS (SELECT k.*, l.f AS l, r.f AS r, t.n, (1000::HUGEINT * a * t.n) // (l.f::HUGEINT * r.f) AS score
               FROM k JOIN f l ON l.lang = k.lang AND l.phrase = k.first AND l.n = k.k
                      JOIN f r ON r.lang = k.lang AND r.phrase = k.rest AND r.n = k.size - k.k JOIN t ON t.lang = k.lang),
         b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
         o AS (SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.lang = b.lang AND c.size > b.size AND 100 * c.a >= 100 * b.a
                                                   AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' ')))
    SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score
    FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase COLLATE "C") AS rank FROM o) WHERE rank <= 2000
    """,
)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocation.mine(table(spark, sf_dir, "documents"))


@query("op12_alignment")
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model")]
    with tidy_shuffles(spark), arrow_rows(spark, align.TEXTS):
        packed, at = stage(align.pack_groups(table(spark, sf_dir, "documents"), *files), "aligned", compression="zstd")
        result, _ = stage(align.digests(packed, align.pair_counts(packed)), "alignment")
        remove(spark, at)
    return result


@query(
    "op13_topk",
    """
    WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
               WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
         s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
               FROM e q JOIN e c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
    SELECT query_id, rank::INTEGER AS rank, vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
    """,
)
def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)

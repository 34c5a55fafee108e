"""The operators of this package as registered queries: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlake.llm import (
    decontamination,
    hard_negatives,
    id_files,
    language_id,
    line_dedup,
    order_minhash,
    packing,
    page_diff,
    pii,
    quality_rules,
    spelling,
    token_counts,
    toxic_segments,
)
from loadlake.llm.common import shared_folder, shipping, table

WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file; the files are installed with their package and never copied."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = quality_rules.judged(table(spark, folder, "documents").select("doc_id", "text"))
    m = F.col("measured")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return docs.select("doc_id", *[m[n].alias(n) for n in names], "base_failed", "kept", "quality")


def op2_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return order_minhash.near_duplicates(table(spark, folder, "documents"))


def op3_toxic_segments(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxic_segments.fit(docs, table(spark, folder, "labels"))
    score = F.col("toxicity")["score"]
    return toxic_segments.scored(docs, model).select(
        "doc_id",
        toxic_segments.held_out(F.col("doc_id")).alias("held_out"),
        score.alias("score"),
        F.when(score >= 0.5, 1).otherwise(0).alias("predicted"),
        F.size(F.col("toxicity")["passages"]).alias("n_passages"),
    )


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = line_dedup.deduplicate_lines(table(spark, folder, "documents").select("doc_id", "text"))
    d = F.col("deduplicated")
    return docs.select("doc_id", d["n_lines"].alias("n_lines"), d["n_dropped"].alias("n_dropped"), F.sha2(d["text"].cast("binary"), 256).alias("kept_sha256"))


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer_path(WORD_TOKENIZER))


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    langs, net = language_id.fit(docs)
    told = language_id.predicted(docs.select("doc_id", "text"), langs, net)
    return told.select(
        "doc_id",
        language_id.held_out(F.col("doc_id")).alias("held_out"),
        F.col("language")["lang"].alias("lang_pred"),
        F.col("language")["score"].alias("score"),
    )


def op7_page_diff(spark: SparkSession, folder: str) -> DataFrame:
    return page_diff.extract(table(spark, folder, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op8_fm_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, benchmark = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    found = decontamination.contamination(docs, benchmark)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = pii.private_spans(docs, pii.fit(docs))

    def number(kind: int) -> Column:  # no second parameter in the lambda: Spark would pass the place in the array
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [number(i).alias(f"n_{kind}") for i, kind in enumerate(pii.KINDS)]
    digest = F.sha2(pii.listed(F.col("base")).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, pii.listed(F.col("spans")).alias("spans"))


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_counts.counted(docs, tokenizer_path(BYTE_TOKENIZER)).select("doc_id", "tokens.*")


def op11_id_files(spark: SparkSession, folder: str) -> DataFrame:
    home = f"{shared_folder(spark)}/ids-{uuid4().hex}"
    id_files.write(table(spark, folder, "documents").select("doc_id", "text"), tokenizer_path(BYTE_TOKENIZER), home)
    rows = id_files.read(spark, home)
    return rows.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.usable(table(spark, folder, "embeddings"), moved)
    return hard_negatives.mined(rows, F.col("vec_id") % 100 == 0)


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(table(spark, folder, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: shipping(query)
    for query in (
        op1_quality_rules,
        op2_order_minhash,
        op3_toxic_segments,
        op4_line_dedup,
        op5_packing,
        op6_language_id,
        op7_page_diff,
        op8_fm_decontamination,
        op9_pii,
        op10_token_counts,
        op11_id_files,
        op12_hard_negatives,
        op13_spelling_variants,
    )
}

ORACLES: dict[str, str] = {
    "op4_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, generate_subscripts(a, 1) AS i, unnest(a) AS line
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents)
        ), keyed AS (
            SELECT doc_id, i, line, translate(
                trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM lines
        ), shared AS (
            SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
            GROUP BY key HAVING count(DISTINCT doc_id) >= 5
        ), told AS (
            SELECT doc_id, i, line, keeper IS NOT NULL AND keeper <> doc_id AS gone
            FROM keyed LEFT JOIN shared USING (key)
        )
        SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
        FROM told GROUP BY doc_id
    """,
    "op8_fm_decontamination": r"""
        WITH folded AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
            FROM documents
        ), items AS (
            SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
            FROM benchmark
        ), windows AS (
            SELECT DISTINCT item_id, len(p) AS n, array_to_string(p, ' ') AS phrase FROM (
                SELECT item_id, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: w[i:i + 9])) AS p
                FROM items WHERE len(w) > 0)
        ), sizes AS (SELECT DISTINCT n FROM windows),
        places AS (
            SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM folded, sizes WHERE len(w) >= n
        ), hits AS (
            SELECT doc_id, i, p.n AS n, item_id FROM (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM places) p
            JOIN windows USING (n, phrase)
        ), covered AS (
            SELECT doc_id, count(DISTINCT k)::BIGINT AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id
        ), named AS (
            SELECT doc_id, count(DISTINCT item_id)::BIGINT AS n_items,
                sha256(string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS items_sha256
            FROM hits GROUP BY doc_id
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
            coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM folded LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
    """,
    "op12_hard_negatives": r"""
        WITH v AS (
            SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
            FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scores AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_dot_product(a.e, b.e)::BIGINT AS s
            FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
        ), positives AS (
            SELECT anchor_id, other AS positive_id, s AS positive_score FROM scores WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, other) <= 5
        )
        SELECT anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, other AS negative_id, positive_score, s AS negative_score
        FROM positives JOIN scores USING (anchor_id)
        WHERE NOT same AND 30 * positive_score <= 100 * s AND 100 * s <= 90 * positive_score
        WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY s DESC, other)
        QUALIFY row_number() OVER w <= 10
    """,
    "op13_spelling_variants": r"""
        WITH RECURSIVE lowered AS (
            SELECT coalesce(doc_id::VARCHAR, '') AS doc, unnest(regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run
            FROM documents
        ), counted AS (
            SELECT doc, run, count(*) AS n FROM lowered GROUP BY ALL
        ), summed AS (
            SELECT run, n, xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(string_split(doc || ':' || run, ''),
                lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END))),
                lambda s, b: xor(s >> 8, xor(
                    xor(xor((xor(s, b) & 1) * 1996959894, ((xor(s, b) >> 1) & 1) * 3993919788),
                        xor(((xor(s, b) >> 2) & 1) * 124634137, ((xor(s, b) >> 3) & 1) * 249268274)),
                    xor(xor(((xor(s, b) >> 4) & 1) * 498536548, ((xor(s, b) >> 5) & 1) * 997073096),
                        xor(((xor(s, b) >> 6) & 1) * 1994146192, ((xor(s, b) >> 7) & 1) * 3988292384)))))) AS h
            FROM counted
        ), vocabulary AS (
            SELECT word, sum(n)::BIGINT AS n FROM (
                SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
                    ELSE run END AS word, n FROM summed)
            WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
        ), cut AS (
            SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS short
            FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)
        ), holed AS (
            SELECT word, n, substr(word, 1, i - 1) || '_' || substr(word, i + 1) AS hole
            FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)
        ), near AS (
            SELECT c.word, v.word AS other, v.n AS other_n FROM cut c JOIN vocabulary v ON v.word = c.short
            UNION ALL SELECT v.word, c.word, c.n FROM cut c JOIN vocabulary v ON v.word = c.short
            UNION ALL SELECT a.word, b.word, b.n FROM holed a JOIN holed b ON a.hole = b.hole AND a.word <> b.word
        ), best AS (
            SELECT word, count(*)::BIGINT AS n_near, (list(other ORDER BY other_n DESC, other))[1] AS first, max(other_n) AS first_n
            FROM near GROUP BY word
        ), formed AS (
            SELECT v.word, CASE WHEN first_n >= 2 * n THEN first END AS form, n, coalesce(n_near, 0)::BIGINT AS n_near,
                CASE WHEN first_n >= 2 * n THEN first_n END AS form_n
            FROM vocabulary v LEFT JOIN best USING (word)
        ), chain AS (
            SELECT word, word AS root FROM formed
            UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL
        ), ends AS (
            SELECT c.word, c.root FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NULL
        )
        SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
    """,
}

"""The registered queries of this subpackage: op1 to op13, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusproof.llm.jaccard_join import jaccard_components

    found = jaccard_components(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "class_id", "copies")


def held_out(doc_id: str, parts: int, part: int):
    """Whether crc32 of the doc_id as text (null: an empty string), modulo ``parts``, is ``part``."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % parts == part


def op1_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusproof.llm.line_crf import quality_scores

    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    scored = quality_scores(documents.select("doc_id", "text"), labels.where(~held_out("doc_id", 5, 0)))
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.3).cast("int").alias("predicted"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from corpusproof.llm.token_files import write_token_files

    return write_token_files(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")).read()


def op2_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusproof.llm.log_bilinear import lm_scores

    scored = lm_scores(_table(spark, sf_dir, "documents"), ~held_out("doc_id", 7, 2))
    return scored.select("doc_id", held_out("doc_id", 7, 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusproof.llm.outliers import judged

    return judged(_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusproof.llm.repeated_windows import remove_repeated_windows

    cut = remove_repeated_windows(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


# fixed values: the host and path rules that go before the mined ones
HOST_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
# weights of the domains in the mix
TARGETS = {"clean": 0.93, "poor": 0.04, "toxic": 0.03}


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages are labelled through the row of ``labels`` with their id: blocked are those of poor quality or toxic."""
    from corpusproof.llm.url_rules import judge_urls

    pages, labels = _table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels")
    blocked = ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("blocked")
    labelled = pages.join(labels, pages["page_id"] == labels["doc_id"]).select("url", blocked)
    return judge_urls(pages.select("page_id", "url"), labelled, HOST_RULES).select("page_id", "host", "path", "rule", "verdict", "mined")


def op5_license_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusproof.llm.licenses import license_matches

    return license_matches(_table(spark, sf_dir, "documents"))


def op6_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusproof.llm.mixing import document_rates, label_domains

    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    rated = document_rates(documents.select("doc_id", "text"), label_domains(labels), TARGETS)
    return rated.select("doc_id", "n_words", "domain", F.round("posterior", 6).alias("posterior"), F.round("rate", 6).alias("rate"))


def op10_simhash_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusproof.llm.decontaminate import contaminations

    return contaminations(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusproof.llm.collocations import collocations

    return collocations(_table(spark, sf_dir, "documents")).drop("cut")


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from corpusproof.llm.packing import packed

    return packed(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")).pieces(with_ids=False)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusproof.llm.spelling import variant_groups

    return variant_groups(_table(spark, sf_dir, "documents")).select("word", "n", "n_near", "form", "form_n", "root")


QUERIES = {
    "op1_line_crf": op1_line_crf,
    "op2_log_bilinear": op2_log_bilinear,
    "op3_token_files": op3_token_files,
    "op4_url_rules": op4_url_rules,
    "op5_license_sentences": op5_license_sentences,
    "op6_soft_mixing": op6_soft_mixing,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_outliers": op8_outliers,
    "op9_repeated_windows": op9_repeated_windows,
    "op10_simhash_windows": op10_simhash_windows,
    "op11_collocations": op11_collocations,
    "op12_best_fit_packing": op12_best_fit_packing,
    "op13_spelling_variants": op13_spelling_variants,
}
_WORDS = "regexp_extract_all({}, '[^\\x20\\x09-\\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# every pair of documents that share a shingle is compared
_OP7 = f"""WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS ws FROM documents),
s AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END)) AS own FROM w),
g AS (SELECT doc_id, len(own) AS n, unnest(own) AS h FROM s),
e AS (SELECT a.doc_id AS a, b.doc_id AS b FROM g a JOIN g b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM s UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.doc_id WHERE r.root < e.b),
c AS (SELECT doc_id, min(root) AS component_id FROM r GROUP BY 1)
SELECT s.doc_id, CAST(len(own) AS BIGINT) AS n_shingles, component_id, CASE WHEN len(own) = 0 THEN s.doc_id ELSE min(s.doc_id) OVER (PARTITION BY own) END AS class_id,
 CASE WHEN len(own) = 0 THEN 1 ELSE count(*) OVER (PARTITION BY own) END AS copies FROM s JOIN c USING (doc_id)"""
# every window is compared with all windows that start earlier
_OP9 = f"""WITH w AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents), p AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
v AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS run FROM p WHERE i + 19 <= len(ws)),
d AS (SELECT doc_id, i, row_number() OVER (PARTITION BY run ORDER BY doc_id, i) > 1 AS again FROM v),
k AS (SELECT p.doc_id, p.i, ws[p.i] AS word, coalesce(bool_or(again) OVER (PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), false) AS gone FROM p LEFT JOIN d USING (doc_id, i)),
t AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM k GROUP BY 1)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, coalesce(kept_sha256, sha256('')) AS kept_sha256 FROM documents LEFT JOIN t USING (doc_id)"""
# every phrase is counted, frequent or not
_OP11 = f"""WITH p AS (SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY 1),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase FROM w, range(1, 6) t(k) WHERE len(ws) >= k),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING a >= 100),
i AS (SELECT f.lang, array_to_string(string_split(phrase, ' ')[s:s + m - 1], ' ') AS phrase, max(a) AS longer FROM f, range(2, 5) u(m), range(1, 5) t(s) WHERE m < k AND s + m - 1 <= k GROUP BY 1, 2),
c AS (SELECT f.lang, f.phrase, f.a, n.n, x.a AS l, y.a AS r, (1000::HUGEINT * f.a * n.n) // (x.a::HUGEINT * y.a) AS score, j
 FROM f JOIN n USING (lang) LEFT JOIN i ON i.lang = f.lang AND i.phrase = f.phrase JOIN range(1, 5) t(j) ON j < f.k
 JOIN f x ON x.lang = f.lang AND x.phrase = array_to_string(string_split(f.phrase, ' ')[1:j], ' ') JOIN f y ON y.lang = f.lang AND y.phrase = array_to_string(string_split(f.phrase, ' ')[j + 1:f.k], ' ')
 WHERE f.k >= 2 AND (longer IS NULL OR 100 * longer < 100 * f.a)),
b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score FROM b QUALIFY rank <= 2000"""
ORACLES: dict[str, str] = {"op11_collocations": _OP11, "op7_jaccard_join": _OP7, "op9_repeated_windows": _OP9}

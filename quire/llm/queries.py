"""The queries of the training-data problems, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import abuse, encoding, leak, neardup, scans, split, tokenise
from quire.session import table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with wrongly decoded characters."""
    return encoding.restored(table(spark, sf_dir, "parsed_documents"), "record_id").where("n_spans > 0").select("record_id").distinct()


def p1_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record's text as it was meant, with the encoding pairs it went through."""
    out = encoding.restored(table(spark, sf_dir, "parsed_documents"), "record_id")
    return out.withColumn("pairs", F.array_join("pairs", ", "))


def p1_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by encoding pair."""
    out = encoding.restored(table(spark, sf_dir, "parsed_documents"), "record_id")
    return out.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n_records"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of noise by element."""
    return scans.find_noise(table(spark, sf_dir, "elements"))


def p3_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean paragraphs of every document."""
    return scans.clean_paragraphs(table(spark, sf_dir, "elements"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items that the splitting operator cuts."""
    return p4_pieces(spark, sf_dir).select("item_kind", "item_id").distinct()


def p4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pieces of all oversized elements, parents and children."""
    items = split.all_items(*(table(spark, sf_dir, t) for t in ("elements", "parents", "children")))
    return split.split_items(items, table(spark, sf_dir, "chunk_limits"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of documents at least 0.6 alike."""
    return neardup.similar_pairs(table(spark, sf_dir, "parsed_documents"))


def p5_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's class of copies, group and number of links."""
    return neardup.groups(table(spark, sf_dir, "parsed_documents"))


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token ids of each document."""
    return tokenise.encode(table(spark, sf_dir, "documents"))


def p6_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens per source, and documents that decoding gives back unchanged; texts are compared by hash and length."""
    docs = table(spark, sf_dir, "documents")
    mark = F.struct(F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"), F.length(F.coalesce("text", F.lit(""))).alias("size"))
    ids = tokenise.encode(docs)
    back = tokenise.decode(ids).select("doc_id", mark.alias("decoded"))
    counts = ids.select("doc_id", F.size("ids").alias("n"))
    return (
        docs.select("doc_id", "source", mark.alias("mark")).join(back, "doc_id").join(counts, "doc_id").groupBy("source")
        .agg(F.count("*").alias("n_docs"), F.count_if(F.col("mark") == F.col("decoded")).alias("n_same"), F.sum("n").alias("n_tokens"))
    )


def p6_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every document's tokens with their offsets: how many, how many begin inside a character, and the bytes and characters up to the last one's end."""
    docs = table(spark, sf_dir, "documents")
    tokens = tokenise.encode_with_offsets(docs)
    inside = F.filter(F.sequence(F.lit(1), F.greatest(F.size("tokens") - 1, F.lit(1))), lambda i: F.get("tokens", i)["char_start"] < F.get("tokens", i - 1)["char_end"])
    last = F.try_element_at("tokens", F.lit(-1))
    return tokens.select("doc_id", F.size("tokens").alias("n_tokens"), F.size(inside).alias("n_split"), F.coalesce(last["byte_end"], F.lit(0)).alias("n_bytes"), F.coalesce(last["char_end"], F.lit(0)).alias("n_chars"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the evaluation items that leaked into them."""
    return leak.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")).select("doc_id", "item_id")


def p7_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each leak, how many of the prompt's words the document contains."""
    return leak.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with an abusive, hateful or sexual passage."""
    return abuse.scores(table(spark, sf_dir, "documents")).where("n_passages > 0 and doc_id is not null").select("doc_id").distinct()


def p8_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every document, by category."""
    return abuse.scores(table(spark, sf_dir, "documents"))


def p8_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagged documents per source."""
    docs = table(spark, sf_dir, "documents").select("text", "source", "lang")
    # The source travels with the row, so that no join is needed.
    keyed = docs.select(F.to_json(F.struct("source")).alias("doc_id"), "text", "lang")
    scored = abuse.scores(keyed).withColumn("source", F.get_json_object("doc_id", "$.source"))
    return abuse.rates(scored)


def p8_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision and recall of the flags against the reviewers' judgements."""
    return abuse.agreement(abuse.scores(table(spark, sf_dir, "documents")), table(spark, sf_dir, "review_labels"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (p1_found, p1_restored, p1_pairs, p3_found, p3_paragraphs, p4_found, p4_pieces, p5_found, p5_groups, p6_ids, p6_roundtrip, p6_offsets, p7_found, p7_coverage, p8_found, p8_scores, p8_rates, p8_review)}

_WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"
_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+"

_RUNS = "unnest(range(1, len(w) - n + 2)) AS k, unnest(list_transform(range(1, len(w) - n + 2), lambda k: array_to_string(w[k : k + n - 1], ' '))) AS g"
_LEAKS = f"""d AS (SELECT doc_id, {_WORDS} AS w FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL),
i AS (SELECT item_id, w, least(12, len(w)) AS n FROM (SELECT item_id, {_WORDS.replace('text', 'prompt')} AS w FROM eval_items WHERE prompt IS NOT NULL AND item_id IS NOT NULL) WHERE len(w) > 0),
sought AS (SELECT DISTINCT item_id, len(w) AS n_words, n, {_RUNS} FROM i),
lengths AS (SELECT DISTINCT n FROM i),
runs AS (SELECT DISTINCT doc_id, n, g FROM (SELECT doc_id, n, {_RUNS} FROM d JOIN lengths ON len(w) >= n))"""

SQL: dict[str, str] = {
    "p4_found": rf"""
WITH items AS (
  SELECT 'element' AS item_kind, element_type AS item_type, element_id AS item_id, text FROM elements
  UNION ALL SELECT 'parent', 'any', parent_id, text FROM parents
  UNION ALL SELECT 'child', chunk_type, child_id, text FROM children)
SELECT DISTINCT i.item_kind, i.item_id
FROM items i JOIN chunk_limits l ON l.item_kind = i.item_kind AND l.item_type = i.item_type
WHERE i.text IS NOT NULL AND i.item_id IS NOT NULL
  AND (length(i.text) > l.max_chars
       OR len(list_filter(regexp_split_to_array(i.text, '{_SPACE}'), lambda t: t <> '')) > l.max_tokens)""",
    "p5_found": f"""
WITH texts AS (SELECT DISTINCT doc_id, text FROM parsed_documents WHERE text IS NOT NULL AND doc_id IS NOT NULL),
words AS (SELECT row_number() OVER () AS t, doc_id, {_WORDS} AS w FROM texts),
grams AS (SELECT DISTINCT t, doc_id, g FROM (SELECT t, doc_id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g FROM words WHERE len(w) >= 3)),
sizes AS (SELECT t, count(*) AS n FROM grams GROUP BY t),
common AS (SELECT a.t AS ta, b.t AS tb, a.doc_id AS da, b.doc_id AS db, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL)
SELECT DISTINCT da AS doc_a, db AS doc_b FROM common JOIN sizes x ON x.t = ta JOIN sizes y ON y.t = tb WHERE 5 * c >= 3 * (x.n + y.n - c)""",
    "p7_found": f"WITH {_LEAKS} SELECT DISTINCT doc_id, item_id FROM runs JOIN sought USING (n, g)",
    "p7_coverage": f"""
WITH {_LEAKS}
SELECT doc_id, item_id, CAST(max(n_words) AS INTEGER) AS n_words, CAST(count(DISTINCT place) AS INTEGER) AS n_shared
FROM (SELECT DISTINCT doc_id, item_id, n_words, unnest(range(k, k + n)) AS place FROM runs JOIN sought USING (n, g)) GROUP BY 1, 2""",
}

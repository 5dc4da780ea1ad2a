"""The registered queries of this subpackage, with production parameters."""

from __future__ import annotations

from functools import partial

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rulestream.llm.alignment import aligned_tokens
from rulestream.llm.lexical import top_documents
from rulestream.llm.lm import trained, vocabulary_of, with_pseudo_likelihood, word_counts
from rulestream.llm.packing import pack_documents
from rulestream.llm.secrets import KINDS, all_spans, joined_spans, secret_spans
from rulestream.llm.sharding import shard_documents
from rulestream.llm.simhash import near_duplicates
from rulestream.llm.sketch import fingerprints
from rulestream.llm.substring import without_repeats
from rulestream.llm.tiling import contaminated
from rulestream.llm.tokens import count_tokens
from rulestream.llm.toxicity import Model, held_out, learn, with_score
from rulestream.llm.warc import read_records, write_archives

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
SEQUENCE = 2048
#: Documents with this score or more are toxic.
TOXIC = 0.7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents on 40 shards whose row counts differ by one at most."""
    return shard_documents(table(spark, sf_dir, "documents"), 40).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    docs = table(spark, sf_dir, "documents")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    counted = count_tokens(docs.select("doc_id", size.alias("n_bytes"), "text"), VOCABULARY)
    return counted.withColumn("over_limit", F.col("n_tokens") > SEQUENCE)


def document_secrets(docs: DataFrame) -> DataFrame:
    """Secrets of documents; a source is an owner, and its documents of one language are a repository."""
    rows = docs.select("doc_id", "text", "source", F.concat_ws("/", "source", "lang").alias("repository"))
    return secret_spans(rows, owner="source", repository="repository")


def is_kind(kind: str, span: Column) -> Column:
    return span["kind"] == kind


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, with who else has them: owners, repositories and uses of each added span."""
    found = document_secrets(table(spark, sf_dir, "documents"))

    def who(span: Column) -> Column:
        return F.concat_ws(":", *[span[n].cast("string") for n in ("kind", "start", "end", "owners", "repositories", "uses")])

    counts = [F.size(F.filter("base", partial(is_kind, kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(joined_spans(F.col("base")), 256).alias("base_sha256"),
        joined_spans(all_spans(F.col("base"), F.col("added"))).alias("spans"),
        F.coalesce(F.array_join(F.transform("added", who), ","), F.lit("")).alias("ownership"),
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to WARC archives and read back by the index."""
    records = read_records(write_archives(table(spark, sf_dir, "pages"), smallest=0))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the share of the item that they cover."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"), words=4, distance=4)


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, with their likeness."""
    return fingerprints(table(spark, sf_dir, "documents"))


def toxicity_model(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from labelled rows that are not held out."""
    return learn(docs, labels.where(~held_out()))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-likelihood of every document under a network learned from all documents."""
    docs = table(spark, sf_dir, "documents")
    counted = word_counts(docs, "text")
    vocabulary = vocabulary_of(docs, "text", counted)
    return with_pseudo_likelihood(docs, trained(docs, vocabulary), vocabulary, counted=counted)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    scored = with_score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"), VOCABULARY, SEQUENCE)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item."""
    return top_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


TERMS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
OP11_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS place, doc_id, {TERMS} AS terms FROM documents WHERE text IS NOT NULL),
stats AS (SELECT count(*) AS many, CAST(sum(len(terms)) AS BIGINT) AS total FROM docs WHERE len(terms) > 0),
items AS (SELECT row_number() OVER () AS number, item_id, {TERMS} AS terms FROM benchmark WHERE text IS NOT NULL),
asked AS (SELECT number, item_id, term, count(*) AS often FROM (SELECT number, item_id, unnest(terms) AS term FROM items) GROUP BY ALL),
held AS (SELECT place, doc_id, n, term, count(*) AS tf
         FROM (SELECT place, doc_id, len(terms) AS n, unnest(terms) AS term FROM docs) SEMI JOIN asked USING (term) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * many + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM held, stats GROUP BY term, many),
scored AS (
  SELECT number, item_id, place, doc_id,
         sum(often * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * many) // total)))) AS score
  FROM asked JOIN held USING (term) JOIN weights USING (term), stats GROUP BY number, item_id, place, doc_id),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY number ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 10"""


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the words of passages of 35 words or more that occur more than once."""
    made = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select("doc_id", "n_words", "n_removed", "kept_sha256")


OP12_SQL = r"""
WITH own AS (
  SELECT row_number() OVER () AS place, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
windows AS (SELECT place, unnest(range(1, len(words) - 33)) AS start, words FROM own),
told AS (SELECT place, start, array_to_string(words[start : start + 34], ' ') AS window_text FROM windows),
again AS (SELECT window_text FROM told GROUP BY window_text HAVING count(*) > 1),
covered AS (SELECT DISTINCT place, start + unnest(range(0, 35)) AS spot FROM told SEMI JOIN again USING (window_text)),
removed AS (SELECT place, count(*) AS n, list(spot) AS gone FROM covered GROUP BY place)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
       sha256(CASE WHEN n IS NULL THEN array_to_string(words, ' ') ELSE
         coalesce(array_to_string(list_filter(words, lambda x, i: NOT list_contains(gone, i)), ' '), '') END) AS kept_sha256
FROM own LEFT JOIN removed USING (place)"""


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in two tokenizations, aligned by bytes."""
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return aligned_tokens(table(spark, sf_dir, "documents"), *paths)


QUERIES = {f.__name__: f for f in (op1_sharding, op2_token_counts, op3_secret_scans, op4_warc, op5_benchmark_decontamination, op6_simhash_near_dedup, op7_document_fingerprints, op8_lm_scoring, op9_toxicity, op10_best_fit_packing, op11_lexical_search, op12_substring_dedup, op13_tokenizer_alignment)}
ORACLES: dict[str, str] = {"op11_lexical_search": OP11_SQL, "op12_substring_dedup": OP12_SQL}

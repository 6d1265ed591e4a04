"""The operators as queries over the test tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import alignment, decontaminate, fingerprints, langid, lexical, licenses, lines, mixing, mtree, quality, scoring, simhash, tokens
from quayside.llm.shared import reachable, small_enough, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(build: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        reachable(spark)
        return build(spark, sf_dir)

    QUERIES[build.__name__] = run
    return run


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts without later repeated runs of 25 words or more, as digests."""
    edited = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return edited.select("doc_id", "n_deleted", F.size("deleted").alias("n_runs"), F.sha2("text", 256).alias("text_sha256"))


@query
def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of three-word shingles, linked at three differing bits or fewer."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), size=3, bits=3)
    shown = F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", shown, "component_id")


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that lie in a 13-word window of a benchmark item."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=13, one_in=20)
    items = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", items, "contaminated")


@query
def op6_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of which rare words lie in a document about as far apart as in the item, though no window of theirs occurs."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=13, one_in=20)
    items = F.sha2(F.array_join("near", ","), 256).alias("near_sha256")
    return found.select("doc_id", F.size("near").cast("long").alias("n_near"), items)


_WORDS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
ORACLES["op6_decontamination"] = f"""
WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS gram
              FROM items, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS r(i) WHERE len(w) > 0),
texts AS (SELECT doc_id, {_WORDS} AS w FROM documents),
hits AS (SELECT doc_id, p, size, item_id
           FROM (SELECT doc_id, p, s.size, array_to_string(w[p : p + s.size - 1], ' ') AS gram
                   FROM texts, (SELECT DISTINCT size FROM windows) AS s, unnest(range(1, len(w) - s.size + 2)) AS r(p))
           JOIN windows USING (size, gram)),
covered AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM hits, unnest(range(p, p + size)) AS r(q) GROUP BY doc_id),
names AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                 string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= coalesce(len(w), 0) AS contaminated
  FROM texts LEFT JOIN covered USING (doc_id) LEFT JOIN names USING (doc_id)
"""


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents sampled so that tokens meet tempered shares of source, language and topic."""
    docs = mixing.with_topic(table(spark, sf_dir, "documents"), table(spark, sf_dir, "embeddings"))
    found = mixing.mix(docs, {"source": 0.5, "lang": 0.7, "topic": 0.7})
    return found.select("doc_id", "source", "lang", "topic", "tokens", "probability", "sampled", "residual")


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and tail probabilities of each document: 0 toxic, 1 poor, 2 good."""
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, quality.ratings(table(spark, sf_dir, "labels")))
    found = quality.graded(docs, model, keep_grade=2)
    tails = [F.get("tails", F.lit(j)).alias(f"p_at_least_{j + 1}") for j in range(2)]
    return found.select("doc_id", "expected_grade", *tails, "keep")


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices of each document, with their compressed sizes and differences in wording."""
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    return found.withColumns({"missing": F.array_join("missing", " "), "added": F.array_join("added", " ")})


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each line of each document."""
    return tokens.section_counts(table(spark, sf_dir, "documents"))


@query
def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten vectors with the largest integer inner product for each hundredth vector."""
    return mtree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10, factor=1024, by_row=True)


ORACLES["op3_topk_search"] = """
WITH rows AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
                FROM embeddings
               WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT vec_id, unnest(range(len(v))) AS at, unnest(v) AS x FROM rows),
scores AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
             FROM parts AS q JOIN parts AS c ON q.at = c.at AND q.vec_id <> c.vec_id
            WHERE q.vec_id % 100 = 0 GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query
def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy difference of each document: documents rated good against all."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    good = labels.where("quality = 1 AND toxic = 0").select(F.col("doc_id").alias("good_id")).distinct()
    good = small_enough(stored(good, "good"))
    docs = docs.select("doc_id", "text")  # other columns may have any name
    marked = docs.join(good, docs["doc_id"] == good["good_id"], "left").select(docs["doc_id"], docs["text"], F.col("good_id").isNotNull().alias("target"))
    return scoring.score(marked, scoring.train(marked))


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document by filters learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    known = docs.where(~langid.held_out("doc_id")).select("text", "lang")
    found = langid.identify(docs, langid.train(known, least_docs=5))
    return found.select("doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", "score")


@query
def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Additive fingerprints of each document and of its edited text, and how alike they and the next document are."""
    found = fingerprints.fingerprints(table(spark, sf_dir, "documents"))
    prints = [fingerprints.shown(F.col(c)).alias(name) for c, name in (("vector", "fingerprint"), ("edited_vector", "edited_fingerprint"))]
    return found.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), *prints, "near_edited", "near_next")


@query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 highest-scoring documents for each benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


ORACLES["op12_lexical_search"] = f"""
WITH texts AS (SELECT doc_id, {_WORDS} AS w FROM documents),
sums AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM texts WHERE len(w) > 0),
held AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS term FROM texts),
times AS (SELECT doc_id, n, term, CAST(count(*) AS BIGINT) AS tf FROM held GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM times, sums GROUP BY term),
asked AS (SELECT DISTINCT item_id, unnest({_WORDS}) AS term FROM benchmark),
scores AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)))) AS BIGINT) AS score
             FROM asked JOIN times USING (term) JOIN weights USING (term), sums GROUP BY item_id, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""


@query
def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers that end together, with counts over the corpus."""
    return alignment.align(table(spark, sf_dir, "documents"))

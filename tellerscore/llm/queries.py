"""Registered queries of the subpackage and the SQL that must give the same rows."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerscore.llm import (
    exact_dedup,
    language_id,
    lexical_search,
    line_dedup,
    lm_scores,
    mixing,
    near_dedup,
    neighbours,
    packing,
    quality_rules,
    secrets,
    token_counts,
    whitening,
)
from tellerscore.llm.common import documents, fold


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents grouped by 3-word shingles and a similarity of 0.85."""
    found = near_dedup.near_duplicates(documents(spark, sf_dir).select("doc_id", "text"), words=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten neighbours of every hundredth vector, among all."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return neighbours.search(vectors, F.col("vec_id") % 100 == 0)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents through a new digest index."""
    index = exact_dedup.new_index(spark)
    found = exact_dedup.dedupe(documents(spark, sf_dir).select("doc_id", "text"), index, batch="documents")
    index.forget()  # all that the result needs of it is written
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op8_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn from four folds of the documents, score all."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    held_out = fold(F.col("doc_id")) == 1
    found = lm_scores.score(docs, ~held_out)
    columns = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return found.select("doc_id", held_out.alias("held_out"), *columns)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without their repeated lines."""
    found = line_dedup.dedupe_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


#: Target weights of the mixture; a source weighs 1.
DOMAIN_WEIGHTS = {"d0": 4, "d1": 3, "d2": 2, "d3": 1}
LANGUAGE_WEIGHTS = {"en": 4, "de": 2, "es": 2, "fr": 2}


def domain_of() -> Column:
    """The documents name no domain: the last digits of the source, modulo 4, stand for it."""
    number = F.regexp_extract("source", "([0-9]+)$", 1)
    return F.when(number != "", F.concat(F.lit("d"), F.pmod(number.cast("long"), F.lit(4)).cast("string")))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half the corpus' tokens, drawn by target weights in at most two passes."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", "source")
    found = mixing.mix(docs, domain_of(), {"domain": DOMAIN_WEIGHTS, "lang": LANGUAGE_WEIGHTS})
    return found.select("doc_id", "domain", "lang", "source", "epoch", "n_tokens")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scanned, with the digest of the base spans."""
    found = secrets.scan(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        "n_markov",
        F.sha2(secrets.joined(F.col("spans"), kinds=3), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"),
    )


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn from four folds of the documents, predict all."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    held_out = fold(F.col("doc_id")) == 0
    model = language_id.fit(docs.where(~held_out))
    found = language_id.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents."""
    path = public_tokenizers.path("word_bpe_49k.json")
    found = token_counts.count_tokens(documents(spark, sf_dir).select("doc_id", "text"), path)
    return found.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All usable vectors on their first eight components."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    model = whitening.fit(vectors)
    numbered = F.posexplode("whitened").alias("at", "value")
    found = whitening.whiten(vectors, model).select("vec_id", "deviation", numbered)
    explained = F.array(*[F.lit(float(e)) for e in model.explained]) if len(model.explained) else F.array(F.lit(0.0))
    return found.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(int(model.centre.n)).cast("long").alias("n"),
        "deviation",
        F.col("value").alias("whitened"),
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(float(model.identity_error)).alias("identity_error"),
    )


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty best of all documents for each benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return lexical_search.search(documents(spark, sf_dir).select("doc_id", "text"), items)


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn quality from two folds of the labels, score all documents."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    held_out = fold(F.col("doc_id"), 3) == 1
    model = quality_rules.fit(docs, labels, training=~held_out)
    found = quality_rules.score(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


QUERIES = {
    "op1_near_dedup": op1_near_dedup,
    "op2_mixing": op2_mixing,
    "op3_secrets": op3_secrets,
    "op4_neighbours": op4_neighbours,
    "op5_packing": op5_packing,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_language_id": op7_language_id,
    "op8_lm_scores": op8_lm_scores,
    "op9_line_dedup": op9_line_dedup,
    "op10_token_counts": op10_token_counts,
    "op11_whitening": op11_whitening,
    "op12_lexical_search": op12_lexical_search,
    "op13_quality_rules": op13_quality_rules,
}

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"



def _cases(column: str, weights: dict[str, int]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in weights.items()) + " ELSE 1 END"


def _shared(source: str, level: str, parent: str) -> str:
    """Two steps of a level: which children their part fills, and every child's budget."""
    within = f"PARTITION BY {parent} ORDER BY capacity / weight, {level}"
    return f"""
        {level}_f AS (
            SELECT *, capacity * sum(weight) OVER ({within} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
                   <= weight * (above - coalesce(sum(capacity) OVER ({within} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS fits
            FROM {source}),
        {level}_g AS (SELECT *, bool_and(fits) OVER ({within} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM {level}_f),
        {level}_b AS (
            SELECT *, CASE WHEN filled THEN capacity ELSE
                   (above - coalesce(sum(CASE WHEN filled THEN capacity END) OVER (PARTITION BY {parent}), 0)) * weight
                   // sum(CASE WHEN NOT filled THEN weight END) OVER (PARTITION BY {parent}) END AS budget
            FROM {level}_g)"""


_MIX = rf"""
        WITH d AS (
            SELECT doc_id, lang, source, coalesce(lang, '') AS l, coalesce(source, '') AS s,
                   CASE WHEN regexp_extract(source, '([0-9]+)$', 1) <> ''
                        THEN 'd' || (CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) % 4) ELSE '' END AS domain,
                   coalesce(len(regexp_extract_all(text, '[^ 	-
]+')), 0) AS n_tokens
            FROM documents),
        leaf AS (SELECT domain, l, s, CAST(sum(n_tokens) AS BIGINT) AS tokens, CAST(2 * sum(n_tokens) AS BIGINT) AS capacity FROM d GROUP BY ALL),
        n1 AS (SELECT domain, CAST(sum(capacity) AS BIGINT) AS capacity, {_cases('domain', DOMAIN_WEIGHTS)} AS weight,
                      (SELECT CAST(sum(tokens) AS BIGINT) // 2 FROM leaf) AS above FROM leaf GROUP BY domain),
        {_shared('n1', 'domain', '1')},
        n2 AS (SELECT x.*, b.budget AS above FROM (
                   SELECT domain, l, CAST(sum(capacity) AS BIGINT) AS capacity, {_cases('l', LANGUAGE_WEIGHTS)} AS weight
                   FROM leaf GROUP BY domain, l) x JOIN domain_b b USING (domain)),
        {_shared('n2', 'l', 'domain')},
        n3 AS (SELECT x.*, 1 AS weight, b.budget AS above FROM leaf x JOIN l_b b USING (domain, l)),
        {_shared('n3', 's', 'domain, l')},
        plan AS (SELECT domain, l, s, budget // tokens AS passes, budget % tokens AS rest FROM s_b WHERE tokens > 0),
        o AS (SELECT d.*, passes, rest, md5('17:' || CAST(passes AS BIGINT) || ':' || doc_id) AS key FROM d JOIN plan USING (domain, l, s)),
        c AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, l, s ORDER BY key) AS drawn FROM o)
        SELECT doc_id, domain, lang, source, n_tokens,
               unnest(range(0, CAST(CASE WHEN rest > 0 AND drawn <= rest THEN passes + 1 ELSE passes END AS BIGINT))) AS epoch
        FROM c"""

_TERMS = """unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))"""

ORACLE = {
    "op12_lexical_search": rf"""
        WITH t AS (SELECT doc_id, {_TERMS} AS term FROM documents),
        q AS (SELECT DISTINCT item_id, {_TERMS} AS term FROM benchmark),
        l AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
        s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM l),
        m AS (SELECT doc_id, 50 + (50 * n * docs) // terms AS m FROM l, s),
        f AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY ALL),
        w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, s GROUP BY term),
        r AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
              FROM q JOIN f USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY ALL HAVING score > 0)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
        FROM r QUALIFY rank <= 50""",
    "op2_mixing": _MIX,
    "op6_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
            FROM documents)
        SELECT doc_id,
               first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               doc_id = first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS kept,
               text_sha256
        FROM d""",
    "op9_line_dedup": rf"""
        WITH l AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
            FROM documents),
        k AS (SELECT *, translate(trim(line, {_SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
        s AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (s.key IS NOT NULL AND doc_id <> s.last) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (s.key IS NULL OR doc_id = s.last), '')) AS kept_sha256
        FROM k LEFT JOIN s ON k.key = s.key GROUP BY doc_id""",
}

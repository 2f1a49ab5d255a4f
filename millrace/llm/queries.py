"""The registered query of each operator, and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    blockknn,
    chat,
    decontaminate,
    jaccard,
    langid,
    lexical,
    licenses,
    mixing,
    mixlm,
    ordinal,
    repeats,
    sharding,
    suffix,
)
from millrace.llm.text import computed, words


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which document contains which benchmark item."""
    found = decontaminate.contained_items(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id", "item_id", "n_item", "n_shared", (F.col("n_shared") / F.col("n_item")).alias("score")
    ).distinct()


OP2_SQL = r"""
WITH item_words AS (
  SELECT item_id, list_filter(string_split_regex(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM benchmark WHERE text IS NOT NULL
), doc_words AS (
  SELECT doc_id, list_filter(string_split_regex(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents WHERE text IS NOT NULL
), items AS (
  SELECT DISTINCT item_id, s FROM (
    SELECT item_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
      lambda i: array_to_string(w[i:i + 4], ' '))) AS s
    FROM item_words WHERE len(w) > 0)
), docs AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
      lambda i: array_to_string(w[i:i + 4], ' '))) AS s
    FROM doc_words WHERE len(w) > 0)
), sizes AS (SELECT item_id, count(*) AS n_item FROM items GROUP BY item_id)
SELECT doc_id, item_id, n_item, count(*) AS n_shared, count(*) / n_item AS score
FROM docs JOIN items USING (s) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id, n_item
HAVING 10 * count(*) >= 8 * n_item
"""


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.similar_documents(table(spark, sf_dir, "documents"), width=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id")


def _in_fold(modulus: int, value: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == value


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixer learns from the training documents of fold 3."""
    return mixlm.score(
        table(spark, sf_dir, "documents"),
        F.coalesce(_in_fold(7, 2), F.lit(False)),
        F.coalesce(_in_fold(7, 3), F.lit(False)),
    )


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(_in_fold(5, 0), F.lit(False))
    languages, model = langid.train(docs.where(~held_out).select("lang", "text"))
    return langid.identify(docs, languages, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blockknn.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP6_SQL = r"""
WITH rows AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT q.vec_id AS query_id, r.vec_id,
    sqrt(list_sum(list_transform(list_zip(q.v, r.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS score
  FROM rows q JOIN rows r ON q.vec_id <> r.vec_id AND len(q.v) = len(r.v)
  WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INTEGER AS rank FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ordinal.rate(docs, table(spark, sf_dir, "labels")).select(
        "doc_id",
        F.col("_expected").alias("expected_grade"),
        F.col("_tail").alias("tail_probability"),
        (F.col("_tail") >= 0.5).alias("keep"),
    )


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"), licenses.templates(spark))
    base = F.filter("spans", lambda s: s["base"])
    starts = F.transform(base, lambda s: s["first_word"])

    def names(spans):
        return F.array_join(
            F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ","
        )

    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        names(base).alias("base_labels"),
        names(F.col("spans")).alias("labels"),
        F.coalesce(
            F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0)
        ).alias("score"),
    )


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)],
        "conv_id long, turn long, role string, text string",
    )
    records = chat.conversation_records(rows.unionByName(own))
    written = chat.canonical_turns(records).select(
        "conv_id", chat.formatted(F.col("turns")).alias("formatted")
    )
    back = written.withColumn("turns", chat.read_back(F.col("formatted")))
    listed = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    loss = chat.loss_text(F.col("turns"))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(listed, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP9_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), placed AS (
  SELECT *, role || text AS said FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  -- three control strings a turn; '\', '<' and '[' take two signs
  sum(length('<|turn|>' || '<|says|>' || '<|end|>') + length(said) + length(said) - length(replace(replace(replace(said, '\', ''), '<', ''), '[', '')))::BIGINT AS formatted_chars
FROM placed GROUP BY conv_id
"""

def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.removal_digests(table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each benchmark item's ten best documents."""
    return lexical.best_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents WHERE text IS NOT NULL
), item_terms AS (
  SELECT DISTINCT item_id, unnest(
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE text IS NOT NULL
), vocabulary AS (SELECT DISTINCT term FROM item_terms),
totals AS (SELECT count(*)::BIGINT AS n_docs, sum(len(t))::BIGINT AS n_words FROM docs WHERE len(t) > 0),
counts AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM docs)
  WHERE term IN (SELECT term FROM vocabulary) GROUP BY r, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM counts, totals GROUP BY term
), lengths AS (
  SELECT r, doc_id, 100 - 90 + ((90 * len(t) * n_docs) // n_words) AS m FROM docs, totals WHERE len(t) > 0
), scores AS (
  SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM item_terms JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (r)
  GROUP BY item_id, r, doc_id HAVING score > 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM scores
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def op12_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.balanced_shards(table(spark, sf_dir, "documents"))


def planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text``; in every tenth document by checksum, words repeat from some place on."""
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    some = docs.select("doc_id", "text", F.coalesce(checksum % 10 == 0, F.lit(False)).alias("_planted"))
    some = some.withColumn("_g", F.floor(checksum / 10))
    some = computed(some, "_words", F.when(F.col("_planted"), words(F.col("text"))))
    n = F.size("_words")
    begin = F.col("_g") % n
    period = 1 + F.floor((n - begin) / (3 + F.col("_g") % 8))
    some = some.withColumn("_a", F.when(n > 0, begin)).withColumn("_p", F.when(n > 0, period))
    place = lambda i: F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p"))
    again = F.transform(
        F.sequence(F.lit(0), n - 1), lambda i: F.get(F.col("_words"), place(i.cast("long")).cast("int"))
    )
    return some.select(
        "doc_id", F.when(F.col("_planted") & (n > 0), F.array_join(again, " ")).otherwise(F.col("text")).alias("text")
    )


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words, found in documents some of which are made periodic first."""
    found = repeats.periodic_runs(planted_periods(table(spark, sf_dir, "documents")))
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    )
    listed = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    found = found.withColumn("longest", longest)
    length, start, period = F.col("longest.length"), -F.col("longest.s"), -F.col("longest.p")
    return found.select(
        "doc_id",
        "n_runs",
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_decontaminate": op2_decontaminate,
    "op3_lm_score": op3_lm_score,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_language": op5_language,
    "op6_neighbours": op6_neighbours,
    "op7_quality": op7_quality,
    "op8_licenses": op8_licenses,
    "op9_chat": op9_chat,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_ranked_search": op11_ranked_search,
    "op12_shards": op12_shards,
    "op13_periodic_runs": op13_periodic_runs,
}
ORACLES = {
    "op2_decontaminate": OP2_SQL,
    "op6_neighbours": OP6_SQL,
    "op9_chat": OP9_SQL,
    "op11_ranked_search": OP11_SQL,
}

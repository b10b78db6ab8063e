"""The operators' queries with production parameters, and their SQL for another engine."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from granary.llm import ann, bpe, chat, decontam, langid, licenses, lm, pii, repair, search, sharding, simhash, toxicity
from granary.llm.common import fold, table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.interleaved_shards(table(spark, sf_dir, "documents"), 8)
    return shards.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


#: CRC-32 by its table of 256 remainders, ranks within sources, and runs of the interleaved order.
OP1_SQL = """
WITH RECURSIVE steps AS (
    SELECT i AS b, i AS c, 0 AS k FROM range(256) t(i)
    UNION ALL
    SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
remainders AS (SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8),
docs AS (
    SELECT doc_id, source, coalesce(octet_length(encode(text)), 0) + 1 AS size,
        md5(concat_ws(':', 'mixture', CAST(doc_id AS VARCHAR))) AS draw,
        xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
            list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: CAST('0x' || x AS BIGINT))),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS text_crc32
    FROM documents, remainders),
ranked AS (
    SELECT *, (2 * row_number() OVER (PARTITION BY source ORDER BY draw, doc_id NULLS FIRST, text_crc32 NULLS FIRST, size) - 1)
        / (2.0 * count(*) OVER (PARTITION BY source)) AS fraction
    FROM docs),
placed AS (
    SELECT *, row_number() OVER (ORDER BY fraction, draw, source NULLS FIRST, doc_id NULLS FIRST, text_crc32 NULLS FIRST, size) - 1 AS p,
        count(*) OVER () AS n
    FROM ranked)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(p * 8 // n AS INTEGER) AS shard,
    p - (p * 8 // n * n + 7) // 8 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM placed
"""


def op2_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model, counts = lm.fit(docs.where(fold("doc_id", 7) != 2).select("text"))
    scored = lm.score(docs, model, counts)
    return scored.select(
        "doc_id", (fold("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ann.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op4_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontam.mark(docs, table(spark, sf_dir, "benchmark"))
    return marked.select(
        "doc_id",
        "n_words",
        decontam.n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (decontam.n_hit() > 0).alias("contaminated"),
    )


#: Whole windows of words of every item, and the documents' words that they cover.
OP4_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
    FROM documents),
items AS (
    SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark),
windows AS (
    SELECT DISTINCT item, n, array_to_string(w[k:k + n - 1], ' ') AS phrase
    FROM (SELECT item, w, least(10, len(w)) AS n, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS k
          FROM items WHERE len(w) > 0)),
places AS (
    SELECT r, n, k, array_to_string(w[k:k + n - 1], ' ') AS phrase
    FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS k
          FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
found AS (SELECT r, k, n, item FROM places JOIN windows USING (n, phrase)),
words AS (SELECT r, count(DISTINCT p) AS hit FROM (SELECT r, unnest(generate_series(k, k + n - 1)) AS p FROM found) GROUP BY r),
listed AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s
           FROM (SELECT DISTINCT r, item FROM found WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(hit, 0) AS n_hit, coalesce(listed.n, 0) AS n_items,
    sha256(coalesce(s, '')) AS items_sha256, coalesce(hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN listed USING (r)
"""


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], said.schema)
    return chat.read_back(chat.formatted(said.unionAll(probe)))


#: The template's lengths: opening and closing mark, role and line end, text, and a backslash for each control string.
OP5_SQL = r"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(CASE WHEN role = 'assistant' THEN 7 ELSE 18 END + 1
        + length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '([<\[])(\\*)(/?(s>|INST\]))', '\1\2\\\3', 'g'))
        + length(regexp_replace(text, '([<\[])(\\*)(/?(s>|INST\]))', '\1\2\\\3', 'g'))) AS BIGINT) AS formatted_chars
FROM said GROUP BY conv_id
"""


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = toxicity.fit(docs, table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0))
    found = toxicity.score(docs.withColumn("held_out", fold("doc_id", 5) == 0), lexicon)
    return found.select(
        "doc_id",
        "held_out",
        F.col("toxicity").alias("score"),
        F.when(F.col("toxicity") >= 0.5, 1).otherwise(0).alias("predicted"),
        F.array_join("toxic_hits", ",").alias("hits"),
    )


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.array_distinct("places.label")
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.word").alias("first_word"),
        F.array_max("places.word").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.col("notices.label"))), ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max("notices.score"), F.lit(0.0))).alias("score"),
    )


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    done = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return done.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    dictionaries = langid.fit(docs.where(fold("doc_id", 3) != 1))
    found = langid.identify(docs.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "text"), dictionaries)
    return found.select(
        "doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"), F.col("lang_rejected").alias("rejected")
    )


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs))
    base = F.filter("pii", lambda s: s["base"])

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, pii.KINDS),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("pii")).alias("spans"),
    )


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Every item's terms against every document's, scored in whole numbers.
OP12_SQL = r"""
WITH docs AS (
    SELECT * FROM (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
        FROM documents) WHERE len(w) > 0),
total AS (SELECT count(*) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM docs),
asked AS (
    SELECT i, item_id, term, count(*) AS q
    FROM (SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(translate(text,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
    GROUP BY ALL),
held AS (
    SELECT r, doc_id, m, term, count(*) AS tf
    FROM (SELECT r, doc_id, 25 + (75 * len(w) * n) // l AS m, unnest(w) AS term FROM docs, total)
    WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS weight
    FROM held, total GROUP BY term),
scored AS (
    SELECT i, item_id, r, doc_id, CAST(sum(q * weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
    FROM asked JOIN held USING (term) JOIN weights USING (term) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""


def damaged(said: DataFrame) -> DataFrame:
    """Conversations with every kind of damage: turns lost, emptied, cut short, repeated or given to the user."""
    words = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    harm = F.crc32(F.concat_ws(":", *words)) % 20
    text, role = (F.coalesce(c, F.lit(" ")) for c in ("text", "role"))
    text = F.when(harm == 1, "").when(harm == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    rows = said.where(harm != 0).select("conv_id", "turn", F.when(harm == 4, "user").otherwise(role).alias("role"), text.alias("text"),
                                        F.explode(F.sequence(F.lit(0), F.when(harm == 3, 1).otherwise(0))).alias("copy"))
    return rows.drop("copy")


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair.summarised(said, damaged(said))


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_lm": op2_lm,
    "op3_neighbours": op3_neighbours,
    "op4_decontam": op4_decontam,
    "op5_chat": op5_chat,
    "op6_toxicity": op6_toxicity,
    "op7_licenses": op7_licenses,
    "op8_bpe": op8_bpe,
    "op9_simhash": op9_simhash,
    "op10_langid": op10_langid,
    "op11_pii": op11_pii,
    "op12_search": op12_search,
    "op13_repair": op13_repair,
}
#: The others' results depend on learned models, compression, fuzzy matching or merging, which SQL cannot express.
ORACLE: dict[str, str] = {"op1_sharding": OP1_SQL, "op4_decontam": OP4_SQL, "op5_chat": OP5_SQL, "op12_search": OP12_SQL}

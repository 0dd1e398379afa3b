"""One query per operator, over its whole table, and its digest columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsflow.llm import (
    bpe, classifier, edit_counts, lloyd, mixing, order_minhash, packing, rules, shards, suffixes, vectors, warc, whitening,
)
from newsflow.llm.common import spread, table
from newsflow.llm.registry import query

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
CAPACITY = 2048
END_ID = 0


@query("op10_bpe")
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, encoded and decoded."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return bpe.digests(docs, BYTE_BPE)


OP7_SQL = """
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), cut AS (
    SELECT r, doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
    FROM texts
), windows AS (
    SELECT r, unnest(range(1, len(w) - 3)) AS i, w FROM cut WHERE len(w) > 5
), counted AS (
    SELECT r, i, count(*) OVER (PARTITION BY r, array_to_string(w[i:i + 4], ' ')) AS n FROM windows
), covered AS (
    SELECT r, count(DISTINCT i + k) AS n_repeat_words
    FROM counted, range(5) AS s(k) WHERE n > 1 GROUP BY r
), measured AS (
    SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        len(l) AS n_lines, length(regexp_replace(t, '[^\\p{L}]', '', 'g')) AS n_letters,
        length(regexp_replace(t, '[^\\p{Lu}]', '', 'g')) AS n_upper,
        length(regexp_replace(t, '[^!?]', '', 'g')) AS n_marks
    FROM cut LEFT JOIN covered USING (r)
), judged AS (
    SELECT *, (n_words < 10)::BIGINT + 2 * (100 * n_repeat_words > 20 * n_words)::BIGINT
        + 4 * (100 * n_symbols > 20 * n_words)::BIGINT + 8 * (100 * n_dup_lines > 50 * n_lines)::BIGINT
        + 16 * (100 * n_upper > 50 * n_letters)::BIGINT + 32 * (word_chars > 30 * n_words)::BIGINT
        + 64 * (100 * n_marks > 50 * n_words)::BIGINT + 128 * (100 * n_letters < 25 * word_chars)::BIGINT
        AS failures
    FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    failures & 3 != 0 AS base_failed, failures = 0 AS kept, failures
FROM judged
"""


@query("op7_quality_rules", OP7_SQL)
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rules.ledger(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~rules.passes("base")).alias("base_failed"), rules.passes("v1").alias("kept"), "failures",
    )


@query("op3_kd_shards")
def op3_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    size = F.log2(F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(shards.ROW_OVERHEAD))
    dims = [size, shards.number_coordinate("doc_id")]
    return shards.assign(docs, 24, dims, ["source", "lang"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op4_best_fit_packing")
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return packed(docs)


def packed(docs: DataFrame) -> DataFrame:
    pieces = packing.pieces(docs, WORD_BPE, CAPACITY, END_ID)
    return packing.pack(pieces, CAPACITY, spread_by=["doc_id", "piece", "ids_crc32"])


OP1_SQL = """
SELECT page_id, strlen(p) AS payload_bytes, sha1(p) AS payload_digest,
    CASE WHEN strlen(p) >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN strlen(p) >= 1000 AND page_id <> last THEN last END AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS p, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages)
"""


@query("op1_warc", OP1_SQL)
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spread(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    records = warc.read_packages(warc.write_packages(pages))
    number = lambda c: F.expr(f"try_cast(substring_index({c}, ':', -1) AS bigint)")
    read = F.col("payload").isNotNull()
    return records.select(
        number("record_id").alias("page_id"),
        F.when(read, F.octet_length("payload")).otherwise(F.col("payload_bytes")).cast("long").alias("payload_bytes"),
        F.when(read, F.sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", number("refers_to").alias("refers_to"),
    )


OP6_SQL = """
WITH RECURSIVE good AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS u, b.vec_id AS v FROM good a JOIN good b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.98
), reach(id, root) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION
    SELECT l.v, r.root FROM reach r JOIN links l ON l.u = r.id
), lowest AS (
    SELECT id, min(root) AS component_id FROM reach GROUP BY id
), counts AS (
    SELECT u, count(*) AS n FROM links GROUP BY u
)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN lowest ON id = e.vec_id LEFT JOIN counts ON u = e.vec_id
"""


@query("op6_near_vectors", OP6_SQL)
def op6_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


def bad_documents(spark: SparkSession, sf_dir: str, docs: DataFrame) -> classifier.Model:
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    return classifier.fit(docs, table(spark, sf_dir, "labels"), bad)


@query("op9_quality_classifier")
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents"))
    model = bad_documents(spark, sf_dir, docs)
    rows = docs.select("doc_id", "text", "source", "lang")
    # The text is not needed beyond the evidence.
    judged = classifier.judge(rows, model, F.col("source"), F.col("lang"), keep=["doc_id"])
    return judged.select("doc_id", *[F.col(f"__{c}").alias(c) for c in ("evidence", "host_rate", "path_rate", "posterior", "kept")])


@query("op5_order_minhash")
def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_documents(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))


@query("op2_suffix_dedup")
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return suffixes.without_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op8_edit_counts")
def op8_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four edits per document, spread over it by hashes of its id: pieces of its own text replace others."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n = F.coalesce(F.length("text"), F.lit(0))

    def one(k: int) -> F.Column:
        part = lambda salt, below: F.pmod(F.xxhash64("doc_id", F.lit(4 * k + salt)), F.greatest(below, F.lit(1)))
        taken = F.substring("text", (part(2, n) + 1).cast("int"), part(3, F.lit(40)).cast("int"))
        return F.struct(part(0, n + 1).alias("start"), part(1, F.lit(60)).alias("length"), taken.alias("replacement"))

    return edit_counts.counted(docs, BYTE_RANKS, F.array(*[one(k) for k in range(4)]))


OP11_SQL = r"""
WITH RECURSIVE docs AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
        md5(coalesce(text, '')) AS digest FROM documents
), keyed AS (
    SELECT *, md5(concat_ws(':', doc_id, digest, row_number() OVER (PARTITION BY doc_id, digest, source, size) - 1)) AS key
    FROM docs
), totals AS (
    SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]
        AS weight, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_no FROM keyed GROUP BY source
), whole AS (
    SELECT sum(source_size)::BIGINT AS t, sum(weight)::BIGINT AS w FROM totals
), shared(k, fixed, fixed_weight) AS (
    SELECT 0, 0::BIGINT, 0::BIGINT
    UNION ALL
    SELECT k + 1, (SELECT coalesce(sum(3 * source_size), 0)::BIGINT FROM totals, whole
            WHERE 3 * source_size < (weight * (t - fixed))::DOUBLE / greatest(w - fixed_weight, 1)),
        (SELECT coalesce(sum(weight), 0)::BIGINT FROM totals, whole
            WHERE 3 * source_size < (weight * (t - fixed))::DOUBLE / greatest(w - fixed_weight, 1))
    FROM shared WHERE k < (SELECT count(*) FROM totals)
), settled AS (
    SELECT fixed, fixed_weight FROM shared ORDER BY k DESC LIMIT 1
), aimed AS (
    SELECT totals.*, least((weight * (t - fixed))::DOUBLE / greatest(w - fixed_weight, 1), 3 * source_size) AS target
    FROM totals, whole, settled
), sources AS (
    SELECT *, floor(target + 0.5)::BIGINT AS words,
        (sum(floor(target + 0.5)::BIGINT) OVER (ORDER BY source_no))::BIGINT AS upto FROM aimed
), cuts AS (
    SELECT *, floor((upto - words)::DOUBLE / (SELECT max(upto) FROM sources) * pow(2, 40))::BIGINT AS low,
        floor(upto::DOUBLE / (SELECT max(upto) FROM sources) * pow(2, 40))::BIGINT AS high FROM sources
), n_slots AS (
    SELECT (max(upto) + 2047) // 2048 AS n FROM sources
), points AS (
    SELECT i, list_sum([((i >> k) & 1) << (39 - k) FOR k IN range(40)])::BIGINT AS point
    FROM n_slots, unnest(range(n)) AS s(i)
), slots AS (
    SELECT source_no, i AS slot, row_number() OVER (PARTITION BY source_no ORDER BY i) - 1 AS block
    FROM points JOIN cuts ON low <= point AND point < high
), laid AS (
    SELECT k.*, c.source_no, source_size, target, words, epoch * source_size + coalesce(sum(size) OVER (
        PARTITION BY c.source_no, epoch ORDER BY md5(concat_ws(':', epoch, key))
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
    FROM keyed k JOIN cuts c ON k.source IS NOT DISTINCT FROM c.source, unnest([0, 1, 2]) AS e(epoch)
), placed AS (
    SELECT *, unnest(range(start::BIGINT // 2048, (least(start + size, words)::BIGINT - 1) // 2048 + 1)) AS block
    FROM laid WHERE least(start + size, words) > start
), parts AS (
    SELECT p.source_no, key, least(start + size, words, (p.block + 1) * 2048) - greatest(start, p.block * 2048) AS n,
        coalesce(slot, n_slots.n + p.block * (SELECT count(*) FROM totals) + p.source_no) AS slot
    FROM n_slots, placed p LEFT JOIN slots s ON s.source_no = p.source_no AND s.block = p.block
), per_row AS (
    SELECT source_no, key, sum(n)::BIGINT AS taken, min(slot)::BIGINT AS first_slot FROM parts GROUP BY ALL
)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken, first_slot
FROM keyed k JOIN cuts c ON k.source IS NOT DISTINCT FROM c.source
LEFT JOIN per_row r ON r.source_no = c.source_no AND r.key = k.key
"""


@query("op11_low_discrepancy_mix", OP11_SQL)
def op11_low_discrepancy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, sources weighed 5, 2, 1 in turn; a document is taken at most three times."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    taken = mixing.taken(mixing.mix(docs, weights=(5, 2, 1), limit=3))
    return taken.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "first_slot")


@query("op12_spectrum_whitening")
def op12_spectrum_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on at most 32 components."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening.whiten(rows).withColumnRenamed("id", "vec_id")


OP13_SQL = r"""
WITH RECURSIVE kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, [floor(64 * c::DOUBLE)::BIGINT FOR c IN embedding] AS x FROM embeddings
    WHERE len(embedding) = 64 AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0
), starts AS (
    SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), x) - 1 AS cluster, x FROM kept
    QUALIFY row_number() OVER (ORDER BY sha256('1:' || vec_id), x) <= 16
), rounds(k, cluster, x) AS (
    SELECT 0, cluster, x FROM starts
    UNION ALL
    (WITH near AS (
        SELECT v.r, v.x, min_by(c.cluster, list_sum([(a[1] - a[2]) ** 2 FOR a IN list_zip(v.x, c.x)]) * 16 + c.cluster) AS cluster
        FROM kept v, rounds c GROUP BY v.r, v.x
    ), sums AS (
        SELECT cluster, d, sum(x[d])::BIGINT AS s, count(*) AS n FROM near, unnest(range(1, 65)) AS t(d) GROUP BY cluster, d
    ), means AS (
        SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY d) AS x FROM sums GROUP BY cluster
    )
    SELECT DISTINCT o.k + 1, o.cluster, coalesce(m.x, o.x) FROM rounds o LEFT JOIN means m USING (cluster) WHERE o.k < 3)
), last AS (
    SELECT cluster, x FROM rounds WHERE k = 3
), near AS (
    SELECT v.r, v.vec_id, min(list_sum([(a[1] - a[2]) ** 2 FOR a IN list_zip(v.x, c.x)]) * 16 + c.cluster)::BIGINT AS best
    FROM kept v, last c GROUP BY v.r, v.vec_id
), found AS (
    SELECT vec_id, (best % 16)::INT AS cluster, best // 16 AS distance FROM near
)
SELECT vec_id, f.cluster, distance, (sum(distance) OVER (PARTITION BY f.cluster))::BIGINT AS cluster_inertia,
    (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(l.x, ',')) AS centroid_sha256
FROM found f JOIN last l ON l.cluster = f.cluster
"""


@query("op13_dimension_lloyd", OP13_SQL)
def op13_dimension_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings of 64 components, 16 clusters, three rounds."""
    found, clusters = lloyd.lloyd(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    inertia = clusters.select("*", F.sum("cluster_inertia").over(Window.partitionBy()).alias("inertia"))
    # A row per centroid, of which there are 16.
    return found.join(F.broadcast(inertia), "cluster").select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")

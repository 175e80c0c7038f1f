"""The queries of this subpackage and their SQL."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexstrata.llm.shared import stored, table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexstrata.llm.quality import quality

    return quality(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexstrata.llm.suffixes import digests

    return digests(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexstrata.llm.leaks import leaks

    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexstrata.llm.overlap import similarity_components

    return similarity_components(table(spark, sf_dir, "documents"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexstrata.llm import token_files as t
    from lexstrata.llm.token_cache import vocabulary_size

    path = tokenizer_path("word_bpe_49k.json")
    files = t.token_files(table(spark, sf_dir, "documents"), t.library_encoder(path), t.bits_for(vocabulary_size(path)), end_id=2)
    return t.token_rows(files)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexstrata.llm.substrings import digests

    return digests(table(spark, sf_dir, "documents"))


def held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexstrata.llm.toxicity import fit, score

    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"), in_training=lambda doc_id: ~held_out(doc_id))
    scored = docs.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexstrata.llm.pieces import Pieces, piece_digests

    return piece_digests(table(spark, sf_dir, "documents"), Pieces(tokenizer_path("piece_bpe_32k.model")))


def count_events(docs: DataFrame, path: str) -> dict[str, DataFrame]:
    """Batches over all documents: every count inserted; then those of texts in `lang` en revised
    to a version that also counts an end mark; then, of rows with one text, all but the first deleted
    (smallest doc_id, null last; rows that repeat a doc_id are copies too)."""
    from lexstrata.llm.token_counts import counted, later_copies

    first, second = "word_bpe_49k", "word_bpe_49k+end"
    rows = stored(counted(docs, path), "counts")
    row = lambda version, sign, n: [F.lit(version).alias("version"), F.lit(sign).alias("sign"), n.alias("n_tokens")]
    n, english = F.col("n_tokens"), F.coalesce(F.col("lang") == "en", F.lit(False))
    inserts = rows.select("source", "lang", *row(first, 1, n))
    old = rows.where(english)
    revised = old.select("source", "lang", *row(first, -1, n)).unionByName(old.select("source", "lang", *row(second, 1, n + 1)))
    deleted = later_copies(rows).select("source", "lang", F.when(english, second).otherwise(first).alias("version"), F.lit(-1).alias("sign"), (n + english.cast("long")).alias("n_tokens"), "copies")
    return {"b1": inserts, "b2": revised, "b3": deleted}


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid

    from lexstrata.llm.shared import shared_dir
    from lexstrata.llm.token_counts import Rollup

    rollup = Rollup(spark, f"{shared_dir(spark)}/lexstrata/{uuid.uuid4().hex}/rollup")
    events = count_events(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    for batch in ("b1", "b2", "b2", "b3", "b1"):  # told twice, applied once
        rollup.commit(batch, events[batch])
    return rollup.totals()


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexstrata.llm.chat import maximal_conversations

    return maximal_conversations(table(spark, sf_dir, "conversations"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexstrata.llm.balls import ball_kmeans

    return ball_kmeans(table(spark, sf_dir, "embeddings"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexstrata.llm.divergence import divergences

    return divergences(table(spark, sf_dir, "documents"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexstrata.llm.sharding import shard_digests

    return shard_digests(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_suffix_dedup, op3_decontamination, op4_jaccard_join, op5_token_files, op6_substring_dedup, op7_toxicity, op8_sentencepiece, op9_token_counts, op10_chat_formatting, op11_centroid_clustering, op12_source_divergence, op13_sharding, pipeline)}

WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

ORACLES = {
    "op2_suffix_dedup": """
        WITH docs AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
        places AS (SELECT doc_id, b, unnest(range(1, greatest(octet_length(b) - 98, 1))) AS p FROM docs),
        strings AS (SELECT doc_id, p, md5(array_slice(b, p, p + 99)) AS g FROM places),
        ranked AS (SELECT doc_id, p, row_number() OVER (PARTITION BY g ORDER BY doc_id, p) AS k FROM strings),
        late AS (SELECT doc_id, p, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS run FROM ranked WHERE k > 1),
        runs AS (SELECT doc_id, min(p) AS a, max(p) + 99 AS z FROM late GROUP BY doc_id, run),
        marked AS (SELECT *, CASE WHEN a <= max(z) OVER (PARTITION BY doc_id ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 0 ELSE 1 END AS fresh FROM runs),
        grouped AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY a) AS span FROM marked),
        spans AS (SELECT doc_id, span, min(a) AS a, max(z) AS z FROM grouped GROUP BY doc_id, span),
        gaps AS (SELECT doc_id, coalesce(lag(z) OVER w, 0) + 1 AS a, s.a - 1 AS z, s.a AS at FROM spans AS s WINDOW w AS (PARTITION BY doc_id ORDER BY s.a)
            UNION ALL SELECT doc_id, max(z) + 1, NULL, NULL FROM spans GROUP BY doc_id),
        kept AS (SELECT doc_id, string_agg(hex(array_slice(b, gaps.a, coalesce(gaps.z, octet_length(b)))), '' ORDER BY gaps.a) AS h FROM gaps JOIN docs USING (doc_id) GROUP BY doc_id),
        counts AS (SELECT doc_id, sum(z - a + 1) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
        SELECT doc_id, octet_length(b) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
            sha256(coalesce(unhex(h), b)) AS kept_sha256 FROM docs LEFT JOIN counts USING (doc_id) LEFT JOIN kept USING (doc_id)
    """,
    "op4_jaccard_join": f"""
        WITH RECURSIVE docs AS (SELECT doc_id, list_transform({WORDS}, lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS w FROM documents),
        words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p, len(w) AS n FROM docs),
        windows AS (SELECT doc_id, n, string_agg(word, ' ') OVER v AS g, count(*) OVER v AS k FROM words
            WINDOW v AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING)),
        shingles AS (SELECT DISTINCT doc_id, md5(g) AS g FROM windows WHERE k = 4
            UNION ALL SELECT doc_id, md5(array_to_string(w, ' ')) FROM docs WHERE len(w) BETWEEN 1 AND 3),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS same FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
        links AS (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * same >= 85 * (x.n + y.n - same)),
        edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach AS (SELECT a AS doc_id, b AS other FROM edges UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other),
        least AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(other, d.doc_id)) AS component_id
        FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
    """,
    "op6_substring_dedup": f"""
        WITH docs AS (SELECT doc_id, {WORDS} AS w FROM documents),
        words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM docs),
        windows AS (SELECT doc_id, p, md5(string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)) AS g,
            count(*) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS n FROM words),
        firsts AS (SELECT g, min(doc_id) AS f FROM windows WHERE n = 13 GROUP BY g HAVING min(doc_id) < max(doc_id)),
        late AS (SELECT doc_id, p FROM windows JOIN firsts USING (g) WHERE n = 13 AND doc_id > f),
        removed AS (SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS p FROM late),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN removed USING (doc_id, p) GROUP BY doc_id),
        counts AS (SELECT doc_id, count(*) AS n FROM removed GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM docs LEFT JOIN counts USING (doc_id) LEFT JOIN kept USING (doc_id)
    """,
    "op12_source_divergence": r"""
        WITH docs AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
        found AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
        kept AS (SELECT lang, term, count(*) AS total FROM found GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
        groups AS (SELECT DISTINCT lang, source FROM docs),
        counts AS (SELECT lang, source, term, count(*) AS n FROM found JOIN kept USING (lang, term) GROUP BY ALL),
        dense AS (SELECT lang, source, term, total, coalesce(n, 0) AS n FROM groups JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
        shares AS (SELECT *, 1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER g + count(*) OVER g) AS p,
            1 + (1000000000::HUGEINT * (total + 1)) // (sum(total) OVER g + count(*) OVER g) AS q FROM dense WINDOW g AS (PARTITION BY lang, source)),
        sums AS (SELECT lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
            FROM shares AS a JOIN shares AS b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
        parts AS (SELECT lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM groups AS a JOIN groups AS b USING (lang)
                LEFT JOIN sums AS s USING (lang) WHERE a.source <> b.source AND s.source = a.source AND s.item = b.source
            UNION ALL SELECT a.lang, a.source, 'pair', b.source, 0 FROM groups AS a JOIN groups AS b USING (lang)
                WHERE a.source <> b.source AND a.lang NOT IN (SELECT lang FROM kept)
            UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM shares WHERE n > 0 AND p > q),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
    """,
    "op10_chat_formatting": """
        WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
        numbered AS (SELECT *, row_number() OVER w AS k FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)),
        marked AS (SELECT *, coalesce(length(role) || ':' || role, '-') || coalesce(length(text) || ':' || text, '-') AS part,
            '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || chr(10) || '<|end|>' || chr(10) AS shown FROM numbered),
        prefixes AS (SELECT conv_id, k, max(k) OVER (PARTITION BY conv_id) AS n, string_agg(part, '') OVER (PARTITION BY conv_id ORDER BY k) AS prefix,
            string_agg(shown, '') OVER (PARTITION BY conv_id ORDER BY k) AS rendered FROM marked),
        wholes AS (SELECT *, row_number() OVER (PARTITION BY prefix ORDER BY conv_id NULLS LAST) AS copy FROM prefixes WHERE k = n)
        SELECT conv_id, CAST(n AS INTEGER) AS n_turns, rendered FROM wholes
        WHERE copy = 1 AND prefix NOT IN (SELECT prefix FROM prefixes WHERE k < n)
    """,
}

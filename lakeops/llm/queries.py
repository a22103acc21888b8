"""The operators of this package as queries with production parameters over whole tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import byte_bpe_tree, conversation_repair, i_match, line_dedup, lsh_forest, mixing, ngram_model, piece_sampling, quality_rules, spelling_variants, substring_dedup, suffix_dedup, token_files
from lakeops.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under its own name."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query()
def op1_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Word statistics of every document, the base rules, and the verdict of the learned list."""
    documents = table(spark, sf, "documents")
    labelled = quality_rules.labelled_statistics(documents, table(spark, sf, "labels"), "doc_id", "text", max_labelled=20_000)
    judged = quality_rules.judged(documents.select("doc_id", "text"), quality_rules.learn(labelled))
    s = lambda name: F.col(f"quality.s.{name}")
    return judged.select("doc_id", s("n_words"), s("word_chars"), s("n_symbols"), s("n_dup_lines"), s("n_repeat_words"), "quality.base_failed", "quality.kept", "quality.rule")


@query(
    r"""
    WITH w AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
    shingles AS (
      SELECT DISTINCT doc_id, CASE WHEN len(words) < 3 THEN array_to_string(words, ' ') ELSE array_to_string(words[pos:pos + 2], ' ') END AS s, len(words) < 3 AS short
      FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 2))) AS pos FROM w WHERE len(words) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    common AS (
      SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.short = b.short AND a.doc_id <> b.doc_id GROUP BY ALL),
    links AS (
      SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
    reach AS (
      WITH RECURSIVE r(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM r JOIN links l ON r.b = l.a) SELECT a, min(b) AS least FROM r GROUP BY a)
    SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(least, w.doc_id)) AS component_id,
           w.doc_id <= coalesce(least, w.doc_id) AS kept
    FROM w LEFT JOIN sizes s ON s.doc_id = w.doc_id LEFT JOIN reach ON reach.a = w.doc_id
    """
)
def op2_lsh_forest(spark: SparkSession, sf: str) -> DataFrame:
    """Groups of documents linked by 0.85 of their runs of three words."""
    groups = lsh_forest.near_duplicates(table(spark, sf, "documents"), shingle=3, percent=85)
    return groups.select("doc_id", "n_shingles", "component_id", "kept")


@query(
    r"""
    WITH sized AS (
      SELECT doc_id, source, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h,
             CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
      FROM documents),
    sources AS (
      SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight
      FROM sized GROUP BY source),
    filled AS (
      SELECT *, row_number() OVER o AS at, CAST(sum(source_size) OVER () AS BIGINT) - 3 * coalesce(CAST(sum(source_size) OVER e AS BIGINT), 0) AS room,
             CAST(sum(weight) OVER () AS BIGINT) - coalesce(CAST(sum(weight) OVER e AS BIGINT), 0) AS shared
      FROM sources
      WINDOW o AS (ORDER BY source_size / weight, source ASC NULLS LAST),
             e AS (ORDER BY source_size / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    n AS (SELECT count(*) FILTER (weight * room > 3 * source_size * shared) AS n_stop FROM filled),
    targets AS (
      SELECT f.source, f.source_size,
             CASE WHEN f.at <= n_stop THEN CAST(3 * f.source_size AS DOUBLE) ELSE CAST(f.weight * r.room AS DOUBLE) / r.shared END AS target
      FROM filled f, n LEFT JOIN filled r ON r.at = n.n_stop + 1),
    placed AS (
      SELECT s.doc_id, s.h, s.size, t.source_size, t.target,
             CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
      FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
    served AS (
      SELECT (k * source_size + upto) / target AS finish, h, k, size FROM placed, range(3) passes(k) WHERE size > 0),
    running AS (
      SELECT finish, h, k, sum(size) OVER (ORDER BY finish, h, k ROWS UNBOUNDED PRECEDING) AS total FROM served),
    cut AS (
      SELECT finish, h, k FROM running WHERE total > (SELECT sum(size) FROM sized) ORDER BY finish, h, k LIMIT 1)
    SELECT p.doc_id, p.size, p.source_size, p.target,
           CAST(p.size * (SELECT count(*) FROM range(3) passes(k)
                          WHERE ((k * p.source_size + p.upto) / p.target, p.h, k) < (cut.finish, cut.h, cut.k)) AS BIGINT) AS taken
    FROM placed p, cut
    """
)
def op3_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """How much of each document the mix of all sources takes."""
    return mixing.mix(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query()
def op4_i_match(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how like they are."""
    return i_match.with_edits(table(spark, sf, "documents"))


@query()
def op5_token_files(spark: SparkSession, sf: str) -> DataFrame:
    """All documents written as token files and read back."""
    import public_tokenizers

    path = scratch_path(spark, "tokens")
    token_files.write(table(spark, sf, "documents"), path, vocabulary=public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_files.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query()
def op6_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Bytes kept of every document after strings of 400 bytes that occur elsewhere."""
    return suffix_dedup.removed_bytes(table(spark, sf, "documents"), length=400).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query()
def op7_piece_sampling(spark: SparkSession, sf: str) -> DataFrame:
    """Two segmentations of every document drawn without replacement, decoded again."""
    import public_tokenizers

    drawn = piece_sampling.segmentations(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"), samples=2, alpha=0.2, seed=0)
    return drawn.drop("ids")


@query()
def op8_ngram_model(spark: SparkSession, sf: str) -> DataFrame:
    """Score of every document by the stored trigram model of the training documents."""
    return ngram_model.scores(table(spark, sf, "documents"), parts=7, part=2)


@query(
    r"""
    WITH lines AS (
      SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
      FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)),
    judged AS (
      SELECT doc_id, pos, line, length(key) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY key) AS gone FROM lines)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
    FROM judged GROUP BY doc_id
    """
)
def op9_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Lines kept of every document, by bitmaps."""
    docs = line_dedup.with_bitmaps(table(spark, sf, "documents").select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    changed = line_dedup.kept_hash(F.when(F.col("_keeps").isNotNull(), text), F.col("_keeps"))
    n_lines = F.size(line_dedup.text_lines(F.col("text"))).cast("long")
    return docs.select("doc_id", n_lines.alias("n_lines"), F.coalesce("_n_dropped", F.lit(0)).alias("n_dropped"), F.coalesce(changed, F.sha2(text, 256)).alias("kept_sha256"))


@query(
    r"""
    WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
    places AS (SELECT doc_id, len(words) AS n, words, unnest(range(1, len(words) + 1)) AS pos FROM w),
    windows AS (
      SELECT doc_id, pos, doc_id > min(doc_id) OVER (PARTITION BY array_to_string(words[pos:pos + 12], ' ')) AS again
      FROM places WHERE pos + 12 <= n),
    gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 13)) AS pos FROM windows WHERE again),
    kept AS (
      SELECT p.doc_id, count(*) FILTER (g.pos IS NOT NULL) AS n_removed,
             string_agg(p.words[p.pos], ' ' ORDER BY p.pos) FILTER (g.pos IS NULL) AS body
      FROM places p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.pos = g.pos GROUP BY p.doc_id)
    SELECT w.doc_id, CAST(len(w.words) AS BIGINT) AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.body, '')) AS kept_sha256
    FROM w LEFT JOIN kept k ON w.doc_id = k.doc_id
    """
)
def op10_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Words kept of every document after windows of 13 words seen in an earlier document."""
    return substring_dedup.repeated_words(table(spark, sf, "documents"), window=13).select("doc_id", "n_words", "n_removed", "kept_sha256")


@query()
def op11_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    """Faults and cheapest repairs of all conversations after damage."""
    return conversation_repair.repairs(conversation_repair.damaged(table(spark, sf, "conversations")), there=F.col("there"))


@query()
def op12_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    """Words of all documents, their near words, and the frequent forms that rare ones lead to."""
    counts = spelling_variants.word_counts(table(spark, sf, "documents"), spelling_variants.misspelt(97))
    return spelling_variants.variants(counts)


@query()
def op13_byte_bpe_tree(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of every document by the ranks of a byte-level vocabulary, and the bytes they decode to."""
    import public_tokenizers

    by = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    rows = byte_bpe_tree.decode(byte_bpe_tree.encode(table(spark, sf, "documents"), *by), *by)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("raw", 256).alias("decoded_sha256"))

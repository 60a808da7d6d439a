"""The registered queries: each operator over its whole table, reduced to the agreed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfloom.llm import (
    bpe,
    collocations,
    decontam,
    language,
    lattice,
    licenses,
    mixing,
    near_dup,
    quality_rules,
    resampling,
    sharding,
    spelling,
    substring,
)
from shelfloom.llm.common import load
from shelfloom.llm.registry import query

#: DuckDB expressions for the words of a text.
_BLANK = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"
_PLAIN = (
    r"regexp_extract_all(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)


@query(
    "op4_mix_sources",
    f"""
    WITH d AS (
      SELECT doc_id, source, len({_BLANK.format("text")})::BIGINT AS size,
             md5('17-' || coalesce(doc_id::VARCHAR, '')) AS k
      FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY 1),
    w AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight,
                 source_size::DOUBLE * 2.0::DOUBLE AS cap, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS total FROM s),
    l AS (SELECT *, row_number() OVER o AS turn,
                 (total - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
                 / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev
          FROM w WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)),
    t AS (SELECT source, source_size,
                 CASE WHEN cap <= lev * weight THEN cap ELSE weight *
                   (SELECT min_by(lev, turn) FROM l WHERE NOT cap <= lev * weight) END AS target FROM l),
    e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(floor(target) / source_size) ELSE 0 END::BIGINT AS epochs FROM t),
    r AS (SELECT d.*, sum(size) OVER (PARTITION BY source ORDER BY k, doc_id ROWS UNBOUNDED PRECEDING) - size AS start FROM d)
    SELECT r.doc_id, r.size, e.source_size, e.target,
           (e.epochs * r.size + greatest(0, least(r.size, floor(e.target)::BIGINT - e.epochs * e.source_size - r.start)))::BIGINT AS taken
    FROM r JOIN e ON r.source IS NOT DISTINCT FROM e.source
    """,
)
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken, _ = mixing.mix_sources(load(spark, sf_dir))
    return taken.select("doc_id", "size", "source_size", "target", "taken")


@query(
    "op8_benchmark_hits",
    f"""
    WITH d AS (SELECT doc_id, {_PLAIN.format("text")} AS w FROM documents),
    b AS (SELECT item_id, {_PLAIN.format("text")} AS w FROM benchmark),
    bw AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS g FROM (
             SELECT item_id, w, least(len(w), 10) AS m, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
             FROM b WHERE len(w) > 0)),
    dw AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS g FROM (
             SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
             FROM d, (SELECT DISTINCT m FROM bw) WHERE len(w) >= m)),
    hits AS (SELECT DISTINCT doc_id, i, m, item_id FROM dw JOIN bw USING (m, g)),
    places AS (SELECT doc_id, count(DISTINCT p)::BIGINT AS n_hit
               FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hits) GROUP BY 1),
    items AS (SELECT doc_id, count(*)::BIGINT AS n_items, sha256(string_agg(x, ',' ORDER BY x)) AS h
              FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM hits) GROUP BY 1)
    SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
)
def op8_benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(load(spark, sf_dir), load(spark, sf_dir, "benchmark"))


@query(
    "op3_near_duplicates",
    r"""
    WITH RECURSIVE d AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
                 ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS x FROM d),
    n AS (SELECT doc_id, len(x)::BIGINT AS n, x FROM s),
    e AS (SELECT doc_id, n, unnest(x) AS g FROM n),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id
          AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
          GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
    l AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
    r(x, y) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.x, l.b FROM r JOIN l ON l.a = r.y),
    c AS (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY 1)
    SELECT n.doc_id, n.n AS n_shingles, component_id, n.doc_id = component_id AS kept FROM n JOIN c USING (doc_id)
    """,
)
def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dup.near_duplicates(load(spark, sf_dir), words=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query(
    "op10_repeated_passages",
    f"""
    WITH d AS (SELECT doc_id, {_BLANK.format("text")} AS w FROM documents),
    v AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS g
          FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
    o AS (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS nth FROM v),
    gone AS (SELECT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM o WHERE nth > 1) GROUP BY 1, 2),
    t AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
    k AS (SELECT t.doc_id, count(gone.p)::BIGINT AS n_removed,
                 string_agg(CASE WHEN gone.p IS NULL THEN x END, ' ' ORDER BY t.p) AS kept
          FROM t LEFT JOIN gone ON gone.doc_id = t.doc_id AND gone.p = t.p GROUP BY 1)
    SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM d LEFT JOIN k USING (doc_id)
    """,
)
def op10_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substring.without_repeats(load(spark, sf_dir))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op1_kd_shards")
def op1_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir).withColumn("text_crc32", F.crc32("text"))
    return sharding.kd_shards(docs, shards=16, columns=["doc_id", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir)
    held_out = language.fold(F.col("doc_id"), 3) == 1
    tagger = language.train_tagger(docs.filter(~held_out))
    tagged = language.tag_languages(docs.select("doc_id", "text"), tagger, "lang_pred", "score")
    return tagged.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op7_adaptive_rules")
def op7_adaptive_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judged(load(spark, sf_dir))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op9_lattice_score")
def op9_lattice_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir)
    held_out = language.fold(F.col("doc_id"), 7) == 2
    return lattice.scores(docs, lattice.train(docs.filter(~held_out)), held_out)


@query("op2_license_scan")
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.labelled(load(spark, sf_dir))


@query("op5_importance_resampling")
def op5_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = load(spark, sf_dir, "labels").filter("quality = 1 AND toxic = 0")
    return resampling.resample(load(spark, sf_dir), good)


@query("op11_spelling_variants")
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(load(spark, sf_dir))


@query("op12_bpe_round_trip")
def op12_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.Vocabulary.read()
    encoded = bpe.encoded(load(spark, sf_dir).select("doc_id", "text"), vocabulary).drop("text")
    return bpe.decoded(encoded, vocabulary).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


@query(
    "op13_collocations",
    r"""
    WITH p AS MATERIALIZED (
      SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
    g AS (SELECT lang, 1 AS m, unnest(w) AS g FROM p
          UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM p
          UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM p),
    f AS MATERIALIZED (SELECT lang, m, g, count(*)::BIGINT AS a FROM g GROUP BY ALL),
    t AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE m = 1 GROUP BY 1),
    c AS MATERIALIZED (SELECT lang, m, a, g, string_split(g, ' ') AS w FROM f WHERE m >= 2 AND a >= 10),
    k AS (SELECT *, 1 AS k, w[1] AS x, array_to_string(w[2:], ' ') AS y FROM c
          UNION ALL SELECT *, 2, w[1] || ' ' || w[2], w[3] FROM c WHERE m = 3),
    cuts AS (SELECT k.lang, k.g, k.a, k, x.a AS l, y.a AS r, (1000000::HUGEINT * k.a * k.a) // (x.a::HUGEINT * y.a) AS score
             FROM k JOIN f x ON x.lang = k.lang AND x.g = k.x JOIN f y ON y.lang = k.lang AND y.g = k.y),
    best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
    parts AS (SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS g FROM c WHERE m = 3),
    gone AS (SELECT DISTINCT c.lang, c.g FROM c JOIN parts b ON b.lang = c.lang AND b.g = c.g WHERE 100 * b.a >= 50 * c.a),
    ranked AS (SELECT lang, g AS phrase, a, l, r, score::BIGINT AS score FROM best ANTI JOIN gone USING (lang, g))
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase, a, l, r, n, score
    FROM ranked JOIN t USING (lang) QUALIFY rank <= 2000
    """,
)
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(load(spark, sf_dir))

"""The registered query of each operator, on whole tables."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketspark.llm import bpe, byte_cnn, centroids, embeddings, language_model, mixing, prefix_trie, quality_rules, repeated_bytes, simhash, substrings, token_files, toxicity
from marketspark.llm.training import remainder
from marketspark.sources.scratch import new_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _judged(scored: DataFrame, held_out: Column, cut: float) -> DataFrame:
    more = [name for name in scored.columns if name not in ("doc_id", "score")]
    held = F.coalesce(held_out, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held, "score", (F.col("score") >= cut).cast("int").alias("predicted"), *more)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digests(_table(spark, sf_dir, "documents"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, fold = _table(spark, sf_dir, "documents"), remainder("doc_id", 4)
    model = byte_cnn.learn(docs, _table(spark, sf_dir, "labels"), rows=fold != 2)
    return _judged(byte_cnn.score(docs, model), fold == 2, 0.7)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(_table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, fold = _table(spark, sf_dir, "documents"), remainder("doc_id", 5)
    model = toxicity.learn(docs, _table(spark, sf_dir, "labels"), rows=fold != 0)
    return _judged(toxicity.score(docs, model), fold == 0, 0.5)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark)
    token_files.write_tokens(_table(spark, sf_dir, "documents"), folder)
    return token_files.checksums(spark, folder)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(_table(spark, sf_dir, "documents"))


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_corpus(_table(spark, sf_dir, "documents"), remainder("doc_id", 7) == 2)


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op11_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes.digests(_table(spark, sf_dir, "documents"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(_table(spark, sf_dir, "embeddings"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (op1_quality_rules, op2_substring_dedup, op3_simhash_near_dedup, op4_byte_cnn, op5_bpe, op6_toxicity, op7_token_files, op8_mixing, op9_language_model, op10_embedding_near_dedup, op11_suffix_array_dedup, op12_centroid_clustering, op13_prefix_trie)
}


def _rounds() -> str:
    """The rounds of op12 one behind the other, each as one more table expression."""
    near = """SELECT * FROM (SELECT r.nr, vec_id, v, k, centre, list_sum(list_transform(range(1, {n} + 1), lambda i: (v[i] - centre[i]) * (v[i] - centre[i])))::BIGINT AS distance
                   FROM whole r, c{t}) QUALIFY row_number() OVER (PARTITION BY nr ORDER BY distance, k) = 1"""
    step = """SELECT k, list(m ORDER BY i) AS centre
              FROM (SELECT c{t}.k, i, CASE WHEN count(a.nr) = 0 THEN any_value(c{t}.centre[i]) ELSE ((sum(v[i]) - ((sum(v[i]) % count(a.nr)) + count(a.nr)) % count(a.nr)) / count(a.nr))::BIGINT END AS m
                    FROM c{t} CROSS JOIN (SELECT unnest(range(1, {n} + 1)) AS i) LEFT JOIN a{t} a ON a.k = c{t}.k GROUP BY c{t}.k, i) GROUP BY k"""
    parts = []
    for t in range(centroids.ROUNDS + 1):
        if t:
            parts.append(f"c{t} AS MATERIALIZED (" + step.format(t=t - 1, n=centroids.SIZE).replace("/ count(a.nr))::", "// count(a.nr))::") + ")")
        parts.append(f"a{t} AS MATERIALIZED (" + near.format(t=t, n=centroids.SIZE) + ")")
    return ",\n".join(parts)


def _crc_table() -> str:
    """The 256 remainders of CRC-32, by its polynomial."""
    table = []
    for byte in range(256):
        for _ in range(8):
            byte = (byte >> 1) ^ (0xEDB88320 if byte & 1 else 0)
        table.append(byte)
    return f"{table}::BIGINT[]"


ORACLES = {
    "op11_suffix_array_dedup": f"""
    WITH hexed AS (SELECT row_number() OVER () AS nr, doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
         pieces AS (SELECT nr, 1000 * unnest(range(0, len(h) // 2000 + 1)) AS base, h FROM hexed),
         chunks AS (SELECT nr, base, substr(h, 2 * base + 1, 2000 + 2 * {repeated_bytes.LENGTH}) AS c FROM pieces),
         windows AS (SELECT nr, base + step AS place, md5_number(substr(c, 2 * step + 1, 2 * {repeated_bytes.LENGTH})) AS w
                     FROM (SELECT nr, base, c, unnest(range(0, least(1000, len(c) // 2 - {repeated_bytes.LENGTH} + 1))) AS step FROM chunks)),
         again AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
         hits AS (SELECT nr, place, place - lag(place) OVER (PARTITION BY nr ORDER BY place) AS gap FROM windows SEMI JOIN again USING (w)),
         runs AS (SELECT nr, place, sum(CASE WHEN gap <= {repeated_bytes.LENGTH} THEN 0 ELSE 1 END) OVER (PARTITION BY nr ORDER BY place) AS run FROM hits),
         spans AS (SELECT nr, min(place) AS b, max(place) + {repeated_bytes.LENGTH} AS e FROM runs GROUP BY nr, run),
         parts AS (SELECT nr, e AS b, lead(b) OVER (PARTITION BY nr ORDER BY b) AS e FROM spans UNION ALL SELECT nr, 0, min(b) FROM spans GROUP BY nr),
         kept AS (SELECT nr, string_agg(CASE WHEN e IS NULL THEN substr(h, 2 * b + 1) ELSE substr(h, 2 * b + 1, 2 * (e - b)) END, '' ORDER BY b) AS k FROM parts JOIN hexed USING (nr) GROUP BY nr),
         counts AS (SELECT nr, count(*) AS n_spans, sum(e - b)::BIGINT AS n_removed FROM spans GROUP BY nr)
    SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
    FROM hexed LEFT JOIN kept USING (nr) LEFT JOIN counts USING (nr)
    """,
    "op12_centroid_clustering": f"""
    WITH whole AS (SELECT row_number() OVER () AS nr, vec_id, list_transform(embedding, lambda x: floor({centroids.SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
                   WHERE len(embedding) = {centroids.SIZE} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
         c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY digest) - 1 AS k, v AS centre
                             FROM (SELECT v, sha256('{centroids.SEED}:' || vec_id) AS digest FROM whole ORDER BY digest LIMIT {centroids.CLUSTERS})),
         {_rounds()}
    SELECT vec_id, k::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY k))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
           sha256(array_to_string(centre, ',')) AS centroid_sha256
    FROM a{centroids.ROUNDS}
    """,
    "op13_prefix_trie": f"""
    WITH own AS (SELECT conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) ORDER BY turn NULLS FIRST) AS turns FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
         steps AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
                                             lambda crc, b: xor(crc >> 8, ({_crc_table()})[(xor(crc, b) & 255) + 1])), 4294967295) % 6 AS h FROM own),
         whole AS (SELECT a.conv_id, coalesce(b.turns, [])[1:a.h] || a.turns[a.h + 1:] AS seq FROM steps a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 100),
         prefixes AS (SELECT conv_id, seq, unnest(range(len(seq) + 1)) AS depth FROM whole),
         nodes AS (SELECT seq[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                          coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(seq) = depth), '') AS ends FROM prefixes GROUP BY ALL),
         sized AS (SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.path[1:n.depth] = n.path) AS n_children
                   FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]),
         above AS (SELECT *, unnest(range(depth + 1)) AS up FROM sized),
         sums AS (SELECT path[1:up] AS path, count(*) FILTER (n_children = 0) AS n_leaves,
                         sum(CASE WHEN depth > 0 THEN (n_convs - 1) * length(path[depth].t) ELSE 0 END) AS saved_tokens FROM above GROUP BY path[1:up])
    SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(ends) AS ends_sha256
    FROM sized JOIN sums USING (path)
    """,
    "op8_mixing": f"""
    WITH counted AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{mixing.WORD}'))::BIGINT AS n_words FROM documents),
         sources AS (SELECT source, sum(n_words)::BIGINT AS tokens FROM counted GROUP BY source),
         ends AS (SELECT max(tokens)::DOUBLE AS largest, min(tokens) FILTER (tokens > 0) AS smallest FROM sources),
         chosen AS (SELECT min(step) / {mixing.STEPS}e0 AS alpha
                    FROM (SELECT unnest(range(0, {mixing.STEPS} + 1)) AS step), ends
                    WHERE pow(largest / smallest, 1 - step / {mixing.STEPS}e0) <= {mixing.MAX_REPEATS}),
         reading AS (SELECT source, tokens, CASE WHEN tokens > 0 THEN round(pow(largest / tokens, 1 - alpha), 9) ELSE 1e0 END AS repeats
                     FROM sources, ends, chosen),
         size AS (SELECT greatest(1, ceil(round(sum(repeats * tokens)) / {mixing.BLOCK_TOKENS})) AS blocks FROM reading),
         copies AS (SELECT counted.*, tokens, repeats, unnest(range(0, floor(repeats)::INTEGER + 1)) AS epoch
                    FROM counted JOIN reading ON counted.source IS NOT DISTINCT FROM reading.source),
         placed AS (SELECT *, coalesce(sum(n_words) OVER (PARTITION BY source, epoch ORDER BY md5('{mixing.SEED}/' || epoch || '/' || doc_id)
                                                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM copies)
    SELECT doc_id, source, n_words, epoch::INTEGER AS epoch,
           least(blocks - 1, floor((epoch * tokens + before) / (repeats * greatest(tokens, 1)) * blocks))::BIGINT AS block,
           md5('block/{mixing.SEED}/' || epoch || '/' || doc_id) AS place
    FROM placed, size
    WHERE epoch < floor(repeats) OR before < (repeats - floor(repeats)) * tokens
    """,
    "op2_substring_dedup": f"""
    WITH cut AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{mixing.WORD}') AS words FROM documents),
         places AS (SELECT doc_id, words, unnest(range(1, len(words) - {substrings.WINDOW} + 2)) AS place FROM cut),
         windows AS (SELECT doc_id, place, array_to_string(words[place:place + {substrings.WINDOW - 1}], ' ') AS passage FROM places),
         firsts AS (SELECT passage, min(doc_id) AS least FROM windows GROUP BY passage),
         gone AS (SELECT DISTINCT doc_id, place + step AS place
                  FROM windows JOIN firsts USING (passage), (SELECT unnest(range({substrings.WINDOW})) AS step) WHERE least < doc_id),
         single AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM cut),
         kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS passage
                  FROM single ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
    SELECT doc_id, len(words)::BIGINT AS n_words, len(words)::BIGINT - coalesce(n, 0) AS n_removed,
           sha256(coalesce(passage, '')) AS kept_sha256
    FROM cut LEFT JOIN kept USING (doc_id)
    """,
    "op10_embedding_near_dedup": f"""
    WITH RECURSIVE vectors AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
         sized AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS size FROM vectors),
         usable AS (SELECT * FROM sized WHERE size > 0 AND isfinite(size)),
         links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y ON x.vec_id <> y.vec_id
                   WHERE list_dot_product(x.v, y.v) / (x.size * y.size) >= {embeddings.THRESHOLD}),
         reached AS (SELECT vec_id AS a, vec_id AS b FROM vectors UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a)
    SELECT a AS vec_id, (SELECT count(*) FROM links WHERE links.a = reached.a) AS n_links, min(b) AS component_id, min(b) = a AS kept
    FROM reached GROUP BY a
    """,
}

"""The operators over their whole tables, with their SQL twins where SQL can say them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.llm import (
    alignment,
    collocations,
    decontaminate,
    jaccard_join,
    language_id,
    license_scan,
    nearest,
    pieces,
    secret_scan,
    sentencepieces,
    sharding,
    substring_dedup,
    token_counts,
    toxicity,
)
from gristmill.llm.columns import prepared, remainder
from gristmill.plans.registry import Query

LLM_QUERIES: dict[str, Query] = {}


def query(sql: str | None = None):
    def register(run):
        def ready(spark: SparkSession, folder: str) -> DataFrame:
            return run(prepared(spark), folder)

        ready.__name__, ready.__doc__ = run.__name__, run.__doc__
        LLM_QUERIES[run.__name__] = Query(ready, sql)
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query()
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rest = remainder(F.col("doc_id"), 5)
    model = toxicity.fit(docs, table(spark, folder, "labels").where(rest != 0))
    found = toxicity.score(docs, model)
    held = F.coalesce(rest == 0, F.lit(False))
    return found.select(
        "doc_id", held.alias("held_out"), "score", toxicity.predicted(F.col("score")).alias("predicted")
    )


@query()
def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    model = pieces.read_model(pieces.default_path())
    return token_counts.token_counts(table(spark, folder, "documents"), model)


@query()
def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, folder, "documents"))

    def text(spans: F.Column) -> F.Column:
        one = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
        return F.concat_ws(",", F.transform(spans, one))

    spans = F.col("found")
    base = F.filter(spans, lambda x: x["kind"] != "guess")
    of = lambda kind: F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        of("assign").alias("n_assign"),
        of("access").alias("n_access"),
        of("hex").alias("n_hex"),
        of("guess").alias("n_guess"),
        F.sha2(text(base).cast("binary"), 256).alias("base_sha256"),
        text(spans).alias("spans"),
    )


OP4_SQL = """
WITH words AS (
    SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+') AS w FROM documents
), has AS (
    SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS g
    FROM words WHERE len(w) >= 5
), iwords AS (
    SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+') AS w FROM benchmark
), held AS (
    SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS g
    FROM iwords WHERE len(w) >= 5
), sizes AS (SELECT item_id, count(*) AS n FROM held GROUP BY item_id)
SELECT doc_id, item_id, count(*) / any_value(n)::DOUBLE AS containment
FROM has JOIN held USING (g) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id HAVING count(*) / any_value(n)::DOUBLE >= 0.8
"""


@query(OP4_SQL)
def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.withColumnRenamed("item", "item_id")


@query()
def op5_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    model = pieces.read_model(pieces.default_path())
    return sentencepieces.encode_documents(table(spark, folder, "documents"), model)


@query()
def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    rest = remainder(F.col("doc_id"), 3)
    model = language_id.fit(docs.where(rest != 1))
    found = language_id.identify(docs, model, spans=False)
    held = F.coalesce(rest == 1, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")



OP7_SQL = """
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+') AS w FROM documents
), sets AS (
    SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS s
    FROM words WHERE len(w) > 0
), nodes AS (
    SELECT s, min(doc_id) AS node, count(DISTINCT doc_id) AS copies FROM sets GROUP BY s
), grams AS (
    SELECT node, len(s) AS n, unnest(s) AS g FROM nodes
), pairs AS (
    SELECT a.node AS a, b.node AS b FROM grams a JOIN grams b ON a.g = b.g AND a.node <> b.node
    GROUP BY a.node, b.node HAVING count(*) / (any_value(a.n) + any_value(b.n) - count(*))::DOUBLE >= 0.8
), reach AS (
    SELECT node AS a, node AS b FROM nodes
    UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON p.a = r.b
), roots AS (SELECT a AS node, min(b) AS root FROM reach GROUP BY a
), classes AS (
    SELECT root, sum(copies)::BIGINT AS size FROM roots JOIN nodes USING (node) GROUP BY root
), links AS (SELECT a AS node, count(*) AS n FROM pairs GROUP BY a)
SELECT d.doc_id, coalesce(r.root, d.doc_id) AS class_id, coalesce(c.size, 1) AS class_size,
    coalesce(l.n, 0) AS n_links, coalesce(n.copies - 1, 0) AS n_copies
FROM documents d LEFT JOIN sets s USING (doc_id) LEFT JOIN nodes n ON n.s = s.s LEFT JOIN roots r ON r.node = n.node
LEFT JOIN classes c ON c.root = r.root LEFT JOIN links l ON l.node = n.node
"""


@query(OP7_SQL)
def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, folder, "documents"))


_ROWS = ", ".join("('" + name + "', '" + body.replace("'", "''") + "')" for name, body in license_scan.TEMPLATES.items())
OP8_SQL = f"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+') AS w FROM documents
), has AS (
    SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS g
    FROM words WHERE len(w) >= 5
), twords AS (
    SELECT license, regexp_extract_all(lower(body), '[\\p{{L}}\\p{{N}}]+') AS w FROM (VALUES {_ROWS}) t(license, body)
), held AS (
    SELECT DISTINCT license, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS g
    FROM twords
), sizes AS (SELECT license, count(*) AS n FROM held GROUP BY license)
SELECT doc_id, license, count(*) / any_value(n)::DOUBLE AS containment
FROM has JOIN held USING (g) JOIN sizes USING (license)
GROUP BY doc_id, license HAVING count(*) / any_value(n)::DOUBLE >= 0.8
"""


@query(OP8_SQL)
def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.find_licenses(table(spark, folder, "documents"))


@query()
def op9_nearest(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    return nearest.nearest(rows, F.col("vec_id") % 50 == 0)


SHARD_BYTES = 1 << 20

OP10_SQL = f"""
WITH rows AS (
    SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
        ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':' || coalesce(md5(text), 'null')), 1, 15))::BIGINT AS h
    FROM documents
), sums AS (
    SELECT depth, h >> (60 - depth) AS bucket, sum(n_bytes) AS total, min(h) AS low, max(h) AS high
    FROM rows, (SELECT unnest(range(0, 61))::INT AS depth) GROUP BY ALL
), ends AS (
    SELECT depth, bucket FROM sums WHERE total <= {SHARD_BYTES} OR low = high
), placed AS (
    SELECT doc_id, h, n_bytes, min(depth) AS depth
    FROM (SELECT *, h >> (60 - d) AS bucket FROM rows, (SELECT unnest(range(0, 61))::INT AS d)) r
    JOIN ends e ON e.depth = r.d AND e.bucket = r.bucket GROUP BY ALL
)
SELECT doc_id, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(h >> (60 - depth)), depth, '0') END AS shard,
    depth, 0::BIGINT AS page, n_bytes FROM placed
"""


@query(OP10_SQL)
def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign_shards(table(spark, folder, "documents"), SHARD_BYTES)


OP11_SQL = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), starts AS (
    SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words WHERE len(w) >= 35
), windows AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY array_to_string(w[i:i + 34], ' ')) AS n FROM starts
), gone AS (
    SELECT doc_id, list(DISTINCT j) AS js
    FROM (SELECT doc_id, unnest(range(i, i + 35)) AS j FROM windows WHERE n > 1) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(js), 0)::BIGINT AS n_removed,
    sha256(array_to_string(CASE WHEN js IS NULL THEN w
        ELSE list_transform(list_filter(range(1, len(w) + 1), lambda j: NOT list_contains(js, j)), lambda j: w[j]) END,
        ' ')) AS kept_sha256
FROM words LEFT JOIN gone USING (doc_id)
"""


@query(OP11_SQL)
def op11_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, folder, "documents"))


OP12_SQL = r"""
WITH pieces AS (
    SELECT lang, regexp_extract_all(x, '[^\x20\x09]+') AS w FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) AS x FROM documents)
), grams AS (
    SELECT lang, k, array_to_string(g, ' ') AS phrase, count(*) AS c, any_value(g) AS g FROM (
        SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS g
        FROM pieces, (VALUES (1), (2), (3)) v(k) WHERE len(w) >= k)
    GROUP BY lang, k, g
), totals AS (SELECT lang, sum(c)::BIGINT AS n FROM grams WHERE k = 1 GROUP BY lang
), candidates AS (SELECT * FROM grams WHERE k >= 2 AND c >= 10
), parts AS (
    SELECT *, array_to_string(g[1:j], ' ') AS first, array_to_string(g[j + 1:k], ' ') AS rest
    FROM candidates, (VALUES (1), (2)) v(j) WHERE j < k
), cuts AS (
    SELECT p.lang, p.phrase, p.k, p.c AS a, j, f.c AS l, r.c AS r,
        (1000000::HUGEINT * p.c * p.c) // (f.c::HUGEINT * r.c) AS score
    FROM parts p JOIN grams f ON f.lang = p.lang AND f.phrase = p.first
    JOIN grams r ON r.lang = p.lang AND r.phrase = p.rest
), scored AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, k, phrase ORDER BY score, j) = 1
), inside AS (
    SELECT lang, phrase, max(c) AS around FROM (
        SELECT lang, c, unnest([array_to_string(g[1:2], ' '), array_to_string(g[2:3], ' ')]) AS phrase
        FROM candidates WHERE k = 3) GROUP BY lang, phrase
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
    phrase, a, l, r, n, score::BIGINT AS score
FROM scored JOIN totals USING (lang) LEFT JOIN inside USING (lang, phrase)
WHERE around IS NULL OR 100 * around < 50 * a
QUALIFY rank <= 2000
"""


@query(OP12_SQL)
def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


@query()
def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    files = alignment.read_files(
        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    )
    return alignment.align_documents(table(spark, folder, "documents"), *files, public_tokenizers.PATTERN)

"""The registered queries of the training-data operators, and the SQL they must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlake.llm import (
    ann,
    bpe,
    exactdedup,
    jaccard,
    linededup,
    mixing,
    pii,
    quality,
    sharding,
    substrings,
    tokenalign,
    urlfilter,
    veccodes,
)
from plantlake.llm.common import stored, table
from plantlake.session import fresh_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


# --- 2: sharding -------------------------------------------------------------

#: The byte limit of a shard in the query.
SHARD_LIMIT = 8 * 1024 * 1024


@query
def op2_sharding(spark, sf_dir):
    """Every document's shard, by extendible hashing of its id."""
    return sharding.shard_rows(table(spark, sf_dir, "documents"), SHARD_LIMIT)


def sharding_sql(limit: int) -> str:
    """All prefixes of all depths that a bucket could have; unique ids."""
    return f"""
    WITH d AS (
      SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS bytes,
        CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
      FROM documents),
    p AS (
      SELECT depth, h >> (60 - depth) AS slot, sum(bytes) AS bytes, count(*) AS n
      FROM d, (SELECT unnest(range(0, 41)) AS depth) GROUP BY ALL),
    b AS (
      SELECT c.* FROM p c LEFT JOIN p up ON up.depth = c.depth - 1 AND up.slot = c.slot >> 1
      WHERE (c.bytes <= {limit} OR c.n = 1) AND (c.depth = 0 OR up.bytes > {limit} AND up.n > 1))
    SELECT d.doc_id, d.bytes, b.depth, right(lpad(bin(b.slot), 60, '0'), b.depth) AS shard,
      CAST(b.bytes AS BIGINT) AS shard_bytes, b.n AS shard_rows
    FROM d JOIN b ON b.slot = d.h >> (60 - b.depth)
    """


ORACLE["op2_sharding"] = sharding_sql(SHARD_LIMIT)

# --- 6: mixing ---------------------------------------------------------------


@query
def op6_mixing(spark, sf_dir):
    """What a mix of all sources at weights 1, 2, 3 takes of each document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    queue = stored(mixing.queued(docs), "mix-queue")
    taken = mixing.mix(queue).groupBy("row").agg(F.sum("taken").alias("taken"))
    return queue.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


ORACLE["op6_mixing"] = r"""
    WITH d AS (
      SELECT doc_id, source,
        CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
        md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
      FROM documents),
    s AS (
      SELECT source, sum(size)::BIGINT AS source_size,
        1.0::DOUBLE + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 AS w,
        row_number() OVER (ORDER BY encode(source) NULLS LAST) AS place
      FROM d GROUP BY source),
    l AS (
      SELECT *, row_number() OVER o AS turn,
        ((sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
          / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS level
      FROM s WINDOW o AS (ORDER BY source_size / w, place)),
    t AS (
      SELECT source, source_size,
        CASE WHEN 3 * source_size <= level * w THEN (3 * source_size)::DOUBLE
          ELSE w * (SELECT level FROM l WHERE NOT 3 * source_size <= level * w ORDER BY turn LIMIT 1) END AS target
      FROM l),
    q AS (
      SELECT d.*, source_size, target,
        sum(size) OVER (PARTITION BY place ORDER BY substr(h, 1, 15), doc_id) - size AS ahead
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source JOIN (SELECT source AS name, place FROM s) ON d.source IS NOT DISTINCT FROM name)
    SELECT doc_id, size, source_size, target,
      (greatest(0, least(size, floor(target) - ahead)) + greatest(0, least(size, floor(target) - ahead - source_size))
        + greatest(0, least(size, floor(target) - ahead - 2 * source_size)))::BIGINT AS taken
    FROM q
    """

# --- 9: URL filters ----------------------------------------------------------

URL_RULES = [
    urlfilter.Rule("allow", "org", "/"),
    urlfilter.Rule("block", "example.org", "/es/"),
    urlfilter.Rule("block", "example.org", "/en/1"),
    urlfilter.Rule("allow", "com", "/fr/"),
    urlfilter.Rule("block", "com", "/de/"),
]


@query
def op9_url_filters(spark, sf_dir):
    """Every page's rule and verdict, through a Bloom filter cascade."""
    return urlfilter.judge(table(spark, sf_dir, "pages"), URL_RULES)


ORACLE["op9_url_filters"] = r"""
    WITH p AS (
      SELECT page_id,
        translate(coalesce(regexp_extract(url, '(?s)\A.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '(?s)\A.*?://[^/?#]*([^?#]*)', 1), '') AS path
      FROM pages),
    r AS (
      SELECT *, CASE
        WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
        WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
        WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
        WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
        WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
      FROM p)
    SELECT *, CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
    FROM r
    """

# --- 10: exact dedup ---------------------------------------------------------


@query
def op10_exact_dedup(spark, sf_dir):
    """Every document's group of equal texts, through a digest index that starts empty."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    index = exactdedup.DigestIndex(spark, fresh_path(spark, "digest-index"))
    return index.add(docs).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


ORACLE["op10_exact_dedup"] = """
    WITH d AS (
      SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
      FROM documents)
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
      doc_id = max(doc_id) OVER g AS kept, text_sha256
    FROM d WINDOW g AS (PARTITION BY text_sha256)
    """

# --- 8: BPE encoding and decoding --------------------------------------------


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op8_bpe(spark, sf_dir):
    """Every document's ids and what they decode to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(bpe.encode(docs, vocabulary(), with_text=True))

# --- 4: n-gram Jaccard join --------------------------------------------------


@query
def op4_ngram_jaccard(spark, sf_dir):
    """Every document's near-duplicate component."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


ORACLE["op4_ngram_jaccard"] = r"""
    WITH RECURSIVE w AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
      FROM documents),
    g AS (
      SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS gram
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(1, len(ws) - 4) + 1)) AS i FROM w WHERE len(ws) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
    o AS (
      SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
      FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
    l AS (
      SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * c >= 80 * (x.n + y.n - c)),
    r AS (SELECT doc_id AS id, doc_id AS root FROM documents UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.id AND r.root < l.b)
    SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(root) FROM r WHERE r.id = d.doc_id) AS component_id
    FROM documents d LEFT JOIN n USING (doc_id)
    """

# --- 5: line dedup -----------------------------------------------------------


@query
def op5_line_dedup(spark, sf_dir):
    """Every document without the lines that a later document repeats for it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    index = linededup.LineIndex(spark, fresh_path(spark, "line-index"))
    index.insert(docs)
    return index.apply(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


ORACLE["op5_line_dedup"] = r"""
    WITH l AS (
      SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
      FROM documents),
    k AS (
      SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
    c AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
    m AS (SELECT k.*, c.key IS NOT NULL AND doc_id <> last AS gone FROM k LEFT JOIN c USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
    FROM m GROUP BY doc_id
    """

# --- 3: quality classifier ---------------------------------------------------


@query
def op3_quality_classifier(spark, sf_dir):
    """Every document's quality and toxicity; hosts are sources, paths their languages."""
    return quality.classify(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.col("source"), F.col("lang")
    )

# --- 1: approximate nearest neighbours ---------------------------------------


@query
def op1_nearest(spark, sf_dir):
    """The ten nearest vectors of every hundredth one."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)

# --- 7: substring dedup ------------------------------------------------------


@query
def op7_substring_dedup(spark, sf_dir):
    """Every passage of 50 words or more that an earlier document holds as well."""
    return substrings.repeated_passages(table(spark, sf_dir, "documents"))

# --- 13: vector code compression ----------------------------------------------


@query
def op13_vector_codes(spark, sf_dir):
    """Every vector's code and error, after four rounds on four codebooks."""
    coded, books = veccodes.compress(table(spark, sf_dir, "embeddings"))
    told = veccodes.with_label_error(coded)
    return told.select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256() if books else None).alias("codebooks_sha256")
    )


def vector_codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Distances to all entries, a round after the other; sums stay below 2^53, so doubles are exact."""
    near = lambda r: f"""
    a{r} AS MATERIALIZED (
      SELECT row, part, any_value(y) AS y,
        min({{'d': list_dot_product(y, y) - 2 * list_dot_product(y, c) + list_dot_product(c, c), 'e': e}}) AS best
      FROM p JOIN c{r} USING (part) GROUP BY row, part)"""  # noqa: E731
    better = lambda r: f"""
    m{r} AS (
      SELECT part, e, list(v ORDER BY j) AS c FROM (
        SELECT part, best.e AS e, j, floor(sum(y[j]) / count(*)) AS v
        FROM (SELECT *, unnest(range(1, len(y) + 1)) AS j FROM a{r}) GROUP BY ALL)
      GROUP BY ALL),
    c{r + 1} AS MATERIALIZED (
      SELECT part, e, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} USING (part, e))"""  # noqa: E731
    steps = ",".join(near(r) + "," + better(r) for r in range(rounds))
    return f"""
    WITH v AS (
      SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS row,
        [floor({veccodes.SCALE} * CAST(x AS DOUBLE)) FOR x IN embedding] AS ints
      FROM embeddings WHERE len(embedding) = len([x FOR x IN embedding IF isfinite(x)])),
    p AS MATERIALIZED (
      SELECT row, vec_id, part, ints[part * len(ints) // {parts} + 1 : (part + 1) * len(ints) // {parts}] AS y
      FROM v, (SELECT unnest(range({parts})) AS part)),
    c0 AS MATERIALIZED (SELECT part, row - 1 AS e, y AS c FROM p WHERE row <= {entries}),{steps},{near(rounds)},
    s AS (
      SELECT row, string_agg(right('0' || hex(best.e), 2), '' ORDER BY part) AS code,
        CAST(sum(best.d) AS BIGINT) AS error
      FROM a{rounds} GROUP BY row)
    SELECT vec_id, lower(code) AS code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
      (SELECT sha256(string_agg(array_to_string([CAST(x AS BIGINT) FOR x IN c], ','), ',' ORDER BY part, e)) FROM c{rounds}) AS codebooks_sha256
    FROM v JOIN s USING (row)
    """


ORACLE["op13_vector_codes"] = vector_codes_sql()

# --- 11: cross-tokenizer alignment ---------------------------------------------


@query
def op11_token_alignment(spark, sf_dir):
    """How two tokenizers' tokens meet in every document, and how usual those meetings are."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    files = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return tokenalign.align(docs, *files)

# --- 12: personal data -----------------------------------------------------------


@query
def op12_pii(spark, sf_dir):
    """Every document's personal data: the patterns' spans, and those a CRF adds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find(docs, pii.fit(pii.labelled(docs)))

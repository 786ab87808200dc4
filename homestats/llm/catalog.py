"""The registered queries of this subpackage and their DuckDB SQL.

Each query applies its operator, with production parameters, to whole tables.
``QUERIES`` maps a name to ``(spark, sf_dir) -> DataFrame``; ``ORACLES`` holds SQL
where SQL can express the result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homestats.llm import ann, centroids, collocations, linededup, mixing, neardup, packing, passages, quality, secret_scan, sequencefile, tokencount, warc
from homestats.llm.common import scratch_path, table

#: Bytes of a batch that goes to a Python worker: texts can be long.
BATCH_BYTES = 16 << 20

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


_MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sized GROUP BY source
), weighed AS (
  SELECT source, source_size, [3.0, 1.0, 2.0][place % 3 + 1]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS cap FROM sources
), ordered AS (
  SELECT *, cap / weight AS fills_at, row_number() OVER w AS nth,
    (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS rest,
    sum(weight) OVER () - coalesce(sum(weight) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS rest_weight
  FROM weighed WINDOW w AS (ORDER BY cap / weight, source NULLS LAST)
), level AS (
  SELECT arg_min(rest / rest_weight, nth) AS filling FROM ordered WHERE rest / rest_weight <= fills_at
), targets AS (
  SELECT source, source_size, coalesce(least(cap, filling * weight), cap)::DOUBLE AS target FROM ordered, level
), rated AS (
  SELECT doc_id, sized.source, size, source_size, target,
    CASE WHEN source_size > 0 THEN target / source_size::DOUBLE ELSE 0.0::DOUBLE END AS rate
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
), taken AS (
  SELECT *, floor(rate)::BIGINT + (CASE WHEN
    ('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, '\N') || ':' || coalesce(source, '\N') || ':' || size), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE
      < rate - floor(rate) THEN 1 ELSE 0 END) AS copies
  FROM rated
)
SELECT doc_id, source, size, source_size, target, rate, copies, (size * copies)::BIGINT AS taken FROM taken
"""


@query("op1_mix_sources", _MIX_SQL)
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all documents: sources weigh 3, 1, 2 in turn and share 150% of all words, at most twice a source's own."""
    planned = mixing.mix_plan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return planned.select("doc_id", "source", "size", "source_size", "target", "rate", "copies", "taken")


_LINES_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
  SELECT rid, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM docs
), keyed AS (
  SELECT rid, pos, line,
    translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), frequent AS (
  SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT rid) >= 10
), marked AS (
  SELECT rid, pos, line, k IN (SELECT k FROM frequent) AS gone FROM keyed
), per_doc AS (
  SELECT rid, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS kept
  FROM marked GROUP BY rid
)
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM per_doc JOIN docs USING (rid)
"""


@query("op4_line_dedup", _LINES_SQL)
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop lines whose key is in at least 10 documents, from all documents."""
    out = linededup.drop_frequent_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


@query("op2_nearest_neighbours")
def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of all vectors to each vector whose id is divisible by 20, by learned partitions."""
    return ann.search(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)


@query("op3_secret_scan")
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in all documents: the base patterns, and runs of at most 2 characters per token."""
    docs = table(spark, sf_dir, "documents")
    spans = secret_scan.secret_spans(F.col("text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    found = docs.select("doc_id", spans.alias("found"))
    base = F.filter("found", lambda s: s["kind"] != "random")

    def number(kind: str):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", number("assign"), number("access"), number("hex"), number("random"),
        F.sha2(secret_scan.listed(base), 256).alias("base_sha256"), secret_scan.listed(F.col("found")).alias("spans"),
    )


@query("op5_quality_rules")
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of all documents, and the verdict of rules weighed by expectation-maximisation."""
    out = quality.assess(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("p_good", 6).alias("p_good"),
    )


@query("op6_pack_sequences")
def op6_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


_WARC_SQL = r"""
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), kept AS (
  SELECT hex, max(page_id) AS kept FROM payloads GROUP BY hex
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(hex, (i // 4 * 5 + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id IS DISTINCT FROM kept AND kept IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM kept THEN kept END AS refers_to
FROM payloads JOIN kept USING (hex)
"""


@query("op7_warc_pages", _WARC_SQL)
def op7_warc_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages to WARC archives, equal payloads once, and read the archives back by their headers."""
    path = scratch_path(spark, "warc")
    warc.write_pages(table(spark, sf_dir, "pages"), path)
    return warc.read_pages(spark, path, payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query("op8_repeated_passages")
def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that documents repeat from others, at a similarity of 0.8 or more."""
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


@query("op9_token_counts")
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents, and whether they exceed 4096."""
    docs = table(spark, sf_dir, "documents")
    counted = docs.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        tokencount.token_count(F.col("text"), public_tokenizers.path("piece_bpe_32k.model")).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > 4096)


@query("op10_near_duplicates")
def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of all documents, at a similarity of 0.8 or more."""
    return neardup.near_duplicate_classes(table(spark, sf_dir, "documents"), 0.8)

def _centroids_sql(k: int = 16, rounds: int = 3) -> str:
    """Rounds of assignment and update written out as tables of a WITH clause."""
    parts = [f"""WITH kept AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM (SELECT sha256('1:' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM kept ORDER BY h, v LIMIT {k})
)"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS (
  SELECT rid, min({{'d': list_sum(list_transform(list_zip(kept.v, c{i}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT, 'c': c}}) AS m
  FROM kept, c{i} GROUP BY rid
)""")
        if i < rounds:
            parts.append(f"""s{i} AS (
  SELECT m.c AS c, pos, sum(v[pos])::HUGEINT AS s, count(*) AS n FROM a{i} JOIN kept USING (rid), range(1, 65) r(pos) GROUP BY m.c, pos
), c{i + 1} AS (
  SELECT c, coalesce(moved, v) AS v FROM c{i}
  LEFT JOIN (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY pos) AS moved FROM s{i} GROUP BY c) USING (c)
)""")
    return ",\n".join(parts) + f"""
SELECT vec_id, m.c::INT AS cluster, m.d AS distance, (sum(m.d) OVER (PARTITION BY m.c))::BIGINT AS cluster_inertia,
  (sum(m.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN kept USING (rid) JOIN c{rounds} ON c{rounds}.c = m.c
"""


@query("op11_centroid_clusters", _centroids_sql())
def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all vectors after three rounds from 16 first centroids."""
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))


@query("op12_sequence_files")
def op12_sequence_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all documents, write their ids to sequence files and read the files back."""
    path = scratch_path(spark, "sequences")
    sequencefile.write_sequences(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return sequencefile.read_documents(spark, path)


_PHRASES_SQL = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS pid, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)
), totals AS (
  SELECT lang, sum(len(w))::HUGEINT AS n FROM pieces GROUP BY lang
), grams AS (
  SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: w[i:i + m - 1])) AS p
  FROM pieces, range(1, 6) sizes(m) WHERE len(w) >= m
), counts AS (
  SELECT lang, m, p, count(*)::HUGEINT AS f FROM grams GROUP BY lang, m, p HAVING count(*) >= 100
), longer AS (
  SELECT lang, p, max(f) AS f FROM (
    SELECT lang, p[1:m - 1] AS p, f FROM counts WHERE m > 2 UNION ALL SELECT lang, p[2:m] AS p, f FROM counts WHERE m > 2
  ) GROUP BY lang, p
), cuts AS (
  SELECT c.lang, c.p, c.m, c.f AS a, k, t.n, x.f AS l, y.f AS r, (1000 * c.f * t.n) // (x.f * y.f) AS score
  FROM counts c JOIN totals t ON t.lang = c.lang JOIN range(1, 5) cut(k) ON k < c.m
  JOIN counts x ON x.lang = c.lang AND x.p = c.p[1:k] JOIN counts y ON y.lang = c.lang AND y.p = c.p[k + 1:c.m]
), best AS (
  SELECT lang, p, a, n, min({'score': score, 'k': k, 'l': l, 'r': r}) AS c FROM cuts GROUP BY lang, p, a, n
), kept AS (
  SELECT best.lang, array_to_string(best.p, ' ') AS phrase, a, c.l AS l, c.r AS r, n, c.score AS score
  FROM best LEFT JOIN longer ON longer.lang = best.lang AND longer.p = best.p WHERE longer.f IS NULL OR 100 * longer.f < 100 * a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank::INT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""


@query("op13_collocations", _PHRASES_SQL)
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of two to five words of each language, over all documents."""
    return collocations.collocations(table(spark, sf_dir, "documents"))

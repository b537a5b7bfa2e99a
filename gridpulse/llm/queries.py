"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, linededup, maintext, mixing, mtree, negatives, pieces, quality, secrets, sharding, simhash, suffixes, urlfilter
from .common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = quality.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    m = "measures."
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return rated.select("doc_id", *[m + x for x in names])


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _number(x: Column) -> Column:
    return F.conv(F.substring(F.md5(x.cast("string")), 1, 8), 16, 10).cast("long")


def _captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages with a fetch time. The tables have none, so it follows from the page's id: a second of 2024."""
    second = F.lit(1704067200) + _number(F.col("page_id")) % (366 * 86400)
    return table(spark, sf_dir, "pages").select("page_id", "url", F.timestamp_seconds(second).alias("fetched"))


def _list_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated entries on hosts, domains and paths that occur in the pages, chosen by hash: added on some day,
    often removed later, sometimes added again."""
    url = F.col("url")
    host, path = urlfilter.host_of(url), F.split_part(urlfilter.path_of(url), F.lit("/"), F.lit(1))
    labels = F.split(host, r"\.")
    domain = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 2, F.lit(1)), 3), ".")
    pages = table(spark, sf_dir, "pages").select(
        F.explode(
            F.array(
                F.struct(F.lit("hosts").alias("list"), host.alias("pattern")),
                F.struct(F.lit("domains").alias("list"), domain.alias("pattern")),
                F.struct(F.lit("paths").alias("list"), F.concat(host, F.lit("/"), path).alias("pattern")),
            )
        ).alias("e")
    )
    n = _number(F.concat_ws(" ", "list", "pattern"))
    day = lambda k: F.timestamp_seconds(F.lit(1704067200) + (n % 200 + k) * 86400)
    step = lambda action, k: F.struct(F.lit(action).alias("action"), day(k).alias("date"))
    steps = (
        F.when(n % 4 == 0, F.array(step("add", 0)))
        .when(n % 4 == 1, F.array(step("add", 0), step("remove", 60)))
        .otherwise(F.array(step("add", 0), step("remove", 30), step("add", 90)))
    )
    chosen = pages.select("e.*").where("pattern is not null").distinct().where(n % 5 == 0)
    return chosen.withColumn("s", F.explode(steps)).select("list", "pattern", "s.action", "s.date")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = urlfilter.check(_captures(spark, sf_dir), _list_entries(spark, sf_dir))
    return checked.withColumn("lists", F.array_join("lists", ","))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintext.extract(table(spark, sf_dir, "pages"))


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", mtree.quantised(F.col("embedding")).alias("v"))
    return mtree.top_k(vectors, F.col("vec_id") % 100 == 0, k=10)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each line of a group of two places or more: its place, the place of the line that stays, and
    whether it is that one."""
    found = linededup.groups(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("doc.doc_id"),
        F.col("n").cast("long").alias("line"),
        F.col("first.doc.doc_id").alias("kept_doc_id"),
        F.col("first.n").cast("long").alias("kept_line"),
        (F.struct("doc", "n") == F.col("first")).alias("kept"),
    )


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select(
        "doc_id", "n_tokens", F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", centroids.kept(F.col("embedding"), scale=256, dim=64).alias("v"))
    return centroids.with_inertia(centroids.cluster(vectors, k=40, rounds=5, seed=2))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.digests(table(spark, sf_dir, "documents").select("doc_id", "text"), depth=400)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.col("kept").alias("kept_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), mtree.quantised(F.col("embedding"), 256).alias("v"))
    return negatives.mine(rows, F.col("vec_id") % 50 == 0, positives=5, negatives=3, least=50, most=95)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_mixing,
        op3_secret_scan,
        op4_sharding,
        op5_url_filter,
        op6_html_extraction,
        op7_top_k,
        op8_simhash,
        op9_line_dedup,
        op10_sentencepiece,
        op11_centroid_clusters,
        op12_suffix_dedup,
        op13_hard_negatives,
    )
}


def _unit(*parts: str) -> str:
    """The SQL of common.unit_hash."""
    return f"(('0x' || substr(md5(concat_ws(':', {', '.join(parts)})), 1, 12))::BIGINT / 281474976710656.0)"


def _op1_measures() -> str:
    """CTEs up to `rated`: doc_id, stratum and the measures of each document."""
    word = r"'[^\x20\x09-\x0D]+'"
    return f"""
d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, {word}) AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, {word})) AS l FROM d),
five AS (SELECT rid, i, list_aggregate(list_slice(w, i, i + 4), 'string_agg', ' ') AS s
  FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS n FROM five) WHERE n > 1),
spans AS (SELECT rid, sum(least(5, coalesce(lead_i - i, 5))) AS n FROM
  (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS lead_i FROM twice) GROUP BY rid),
m AS (SELECT rid, doc_id, coalesce('=' || lang, '(null)') AS stratum, len(w)::BIGINT AS n_words,
  list_sum(list_transform(w, lambda x: length(x)))::BIGINT AS c,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
  length(regexp_replace(t, '[^!A-Z]', '', 'g'))::BIGINT AS n_shouts,
  len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(s.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN spans s USING (rid)),
rated AS (SELECT *, coalesce(c, 0) AS word_chars, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  CASE WHEN c > 0 THEN floor(1000 * n_symbols / c) ELSE 0 END AS symbols,
  CASE WHEN n_lines > 0 THEN floor(1000 * n_dup_lines / n_lines) ELSE 0 END AS dup_lines,
  CASE WHEN n_words > 0 THEN floor(1000 * n_repeat_words / n_words) ELSE 0 END AS repeats,
  CASE WHEN c > 0 THEN floor(1000 * n_shouts / c) ELSE 0 END AS shouts FROM m)"""


def _op1_sql(p: quality.Params = quality.Params()) -> str:
    cutoffs = ", ".join(f"({i}, {c})" for i, c in enumerate(p.cutoffs))
    values = " UNION ALL ".join(f"SELECT rid, doc_id, stratum, '{s}' AS signal, {s} AS v FROM rated" for s in quality.SIGNALS)
    r = p.risk
    return f"""WITH {_op1_measures()},
vals AS ({values}),
grid(pos, cutoff) AS (VALUES {cutoffs}),
known AS (SELECT doc_id, min(quality) > 0 AS good, {_unit("'half'", "doc_id")} < 0.5 AS tune FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
gains AS (SELECT stratum, signal, pos, sum(CASE WHEN good THEN -{p.weight} ELSE 1 END) AS gain FROM vals JOIN known USING (doc_id) JOIN grid ON v > cutoff WHERE tune GROUP BY ALL),
props AS (SELECT stratum, signal, arg_max(pos, gain * 100 - pos) AS prop FROM gains GROUP BY ALL HAVING max(gain) > 0),
joint AS (SELECT stratum, g.pos, rid, bool_or(v > c.cutoff) AS gone FROM vals JOIN known USING (doc_id) JOIN props USING (stratum, signal)
  CROSS JOIN grid g JOIN grid c ON c.pos = least(g.pos, prop) WHERE good AND NOT tune GROUP BY ALL),
ks AS (SELECT stratum, pos, count(*) FILTER (gone) AS k, count(*) AS n FROM joint GROUP BY ALL),
tails AS (SELECT *, CASE WHEN k > n * {r} THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1),
  lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({r}) + (n - i) * ln(1 - {r})))) END AS p FROM ks),
ends AS (SELECT stratum, coalesce(min(pos) FILTER (p > {p.delta} / (SELECT count(DISTINCT stratum) FROM props)), {len(p.cutoffs)}) AS stopped FROM tails GROUP BY ALL),
rules AS (SELECT stratum, signal, cutoff AS most FROM props JOIN ends USING (stratum) JOIN grid ON pos = least(prop, stopped - 1)),
bad AS (SELECT DISTINCT rid FROM vals JOIN rules USING (stratum, signal) WHERE v > rules.most)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND rid NOT IN (SELECT rid FROM bad) AS kept FROM rated"""


_OP2_SQL = f"""WITH RECURSIVE
d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size, md5(coalesce(text, '')) AS h,
  row_number() OVER (PARTITION BY doc_id, md5(coalesce(text, ''))) - 1 AS nth FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM d GROUP BY source),
fill AS (SELECT 0 AS step, source, source_size, weight, false AS full_ FROM s
  UNION ALL
  SELECT step + 1, source, source_size, weight, full_ OR weight * level > 3 * source_size
  FROM (SELECT *, (sum(source_size) OVER () - sum(CASE WHEN full_ THEN 3 * source_size ELSE 0 END) OVER ())
    / sum(CASE WHEN full_ THEN 0 ELSE weight END) OVER () AS level FROM fill)
  WHERE step <= (SELECT count(*) FROM s)),
last AS (SELECT *, (sum(source_size) OVER () - sum(CASE WHEN full_ THEN 3 * source_size ELSE 0 END) OVER ())
    / sum(CASE WHEN full_ THEN 0 ELSE weight END) OVER () AS level FROM fill WHERE step = (SELECT max(step) FROM fill)),
t AS (SELECT source, source_size, CASE WHEN full_ THEN 3.0 * source_size ELSE weight * level END::DOUBLE AS target FROM last),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t)
SELECT doc_id, size, source_size, target,
  (size * (floor(rate) + CASE WHEN {_unit("'0'", "coalesce(doc_id::VARCHAR, 'null')", "h", "nth::VARCHAR")} < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source"""

_OP5_SQL = r"""WITH u AS (SELECT page_id, url, make_timestamp((1704067200 + ('0x' || substr(md5(page_id::VARCHAR), 1, 8))::BIGINT % (366 * 86400)) * 1000000) AS fetched,
  lower(regexp_extract(url, '^\s*[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)) AS host,
  regexp_extract(url, '^\s*[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+/([^?#]*)', 1) AS path FROM pages),
p AS (SELECT *, split_part(path, '/', 1) AS first, string_split(host, '.') AS l FROM u),
c AS (SELECT DISTINCT * FROM (SELECT 'hosts' AS list, host AS pattern FROM p UNION ALL
  SELECT 'domains', array_to_string(list_slice(l, greatest(len(l) - 2, 1), greatest(len(l) - 2, 1) + 2), '.') FROM p UNION ALL
  SELECT 'paths', host || '/' || first FROM p) WHERE pattern IS NOT NULL),
n AS (SELECT *, ('0x' || substr(md5(list || ' ' || pattern), 1, 8))::BIGINT AS n FROM c),
i AS (SELECT list, rtrim(pattern, '/') AS pattern, n, unnest(CASE n % 4 WHEN 0 THEN [[0, 100000]] WHEN 1 THEN [[0, 60]] ELSE [[0, 30], [90, 100000]] END) AS s FROM n WHERE n % 5 = 0),
spans AS (SELECT list, pattern, TIMESTAMP '2024-01-01' + to_days((n % 200 + s[1])::INT) AS since, TIMESTAMP '2024-01-01' + to_days((n % 200 + s[2])::INT) AS until FROM i),
hosts AS (SELECT page_id, url, fetched, path, first, unnest(list_transform(range(1, len(l) + 1), lambda k: array_to_string(list_slice(l, k, len(l)), '.'))) AS h FROM p),
asked AS (SELECT page_id, url, fetched, h AS pattern FROM hosts UNION SELECT page_id, url, fetched, h || '/' || first FROM hosts WHERE first <> ''),
hits AS (SELECT page_id, url, fetched, string_agg(DISTINCT list, ',' ORDER BY list) AS lists FROM asked JOIN spans USING (pattern) WHERE fetched >= since AND fetched < until GROUP BY ALL)
SELECT p.page_id, p.url, p.fetched, coalesce(lists, '') AS lists, lists IS NOT NULL AS blocked FROM p LEFT JOIN hits USING (page_id, url, fetched)"""

_OP6_SQL = r"""WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS t FROM pages),
plain AS (SELECT page_id, url, regexp_replace(t, '<[^>]*>', ' ', 'g') AS t FROM a),
one AS (SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(t, '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g') AS t FROM plain),
text AS (SELECT page_id, url, trim(regexp_replace(regexp_replace(t, '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS text FROM one)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM text"""

_OP7_SQL = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.e, v.e)::BIGINT AS score FROM v q, v WHERE q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id)
SELECT query_id, rank::INT AS rank, vec_id, score FROM
  (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10"""

_FINE = "embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _op11_sql(k: int = 40, rounds: int = 5, seed: int = 2) -> str:
    def assigned(r: int) -> str:
        d = "list_dot_product(e, e) - 2 * list_dot_product(e, ce) + list_dot_product(ce, ce)"
        return f"""a{r} AS MATERIALIZED (SELECT rid, vec_id, e, c AS cluster, d::BIGINT AS distance FROM (SELECT rid, vec_id, e, c, {d} AS d,
  row_number() OVER (PARTITION BY rid ORDER BY {d}, c) AS n FROM v, c{r}) WHERE n = 1)"""

    def moved(r: int) -> str:
        return f"""c{r + 1} AS MATERIALIZED (SELECT c, coalesce(m, ce) AS ce FROM c{r} LEFT JOIN (SELECT cluster, list(x ORDER BY p) AS m FROM
  (SELECT cluster, p, floor(sum(x) / count(*)) AS x FROM (SELECT cluster, unnest(e) AS x, unnest(range(64)) AS p FROM a{r}) GROUP BY cluster, p) GROUP BY cluster) ON c = cluster)"""

    steps = ", ".join(f"{assigned(r)}, {moved(r)}" for r in range(rounds))
    sha = "sha256(array_to_string(list_transform(ce, lambda x: x::BIGINT::VARCHAR), ','))"
    return f"""WITH v AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings WHERE len(embedding) = 64 AND {_FINE}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS c, e AS ce FROM (SELECT sha256('{seed}:' || vec_id) AS h, e FROM v ORDER BY h LIMIT {k})),
{steps}, {assigned(rounds)}
SELECT vec_id, cluster::INT AS cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
  (sum(distance) OVER ())::BIGINT AS inertia, {sha} AS centroid_sha256 FROM a{rounds} JOIN c{rounds} ON c = cluster"""


_OP12_SQL = """WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
p AS (SELECT rid, o, substr(x, 2 * o + 1, 2 * (1000 + 399)) AS x FROM (SELECT rid, x, unnest(range(0, len(x) // 2 - 399, 1000)) AS o FROM d)),
w AS (SELECT rid, o + i AS i, md5(substr(x, 2 * i + 1, 800)) AS m FROM (SELECT rid, o, x, unnest(range(0, len(x) // 2 - 399)) AS i FROM p)),
s AS (SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) AS before FROM (SELECT rid, i, count(*) OVER (PARTITION BY m) AS n FROM w) WHERE n > 1),
g AS (SELECT rid, i, sum(CASE WHEN before IS NULL OR i > before + 400 THEN 1 ELSE 0 END) OVER (PARTITION BY rid ORDER BY i) AS g FROM s),
spans AS (SELECT rid, min(i) AS a, max(i) + 400 AS b FROM g GROUP BY rid, g),
cuts AS (SELECT rid, a, b, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS since FROM spans),
gone AS (SELECT rid, sum(b - a)::BIGINT AS n_removed, count(*)::BIGINT AS n_spans, max(b) AS last,
  string_agg(substr(x, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS kept FROM cuts JOIN d USING (rid) GROUP BY rid)
SELECT doc_id, (len(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, '') || substr(x, 2 * coalesce(last, 0) + 1))) AS kept_sha256 FROM d LEFT JOIN gone USING (rid)"""

_OP13_SQL = f"""WITH v AS (SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND {_FINE}),
s AS MATERIALIZED (SELECT a.rid, a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS alike, list_dot_product(a.e, v.e)::BIGINT AS score
  FROM v a JOIN v ON a.rid <> v.rid AND len(a.e) = len(v.e) WHERE a.vec_id % 50 = 0),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS n FROM s WHERE alike) WHERE n <= 5),
q AS (SELECT p.anchor_id, p.vec_id AS positive_id, row_number() OVER (PARTITION BY rid, p.n ORDER BY s.score DESC, s.vec_id) AS rank, s.vec_id AS negative_id,
  p.score AS positive_score, s.score AS negative_score FROM p JOIN s USING (rid)
  WHERE NOT s.alike AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM q WHERE rank <= 3"""

ORACLES: dict[str, str] = {
    "op1_quality_rules": _op1_sql(),
    "op2_mixing": _OP2_SQL,
    "op5_url_filter": _OP5_SQL,
    "op6_html_extraction": _OP6_SQL,
    "op7_top_k": _OP7_SQL,
    "op11_centroid_clusters": _op11_sql(),
    "op12_suffix_dedup": _OP12_SQL,
    "op13_hard_negatives": _OP13_SQL,
}

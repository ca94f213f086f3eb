"""The queries of the operators over the given tables. Where SQL can say the same, ``ORACLES`` does."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from exactsync.llm.shared import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_bpe() -> str:
    """The vocabulary file of the token queries; executors have it at the same place."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op5_token_counts")
def token_counts(spark, sf_dir):
    from exactsync.llm.tokens import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), byte_bpe())


@query("op7_packing")
def packing(spark, sf_dir):
    from exactsync.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), byte_bpe())


_LINE_SQL = """
WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT doc_id, generate_subscripts(lines, 1) AS pos, unnest(lines) AS line FROM cut),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
frequent AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT k.*, f.key IS NOT NULL AS dropped FROM keyed k LEFT JOIN frequent f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query("op10_line_dedup", _LINE_SQL)
def line_dedup(spark, sf_dir):
    from pyspark.sql import functions as F

    from exactsync.llm.lines import dedupe_lines

    done = dedupe_lines(table(spark, sf_dir, "documents"))
    return done.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query("op9_secrets")
def secret_scan(spark, sf_dir):
    from pyspark.sql import functions as F

    from exactsync.llm import secrets

    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *(secrets.count_kind(F.col("base"), k).alias(f"n_{k}") for k in secrets.KINDS[:3]),
        F.sha2(secrets.joined(F.col("base")), 256).alias("base_sha256"),
        secrets.joined(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )


@query("op2_simhash")
def simhash_classes(spark, sf_dir):
    from exactsync.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op1_mixing")
def mixing(spark, sf_dir):
    from exactsync.llm.mixing import mix

    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op6_vector_dedup")
def vector_dedup(spark, sf_dir):
    from exactsync.llm.vectors import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op8_nearest")
def nearest_vectors(spark, sf_dir):
    from exactsync.llm.neighbours import nearest

    return nearest(table(spark, sf_dir, "embeddings"))


@query("op4_language_id")
def language_id(spark, sf_dir):
    from exactsync.llm.language import identify

    return identify(table(spark, sf_dir, "documents"))


@query("op3_quality")
def quality_scores(spark, sf_dir):
    from exactsync.llm import quality

    documents = table(spark, sf_dir, "documents")
    return quality.scored(documents, quality.fit(documents, table(spark, sf_dir, "labels")))


#: The entries of op11: verdict, host, path.
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

_URL_SQL = """
WITH cut AS (SELECT page_id,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
ruled AS (SELECT *, CASE
    WHEN (host = 'example.org' OR suffix(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'example.org' OR suffix(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/') THEN 'org/'
    WHEN (host = 'com' OR suffix(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR suffix(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/' END AS rule FROM cut)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/es/', 'example.org/en/1', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM ruled
"""


@query("op11_url_filter", _URL_SQL)
def url_filter(spark, sf_dir):
    from exactsync.llm import urls

    return urls.judge(table(spark, sf_dir, "pages"), urls.entries_of(spark, URL_RULES))


def repeat_words(doc_id, words):
    """Every tenth document (by hash of its id) with the words from a drawn place on repeated in a drawn period."""
    import zlib

    hashed = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if hashed is None or hashed % 10 or not words:
        return words
    g, n = hashed // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


@query("op12_periodic_runs")
def periodic_runs(spark, sf_dir):
    from exactsync.llm import periodic

    return periodic.scan(table(spark, sf_dir, "documents"), repeat_words)


_DIVERGENCE_SQL = """
WITH texts AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                      coalesce(text, '') AS text FROM documents),
words AS (SELECT doc, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM texts),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 3),
sizes AS (SELECT lang, count(*) AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
said AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM texts),
group_sizes AS (SELECT g.lang, g.source, coalesce(sum(s.n), 0)::HUGEINT AS total
                FROM groups g LEFT JOIN said s USING (lang, source) GROUP BY ALL),
shares AS (SELECT k.lang, k.term, g.source, coalesce(s.n, 0) AS n,
                  1 + (1000000000::HUGEINT * (coalesce(s.n, 0) + 1)) // (g.total + z.v) AS p,
                  1 + (1000000000::HUGEINT * (k.n + 1)) // (z.total + z.v) AS q
           FROM kept k JOIN sizes z USING (lang) JOIN group_sizes g USING (lang)
           LEFT JOIN said s ON s.lang = k.lang AND s.term = k.term AND s.source = g.source),
pair_sums AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
              FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN pair_sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT lang, source, 'pair' AS part, item, value,
                  row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
           UNION ALL
           SELECT * FROM (SELECT lang, source, 'term' AS part, item, value,
                  row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM terms) WHERE rank <= 200)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM ranked
"""


@query("op13_source_divergence", _DIVERGENCE_SQL)
def source_divergence(spark, sf_dir):
    from exactsync.llm import divergence

    return divergence.audit(table(spark, sf_dir, "documents"))

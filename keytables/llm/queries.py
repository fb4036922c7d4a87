"""The operators as queries over whole tables, with the SQL that gives the same rows where there is one.

Paths of vocabulary files come from the ``public_tokenizers`` package of the machine.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keytables.llm import (
    attention_scores,
    grid_join,
    language_id,
    minhash_dedup,
    ordinal_quality,
    periodic_runs,
    permutation_index,
    piece_encoding,
    ranked_search,
    substring_dedup,
    token_files,
    url_filters,
)
from keytables.llm.mixing import mix_sources, repetition_rates
from keytables.sources.scratch import scratch_path, write_result

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(run):
        QUERIES[run.__name__] = run
        if sql:
            SQL[run.__name__] = sql
        return run

    return add


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query()
def op1_token_files(spark, folder):
    """Token ids written as ORC, and their digests read back from the files."""
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(
        _table(spark, folder, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2
    )
    files = token_files.read_token_files(spark, path)
    return token_files.token_starts(token_files.token_digests(files), files).select("doc_id", "start", "n_tokens", "ids_crc32")


# For each id the smallest one that links lead to.
_COMPONENTS = """
    both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
    reached AS (
        SELECT id, id AS r FROM ids UNION SELECT reached.id, both_ways.b FROM reached JOIN both_ways ON reached.r = both_ways.a
    ),
    components AS (SELECT id, min(r) AS component_id FROM reached GROUP BY id)
"""


@_query(
    f"""
    WITH RECURSIVE usable AS (
        SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
        WHERE len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
            AND len(list_filter(embedding, lambda v: v <> 0)) > 0
    ),
    links AS (
        SELECT p.vec_id AS a, q.vec_id AS b FROM usable p JOIN usable q ON p.vec_id < q.vec_id
        WHERE list_cosine_similarity(p.x, q.x) >= 0.95
    ),
    ids AS (SELECT vec_id AS id FROM embeddings), {_COMPONENTS}
    SELECT id AS vec_id, (SELECT count(*) FROM both_ways WHERE a = id) AS n_links, component_id, id = component_id AS kept
    FROM components
    """
)
def op2_grid_join(spark, folder):
    """The near-duplicate group of every vector."""
    return write_result(spark, "vector-links", lambda: grid_join.link_vectors(_table(spark, folder, "embeddings"), 0.95))


@_query(
    rf"""
    WITH RECURSIVE split AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'
        ) AS w FROM documents
    ),
    shingles AS (
        SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
        FROM split, LATERAL (SELECT unnest(range(1, greatest(len(w) - 3, 2))) AS i) WHERE len(w) > 0
    ),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    common AS (
        SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS n FROM shingles p JOIN shingles q ON p.s = q.s AND p.doc_id < q.doc_id
        GROUP BY ALL
    ),
    links AS (
        SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)
    ),
    ids AS (SELECT doc_id AS id FROM documents), {_COMPONENTS}
    SELECT id AS doc_id, coalesce(n, 0) AS n_shingles, component_id, id = component_id AS kept
    FROM components LEFT JOIN sizes ON doc_id = id
    """
)
def op3_minhash_dedup(spark, folder):
    """The near-duplicate group of every document."""
    return write_result(spark, "near-duplicates", lambda: minhash_dedup.near_duplicates(_table(spark, folder, "documents")))


@_query()
def op4_ordinal_quality(spark, folder):
    """Every document's expected grade and whether it is good enough to keep; grades are learnt from the labels."""
    documents = _table(spark, folder, "documents")
    model = ordinal_quality.train(documents, ordinal_quality.graded_labels(_table(spark, folder, "labels")))
    graded = ordinal_quality.grade(documents, model)
    return graded.select("doc_id", "expected_grade", "tail_probability", F.col("selected").alias("kept"))


@_query()
def op5_piece_encoding(spark, folder):
    """Ids of the merge-type model, their digest, and that of the text decoded from them."""
    return piece_encoding.round_trip_digests(
        _table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    )


URL_RULES = [
    url_filters.Rule("allow", "org", "/"),
    url_filters.Rule("block", "example.org", "/es/"),
    url_filters.Rule("block", "example.org", "/en/1"),
    url_filters.Rule("allow", "com", "/fr/"),
    url_filters.Rule("block", "com", "/de/"),
]


@_query(
    """
    WITH cut AS (
        SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
        FROM pages
    ), parsed AS (
        SELECT page_id,
            translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
        FROM cut
    ), outcomes AS (
        SELECT doc_id AS page_id, min(CAST(quality = 1 AND toxic = 0 AS INT)) AS good FROM labels GROUP BY doc_id
    ), hosts AS (
        SELECT host, count(good) AS n, coalesce(sum(good), 0) AS good,
            array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS domain,
            string_split(host, '.')[-1] AS suffix
        FROM parsed LEFT JOIN outcomes USING (page_id) GROUP BY host
    ), base AS (SELECT coalesce(sum(good) / nullif(sum(n), 0), 0.5) AS p FROM hosts),
    s0 AS (SELECT suffix, sum(good) AS good, sum(n) AS n, any_value(p) AS prior FROM hosts, base GROUP BY suffix),
    s1 AS (
        SELECT count(*) AS g, sum(n) AS seen,
            sum(CAST(round(n * pow(good / n - prior, 2.0) / (prior * (1 - prior)), 9) AS DECIMAL(38, 9))) AS chi
        FROM s0 WHERE n > 0 AND prior > 0 AND prior < 1
    ), s2 AS (
        SELECT CASE WHEN g = 0 OR seen <= g OR CAST(chi AS DOUBLE) <= g THEN 1000.0
            ELSE least(1000.0, greatest(2.0, (seen - g) / (CAST(chi AS DOUBLE) - g) - 1)) END AS s FROM s1
    ), suffixes AS (SELECT suffix, (good + s * prior) / (n + s) AS rate FROM s0, s2),
    d0 AS (
        SELECT domain, suffix, sum(good) AS good, sum(n) AS n, any_value(rate) AS prior
        FROM hosts JOIN suffixes USING (suffix) GROUP BY domain, suffix
    ), d1 AS (
        SELECT count(*) AS g, sum(n) AS seen,
            sum(CAST(round(n * pow(good / n - prior, 2.0) / (prior * (1 - prior)), 9) AS DECIMAL(38, 9))) AS chi
        FROM d0 WHERE n > 0 AND prior > 0 AND prior < 1
    ), d2 AS (
        SELECT CASE WHEN g = 0 OR seen <= g OR CAST(chi AS DOUBLE) <= g THEN 1000.0
            ELSE least(1000.0, greatest(2.0, (seen - g) / (CAST(chi AS DOUBLE) - g) - 1)) END AS s FROM d1
    ), domains AS (SELECT domain, (good + s * prior) / (n + s) AS rate FROM d0, d2),
    h0 AS (SELECT host, hosts.good, hosts.n, rate AS prior FROM hosts JOIN domains USING (domain)),
    h1 AS (
        SELECT count(*) AS g, sum(n) AS seen,
            sum(CAST(round(n * pow(good / n - prior, 2.0) / (prior * (1 - prior)), 9) AS DECIMAL(38, 9))) AS chi
        FROM h0 WHERE n > 0 AND prior > 0 AND prior < 1
    ), h2 AS (
        SELECT CASE WHEN g = 0 OR seen <= g OR CAST(chi AS DOUBLE) <= g THEN 1000.0
            ELSE least(1000.0, greatest(2.0, (seen - g) / (CAST(chi AS DOUBLE) - g) - 1)) END AS s FROM h1
    ), posterior AS (
        SELECT host, good + s * prior AS a, n - good + s * (1 - prior) AS b, (good + s * prior) / (n + s) AS rate FROM h0, h2
    ), bounds AS (
        SELECT host, rate - 1.0 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS bound FROM posterior
    ), judged AS (
        SELECT page_id, host, path, bound,
            CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
                WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
                WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
                WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
        FROM parsed LEFT JOIN bounds USING (host)
    )
    SELECT page_id, host, path, rule,
        CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN bound >= 0.5 THEN 'allow' ELSE 'block' END AS verdict
    FROM judged
    """
)
def op7_url_filters(spark, folder):
    """Every page judged by the rules, else by its host's reputation from the labels of its pages."""
    labels = _table(spark, folder, "labels")
    good = ((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int")
    outcomes = labels.groupBy(F.col("doc_id").alias("page_id")).agg((F.min(good) == 1).alias("good"))
    pages = _table(spark, folder, "pages")
    # Chosen before it is written, so that the pages' own columns are neither shuffled nor written.
    chosen = ["page_id", "host", "path", "rule", "verdict"]
    return write_result(spark, "judged-urls", lambda: url_filters.filter_urls(pages, outcomes, URL_RULES).select(*chosen))


@_query(
    r"""
    WITH split AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
    ),
    windows AS (
        SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS s FROM split, LATERAL (SELECT unnest(range(1, len(w) - 11)) AS i)
    ),
    firsts AS (SELECT s, min(doc_id) AS first FROM windows GROUP BY s),
    gone AS (
        SELECT DISTINCT doc_id, i + j AS p FROM windows JOIN firsts USING (s), range(13) AS r(j) WHERE first < doc_id
    ),
    words AS (SELECT doc_id, p, w[p] AS word FROM split, LATERAL (SELECT unnest(range(1, len(w) + 1)) AS p)),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS k FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
    lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
    FROM split LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)
    """
)
def op6_substring_dedup(spark, folder):
    """What is left of every document without the passages of 13 words that smaller documents have."""
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    digest = F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")

    def left() -> DataFrame:
        return substring_dedup.remove_repeats(documents, join_always=True).select("doc_id", "n_words", "n_removed", digest)

    return write_result(spark, "without-repeats", left)


# The shares of characters that the sources are mixed to.
SOURCE_WEIGHTS = {f"src{i}": 1.0 + i % 4 for i in range(20)}
# How often documents of any other source, of none, or of a source without a size are repeated on average.
OTHER_RATE = 1.0

MIX_SQL = f"""
    WITH weights AS (SELECT 'src' || i AS source, 1.0::DOUBLE + i % 4 AS w FROM range(20) t(i)),
    sizes AS (
        SELECT source, w, sum(coalesce(n_chars, 0))::DOUBLE AS size FROM documents JOIN weights USING (source) GROUP BY source, w
    ), rates AS (
        SELECT source, (SELECT sum(size) FROM sizes WHERE size > 0) * w / (SELECT sum(w) FROM sizes WHERE size > 0) / size AS r
        FROM sizes WHERE size > 0
    ), steps AS (
        SELECT r, k, sum(exp(k * ln(r) - r - lgamma(k + 1.0))) OVER (PARTITION BY r ORDER BY k) AS p
        FROM (SELECT DISTINCT r FROM rates UNION SELECT {OTHER_RATE}::DOUBLE), LATERAL (SELECT unnest(range(ceil(r + 12 * sqrt(r) + 30)::BIGINT)) AS k)
    ), listed AS (SELECT r, list(p ORDER BY k) AS p FROM steps GROUP BY r),
    named AS (
        SELECT d.*, concat_ws(':', coalesce(doc_id::VARCHAR, 'null'), coalesce(md5(text), 'null'),
            row_number() OVER (PARTITION BY doc_id, text ORDER BY source) - 1) AS id FROM documents d
    ), drawn AS (
        SELECT named.*, ('0x' || substr(md5('mix:' || id), 1, 12))::BIGINT / 281474976710656.0::DOUBLE AS u, coalesce(r, {OTHER_RATE}) AS r
        FROM named LEFT JOIN rates USING (source)
    ), counted AS (SELECT drawn.*, len(list_filter(p, lambda x: x <= u)) AS n FROM drawn JOIN listed USING (r))
    SELECT doc_id, text, lang, source, n_chars, copy::INT AS copy,
        ('0x' || substr(md5('mix-order:' || id || ':' || copy), 1, 12))::BIGINT / 281474976710656.0::DOUBLE AS shuffle_key
    FROM counted, LATERAL (SELECT unnest(range(n)) AS copy) c
"""


@_query(MIX_SQL)
def op8_mixing(spark, folder):
    """All documents, repeated so that the sources' shares of characters are as the weights; other sources as they are."""
    documents = _table(spark, folder, "documents")
    rates = repetition_rates(documents, "source", SOURCE_WEIGHTS, size=F.col("n_chars"))
    return mix_sources(documents, "source", rates, default_rate=OTHER_RATE)


@_query()
def op9_permutation_index(spark, folder):
    """The ten nearest of every hundredth vector."""
    vectors = _table(spark, folder, "embeddings")
    queries = vectors.where("vec_id % 100 = 0")
    return write_result(spark, "nearest-vectors", lambda: permutation_index.search(vectors, queries, k=10))


@_query()
def op10_language_id(spark, folder):
    """The language of every document, learnt from four fifths of them."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    documents = _table(spark, folder, "documents").withColumn("held_out", held_out)
    # Rows without an id are in no fold: not held out, nor learnt from.
    model = language_id.train(documents.where(~F.col("held_out") & F.col("doc_id").isNotNull()))
    texts = documents.select("doc_id", "held_out", "text")
    return language_id.identify(texts, model).select("doc_id", "held_out", "lang_pred", "score", "accepted")


@_query()
def op11_attention_scores(spark, folder):
    """The log10 probability of every document by an attention model, learnt from six sevenths of them, and by word counts."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    documents = _table(spark, folder, "documents").withColumn("held_out", held_out)
    return attention_scores.score_documents(documents, public_tokenizers.path("byte_bpe_50k.json"))


# A number from 0 to 255, by rule: eight steps of the polynomial division.
_CRC_STEP = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END"


@_query(
    rf"""
    WITH crc AS (
        SELECT list_transform(range(256), lambda n: list_reduce([n::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, i: {_CRC_STEP})) AS t
    ),
    hashed AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, xor(list_reduce(
            list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])
        ), 4294967295::BIGINT) AS h FROM documents, crc
    ),
    planned AS (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS again, h // 10 AS g FROM hashed),
    shaped AS (SELECT *, CASE WHEN again THEN g % n END AS a FROM planned),
    split AS (
        SELECT doc_id, n, CASE WHEN again THEN list_transform(range(n), lambda i:
            w[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END + 1]) ELSE w END AS w FROM shaped
    ),
    words AS (SELECT doc_id, n, i, w[i + 1] AS word FROM split, LATERAL (SELECT unnest(range(n)) AS i)),
    equal AS (
        SELECT x.doc_id, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i
            AND 4 * (y.i - x.i) <= x.n
    ),
    islands AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS r FROM equal),
    periodic AS (
        SELECT doc_id, q, min(i) AS s, count(*) + q AS l FROM islands GROUP BY doc_id, q, r HAVING count(*) + q >= greatest(6, 4 * q)
    ),
    runs AS (SELECT doc_id, s, l, min(q) AS q FROM periodic GROUP BY doc_id, s, l),
    gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM runs),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS k FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
    listed AS (
        SELECT doc_id, count(*) AS c, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS t FROM runs GROUP BY doc_id
    ),
    longest AS (
        SELECT doc_id, s, l, q FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY l DESC, s, q) = 1
    )
    SELECT doc_id, coalesce(c, 0) AS n_runs, s AS start, l AS length, q AS period, 1000 * l // q AS exponent_milli,
        sha256(coalesce(t, '')) AS runs_sha256, sha256(coalesce(k, '')) AS collapsed_sha256
    FROM split LEFT JOIN longest USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
    """
)
def op12_periodic_runs(spark, folder):
    """The runs of every document, a tenth of them made periodic by a rule, and what is left without repetitions."""
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    g, n, a = F.floor(F.col("h") / 10), F.col("n"), F.col("a")
    place = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.when(i < a, i).otherwise(a + (i - a) % (1 + F.floor((n - a) / (3 + g % 8)))).cast("int"),
    )
    documents = (
        _table(spark, folder, "documents")
        .select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
        .withColumn("w", F.when(F.col("h") % 10 == 0, words))
        .withColumn("n", F.size("w"))
        .withColumn("a", F.when(n > 0, g % F.when(n > 0, n)))
        .select(
            "doc_id",
            F.when(n > 0, F.array_join(F.transform(place, lambda i: F.get("w", i)), " ")).otherwise(F.col("text")).alias("text"),
        )
    )
    found = periodic_runs.find_runs(documents).withColumn("longest", periodic_runs.longest_run())
    line = F.transform("runs", lambda r: F.concat_ws(",", *(r[name].cast("string") for name in ("start", "length", "period"))))
    lines = F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "longest.start",
        "longest.length",
        "longest.period",
        F.expr("(1000 * longest.length) div longest.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@_query(
    r"""
    WITH split AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'
        ) AS t FROM documents
    ),
    totals AS (SELECT count(*) AS n, sum(len(t))::BIGINT AS l FROM split WHERE len(t) > 0),
    sizes AS (SELECT doc_id, 10 + (90 * len(t) * n) // l AS m FROM split, totals WHERE len(t) > 0),
    asked AS (
        SELECT DISTINCT item_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'
        )) AS term FROM benchmark
    ),
    terms AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM split) GROUP BY doc_id, term),
    held AS (SELECT term, count(*) AS df FROM terms SEMI JOIN asked USING (term) GROUP BY term),
    weights AS (SELECT term, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM held, totals),
    scores AS (
        SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
        FROM asked JOIN weights USING (term) JOIN terms USING (term) JOIN sizes USING (doc_id) GROUP BY item_id, doc_id
    )
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
    FROM scores WHERE score > 0 QUALIFY rank <= 10
    """
)
def op13_ranked_search(spark, folder):
    """The ten best documents for every benchmark item."""
    return ranked_search.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"), k=10)

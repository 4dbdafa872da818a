"""Queries over the test tables, one for each operator, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from .common import WORD, table

QUERIES = {}
CHECKS = {}


def query(name: str, check: str | None = None):
    def register(run):
        QUERIES[name] = run
        if check is not None:
            CHECKS[name] = check
        return run

    return register


@query("op3_simhash")
def _(spark, sf_dir):
    from .simhash import hex_of, simhash_groups

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    groups = simhash_groups(docs, keep_text=False)
    return groups.select("doc_id", hex_of("fingerprint").alias("fingerprint"), "component_id")


MIX_CHECK = f"""
WITH docs AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size FROM documents),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
    FROM docs GROUP BY source),
weighted AS (SELECT *, [5, 2, 1][(rank % 3 + 1)::INT]::BIGINT AS weight, 3 * source_size AS cap FROM sources),
caps AS (
    SELECT *, coalesce(sum(cap) OVER earlier, 0)::BIGINT AS caps_before, coalesce(sum(weight) OVER earlier, 0)::BIGINT AS weights_before,
           sum(source_size) OVER ()::BIGINT AS total, sum(weight) OVER ()::BIGINT AS weights
    FROM weighted
    WINDOW earlier AS (ORDER BY cap::DOUBLE / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
    SELECT arg_min((total - caps_before)::DOUBLE / (weights - weights_before), weights_before) AS level FROM caps
    WHERE (total - caps_before)::DOUBLE / (weights - weights_before) * weight <= cap)
SELECT doc_id, size, source_size, least(cap::DOUBLE, coalesce(level, 0) * weight) AS target
FROM docs JOIN weighted ON docs.source IS NOT DISTINCT FROM weighted.source CROSS JOIN level"""


@query("op4_mixing")
def _(spark, sf_dir):
    from .mixing import mix

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op10_bpe")
def _(spark, sf_dir):
    from .bpe import round_trip

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip(docs, vocabulary_path(), packed=True).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op9_language")
def _(spark, sf_dir):
    from .langid import identify_folds

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify_folds(docs).select("doc_id", "held_out", "lang_pred", "score")


@query("op6_pii")
def _(spark, sf_dir):
    from .pii import KINDS, find_spans, train

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_spans(docs, train(docs)).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["base"])

    def line(spans):
        parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(parts, ",")

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in KINDS],
        F.sha2(line(base).cast("binary"), 256).alias("base_sha256"),
        line(F.col("spans")).alias("spans"),
    )


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_URL = r"^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
_GLOB_TESTS = " OR ".join(
    f"regexp_full_match(canonical, '{pattern}', 's')"
    for pattern in (
        r".*spam-farm\..*", r".*cheap-pills\..*", "[^/?]*casino[^/?]*/.*", r"[^/?]*\.xxx/.*", "[^/?]*viagra[^/?]*/.*",
        r".*/wp-login\.php.*", ".*/cgi-bin/.*", r".*\.exe", r".*\?.*sessionid=.*",
    )
)
URL_CHECK = f"""
WITH parts AS (
    SELECT page_id, coalesce(translate(regexp_extract(url, '{_URL}', 1, 's'), '{_UPPER}', '{_UPPER.lower()}'), '') AS host,
           coalesce(regexp_extract(url, '{_URL}', 2, 's'), '') AS path, coalesce(regexp_extract(url, '{_URL}', 3, 's'), '') AS query
    FROM pages),
ruled AS (
    SELECT *, '.' || host || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS canonical,
           CASE WHEN ends_with('.' || host, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
                WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
                WHEN ends_with('.' || host, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
                WHEN ends_with('.' || host, '.net') AND starts_with(path, '/') THEN 'net/' END AS rule
    FROM parts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN {_GLOB_TESTS} THEN 'block' ELSE 'allow' END AS verdict
FROM ruled"""


@query("op5_urls", URL_CHECK)
def _(spark, sf_dir):
    from .urls import judge

    return judge(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


@query("op8_quality")
def _(spark, sf_dir):
    from .quality import BASE, quality

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = quality(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return judged.select("doc_id", *BASE, "base_failed", "kept", "rejected_by")


@query("op7_toxicity")
def _(spark, sf_dir):
    from .toxicity import score_folds

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return score_folds(docs, labels, keep_text=False).select("doc_id", "held_out", "score", "predicted")


@query("op2_embeddings")
def _(spark, sf_dir):
    from .embeddings import embedding_groups

    groups = embedding_groups(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return groups.select("vec_id", "n_links", "component_id", "kept")


def _license_check() -> str:
    from .licenses import TEMPLATES, TOKEN, WORDS, shingles_of

    rows = [(name, shingle) for name, text in TEMPLATES.items() for shingle in shingles_of(text)]
    values = ", ".join(f"('{name}', '{shingle}')" for name, shingle in rows)
    return f"""
WITH templates AS (SELECT * FROM (VALUES {values}) t(license, shingle)),
sizes AS (SELECT license, count(*) AS n FROM templates GROUP BY license),
words AS (SELECT doc_id, regexp_extract_all(lower(text), '{TOKEN}') AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, unnest([array_to_string(w[i:i + {WORDS - 1}], ' ') FOR i IN range(1, len(w) - {WORDS - 2})]) AS shingle
    FROM words)
SELECT doc_id, license, count(*) / any_value(n) AS containment, count(*)::INT AS n_found, any_value(n)::INT AS n_shingles
FROM shingles JOIN templates USING (shingle) JOIN sizes USING (license)
GROUP BY doc_id, license HAVING count(*) / any_value(n) >= 0.8"""


@query("op1_licenses", _license_check())
def _(spark, sf_dir):
    from .licenses import scan

    return scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


_TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CONTAMINATION_CHECK = f"""
WITH docs AS (
    SELECT row_number() OVER () AS doc, doc_id,
           coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '{_TERM}'), []) AS w
    FROM documents),
items AS (SELECT item_id, regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '{_TERM}') AS w FROM benchmark),
lengths AS (SELECT DISTINCT least(len(w), 10) AS size FROM items WHERE len(w) > 0),
windows AS (
    SELECT DISTINCT item_id, array_to_string(w[i:i + size - 1], ' ') AS phrase
    FROM (SELECT item_id, w, least(len(w), 10) AS size, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0)),
found AS (
    SELECT doc, i, size, phrase
    FROM (SELECT doc, i, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
          FROM (SELECT doc, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, lengths WHERE len(w) >= size))
    WHERE phrase IN (SELECT phrase FROM windows)),
hits AS (SELECT doc, count(DISTINCT place) AS n_hit FROM (SELECT doc, unnest(range(i, i + size)) AS place FROM found) GROUP BY doc),
listed AS (
    SELECT doc, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc, item_id::VARCHAR AS item FROM found JOIN windows USING (phrase) WHERE item_id IS NOT NULL) GROUP BY doc)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (doc) LEFT JOIN listed USING (doc)"""


@query("op13_decontamination", CONTAMINATION_CHECK)
def _(spark, sf_dir):
    from .contamination import decontaminate

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated"
    )


@query("op11_whitening")
def _(spark, sf_dir):
    from .whitening import train, whiten

    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    models = train(vectors)
    found = whiten(vectors, models).withColumn("_d", F.size("embedding"))
    facts = spark.createDataFrame(
        [(d, i + 1, m.n, share, m.identity_error) for d, m in models.items() for i, share in enumerate(m.explained)],
        "d int, component int, n bigint, explained double, identity_error double",
    )
    rows = found.select("vec_id", "deviation", "_d", F.posexplode("whitened").alias("_i", "whitened"))
    return rows.join(facts, (F.col("_d") == F.col("d")) & (F.col("_i") + 1 == F.col("component"))).select(
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
    )


NEGATIVES_CHECK = """
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scores AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike, list_inner_product(a.x, b.x)::BIGINT AS score
    FROM vectors a JOIN vectors b ON a.vec_id % 50 = 0 AND b.vec_id <> a.vec_id),
positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INT AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3"""


@query("op12_hard_negatives", NEGATIVES_CHECK)
def _(spark, sf_dir):
    from .hardnegatives import mine

    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)

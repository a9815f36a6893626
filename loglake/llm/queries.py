"""Registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake.llm import bpe, collocations, decontamination, fingerprints, html_text, licenses, line_dedup, near_dedup, packing, runs, secrets, toxicity, url_filter


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all pages. Listed are the pages of hosts named for what nobody trains on;
    their canonical URLs block every other spelling of the same pages."""
    pages = _table(spark, sf_dir, "pages")
    host, _, _ = url_filter.url_parts(F.col("url"))
    listed = pages.where(host.rlike(UNWANTED_HOST)).select("url")
    judged = url_filter.filter_urls(pages.select("page_id", "url"), listed, url_filter.RULES)
    return judged.select("page_id", "_url.host", "_url.path", "_url.rule", "_url.verdict")


#: A label of the host, or a word of one, that names an unwanted trade.
UNWANTED_HOST = "(^|[.-])(ads|adult|casino|phish|porn|spam)([.-]|$)"

OP8_SQL = r"""
WITH parts AS (
  SELECT page_id,
         CASE WHEN contains(u, '://') THEN substr(u, instr(u, '://') + 3) ELSE '' END AS rest
  FROM (SELECT page_id, coalesce(url, '') AS u FROM pages)
), split AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(rest, '^[^/?#]*[^?#]*\?([^#]*)', 1) AS query
  FROM parts
), spelled AS (
  SELECT *, array_to_string(list_sort(list_filter(string_split(query, '&'), lambda p:
             p <> '' AND NOT regexp_matches(p, '^(utm_[A-Za-z0-9_]*|ref|fbclid|gclid)(=|$)'))), '&') AS kept
  FROM split
), keyed AS (
  SELECT *, regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^www\.', '') || regexp_replace(path, '/+$', '')
            || CASE WHEN kept <> '' THEN '?' || kept ELSE '' END AS canonical,
         CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
              WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
              WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
              WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM spelled
), listed AS (
  SELECT DISTINCT canonical AS entry FROM keyed
  WHERE canonical <> '' AND regexp_matches(host, '(^|[.-])(ads|adult|casino|phish|porn|spam)([.-]|$)')
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN entry IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM keyed LEFT JOIN listed ON canonical = entry
"""


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in all documents, with counts and a digest of the base kinds."""
    found = secrets.scan_secrets(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: ~s["weak"])

    def count(kind: int):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"),
    )


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how alike they are."""
    compared = fingerprints.compare_edited(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return compared.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.fingerprint_text(F.col("fingerprint")).alias("fingerprint"),
        fingerprints.fingerprint_text(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op8_url_filter": op8_url_filter,
    "op9_secret_scan": op9_secret_scan,
    "op10_document_fingerprints": op10_document_fingerprints,
}

ORACLE_SQL: dict[str, str] = {"op8_url_filter": OP8_SQL}


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents, by three-word shingles at 0.85."""
    found = near_dedup.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"), 3, 85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


OP2_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3
           THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
           WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * both_ >= 85 * (p.n + q.n - both_)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y
), least AS (
  SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least USING (doc_id) LEFT JOIN sizes ON sizes.doc_id = d.doc_id
"""

QUERIES["op2_minhash_near_dedup"] = op2_minhash_near_dedup
ORACLE_SQL["op2_minhash_near_dedup"] = OP2_SQL


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents against all benchmark items, windows of ten words."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.find_contamination(docs, _table(spark, sf_dir, "benchmark"))
    listed = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP4_SQL = r"""
WITH word_lists AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), item_lists AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_lists WHERE len(w) > 0)
), doc_windows AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS s
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM word_lists, (SELECT DISTINCT size FROM item_windows))
), hits AS (
  SELECT doc_id, i, size, item_id FROM doc_windows JOIN item_windows USING (size, s)
), hit_words AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS j FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS listed
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM word_lists LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

QUERIES["op4_benchmark_decontamination"] = op4_benchmark_decontamination
ORACLE_SQL["op4_benchmark_decontamination"] = OP4_SQL


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, by a model of the labels that may teach."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit_toxicity(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        F.col("_toxicity").alias("score"),
        (F.col("_toxicity") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


QUERIES["op7_toxicity"] = op7_toxicity


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of token ids in sequences of 1024."""
    packed = packing.pack_documents(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


QUERIES["op3_best_fit_packing"] = op3_best_fit_packing


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    found = html_text.extract_text(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", F.col("_text").alias("text"), F.length("_text").cast("long").alias("n_chars"))


QUERIES["op6_html_extraction"] = op6_html_extraction


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in all documents."""
    found = licenses.scan_licenses(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumn("differences", F.array_join("differences", "; "))


QUERIES["op5_license_scan"] = op5_license_scan


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that repeat an earlier one."""
    cleaned = line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", F.col("_gone").alias("n_gone"), F.col("_text").alias("text"))


QUERIES["op1_line_dedup"] = op1_line_dedup


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def looped_text(doc_id: Column, text: Column) -> Column:
    """The texts of op12: of each tenth document the words from some place on repeat themselves."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def looped(x: Column) -> Column:
        size = F.size(x["words"])
        at = F.struct(x["words"].alias("words"), (x["g"] % size).alias("a"), (x["g"] % 8 + 3).alias("parts"), size.alias("n"))
        return _let(at, lambda y: _let(F.struct(y["words"].alias("words"), y["a"].alias("a"), F.floor(F.lit(1) + (y["n"] - y["a"]) / y["parts"]).alias("p")), loop))

    def loop(z: Column) -> Column:
        place = lambda i: (z["a"] + (i - z["a"]) % z["p"] + 1).cast("int")
        return F.array_join(F.transform(z["words"], lambda w, i: F.when(i < z["a"], w).otherwise(F.element_at(z["words"], place(i)))), " ")

    some = _let(F.struct(words.alias("words"), F.floor(h / 10).alias("g")), looped)
    return F.when((h % 10 == 0) & text.rlike(r"[^\x20\x09-\x0D]"), some).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words in all documents, the longest of each, and the texts without what they repeat."""
    docs = _table(spark, sf_dir, "documents")
    found = runs.collapse_runs(docs.select("doc_id", looped_text(F.col("doc_id"), F.col("text")).alias("text")))
    longest = F.array_max(F.transform("_runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("_runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("_longest", longest).select(
        "doc_id",
        F.size("_runs").cast("long").alias("n_runs"),
        (-F.col("_longest.start")).alias("start"),
        F.col("_longest.length").alias("length"),
        (-F.col("_longest.period")).alias("period"),
        F.floor(1000 * F.col("_longest.length") / -F.col("_longest.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("_collapsed", 256).alias("collapsed_sha256"),
    )


OP12_SQL = r"""
WITH hashed AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS o,
         xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
             lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)),
               lambda x, i: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END)))) AS h
  FROM documents
), looped AS (
  SELECT doc_id, o, len(o) AS n, h % 10 = 0 AND len(o) > 0 AS loops, CASE WHEN len(o) > 0 THEN (h // 10) % len(o) END AS a, h // 10 AS g FROM hashed
), texts AS (
  SELECT doc_id, CASE WHEN loops THEN list_transform(range(0, n), lambda i: o[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END])
                 ELSE o END AS w
  FROM looped
), grams AS (
  SELECT doc_id, i, array_to_string(w[i + 1:i + 5], ' ') AS s FROM (SELECT doc_id, w, unnest(range(0, len(w) - 4)) AS i FROM texts)
), alike AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.s = y.s AND x.i < y.i
), stretches AS (
  SELECT doc_id, q AS period, min(i) AS start, count(*) + 4 + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM alike)
  GROUP BY doc_id, q, island
), found AS (
  SELECT doc_id, start, length, min(period) AS period FROM stretches WHERE length >= greatest(6, 4 * period) GROUP BY doc_id, start, length
), counted AS (
  SELECT doc_id, count(*) AS n_runs, max((length, -start, -period)) AS best,
         string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed
  FROM found GROUP BY doc_id
), dropped AS (
  SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM found
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS i FROM texts) ANTI JOIN dropped USING (doc_id, i)
  GROUP BY doc_id
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, -best[2] AS start, best[1] AS length, -best[3] AS period,
       1000 * best[1] // -best[3] AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM texts LEFT JOIN counted USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

QUERIES["op12_periodic_runs"] = op12_periodic_runs
ORACLE_SQL["op12_periodic_runs"] = OP12_SQL


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents by the multilingual byte-level vocabulary, and what they decode to."""
    encoded = bpe.encode_texts(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    digests = encoded.select(
        "doc_id",
        F.size("_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        "_ids",
    )
    return bpe.decode_ids(digests).select("doc_id", "n_tokens", "ids_sha256", F.sha2("_bytes", 256).alias("decoded_sha256"))


QUERIES["op13_byte_bpe"] = op13_byte_bpe


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of each language in all documents."""
    found = collocations.collocations(_table(spark, sf_dir, "documents").select("lang", "text"), top=2000)
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


OP11_SQL = r"""
WITH split AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM split
), grams AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM pieces, (VALUES (1), (2), (3), (4)) AS s(size))
  GROUP BY ALL
), frequent AS (
  SELECT * FROM grams WHERE f >= 30
), candidates AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM frequent WHERE size > 1
), cuts AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:size], ' ') AS rest
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)
), scored AS (
  SELECT c.lang, c.phrase, c.a, min((2000000::HUGEINT * c.a // (x.f + y.f), k, x.f, y.f)) AS best
  FROM cuts c JOIN frequent x ON x.lang = c.lang AND x.phrase = c.head JOIN frequent y ON y.lang = c.lang AND y.phrase = c.rest
  GROUP BY ALL
), inner_phrases AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, a AS longer
  FROM (SELECT *, unnest(range(1, size - m + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS m FROM candidates WHERE size > 2))
), covered AS (
  SELECT DISTINCT c.lang, c.phrase FROM candidates c JOIN inner_phrases i ON i.lang = c.lang AND i.phrase = c.phrase WHERE 100 * longer >= 80 * a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY best[1] DESC, a DESC, phrase) AS rank
  FROM scored ANTI JOIN covered USING (lang, phrase)
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE size = 1 GROUP BY lang
)
SELECT lang, rank, phrase, a, best[3] AS l, best[4] AS r, n, best[1]::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

QUERIES["op11_collocations"] = op11_collocations
ORACLE_SQL["op11_collocations"] = OP11_SQL

"""The registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidebars.llm import (bpe, decontamination, language, license_scan, merkle, quality, secret_scan, simhash, spelling,
                          suffix_dedup, token_counts, token_files, top_k)
from tidebars.llm.frames import documents, held_out, pick
from tidebars.session import scratch_dir

#: The vocabulary files of op4 and op6 and of op8, and the id that op6 puts behind each document.
BYTE_BPE = "byte_bpe_50k.json"
BYTE_RANKS = "byte_bpe_50k.tiktoken"
END_ID = 2

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(documents(spark, sf_dir), "doc_id", "text")
    found = decontamination.find_contamination(docs, documents(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        decontamination.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


SQL["op1_decontamination"] = """
WITH doc AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), item AS (
  SELECT cast(item_id AS varchar) AS item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), sized AS (SELECT *, least(13, len(w)) AS k FROM item WHERE len(w) > 0
), cuts AS (SELECT item_id, k, w, unnest(generate_series(1, len(w) - k + 1)) AS i FROM sized
), wins AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS win FROM cuts
), places AS (SELECT rid, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
              FROM doc, (SELECT DISTINCT k FROM wins) WHERE len(w) >= k
), found AS (SELECT p.rid, p.i, p.k, x.item_id FROM places p JOIN wins x
             ON x.k = p.k AND x.win = array_to_string(p.w[p.i:p.i + p.k - 1], ' ')
), hits AS (SELECT rid, count(DISTINCT j) AS n_hit FROM (SELECT rid, unnest(generate_series(i, i + k - 1)) AS j FROM found) GROUP BY rid
), ids AS (SELECT rid, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS listed FROM found GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hits USING (rid) LEFT JOIN ids USING (rid)
"""


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = simhash.simhash_components(documents(spark, sf_dir))
    return linked.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


def coded_digests(coded: DataFrame) -> DataFrame:
    rows = pick(coded, "doc_id", "n_tokens", "ids", "decoded")
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query
def op4_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    docs = pick(documents(spark, sf_dir), "doc_id", "text")
    return coded_digests(bpe.round_trip(docs, path or public_tokenizers.path(BYTE_BPE), remembered=2 * bpe.REMEMBERED))


@query
def op6_token_files(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    folder = scratch_dir(spark, "token-files")
    token_files.write_token_files(documents(spark, sf_dir), folder, path or public_tokenizers.path(BYTE_BPE), END_ID)
    back = token_files.read_token_files(spark, folder)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(documents(spark, sf_dir), "doc_id", "text")
    model = quality.fit_rules(docs, documents(spark, sf_dir, "labels"))
    return quality.score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = language.identify(pick(docs, "doc_id", "text"), language.fit_languages(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(pick(documents(spark, sf_dir), "doc_id", "text"))
    base = F.filter("secrets", lambda s: s["kind"].isin(*secret_scan.LEAST))
    counts = [F.expr(f"cast(size(filter(secrets, s -> s.kind = '{k}')) AS bigint) AS n_{k}") for k in secret_scan.LEAST]
    digest = F.sha2(secret_scan.listed(base).cast("binary"), 256)
    return found.select("doc_id", *counts, digest.alias("base_sha256"), secret_scan.listed(F.col("secrets")).alias("spans"))


def _secrets_sql() -> str:
    quoted = lambda p: "'" + p.replace("'", "''") + "'"
    kinds = [(k, p, f"length(regexp_extract(value, {quoted(p)}, 2)) >= 8" if k == "assign" else "true") for k, p in secret_scan.BASE]
    plain = [p.replace("*+", "*").replace("++", "+").replace("}+", "}") for p in secret_scan.ALLOWED]
    refused = " AND ".join(f"NOT regexp_matches(value, {quoted(p)})" for p in plain)
    kinds += [(c.kind, c.pattern, " AND ".join(f"regexp_matches(value, {quoted(p)})" for p in c.holds) + " AND " + refused)
              for c in secret_scan.CLASSES]
    cut = " UNION ALL ".join(
        f"SELECT rid, '{k}' AS kind, {i} AS rank, regexp_extract_all(t, {quoted(p)}) AS found, regexp_split_to_array(t, {quoted(p)}) AS gaps"
        f" FROM doc WHERE regexp_matches(t, {quoted(p)})" for i, (k, p, _) in enumerate(kinds))
    keep = " OR ".join(f"(kind = '{k}' AND {c})" for k, _, c in kinds)
    windows = " UNION ALL ".join(
        f"SELECT rid, kind, rank, start, unnest(generate_series(0, length(value) - {c.window})) AS off, {c.window} AS w, {c.most} AS most, "
        + ("lower(value)" if "hex" in c.kind else "translate(value, '-_', '+/')") + f" AS v FROM held WHERE kind = '{c.kind}'"
        for c in secret_scan.CLASSES)
    base = len(secret_scan.BASE)
    return f"""
WITH doc AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), cut AS ({cut}
), numbered AS (SELECT *, unnest(generate_series(1, len(found))) AS i FROM cut
), placed AS (SELECT rid, kind, rank, found[i] AS value,
  list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS start FROM numbered
), held AS (SELECT * FROM placed WHERE {keep}
), windows AS ({windows}
), letters AS (SELECT rid, kind, rank, start, off, w, most, unnest(string_split(substr(v, off + 1, w), '')) AS c FROM windows
), counted AS (SELECT rid, kind, rank, start, off, w, most, c, count(*) AS n FROM letters GROUP BY ALL
), sums AS (SELECT rid, kind, rank, start, off, w, most, sum(cast(round(n * log2(n) * 1000000) AS bigint)) AS s FROM counted GROUP BY ALL
), stretches AS (SELECT rid, kind, rank, start + min(off) AS a, start + max(off) + any_value(w) AS b FROM sums WHERE s <= most GROUP BY rid, kind, rank, start
), base AS (SELECT rid, kind, rank, start AS a, start + length(value) AS b FROM held WHERE rank < {base}
), spans AS (SELECT * FROM base UNION ALL SELECT * FROM stretches s
  WHERE NOT EXISTS (SELECT 1 FROM base x WHERE x.rid = s.rid AND s.a < x.b AND x.a < s.b)
), listed AS (SELECT rid, {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k, _ in secret_scan.BASE)},
  string_agg(kind || ':' || cast(a AS bigint) || ':' || cast(b AS bigint), ',' ORDER BY a, rank, b) AS spans,
  string_agg(kind || ':' || cast(a AS bigint) || ':' || cast(b AS bigint), ',' ORDER BY a, rank, b) FILTER (rank < {base}) AS base
  FROM spans GROUP BY rid)
SELECT doc_id, {', '.join(f"coalesce(n_{k}, 0) AS n_{k}" for k, _ in secret_scan.BASE)}, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans FROM doc LEFT JOIN listed USING (rid)
"""


SQL["op5_secrets"] = _secrets_sql()


@query
def op8_token_counts(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    docs = pick(documents(spark, sf_dir), "doc_id", "text")
    return token_counts.count_tokens(docs, path or public_tokenizers.path(BYTE_RANKS)).select("doc_id", "n_pieces", "n_tokens")


@query
def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(documents(spark, sf_dir, "embeddings"))


SQL["op9_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x AS double)) AS bigint)) AS c FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, d.vec_id, cast(list_sum(list_transform(list_zip(q.c, d.c), lambda p: p[1] * p[2])) AS bigint) AS score
  FROM (SELECT DISTINCT vec_id, c FROM v WHERE vec_id % 20 = 0) q JOIN v d ON d.vec_id <> q.vec_id
)
SELECT query_id, cast(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS int) AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""


@query
def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.find_licenses(pick(documents(spark, sf_dir), "doc_id", "text"))
    return found.select("doc_id", F.size("licenses").cast("bigint").alias("n_licenses"), F.array_join("licenses", ",").alias("licenses"),
                        F.size("matches").cast("bigint").alias("n_templates"))


def _licenses_sql() -> str:
    index = license_scan.TemplateIndex([(n, t.encode()) for n, t in license_scan.TEMPLATES])
    rows = ", ".join(
        f"({t}, '{index.names[t]}', {c.size}, {c.step}, {len(own)}, '{' '.join(w.decode() for w in s)}')"
        for t, own in enumerate(index.shingles) for s in own for c in index.classes
        if c.size == index.sizes[t] and c.step == 1 << (len(own) - 1).bit_length())
    return f"""
WITH doc AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), shingle(template, license, size, step, n, words) AS (VALUES {rows}
), places AS (SELECT rid, size, unnest(generate_series(0, len(w) - size)) AS p, w FROM doc, (SELECT DISTINCT size FROM shingle) WHERE len(w) >= size
), hits AS (SELECT rid, template, license, step, n, p, words FROM places x JOIN shingle s
            ON s.size = x.size AND s.words = array_to_string(x.w[p + 1:p + x.size], ' ')
), windows AS (SELECT rid, template, license, n, words, p // step AS k FROM hits
  UNION ALL SELECT rid, template, license, n, words, p // step - 1 FROM hits WHERE step > 1 AND p >= step
), matched AS (SELECT DISTINCT rid, template, license FROM (
  SELECT rid, template, license, n, k FROM windows GROUP BY ALL HAVING count(DISTINCT words) >= {license_scan.CONTAINED} * n))
SELECT doc_id, count(DISTINCT license) AS n_licenses, coalesce(string_agg(DISTINCT license, ',' ORDER BY license), '') AS licenses,
       count(template) AS n_templates
FROM doc LEFT JOIN matched USING (rid) GROUP BY rid, doc_id
"""


SQL["op10_licenses"] = _licenses_sql()


#: What the manifest of the documents covers, in the order in which it is hashed.
LEAF_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


@query
def op13_merkle(spark: SparkSession, sf_dir: str, span_bits: int = merkle.SPAN_BITS) -> DataFrame:
    """A tampered leaf has one more in n_chars; the proofs are those of the untampered table."""
    one_more = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    tampered = merkle.leaf_hash(*(one_more if f == "n_chars" else F.col(f) for f in LEAF_FIELDS))
    manifest = merkle.manifest_of(documents(spark, sf_dir), LEAF_FIELDS, "lang", ["doc_id"], span_bits, tampered=tampered)
    proofs = manifest.leaves.select("tree", "idx", "doc_id", "leaf", "tampered").join(merkle.prove(manifest), ["tree", "idx"])
    folded = merkle.fold(F.col("tampered"), F.col("path"))
    return proofs.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
                         folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


@query
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(spelling.vocabulary(documents(spark, sf_dir), worn=199))


@query
def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(documents(spark, sf_dir))
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))

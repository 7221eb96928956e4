"""One query per corpus operator, over whole tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quipyard.llm import (
    bpe,
    decontamination,
    exact_dedup,
    fingerprints,
    merkle,
    neighbours,
    passages,
    periodic_runs,
    pii,
    sharding,
    simhash,
    suffix_tree_lm,
    token_shards,
    toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (spark, folder) under its own name."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def tokenizer_file() -> str:
    """Place of the public word-level BPE file."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/documents.parquet")


@query()
def op1_passages(spark: SparkSession, folder: str) -> DataFrame:
    return passages.repeated_passages(documents(spark, folder))


@query()
def op2_token_shards(spark: SparkSession, folder: str) -> DataFrame:
    shards = token_shards.write_shards(documents(spark, folder), tokenizer_file())
    return token_shards.read_documents(spark, shards)


@query()
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    labels = spark.read.parquet(f"{folder.rstrip('/')}/labels.parquet")
    return toxicity.score_documents(docs, toxicity.train(docs, labels))


@query()
def op4_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_personal_data(documents(spark, folder).select("doc_id", "text"))
    return found.select(
        "doc_id",
        *[pii.count_kind(F.col("base_spans"), kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS],
        F.sha2(pii.spans_text(F.col("base_spans")), 256).alias("base_sha256"),
        pii.spans_text(F.col("all_spans")).alias("spans"),
        pii.scores_text(F.col("all_spans")).alias("scores"),
    )


@query()
def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    near = simhash.near_duplicates(documents(spark, folder), shingle=4, distance=4)
    return near.select("doc_id", simhash.print_hex().alias("fingerprint"), "component_id")


@query(
    """
    WITH d AS (
      SELECT doc_id, coalesce(text, '') AS text,
             sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
      FROM documents),
    r AS (
      SELECT doc_id, text_sha256,
             first_value(doc_id) OVER best AS keep_id,
             row_number() OVER best AS place,
             count(*) OVER (PARTITION BY text_sha256) AS group_size
      FROM d
      WINDOW best AS (PARTITION BY text_sha256 ORDER BY length(text) DESC, doc_id))
    SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM r
    """
)
def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.mark_duplicates(documents(spark, folder)).drop("length")


@query()
def op7_suffix_tree(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_tree_lm.score_texts(documents(spark, folder))


@query()
def op8_feistel_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shuffle_into_shards(documents(spark, folder), shards=40)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "row",
    )


@query()
def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{folder.rstrip('/')}/benchmark.parquet")
    return decontamination.find_passages(documents(spark, folder), benchmark)


@query()
def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_decode(documents(spark, folder), tokenizer_file(), digests=True)


def with_planted_period(doc_id: Column, text: Column) -> Column:
    """The text, or for a tenth of the ids its words with a periodic tail, joined by spaces.

    Rows without an id are left as they are.
    """
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n = F.size(words)
    hashed = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(hashed / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    period = F.slice(words, a + 1, p)
    tail = F.slice(F.flatten(F.array_repeat(period, F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    edited = F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")
    return F.when((hashed % 10 == 0) & (n > 0), edited).otherwise(text)


def op11_digests(runs: Column, collapsed: Column) -> list[Column]:
    """Columns of the report on one text."""
    best = F.array_min(
        F.transform(runs, lambda r: F.struct((-r["length"]).alias("shorter"), r["start"].alias("start"), r["period"].alias("period")))
    )
    length = -best["shorter"]
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    listed = F.concat(F.array_join(F.transform(runs, line), "\n"), F.when(F.size(runs) > 0, "\n").otherwise(""))
    return [
        F.size(runs).cast("long").alias("n_runs"),
        best["start"].alias("start"),
        length.alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * length / best["period"]).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2(collapsed, 256).alias("collapsed_sha256"),
    ]


@query()
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    edited = documents(spark, folder).select("doc_id", with_planted_period(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs.collapse_runs(edited)
    return found.select("doc_id", *op11_digests(F.col("runs"), F.col("collapsed")))


@query()
def op12_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own = {"sketch": fingerprints.fingerprint(F.col("text")), "n_chars": F.length("text").cast("long")}
    pairs = neighbours.with_next(docs, "doc_id", "text", own, ["text", "sketch"])
    half = F.floor(F.col("n_chars") / 2).cast("int")
    kept = F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half)
    edited = pairs.withColumn("edited", F.concat(kept, F.substring("next_text", F.lit(1), half)))
    sketched = edited.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "sketch",
        fingerprints.fingerprint(F.col("edited")).alias("edited_sketch"),
        "next_sketch",
    )
    return sketched.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprints.to_text(F.col("sketch")).alias("fingerprint"),
        fingerprints.to_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        fingerprints.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        fingerprints.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        fingerprints.distinct_shingles(F.col("sketch")).alias("distinct_shingles"),
        fingerprints.containment(F.col("edited_sketch"), F.col("sketch")).alias("edited_in_own"),
    )


def _sql_leaf(n_chars: str) -> str:
    fields = [f"CAST({c} AS VARCHAR)" for c in ("doc_id", "source", "lang", n_chars, "text")]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


def _sql_tree(name: str, leaves: str) -> str:
    """Views `name`: every node (g, level, i, h, n nodes on its level), and `name`_steps: what a leaf meets on its way up."""
    return f"""
    {name} AS (
      SELECT g, 0 AS level, i, h, count(*) OVER (PARTITION BY g) AS n FROM {leaves}
      UNION ALL
      SELECT g, level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (max(n) + 1) // 2
      FROM {name} WHERE n > 1 GROUP BY g, level, i // 2),
    {name}_steps AS (
      SELECT a.g, a.i, list(CASE WHEN s.h IS NULL THEN 'N' WHEN (a.i >> u.level) & 1 = 1 THEN 'L' || s.h ELSE 'R' || s.h END
                            ORDER BY u.level) AS steps
      FROM {leaves} a JOIN (SELECT DISTINCT g, level FROM {name} WHERE n > 1) u ON a.g = u.g
      LEFT JOIN {name} s ON s.g = a.g AND s.level = u.level AND s.i = xor(a.i >> u.level, 1)
      GROUP BY a.g, a.i)"""


_SQL_CRC32 = """xor(list_reduce(
  list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
    lambda x, bit: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT)"""


@query(
    f"""
    WITH RECURSIVE hashed AS (
      SELECT doc_id, coalesce('=' || lang, '') AS g, {_sql_leaf("n_chars")} AS h,
             CASE WHEN {_SQL_CRC32} % 7 = 0 THEN {_sql_leaf("n_chars + 1")} END AS tampered
      FROM documents),
    leaves AS (
      SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS i FROM hashed),
    {_sql_tree("node", "leaves")},
    subroots AS (
      SELECT g AS name, '' AS g, row_number() OVER (ORDER BY g) - 1 AS i, h FROM node WHERE n = 1),
    {_sql_tree("upper_node", "subroots")},
    walked AS (
      SELECT l.doc_id, l.h AS leaf, r.h AS subroot, coalesce(l.tampered, l.h) AS claimed,
             (SELECT h FROM upper_node WHERE n = 1) AS root,
             list_concat(coalesce(a.steps, []), coalesce(b.steps, [])) AS steps
      FROM leaves l JOIN subroots r ON r.name = l.g
      LEFT JOIN node_steps a ON a.g = l.g AND a.i = l.i
      LEFT JOIN upper_node_steps b ON b.i = r.i),
    folded AS (
      SELECT *, list_reduce(list_prepend(claimed, steps), lambda h, s:
        CASE s[1] WHEN 'L' THEN sha256(s[2:] || h) WHEN 'R' THEN sha256(h || s[2:]) ELSE sha256(h) END) AS folded_root
      FROM walked)
    SELECT doc_id, leaf, subroot, root, folded_root, folded_root = root AS verified,
           sha256(array_to_string(list_transform(list_filter(steps, lambda s: s <> 'N'), lambda s: s[2:]), '')) AS proof_sha256
    FROM folded
    """
)
def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    changed = [F.col("n_chars") + 1 if c == "n_chars" else F.col(c) for c in columns]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    leaves = documents(spark, folder).select(
        "doc_id",
        "lang",
        merkle.leaf_hash([F.col(c) for c in columns]).alias("leaf"),
        F.when(tampered, merkle.leaf_hash(changed)).alias("tampered"),
    )
    manifest = merkle.build(leaves, "lang", "doc_id", "leaf", ["tampered"])
    checked = merkle.check_rows(manifest, F.coalesce("row.c0", "row.leaf"))
    return checked.select(
        F.col("row.id").alias("doc_id"), "row.leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )

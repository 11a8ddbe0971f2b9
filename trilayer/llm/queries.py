"""Queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trilayer.llm import (
    decision_list, decontaminate, filter_audit, katz, language, licenses, mixing, near_dup,
    periodic_runs, quality_fm, top_k, url_lists, warc,
)
from trilayer.sources.raw import table
from trilayer.workspace import written


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its set size, the smallest id of its group and whether it stays."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its size, its source's size and target, and the words the mix takes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its words inside benchmark windows and the items they are from."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.decontaminate(docs, items)
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out; a null id has
    no hash and is learned from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    models = language.learn(docs.filter(~held_out))
    found = language.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), models)
    return found.drop("text")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from labels that are not held out; a null id
    has no hash and no label."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    machine = quality_fm.learn(docs.filter(~held_out), labels.filter(~held_out))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return quality_fm.classify(rows, machine).drop("text")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document and the verdict of the rules learned from labelled
    documents that pass the base filter."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    measured = decision_list.statistics(docs).drop("text")
    measured = written(measured, "rules-statistics")
    open_rows = measured.filter(~F.col("base_failed"))
    rows = decision_list.labelled_rows(open_rows, table(spark, sf_dir, "labels"))
    found = decision_list.apply(measured, decision_list.learn(rows))
    return found.select(
        "doc_id", *decision_list.COUNTS, "base_failed", "kept", "rule", *decision_list.FEATURES[1:]
    )


def op1_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under a model of those that are not held out; a null
    id has no hash and is learned from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    found, _ = katz.score(docs.withColumn("train", ~held_out))
    return found.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score",
    )


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as the record read back from the archives written of all pages."""
    return warc.archive_and_read(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def list_entries(captures: DataFrame) -> DataFrame:
    """Dated entries of three lists, derived from the hosts of the captures."""
    day, start = 86_400, 1_704_067_200
    hosts = captures.select(url_lists.host(F.col("url")).alias("host")).filter("host != \"\"")
    hosts = hosts.distinct().withColumn("n", F.octet_length("host"))
    domains = hosts.select(F.substring_index("host", ".", -2).alias("host")).distinct()
    domains = domains.withColumn("n", F.octet_length("host"))

    def entries(rows, name, action, kind, days, tail=""):
        return rows.select(
            F.lit(name).alias("list"),
            F.concat(F.lit(kind + ":"), "host", F.lit(tail)).alias("pattern"),
            F.lit(action).alias("action"), (start + days * day).cast("long").alias("at"),
        )

    n = F.col("n")
    every = [
        entries(hosts.filter(n % 2 == 0), "hosts", "add", "host", n * 11 % 200),
        entries(hosts.filter(n % 2 == 0), "hosts", "remove", "host", n * 11 % 200 + 60),
        entries(hosts.filter(n % 4 == 0), "hosts", "add", "host", n * 11 % 200 + 120),
        entries(domains, "domains", "add", "domain", n * 17 % 150),
        entries(domains, "domains", "remove", "domain", n * 17 % 150 + 45),
        entries(hosts.filter(n % 3 == 0), "paths", "add", "prefix", n * 29 % 300, "/en"),
    ]
    found = every[0]
    for more in every[1:]:
        found = found.unionByName(more)
    return found


def op3_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, as a capture at a time derived from its id, with the list entries active
    then; a null id has no time and meets none."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    fetched = F.lit(1_704_067_200) + F.col("page_id") * 7919 % 31_622_400
    captures = pages.withColumn("fetched_at", fetched)
    found = url_lists.evaluate(captures, list_entries(captures))
    return found.select(
        "page_id", "fetched_at", "blocked", "n_active", F.array_join("active", ", ").alias("active")
    )


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of their source: up to two directories deep by id, each tenth
    being a licence file. Every row is a file of its own, with a path of its own if it has
    no id."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", "text", F.monotonically_increasing_id().alias("row"))
    number = F.coalesce("doc_id", -1 - F.col("row"))
    name = F.when(number % 10 == 0, "LICENSE").otherwise(
        F.concat(number.cast("string"), F.lit(".txt")))
    first = F.concat(F.lit("/a"), F.floor(number / 30) % 5)
    second = F.concat(F.lit("/b"), F.floor(number / 150) % 8)
    path = F.concat(
        F.coalesce("source", F.lit("unknown")),
        F.when(F.floor(number / 10) % 3 > 0, first).otherwise(""),
        F.when(F.floor(number / 10) % 3 > 1, second).otherwise(""), F.lit("/"), name,
    )
    files = docs.select(F.struct("row", "doc_id").alias("file"), path.alias("path"), "text")
    found = licenses.scan(files, "file", "path", "text")
    return found.select(F.col("file.doc_id").alias("doc_id"), *found.columns[1:])


def op11_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors of every vector whose id is divisible by 50."""
    found = top_k.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
    return found.select("query_id", "rank", "vec_id", "score")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters in all 120 orders, per source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return filter_audit.audit(docs, table(spark, sf_dir, "labels"))


def with_periods(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, text) of which each tenth, by a hash of the id, goes on from one
    of its words with copies of what follows there; a null id has no hash."""
    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(F.when(chosen, F.col("text")), F.lit(r"([^\x20\x09-\x0D]+)"), 1)
    rows = docs.select("doc_id", "text", g.alias("g"), words.alias("w"))
    rows = rows.withColumn("n", F.size("w")).withColumn(
        "a", F.when(F.col("n") > 0, F.pmod("g", "n")).cast("int")
    )
    length = (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    rows = rows.withColumn("p", length)
    rest = F.col("n") - F.col("a")
    block = F.slice("w", F.col("a") + 1, F.col("p"))
    copies = F.flatten(F.array_repeat(block, F.ceil(rest / F.col("p")).cast("int")))
    rewritten = F.concat_ws(" ", F.slice("w", F.lit(1), F.col("a")), F.slice(copies, F.lit(1), rest))
    return rows.select(
        "doc_id", F.when(F.col("n") > 0, rewritten).otherwise(F.col("text")).alias("text")
    )


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document: how many, the one of greatest exponent, and digests
    of all of them and of the text without what they repeat."""
    found = periodic_runs.find_runs(with_periods(table(spark, sf_dir, "documents")))
    ranked = F.transform("runs", lambda r: F.struct(
        (r["length"] / r["period"]).alias("exponent"), (-r["start"]).alias("earlier"),
        (-r["period"]).alias("shorter"), r["length"].alias("length")))
    lines = F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    digest = F.sha2(F.array_join(lines, ""), 256)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.array_max(ranked).alias("best"),
        digest.alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", (-F.col("best.earlier")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.shorter")).alias("period"),
        F.expr("1000 * best.length div -best.shorter").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256",
    )


QUERIES = {
    "op11_top_k": op11_top_k,
    "op12_filter_audit": op12_filter_audit,
    "op13_periodic_runs": op13_periodic_runs,
    "op9_licenses": op9_licenses,
    "op3_url_lists": op3_url_lists,
    "op5_warc": op5_warc,
    "op1_katz": op1_katz,
    "op2_quality_rules": op2_quality_rules,
    "op4_quality": op4_quality,
    "op8_language": op8_language,
    "op6_decontaminate": op6_decontaminate,
    "op7_near_duplicates": op7_near_duplicates,
    "op10_mixing": op10_mixing,
}

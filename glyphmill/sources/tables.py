"""Sources and sinks: explicit schemas, layered corpora, artifacts, rules, content hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SECTIONS = "section_seq bigint, ref string, source string, layer string, version string, license string, lines array<string>"
SENTENCES = "ref string, source string, layer string, license string, text string, n_words int, section_seq bigint, line_idx int, sent_idx int"
LEXICON = "skeleton string, category string, best string, count bigint, ratio double, variants array<struct<form:string,n:bigint>>, rabbinic string"
BIGRAMS = "prev string, skeleton string, form string"
NAMES = "skeleton string"
REVIEW = "skeleton string, count bigint, variants array<struct<form:string,n:bigint>>"
HOMOGRAPHS = "skeleton string, fixed string, default string, after map<string,string>, before map<string,string>"
OVERRIDES = "scope string, skeleton string, form string"
QUOTE_TOKENS = "span_id bigint, off int, form string, skeleton string"
QUOTE_NGRAMS = "key string, span_id bigint, off int"
QUOTE_SPANS = "span_id bigint, n int, ref string"
CORRECTIONS = "skeleton string, form string, paragraph string, context string"
PENDING = "skeleton string, paragraph string, context string, position int, note string, candidates array<string>, count bigint"
CATALOG = "key string, title string, layer string, commercial_ok boolean, note string, prefer_versions array<string>"


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with an explicit schema; blank lines are skipped."""
    return spark.read.schema(schema).json(path)


def write_corpus(sentences: DataFrame, path: str) -> None:
    """One folder per layer, so that reading some layers reads no other files."""
    sentences.write.mode("overwrite").partitionBy("layer").parquet(path)


def read_corpus(spark: SparkSession, path: str, layers: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.where(F.col("layer").isin(layers)) if layers else df


def write_artifact(df: DataFrame, path: str, form: str = "parquet") -> None:
    df.write.mode("overwrite").format(form).save(path)


def read_artifact(spark: SparkSession, path: str, schema: str, form: str = "parquet") -> DataFrame:
    """The artifact, or an empty table of its schema where none has been written."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema).format(form).load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def parse_homographs(rules: DataFrame) -> DataFrame:
    """(skeleton, json) to HOMOGRAPHS: a plain string decides at once, an object by after, before, default."""
    text = F.trim("json")
    obj = F.from_json("json", "struct<default:string,after:map<string,string>,before:map<string,string>>")
    plain = ~text.startswith("{")
    return rules.select("skeleton", F.when(plain, F.regexp_replace(text, '^"|"$', "")).alias("fixed"), F.when(~plain, obj["default"]).alias("default"), F.when(~plain, obj["after"]).alias("after"), F.when(~plain, obj["before"]).alias("before"))


def content_hash(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """One row (sha256): the hash of all row hashes in key order, for a frozen set of bounded size."""
    rows = df.select(key, F.sha2(F.concat_ws("\x1f", key, *columns), 256).alias("h"))
    return rows.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(key, "h"))), lambda r: r["h"]), ""), 256).alias("sha256"))


def flatten_text(nested: str, depth: int) -> object:
    """Column: the non-blank strings of a nested array of fixed depth, in order."""
    out = F.col(nested)
    for _ in range(depth - 1):
        out = F.flatten(out)
    return F.filter(out, lambda x: F.trim(x) != "")


def pick_version(versions: DataFrame, preferred: list[str]) -> DataFrame:
    """One version per ref: the first preferred title (substring, any case), else the first in the language, else the first."""
    title = F.lower("title")
    rank = F.coalesce(*[F.when(title.contains(p.lower()), i) for i, p in enumerate(preferred)], F.when(F.col("language") == "he", len(preferred)), F.lit(len(preferred) + 1))
    return versions.groupBy("ref").agg(F.min_by(F.struct("title", "license", "lines"), F.struct(rank, "idx")).alias("v")).select("ref", "v.title", F.coalesce(F.nullif("v.license", F.lit("")), F.lit("unknown")).alias("license"), "v.lines")


def section_refs(books: DataFrame) -> DataFrame:
    """(book, chapters, style) to (book, ref): chapters from 1, or folios 2a, 2b, 3a ..."""
    i = F.col("i")
    folio = F.concat((F.floor(i / 2) + 2).cast("string"), F.when(i % 2 == 0, "a").otherwise("b"))
    return books.select("book", "style", F.explode(F.sequence(F.lit(0), F.col("chapters") - 1)).alias("i")).select("book", F.concat_ws(" ", "book", F.when(F.col("style") == "folio", folio).otherwise((i + 1).cast("string"))).alias("ref"))


def license_log(sections: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """Sections per (source, version) with the licence verdict; earlier entries are added."""
    from ..functions.classify import license_verdict

    rows = sections.groupBy("source", "version").agg(F.count(F.lit(1)).alias("sections"), F.min_by("license", "section_seq").alias("license"), F.min_by("ref", "section_seq").alias("example_ref"))
    if earlier is not None:
        rows = rows.unionByName(earlier.select(*rows.columns)).groupBy("source", "version").agg(F.sum("sections").alias("sections"), F.first("license").alias("license"), F.min("example_ref").alias("example_ref"))
    return rows.withColumn("verdict", license_verdict(F.col("license")))


def unprocessed(incoming: DataFrame, done: DataFrame, key: str = "ref") -> DataFrame:
    return incoming.join(done.select(key).distinct(), key, "left_anti")

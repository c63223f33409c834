"""Readers of text collections. Schemas are explicit; malformed lines fail, or are counted and set aside."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ARTICLE = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "title", "content", "text", "url", "source", "language", "published_date")])


def strict_jsonl(spark: SparkSession, path: str, schema: T.StructType = ARTICLE) -> DataFrame:
    """Every line must parse; a path that matches nothing is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def permissive_jsonl(spark: SparkSession, path: str, schema: T.StructType = ARTICLE) -> DataFrame:
    """All lines; what does not parse is in ``_corrupt_record``."""
    extended = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    return spark.read.schema(extended).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def usable_jsonl(spark: SparkSession, path: str, schema: T.StructType = ARTICLE) -> DataFrame:
    """Lines that parse; others are skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def counters(rows: DataFrame) -> DataFrame:
    """Lines read, malformed, and usable."""
    # the reader refuses to read the corrupt column alone, so one more column is asked something that always holds
    other = F.col(next(c for c in rows.columns if c != "_corrupt_record")).cast("string")
    bad = F.col("_corrupt_record").isNotNull() & (other.isNull() | (F.length(other) >= 0))
    return rows.agg(F.count("*").alias("read"), F.count_if(bad).alias("malformed"), F.count_if(~bad).alias("usable"))


def next_batch(rows: DataFrame, processed: DataFrame, key: str, order: Sequence[str], n: int) -> DataFrame:
    """The next ``n`` rows in order that are not in ``processed``."""
    return rows.join(processed.select(key).distinct(), key, "left_anti").orderBy(*order).limit(n)


def newest_files(rows: DataFrame, most: int) -> DataFrame:
    """Rows of the ``most`` files with the greatest names; the few names are ranked, not the rows."""
    from pyspark.sql import Window

    named = rows.select("*", F.col("_metadata.file_name").alias("file"))
    names = named.select("file").distinct().withColumn("k", F.dense_rank().over(Window.orderBy(F.col("file").desc()))).filter(F.col("k") <= most).select("file")
    return named.join(F.broadcast(names), "file")


def nested(spark: SparkSession, root: str, pattern: str, schema: T.StructType = ARTICLE) -> DataFrame:
    return spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).json(root)


def splits(spark: SparkSession, paths: dict[str, str], schema: T.StructType = ARTICLE) -> DataFrame:
    """Union of the splits that exist; a missing one is left out."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    out = None
    for name, path in paths.items():
        p = hadoop.Path(path)
        if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
            part = spark.read.schema(schema).json(path).withColumn("split", F.lit(name))
            out = part if out is None else out.unionByName(part)
    if out is None:
        raise FileNotFoundError(f"none of {sorted(paths)}")
    return out


def cache_key(url: Column) -> Column:
    """The key that scraped texts are kept under."""
    return F.substring(F.sha2(url, 256), 1, 16)


def from_cache(rows: DataFrame, cache: DataFrame, url: str, least: int = 0) -> DataFrame:
    """``rows`` whose url is in ``cache`` (key, text) with a text of at least ``least`` characters, plus ``key`` and ``cached``."""
    found = cache.filter(F.length("text") >= least).select("key", F.col("text").alias("cached"))
    return rows.withColumn("key", cache_key(F.col(url))).join(found, "key")


def cohorts(spark: SparkSession, paths: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """Rows of several JSONL files in order; of an id (``id``, else ``article_id``) the first row stays.

    Rows without content go first, so that they claim no id. ``cohort`` is the file's place.
    """
    from lensmill.operators.relate import first_by

    both = T.StructType([*(schema or ARTICLE).fields, T.StructField("article_id", T.StringType())])
    out = None
    for k, path in enumerate(paths):
        part = spark.read.schema(both).json(path).withColumn("cohort", F.lit(k))
        out = part if out is None else out.unionByName(part)
    known = out.withColumn("id", F.coalesce("id", "article_id")).drop("article_id").filter((F.trim(F.coalesce("content", F.lit(""))) != "") & F.col("id").isNotNull())
    return first_by(known, ["id"], ["cohort"])


def id_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("id")).filter("id <> ''").distinct()


def flags_tsv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("sep", "\t").option("header", "true").schema("id STRING, cap STRING, title STRING").csv(path).filter("cap = 'Y'")


def matrix_to_long(bundle: DataFrame) -> DataFrame:
    """A prediction bundle (article_ids, dimension_names, predictions[n][k], labels[n][k]) as rows."""
    rows = bundle.select("dimension_names", F.explode(F.arrays_zip("article_ids", "predictions", "labels")).alias("r"))
    cells = rows.select(F.col("r.article_ids").alias("id"), F.explode(F.arrays_zip("dimension_names", F.col("r.predictions").alias("pred"), F.col("r.labels").alias("label"))).alias("c"))
    return cells.select("id", F.col("c.dimension_names").alias("dim"), F.col("c.pred").alias("pred"), F.col("c.label").alias("label"))


def explode_attributes(df: DataFrame, column: str, want: str, version: str | None = None, least: float | None = None) -> DataFrame:
    """One package's entry of a map of scores: names with - and _ alike, raw average before the plain one, finite only."""
    e = df.select("id", F.explode(column).alias("name", "a")).filter(F.translate("name", "-", "_") == want)
    if version is not None:
        e = e.filter(F.coalesce("a.version", "a.filter_version") == version)
    wa = F.coalesce("a.raw_weighted_average", "a.weighted_average")
    e = e.select("id", wa.alias("wa")).filter(F.col("wa").isNotNull() & ~F.isnan("wa") & (F.abs("wa") != float("inf")))
    return e if least is None else e.filter(F.col("wa") >= least)

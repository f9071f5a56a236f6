"""Landed files of other formats: JSON lines and CSV with their rejects, sitemap files and sitemap indexes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsluice.sources.pages import URL

#: Name of the column that holds a line that does not fit the schema.
REJECTED = "rejected"
#: Most sitemaps that one index may name, which is the protocol's own bound.
MOST_SITEMAPS = 50_000


def read_lines(spark: SparkSession, path: str | list[str], kind: str, schema: T.StructType | str, **options: str | bool) -> DataFrame:
    """The schema's columns and ``rejected`` of each line of JSON or CSV files.

    A line that does not fit the schema (broken off, a word where a number belongs, no object, too many or too few fields) is a row
    with itself in ``rejected``, beside what could be read of it; for all others that is null. No line is lost and none
    stops the job. The schema is given, never inferred, so that files are read once. Where ``rejected`` is asked for every
    column is parsed, or a line would count as good or bad by what else a query happens to read. CSV texts with line
    ends need ``multiLine=True``, which gives up splitting a file.
    """
    columns = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if kind not in ("json", "csv"):
        raise ValueError(f"lines are json or csv, not {kind}")
    if REJECTED in columns.names:
        raise ValueError(f"the schema may not have a column {REJECTED}")
    whole = T.StructType([*columns.fields, T.StructField(REJECTED, T.StringType())])
    reader = spark.read.schema(whole).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REJECTED)
    own = {"columnPruning": False, "escape": '"'} if kind == "csv" else {}
    rows = reader.options(**(own | options)).format(kind).load(path)
    # Nothing of each column is added to the rejected line, so that who asks for the line has all columns parsed.
    nothing = [F.coalesce(F.substring(F.col(f"`{c}`").cast("string"), 1, 0), F.lit("")) for c in columns.names]
    return rows.withColumn(REJECTED, F.concat(REJECTED, *nothing))


def read_sitemaps(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """loc, lastmod, changefreq, priority of each url of sitemap files, packed ones too; files are split by their urls.

    Namespaces are ignored, missing elements are null, and a url whose date or number cannot be read has null there.
    """
    return spark.read.format("xml").option("rowTag", "url").option("ignoreNamespace", True).option("mode", "PERMISSIVE").schema(URL).load(path)


def read_sitemap_index(spark: SparkSession, path: str) -> DataFrame:
    """loc and lastmod of each sitemap that an index names."""
    entry = T.StructType([T.StructField("loc", T.StringType()), T.StructField("lastmod", T.DateType())])
    return spark.read.format("xml").option("rowTag", "sitemap").option("ignoreNamespace", True).schema(entry).load(path)


def read_indexed(spark: SparkSession, index: str) -> DataFrame:
    """The urls of all sitemaps that an index names, each sitemap once. An index of more than MOST_SITEMAPS is refused."""
    named = [r["loc"].strip() for r in read_sitemap_index(spark, index).filter("loc is not null").select("loc").distinct().limit(MOST_SITEMAPS + 1).collect()]
    if len(named) > MOST_SITEMAPS:
        raise ValueError(f"{index} names more than {MOST_SITEMAPS} sitemaps")
    return read_sitemaps(spark, sorted(named)) if named else spark.createDataFrame([], URL)

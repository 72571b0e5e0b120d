"""Citation-manager JSON (CSL items) -> 9-column table (S3, with S9 and S10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from prismark.functions.fields import first_date_part, format_authors_csl

CSL_AUTHOR = T.StructType([T.StructField(n, T.StringType()) for n in ("literal", "family", "given")])
CSL_ITEM = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("container-title", T.StringType()),
    T.StructField("DOI", T.StringType()),
    T.StructField("URL", T.StringType()),
    T.StructField("abstract", T.StringType()),
    T.StructField("author", T.ArrayType(CSL_AUTHOR)),
    T.StructField("issued", T.StructType([T.StructField("date-parts", T.ArrayType(T.ArrayType(T.IntegerType())))])),
])


def csl_table(items: DataFrame, item_col: str | None = None) -> DataFrame:
    """Project CSL items (top-level columns, or one struct column) to ID, Type, Title,
    Journal, DOI, URL, Abstract, Authors, Year."""
    it = (lambda f: F.col(item_col)[f]) if item_col else (lambda f: F.col(f"`{f}`"))
    return items.select(
        it("id").alias("ID"),
        it("type").alias("Type"),
        it("title").alias("Title"),
        it("container-title").alias("Journal"),
        it("DOI").alias("DOI"),
        it("URL").alias("URL"),
        it("abstract").alias("Abstract"),
        F.coalesce(format_authors_csl(it("author")), F.lit("")).alias("Authors"),
        first_date_part(it("issued")["date-parts"]).alias("Year"),
    )


def read_csl_json(spark: SparkSession, path: str) -> DataFrame:
    """S3: a JSON array of CSL items (whole-file records) with an explicit schema."""
    items = spark.read.schema(CSL_ITEM).option("multiLine", True).json(path)
    return csl_table(items)


def parse_csl_column(c: Column) -> Column:
    """One CSL item held as JSON text -> struct (same schema as the file reader)."""
    return F.from_json(c, CSL_ITEM)

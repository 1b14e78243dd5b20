"""Category dimension: JSON list → ``(category_id int, title string, assignable boolean)``.

The dimension is small by nature (a few dozen categories); operators that
join it check that bound before broadcasting it (``operators.joins``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CATEGORY_JSON_SCHEMA = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("etag", T.StringType()),
        T.StructField(
            "items",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("kind", T.StringType()),
                        T.StructField("etag", T.StringType()),
                        T.StructField("id", T.StringType()),
                        T.StructField(
                            "snippet",
                            T.StructType(
                                [
                                    T.StructField("channelId", T.StringType()),
                                    T.StructField("title", T.StringType()),
                                    T.StructField("assignable", T.BooleanType()),
                                ]
                            ),
                        ),
                    ]
                )
            ),
        ),
    ]
)


def read_categories(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Read a category-list JSON document (one object with ``items[]``,
    spread over many lines) into one row per category."""
    doc = spark.read.schema(CATEGORY_JSON_SCHEMA).option("multiLine", True).json(path)
    items = doc.select(F.explode("items").alias("item"))
    return items.select(
        F.col("item.id").try_cast("int").alias("category_id"),
        F.col("item.snippet.title").alias("title"),
        F.col("item.snippet.assignable").alias("assignable"),
    ).where(F.col("category_id").isNotNull())


def category_items(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Every item of the category documents in ``path`` (one JSON document a
    file), usable or not: ``file``, ``position`` (from 0), ``category_id``,
    ``title``, ``assignable`` and ``reason``, which is null for a usable item.

    A document is parsed once into a ``VARIANT`` and its items are cast one by
    one, so a broken item costs that item and not its document. Reasons:
    ``document`` (no JSON), ``items`` (no list of items), ``id`` (no whole
    number, as number or text), ``title`` (missing or no text)."""
    doc = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("file"), F.try_parse_json("value").alias("doc")
    )
    items = F.try_variant_get("doc", "$.items", "array<variant>")
    found = doc.select("file", F.col("doc").isNull().alias("_bad"), items.isNull().alias("_none"), F.posexplode_outer(items).alias("position", "item"))
    title = F.when(F.schema_of_variant(F.try_variant_get("item", "$.snippet.title", "variant")) == "STRING", F.try_variant_get("item", "$.snippet.title", "string"))
    typed = found.select(
        "file", "position", F.try_variant_get("item", "$.id", "string").try_cast("int").alias("category_id"), title.alias("title"),
        F.try_variant_get("item", "$.snippet.assignable", "boolean").alias("assignable"), "_bad", "_none",
    )
    reason = (
        F.when(F.col("_bad"), "document").when(F.col("_none"), "items")
        .when(F.col("category_id").isNull(), "id").when(F.col("title").isNull(), "title")
    )
    empty = F.col("position").isNull() & ~F.col("_bad") & ~F.col("_none")  # a list without items
    return typed.where(~empty).select("file", "position", "category_id", "title", "assignable", reason.alias("reason"))


def categories_from_table(df: DataFrame, id_col: str, title_col: str) -> DataFrame:
    """Any table with an id and a title column as the dimension."""
    return df.select(
        F.col(id_col).cast("int").alias("category_id"),
        F.col(title_col).alias("title"),
        F.lit(True).alias("assignable"),
    )

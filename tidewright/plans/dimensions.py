"""Dimension tables: products, stations, operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.texts import code_prefix, strip_marks
from ..operators.incremental import first_source_wins

# Finance classes of the product codes.
PLANT, LIFESTYLE, SPECIAL, PERIODICAL, BOOK = (
    "3-植物", "4-不二生活", "5-特殊商品", "2-期刊&电子出版物", "1-图书",
)
NEW_ITEM, OLD_ITEM = "新品", "老品"
# The two product families.
FAMILY = {True: ("BA", "文创"), False: ("BK", "出版物")}


def product_dimension(
    products: DataFrame, suppliers: DataFrame, types: DataFrame, day: dt.date
) -> DataFrame:
    """Products with category levels from the type code, finance class and new/old state.

    ``day`` is the run date; an item is new when it came in the year of the day before.
    """
    code = F.col("h_type")
    gift = F.left(code, F.lit(2)) == "13"
    out = products.join(
        suppliers.select(
            F.col("f_id").alias("h_factory"), F.col("f_department").alias("supplier_name")
        ),
        "h_factory",
        "left",
    ).select(
        F.date_format("h_input_date", "yyyy-MM-dd HH:mm:ss").alias("create_time"),
        F.year("h_input_date").alias("_year"),
        F.col("h_id").alias("product_code"),
        strip_marks(F.col("h_name")).alias("product_name"),
        F.col("h_isbn").alias("product_isbn"),
        F.col("h_output_price").alias("product_price"),
        F.col("h_factory").alias("supplier_code"),
        "supplier_name",
        F.when(gift, FAMILY[True][0]).otherwise(FAMILY[False][0]).alias("category_one_code"),
        F.when(gift, FAMILY[True][1]).otherwise(FAMILY[False][1]).alias("category_one_name"),
        code_prefix(code, 2).alias("category_two_code"),
        code_prefix(code, 4).alias("category_three_code"),
        code_prefix(code, 6).alias("category_four_code"),
        F.when(F.length(code) > 6, code).alias("category_five_code"),
    )
    for level in ("two", "three", "four", "five"):
        names = types.select(
            F.col("h_type").alias(f"category_{level}_code"),
            F.col("type_name").alias(f"category_{level}_name"),
        )
        out = out.join(names, f"category_{level}_code", "left")
    two, four = F.col("category_two_code"), F.col("category_four_code")
    return out.select(
        "create_time", "product_code", "product_name", "product_isbn", "product_price",
        "supplier_code", "supplier_name", "category_one_code", "category_one_name",
        *[f"category_{n}_{p}" for n in ("two", "three", "four", "five") for p in ("code", "name")],
        F.when(four == "130503", PLANT)
        .when((two == "13") & (four != "130503"), LIFESTYLE)
        .when(two == "15", SPECIAL)
        .when(two.isin("14", "22"), PERIODICAL)
        .otherwise(BOOK)
        .alias("fina_category_name"),
        F.when(F.col("_year") == F.lit((day - dt.timedelta(days=1)).year), NEW_ITEM)
        .otherwise(OLD_ITEM)
        .alias("product_state"),
    )


def product_wide(
    skus: DataFrame, spus: DataFrame, spu_authors: DataFrame, authors: DataFrame,
    suppliers: DataFrame, categories: DataFrame, territories: DataFrame, spu_brands: DataFrame,
    brands: DataFrame,
) -> DataFrame:
    """One row per sku with category path, supplier, brand and the authors' names joined by commas.

    Null names are left out; a product without any other has a null list.  The list is one value
    of the result, so its names meet in one row; equal names are counted before they are moved.
    """
    counted = (
        spu_authors.join(authors, "author_code")
        .where(F.col("author_name").isNotNull())
        .groupBy("spu_code", "author_name")
        .agg(F.count(F.lit(1)).cast("int").alias("_times"))
    )
    author_names = counted.groupBy("spu_code").agg(
        F.array_join(
            F.flatten(
                F.transform(
                    F.sort_array(F.collect_list(F.struct("author_name", "_times"))),
                    lambda name: F.array_repeat(name["author_name"], name["_times"]),
                )
            ),
            ",",
        ).alias("author_name")
    )
    brand = (
        spu_brands.join(brands, "brand_code", "left")
        .groupBy("spu_code")
        .agg(F.min(F.struct("brand_code", "brand_name", "brand_line_name")).alias("_brand"))
    )
    content = F.col("content_type") == 1
    # A territory the table lacks leaves the path empty.
    code = F.when(content, F.col("_territory")).otherwise(F.col("category_code"))
    rows = (
        skus.join(spus, "spu_code")
        .join(author_names, "spu_code", "left")
        .join(suppliers.select("supplier_code", "supplier_name"), "supplier_code")
        .join(
            categories.select(
                F.col("category_code").alias("background_category_code"), "category_name"
            ),
            "background_category_code",
        )
        .withColumnRenamed("background_category_code", "category_code")
        .join(
            territories.select(
                "territory_code", "territory_name", F.col("territory_code").alias("_territory")
            ),
            "territory_code",
            "left",
        )
        .join(brand, "spu_code")
    )
    return rows.select(
        "sku_code", "bar_code", "sku_name", "price", "content_type",
        F.left(code, F.lit(2)).alias("first_classification_code"),
        F.left(code, F.lit(4)).alias("second_classification_code"),
        F.left(code, F.lit(6)).alias("third_classification_code"),
        code.alias("fourth_classification_code"),
        F.when(content, F.col("territory_name"))
        .otherwise(F.col("category_name"))
        .alias("classification_name"),
        "supplier_code", "supplier_name", "author_name", "start_flow_location", "goods_index",
        "spu_status",
        F.date_format("create_time", "yyyy-MM-dd").alias("create_time"),
        "_brand.brand_code", "_brand.brand_name", "_brand.brand_line_name",
    )


def station_dimension(stations: DataFrame, on_new_system: DataFrame, extra: DataFrame) -> DataFrame:
    """Stations with the book system they use and the attributes kept elsewhere."""
    moved = on_new_system.select("station_code").distinct().withColumn("_moved", F.lit(True))
    return (
        stations.join(
            moved.withColumnRenamed("station_code", "new_station_code"), "new_station_code", "left"
        )
        .join(
            extra.select("new_station_code", "logsystem_code", "station_name_all"),
            "new_station_code",
        )
        .withColumn("bookstore_system", F.when(F.col("_moved"), "ERP").otherwise("YH"))
        .drop("_moved")
    )


def operator_dimension(first: DataFrame, second: DataFrame) -> DataFrame:
    """Operators of the first source, then those only the second knows."""
    columns = ["user_code", "user_name"]
    return first_source_wins(first.select(*columns), second.select(*columns), ["user_code"])

"""Catalog JSON documents (S1, S2): products and their data files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STR = T.StringType()
FILE_STRUCT = T.StructType([T.StructField(n, STR) for n in [
    "fileName", "fileSize", "fileDownloadURI", "fileDataFromDate", "fileDataToDate", "fileTypeText",
    "fileReleaseDate", "fileLastModifiedDateTime"]])
PRODUCT_STRUCT = T.StructType([
    *[T.StructField(n, STR) for n in ["productIdentifier", "productTitleText", "productDescriptionText",
                                      "productFrequencyText", "productFromDate", "productToDate",
                                      "productTotalFileSize", "productFileTotalQuantity", "lastModifiedDateTime"]],
    T.StructField("mimeTypeIdentifierArrayText", T.ArrayType(STR)),
    T.StructField("productFileBag", T.StructType([T.StructField("fileDataBag", T.ArrayType(FILE_STRUCT))])),
])
CATALOG_SCHEMA = T.StructType([T.StructField("count", T.LongType()),
                               T.StructField("bulkDataProductBag", T.ArrayType(PRODUCT_STRUCT))])


def read_catalog(spark: SparkSession, paths, multi_line: bool = False) -> DataFrame:
    return spark.read.schema(CATALOG_SCHEMA).option("multiLine", str(multi_line).lower()).json(paths)


def products(catalog: DataFrame) -> DataFrame:
    """One row per product, fields renamed; ``formats`` defaults to an empty array."""
    p = catalog.select(F.explode("bulkDataProductBag").alias("p"))
    return p.select(
        F.col("p.productIdentifier").alias("product_id"), F.col("p.productTitleText").alias("title"),
        F.col("p.productDescriptionText").alias("description"), F.col("p.productFrequencyText").alias("frequency"),
        F.col("p.productFromDate").alias("from_date"), F.col("p.productToDate").alias("to_date"),
        F.col("p.productTotalFileSize").try_cast("bigint").alias("total_size"),
        F.col("p.productFileTotalQuantity").try_cast("bigint").alias("file_count"),
        F.col("p.lastModifiedDateTime").alias("last_modified"),
        F.coalesce(F.col("p.mimeTypeIdentifierArrayText"), F.array().cast("array<string>")).alias("formats"),
        F.col("p.productFileBag.fileDataBag").alias("files"))


def data_files(products_df: DataFrame, file_type: str = "Data") -> DataFrame:
    """One row per data file of each product, with its position in the catalog list."""
    f = products_df.select("product_id", F.posexplode(F.coalesce("files", F.array().cast(T.ArrayType(FILE_STRUCT))))
                           .alias("position", "f"))
    return f.filter(F.col("f.fileTypeText") == file_type).select(
        "product_id", "position", F.col("f.fileName").alias("file_name"),
        F.col("f.fileSize").try_cast("bigint").alias("file_size"), F.col("f.fileDownloadURI").alias("file_url"),
        F.col("f.fileDataFromDate").alias("from_date"), F.col("f.fileDataToDate").alias("to_date"),
        F.col("f.fileLastModifiedDateTime").alias("last_modified"))

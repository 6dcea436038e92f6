"""Tables out of JSON, JSON lines and raw text files, and versions of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StringType, StructType

BAD = "_corrupt_record"


def records(spark: SparkSession, path: str, schema: StructType, field: str = "records") -> DataFrame:
    """The rows of ``{"records": [...]}`` documents."""
    whole = StructType([StructField(field, schema_array(schema))])
    return spark.read.schema(whole).option("multiLine", True).json(path).select(F.inline(field))


def schema_array(schema: StructType):
    from pyspark.sql.types import ArrayType

    return ArrayType(schema)


def optional(spark: SparkSession, path: str, schema: StructType, field: str = "records") -> DataFrame:
    """``records``, or no rows if there is no such file."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return records(spark, path, schema, field) if there else spark.createDataFrame([], schema)


def lines(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """JSON lines as (good rows, bad lines with their file): bad lines are handed over, not dropped unseen."""
    wide = StructType([*schema.fields, StructField(BAD, StringType())])
    raw = spark.read.text(path).filter(F.trim("value") != "").select("value", F.col("_metadata.file_path").alias("path"))
    parsed = raw.select("path", "value", F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}).alias("r"))
    bad = F.col("r").isNull() | F.col(f"r.{BAD}").isNotNull()
    return parsed.filter(~bad).select(*(F.col(f"r.{f.name}").alias(f.name) for f in schema.fields)), parsed.filter(bad).select("path", "value")


def latest(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key by an explicit order column."""
    return df.groupBy(key).agg(F.max_by(F.struct(*df.columns), order).alias("r")).select("r.*")


def harvest(spark: SparkSession, paths: str | list[str], pattern: str) -> DataFrame:
    """Distinct matches of a pattern in any text file: what has been used before."""
    return spark.read.text(paths).select(F.explode(F.regexp_extract_all("value", F.lit(pattern), F.lit(0))).alias("match")).distinct()


#: One item of a list that is written as text: in single or double quotes with escapes, else up to a comma.
ITEM = r"""'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^,\[\]'"\s][^,\[\]]*+"""


def coerced_list(column):
    """A list that may be stored as JSON or as a program prints it: items in either kind of quotes, which may hold the other
    kind, commas and brackets; bare items are texts and None is null. Anything else is null."""
    column = F.trim(F.col(column) if isinstance(column, str) else column)
    inside = F.trim(column.substr(F.lit(2), F.length(column) - 2))
    items = F.regexp_extract_all(inside, F.lit(f"(?s)({ITEM})"), F.lit(1))
    marks = F.regexp_replace(F.regexp_replace(inside, f"(?s){ITEM}", "x"), r"\s", "")
    listed = F.startswith(column, F.lit("[")) & F.endswith(column, F.lit("]")) & marks.rlike("^[x,]*$") & ~marks.rlike("xx|,,|^,")

    def plain(x):
        inner = F.regexp_replace(x.substr(F.lit(2), F.length(x) - 2), r"(?s)\\(.)", "$1")
        bare = F.rtrim(x)
        return F.when(x.rlike("^['\"]"), inner).when(bare.isin("None", "null"), F.lit(None)).otherwise(bare)

    return F.when(listed, F.transform(items, plain))


def versions(snapshots: dict[int, DataFrame]) -> DataFrame:
    """Snapshots as one table with their number in ``version``."""
    out = None
    for n, df in snapshots.items():
        df = df.withColumn("version", F.lit(n))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out

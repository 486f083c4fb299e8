"""Scans: JSON lines, typed CSV, string dimensions, categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.clean import NUMERIC_TEXT
from ..functions.text import once, strip_space

# Cell texts that mean "missing" in a CSV file.
NA_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
CATEGORY_HEADER = ["name", "slug", "url_path", "full_url", "n_code", "data_id", "number_of_children"]
ZIP_HEADER = ["ZIP Code", "Type", "Common Cities", "County", "Area Codes"]

# A NaN or Infinity where a JSON value stands.
BARE_NUMBER = r"([:\[,]\s*)-?(?:NaN|Infinity)(?=\s*[,}\]])"
BIGINT_TEXT = r"^[+-]?\d{1,18}$"


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    found = location.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(location)
    return found is not None and len(found) > 0


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """(line, doc, status): status is ``ok`` or ``malformed``; blank lines are left out.

    A document that only fails for bare NaN or Infinity values is read with null in their place; in such a document the
    same is done inside strings that look alike (a colon, comma or bracket, the token, and another of these).
    """
    text = strip_space(F.col(column))
    rows = lines.select(text.alias("line")).where(F.col("line") != "")
    named = F.col("line").contains("NaN") | F.col("line").contains("Infinity")  # far faster than the pattern
    suspect = named & F.col("line").rlike(BARE_NUMBER) & F.try_parse_json("line").isNull()
    mended = F.regexp_replace("line", BARE_NUMBER, "$1null")
    rows = rows.select(F.when(suspect & F.try_parse_json(mended).isNotNull(), mended).otherwise(F.col("line")).alias("line"))
    rows = rows.select(once(F.struct("line", F.try_parse_json("line").alias("doc"))).alias("__l")).select("__l.*")
    return rows.select("line", "doc", F.when(F.col("doc").isNotNull(), "ok").otherwise("malformed").alias("status"))


def read_jsonl(spark: SparkSession, path: str, keep_malformed: bool = False) -> DataFrame:
    """JSON lines with unparsable ones dropped; an absent path is an empty table.

    ``keep_malformed`` keeps them (doc NULL), so that they can be counted.
    """
    if _exists(spark, path):
        lines = spark.read.text(path)
    else:
        lines = spark.createDataFrame([], "value string")
    parsed = parse_lines(lines)
    return parsed if keep_malformed else parsed.where("status = 'ok'")


def _csv(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    return spark.read.csv(
        path,
        header=True,
        inferSchema=False,
        multiLine=multi_line,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def infer_types(df: DataFrame) -> T.StructType:
    """Narrowest of BIGINT, DOUBLE, BOOLEAN, STRING that holds every value of each string column; one pass."""
    checks = []
    for i, c in enumerate(df.columns):
        text = strip_space(F.col(c))
        number = text.rlike(NUMERIC_TEXT)
        checks += [
            F.coalesce(F.bool_and(text.rlike(BIGINT_TEXT)), F.lit(False)).alias(f"i{i}"),
            F.coalesce(F.bool_and(number), F.lit(False)).alias(f"d{i}"),
            F.coalesce(F.bool_and(text.isin("True", "False", "TRUE", "FALSE", "true", "false")), F.lit(False)).alias(f"b{i}"),
        ]
    found = df.agg(*checks).first()

    def kind(i: int) -> T.DataType:
        if found[f"i{i}"]:
            return T.LongType()
        if found[f"d{i}"]:
            return T.DoubleType()
        return T.BooleanType() if found[f"b{i}"] else T.StringType()

    return T.StructType([T.StructField(c, kind(i)) for i, c in enumerate(df.columns)])


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType | None = None, string_columns: list[str] = (), multi_line: bool = True) -> DataFrame:
    """CSV with a header; the NA texts become NULL.  Types are inferred unless a schema is given.

    Ids belong in ``string_columns``, so that they stay text.
    """
    raw = _csv(spark, path, multi_line)
    cleaned = raw.select(*[F.when(~F.col(f"`{c}`").isin(NA_TEXTS), F.col(f"`{c}`")).alias(c) for c in raw.columns])
    types = schema or infer_types(cleaned)
    keep = set(string_columns)

    def typed(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if f.name in keep or isinstance(f.dataType, T.StringType):
            return c
        return strip_space(c).try_cast(f.dataType).alias(f.name)

    return cleaned.select(*[typed(f) for f in types.fields])


def read_dimension(spark: SparkSession, path: str, key: str | None = None, multi_line: bool = True) -> DataFrame:
    """All-string CSV, missing cells as ''; with ``key``, rows with a blank one are dropped and it is trimmed."""
    raw = _csv(spark, path, multi_line)
    filled = raw.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in raw.columns])
    if key is None:
        return filled
    return filled.withColumn(key, F.trim(f"`{key}`")).where(F.col(f"`{key}`") != "")


def category_ids(categories: DataFrame) -> DataFrame:
    """Fill a missing ``data_id`` from ``n_code`` (the part after ``N-``), else ''."""
    derived = F.regexp_extract(F.coalesce("n_code", F.lit("")), "(?i)N-([0-9a-z]+)", 1)
    own = F.when(F.coalesce("data_id", F.lit("")) != "", F.col("data_id"))
    return categories.withColumn("data_id", F.coalesce(own, derived))


def load_categories(spark: SparkSession, path: str) -> DataFrame:
    return category_ids(read_dimension(spark, path))

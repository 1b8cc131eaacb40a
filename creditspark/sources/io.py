"""Sources and sinks (IO1-IO4).

IO1  CSV scan with a header, explicit schema and two NULL spellings
     ("NA" and the empty field); no schema inference at scale.
IO2  CSV sink with a header (row names become an explicit rank column upstream).
IO3  shape/schema inspection as a DataFrame.
IO4  snapshots: a DataFrame is immutable, ``persist`` serves branch points; ``Snapshots`` keeps named copies of tables
     whose sources will change, in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditspark.operators.cache import persist
from creditspark.session import scratch_path


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             null_value: str = "NA") -> DataFrame:
    """``read.csv(f, na.strings=c("NA",""))``: both spellings become NULL."""
    reader = spark.read.option("header", "true").option("nullValue", null_value) \
        .option("emptyValue", None).option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", "true")
    df = reader.csv(path)
    # string columns: the empty field is NULL too
    quoted = lambda name: F.col("`" + name.replace("`", "``") + "`")  # noqa: E731 - headers hold dots
    return df.select([F.nullif(quoted(f.name), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType) else quoted(f.name)
                      for f in df.schema.fields])


def read_csv_with_rejects(spark: SparkSession, path: str, schema: T.StructType, null_value: str = "NA",
                          header: bool = True) -> tuple[DataFrame, DataFrame]:
    """IO1 with a side output: (rows that fit the schema, lines that do not as (record, file)).

    A line is rejected for a value that is not of its column's type, or for too few or too many fields.  The scan is persisted
    for both sides (``cache.release`` gives it back): a value that is not read cannot be found wrong.
    """
    bad = "_corrupt_record"
    full = T.StructType([*schema.fields, T.StructField(bad, T.StringType())])
    rows = (spark.read.schema(full).option("header", str(header).lower()).option("nullValue", null_value).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", bad).csv(path).withColumn("_file", F.input_file_name()))
    rows = persist(rows)
    good = rows.filter(F.col(bad).isNull()).select([F.nullif(F.col(f.name), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
                                                    for f in schema.fields])
    return good, rows.filter(F.col(bad).isNotNull()).select(F.col(bad).alias("record"), F.col("_file").alias("file"))


def write_csv(df: DataFrame, path: str, null_value: str = "NA", mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", "true").option("nullValue", null_value).csv(path)


def sanitize_names(df: DataFrame) -> DataFrame:
    """Dotted/space-containing CSV headers -> snake_case names."""
    import re
    return df.toDF(*[re.sub(r"[^0-9a-zA-Z]+", "_", c).strip("_").lower() for c in df.columns])


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """IO3: (table_name, n_rows, n_cols) for each named table."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows"))
               .select(F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_cols"))
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def schema_profile(df: DataFrame) -> list[tuple[str, str]]:
    """``str(df)``: (column, type) pairs from the schema (no job)."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


class Snapshots:
    """IO4: named copies of tables, written to the session's shared folder.

    A copy holds what the table held when it was taken, also after its files are overwritten.  Taking a name again
    replaces its copy for later ``read`` calls; ``release`` deletes the files (plans that still read them fail).
    What is not released goes with the session's scratch folder.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._kept: dict[str, tuple[str, T.StructType]] = {}

    def take(self, name: str, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, "snapshot")
        df.write.parquet(path)
        self.release(name)
        self._kept[name] = (path, df.schema)
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        path, schema = self._kept[name]
        return self.spark.read.schema(schema).parquet(path)

    def names(self) -> list[str]:
        return sorted(self._kept)

    def release(self, name: str) -> None:
        """Delete a copy; a name that was never taken is no error."""
        if name in self._kept:
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._kept.pop(name)[0])
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

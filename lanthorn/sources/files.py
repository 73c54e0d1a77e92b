"""File sources and sinks: CSV, parquet table replacement, text corpora."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanthorn.functions import text as tx


_CSV = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "quote": '"', "escape": '"'}


def write_csv(df: DataFrame, path: str) -> str:
    """Header row, no index column; replaces what is at ``path``.

    Cells keep their blanks, quotes and line breaks; null and the empty
    string are both written as an empty cell.
    """
    df.write.mode("overwrite").options(**_CSV).option("emptyValue", "").csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Header CSV; an empty cell is null.  Pass a schema: inference costs a
    full extra pass and guesses types per file.  Quoted cells may hold line
    breaks, so a file is read by one task: keep files small."""
    reader = spark.read.options(**_CSV).option("multiLine", True).option("mode", "FAILFAST")
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", True).csv(path)


def replace_tables(tables: dict[str, DataFrame], base: str) -> dict[str, str]:
    """Drop-and-recreate: each table fully replaces the previous one.

    Parquet directories written with ``overwrite``; a reader never sees a
    mix of old and new rows of one table because the write commits the
    directory as a whole.
    """
    paths = {}
    for name, df in tables.items():
        path = f"{base}/{name}"
        df.write.mode("overwrite").parquet(path)
        paths[name] = path
    return paths


def load_corpus(spark: SparkSession, folder: str, expected: Sequence[str] | None = None,
                pattern: str = r"^doc_(\d+)\.txt$") -> DataFrame:
    """One document per file; one chunk per document.

    Output (id, document_id, text): text stripped, ids ``doc_NN`` and
    ``doc_NN_chunk_01``.  With ``expected`` file names, a missing file is
    an error (the anti join of the expected names against the files read).
    """
    files = (spark.read.text(folder, wholetext=True)
             .select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("text")))
    files = files.filter(F.col("file_name").rlike(pattern))
    if expected is not None:
        want = spark.createDataFrame([(e,) for e in expected], "file_name string")
        missing = [r["file_name"] for r in want.join(files, "file_name", "left_anti").collect()]
        if missing:
            raise FileNotFoundError(f"Required corpus files not found: {sorted(missing)}")
    num = F.regexp_extract("file_name", pattern, 1).cast("int")
    return files.select(tx.format_chunk_id(num).alias("id"), tx.format_doc_id(num).alias("document_id"),
                        tx.strip_ws("text").alias("text"))


def run_query_suite(spark: SparkSession, statements: dict[str, str], out_base: str) -> DataFrame:
    """Run named SQL statements; store each result under its name.

    Returns (query, rows, path): the stored results are read back to count.
    """
    rows = []
    for name, sql in statements.items():
        path = f"{out_base}/{name}"
        spark.sql(sql.strip().rstrip(";")).write.mode("overwrite").parquet(path)
        rows.append((name, path))
    parts = [spark.read.parquet(p).agg(F.count(F.lit(1)).alias("rows"))
             .select(F.lit(n).alias("query"), "rows", F.lit(p).alias("path")) for n, p in rows]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

"""Column handling shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanthorn.session import ensure_checkpoint_dir, scratch_path


BATCH_ROWS = 1000


def small_batches(spark) -> None:
    """Keep the Arrow batches that cross to Python small: they hold whole texts, at most ``BATCH_ROWS`` of them."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def id_and_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id BIGINT, text BINARY) and nothing else, so no extra column can clash."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id BIGINT, text STRING) and nothing else."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each lengthened until no column of ``df`` has it (Spark does not tell upper case from lower)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared checkpoint folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark) -> None:
    """Let Spark drop the shuffle files of finished steps, whose results are written, before the next begins.

    Twice, as the first round frees what Spark's event queue held until then.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def count_blobs(counts, slices_: int):
    """Arrow rows (slice, counts) of one task's vector of counts below 2^32, cut into equal slices."""
    import numpy as np
    import pyarrow as pa

    part = np.asarray(counts).reshape(slices_, -1)
    used = [i for i in range(slices_) if part[i].any()]
    return pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int32()), pa.array([part[i].astype("<u4").tobytes() for i in used], pa.binary())],
        names=["slice", "counts"])


def summed_counts(blobs: DataFrame, size: int, slices_: int):
    """Sum the tasks' vectors slice by slice on the executors; the driver gets ``size`` numbers.

    A slice is summed in one task, one task vector at a time (streamed, never gathered), so memory
    is bounded by the vector's size whatever the number of input tasks.
    """
    import numpy as np
    import pyarrow as pa

    def add(batches):
        total = {}
        for b in batches:
            for s, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                v = np.frombuffer(c, "<u4").astype(np.int64)
                total[s] = total[s] + v if s in total else v
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
                names=["slice", "counts"])

    out = np.zeros((slices_, size // slices_), dtype=np.int64)
    summed = blobs.repartition(slices_, "slice").mapInArrow(add, "slice int, counts binary")
    for row in summed.toLocalIterator():
        out[row["slice"]] += np.frombuffer(row["counts"], "<i8")
    return out.reshape(-1)

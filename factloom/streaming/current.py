"""The current fact of each cell, kept as facts arrive.

The target is the state: one row a cell, the fact of the newest filing, then of the preferred unit, then of the highest id,
whatever the order in which they come, so late rows count as if they had come in time. Of each batch the best fact of a
cell is put against the one that the target has; only the partitions of these cells are read and written, by as many tasks
as they have rows for. Nothing of the cells is held in executors' memory from one batch to the next, nor stored twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from factloom.operators import merges
from factloom.plans.views import CELL
from factloom.session import kept
from factloom.sources.store import exists

#: Rows of a file of the target, and so of a task that writes one.
FILE_ROWS = 100_000


def current_cells(facts: DataFrame) -> DataFrame:
    """One fact a cell of a stream or a table of facts with filed_date, by one aggregation that keeps the best of each."""
    rest = [c for c in facts.columns if c not in (*CELL, "filed_date", "id")]
    best = F.struct("filed_date", (-F.col("unit_rank")).alias("preference"), "id", *rest)
    return facts.groupBy(*CELL).agg(F.max(best).alias("f")).select(*CELL, "f.*").drop("preference").select(*facts.columns)


def keep_current(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, files_a_batch: int = 1000, part_rows: int = merges.PART_ROWS, file_rows: int = FILE_ROWS) -> StreamingQuery:
    """Brings the target up to date with the Parquet files of the source that have come since the checkpoint. A batch that
    runs again finds its own cells in place and leaves them so."""
    arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(source)

    def put(batch: DataFrame, batch_id: int) -> None:
        own, cells = batch.sparkSession, current_cells(batch)
        if exists(own, f"{target}/_SUCCESS"):
            merges.merge(own, target, cells, "cik", lambda old, new: current_cells(old.unionByName(new)), file_rows=file_rows)
            return
        cells = kept(cells, "batch")
        if not cells.isEmpty():
            merges.lay_out(cells, target, "cik", part_rows=part_rows, file_rows=file_rows)

    return arriving.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

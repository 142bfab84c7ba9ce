"""Ready files as a stream: each new ``.ok`` file starts the load of its date.

The operators run no jobs of their own, so the same ones serve streams; a load
replaces whole dates, so a batch replayed after a failure ends in the same state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegate import schemas as S
from tidegate.operators.split import judge_transfers
from tidegate.plans.loads import load
from tidegate.plans.runs import Warehouse, on_dates, read_control
from tidegate.sources import inbound

_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Stream of (dataset, business_date), one row per ready file; contents are not read.

    An empty ready file is no arrival: file scans skip empty files.
    """
    name = F.col("_metadata.file_name")
    return (
        spark.readStream.format("binaryFile")
        .schema(_FILE_SCHEMA)
        .option("pathGlobFilter", "*_*.ok")
        .load(folder)
        .select(
            inbound.dataset_of(name).alias("dataset"), inbound.date_of(name).alias("business_date")
        )
        .filter("dataset IS NOT NULL AND business_date IS NOT NULL")
    )


def load_on_arrival(
    spark: SparkSession, warehouse: Warehouse, checkpoint: str, **trigger
) -> StreamingQuery:
    """Load every date whose ready file arrives, clients before transfers.

    Transfers that arrived first and failed for want of clients are loaded again
    when the clients of their date come in. ``trigger`` goes to
    ``DataStreamWriter.trigger``, for example ``availableNow=True``.
    """

    def load_batch(batch: DataFrame, _: int) -> None:
        # One row per ready file of the batch.
        rows = batch.distinct().collect()
        clients = [r.business_date for r in rows if r.dataset == S.CLIENTS.name]
        transfers = {r.business_date for r in rows if r.dataset == S.TRANSFERS.name}
        if clients:
            load(spark, warehouse, S.CLIENTS, clients)
            transfers |= _waiting_for_clients(spark, warehouse, clients)
        if transfers:
            load(spark, warehouse, S.TRANSFERS, sorted(transfers))

    return (
        arrivals(spark, warehouse.inbound)
        .writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def _waiting_for_clients(spark, warehouse, dates):
    failed = on_dates(read_control(spark, warehouse), dates).filter(
        (F.col("process_name") == S.LOAD_TRANSFERS)
        & (F.col("reason_code") == "MISSING_CLIENT_SNAPSHOT")
    )
    return {r.business_date for r in failed.select("business_date").collect()}


def judge_arriving_transfers(
    lines: DataFrame, ref_currency: DataFrame, ref_country: DataFrame
) -> DataFrame:
    """Judged rows of a stream of transfer lines (``value``, ``source_file_name``).

    Stateless: repeated keys are a property of a complete file and are left to the load.
    """
    return judge_transfers(inbound.parse_lines(lines, S.TRANSFERS), ref_currency, ref_country)

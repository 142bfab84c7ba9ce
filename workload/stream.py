"""The row rules on a stream of arriving files."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate import schemas as S
from tidegate.sources import reference
from tidegate.sources.files import work_folder
from tidegate.streaming import judge_arriving_transfers
from workload import shapes
from workload.oracle import sql
from workload.registry import query
from workload.storage import write_inbound_lines


@query(sql(
    "SELECT strftime(business_date, '%Y-%m-%d') AS business_date, reject_reason, COUNT(*) AS row_count"
    " FROM t_judged GROUP BY business_date, reject_reason"
))
def streamed_reject_reasons(spark, sf_dir):
    """Inbound lines judged as a file stream into a table, then counted by reason."""
    folder, judged, state = (work_folder(spark, p) for p in ("arriving", "judged", "state"))
    write_inbound_lines(shapes.inbound_transfers(spark, sf_dir), S.TRANSFERS, folder)
    lines = spark.readStream.schema("value string").option("lineSep", "\n").text(f"{folder}/*").select(
        "value",
        F.regexp_extract(F.col("_metadata.file_path"), "source_file_name=([^/]+)/", 1).alias("source_file_name"),
    )
    rows = judge_arriving_transfers(
        lines, reference.ref_currency(spark), reference.ref_country(spark)
    )
    stream = (
        rows.select("business_date", "reject_reason")
        .writeStream.format("parquet")
        .option("path", judged)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()
    return spark.read.parquet(judged).groupBy("business_date", "reject_reason").agg(
        F.count("*").alias("row_count")
    )

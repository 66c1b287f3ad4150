"""New points scored as their files arrive: an extension, since batch runs skip finished tiles already."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.horizon import score
from ..sources.tables import write_findings
from ..specs import SkySpec

POINTS = "location_id STRING, tile_id STRING, x DOUBLE, y DOUBLE, dish_height_m DOUBLE"


def score_stream(spark: SparkSession, points_path: str, surfaces: DataFrame, out_path: str, checkpoint: str, spec: SkySpec = SkySpec()) -> StreamingQuery:
    """Score whatever Parquet files are new in ``points_path`` and write their tiles; a batch that runs again writes the same."""

    def each(batch: DataFrame, number: int) -> None:
        write_findings(score(batch, surfaces, spec), f"{out_path}/batch={number}")

    stream = spark.readStream.schema(POINTS).parquet(points_path)
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

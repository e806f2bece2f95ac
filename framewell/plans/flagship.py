"""Flagship query: newest valid frame of every device, from raw topic text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewell.functions.timefmt import as_ntz
from framewell.operators import ordering, parse
from framewell.plans import fixtures as fx
from framewell.plans.registry import query
from framewell.plans.sqlparts import META, with_

FLAGSHIP_SQL = with_(META) + """
SELECT device_id, name, event_datetime, img_path, event_id AS offset FROM (
  SELECT * FROM meta WHERE event_id % 50 NOT IN (0, 2, 3)
  QUALIFY row_number() OVER (PARTITION BY name ORDER BY event_id DESC) = 1)
QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY event_datetime DESC, name DESC) = 1"""


def newest_valid_frames(topic: DataFrame) -> DataFrame:
    """topic(value) -> validate -> good rows -> metadata -> keep last per name
    -> newest per device. Shuffles: one keyed aggregate per step, both with
    map-side combine."""
    good, _ = parse.split_rejects(parse.validate_frames(topic, keep=["offset"]))
    meta = parse.derive_metadata(good.drop("img"), with_process_time=False)
    # only the carried columns go into the aggregate buffers
    meta = meta.select("device_id", "name", "event_datetime", "img_path", "offset")
    last = ordering.keep_last(meta, "name", "offset")
    newest = ordering.latest_per_key(last, "device_id", ("event_datetime", "name"))
    return newest.withColumn("event_datetime", as_ntz(F.col("event_datetime")))


@query("newest_valid_frames", FLAGSHIP_SQL)
def q_newest_valid_frames(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: P1 C1 C2 P2 W1 W2 end to end."""
    return newest_valid_frames(fx.topic(spark, d))

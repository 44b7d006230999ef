"""A raw event log derived from all rows of the ``events`` table.

Most events become a plain JSON message; every fortieth kind of row is broken or unusual in one
way. One event in seven is delivered again by its sender, one in eleven comes again with the same
key from another user. The same SQL text builds the log in Spark and in the checking engine.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spikelens import configure, shared_dir
from spikelens.sources import RAW_SCHEMA, stage

# Folder of the log per application and scale.
_WRITTEN: dict[tuple[str, str], str] = {}

# Dialect words: microseconds since 1970, and ISO text with six fraction digits, of column ts.
SPARK_WORDS = {
    "@micros": "timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)",
    "@iso": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")",
}
CHECK_WORDS = {"@micros": "epoch_us(ts)", "@iso": "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"}

LOG_SQL = """
SELECT 'events' AS topic, part, off, cast(sender AS string) AS sender,
  us + (off * 7919 % 250000) AS arrived_us,
  CASE k
    WHEN 0 THEN ''
    WHEN 1 THEN 'not-json'
    WHEN 2 THEN concat('{"user_id":" ', chr(160), chr(92), 't",', tj, ',', vj, ',', sj, ',', kj, '}')
    WHEN 3 THEN concat('{"user_id":', cast(sender AS string), ',', tj, ',', vj, ',', sj, ',', kj, '}')
    WHEN 4 THEN concat('{', uj, ',', tj, ',"value":"', v, '",', sj, ',', kj, '}')
    WHEN 5 THEN concat('{', uj, ',', tj, ',"value":1e8,', sj, ',', kj, '}')
    WHEN 6 THEN concat('{', uj, ',', tj, ',', sj, ',', kj, '}')
    WHEN 7 THEN concat('{', uj, ',', tj, ',', vj, ',', sj, ',', kj, '} trailing')
    WHEN 8 THEN concat('{', uj, ',', vj, ',', sj, ',', kj, '}')
    WHEN 9 THEN concat('{', body, ',"timestamp":', cast(us_ms AS string), ',', kj, '}')
    WHEN 10 THEN concat('{', body, ',"timestamp":', cast(us AS string), ',', kj, '}')
    WHEN 11 THEN concat('{', body, ',"timestamp":', cast(us * 1000 AS string), ',', kj, '}')
    WHEN 12 THEN concat('{', body, ',"timestamp":"', iso, 'Z",', kj, '}')
    WHEN 13 THEN concat('{', body, ',"timestamp":"', iso, '+02:30",', kj, '}')
    WHEN 14 THEN concat('{', body, ',', kj, '}')
    WHEN 15 THEN concat('{', body, ',"timestamp":"', substring(iso, 1, 10), '",', kj, '}')
    WHEN 16 THEN concat('{', body, ',', sj, '}')
    WHEN 17 THEN concat('{', body, ',', sj, ',"trace_id":" ', chr(160), 'tr-', cast(event_id AS string), '  "}')
    WHEN 18 THEN concat('[{', body, ',', sj, ',', kj, '}]')
    WHEN 19 THEN concat('{', body, ',', sj, ',', kj, '}] x')
    WHEN 20 THEN concat('{', uj, ',', tj, ',"value":null,', sj, ',', kj, '}')
    WHEN 21 THEN concat('{', body, ',', sj, ',"trace_id":null}')
    WHEN 22 THEN concat('{', body, ',"timestamp":" ', cast(us_ms AS string), ' ",', kj, '}')
    WHEN 23 THEN concat('{', body, ',"timestamp":-5,', kj, '}')
    WHEN 24 THEN concat('{', body, ',', sj, ',', kj, '}}')
    WHEN 25 THEN concat('{', uj, ',', tj, ',"value":-100000000.0,', sj, ',', kj, '}')
    WHEN 26 THEN concat('{', uj, ',', tj, ',"value":99999999.99,', sj, ',', kj, '}')
    WHEN 27 THEN concat('{', tj, ',', vj, ',', sj, ',', kj, '}')
    WHEN 28 THEN concat('{', body, ',"timestamp":1.5e9,', kj, ',"extra":{"a":[1,{"b":null}]}}')
    WHEN 29 THEN concat('{', body, ',', sj, ',"trace_id":"shared-', event_type, '"}')
    WHEN 30 THEN concat('{', body, ',', sj, ',"trace_id":17}')
    WHEN 31 THEN concat('  {', body, ' , ', sj, ' , ', kj, ' }  ')
    WHEN 32 THEN concat('{', uj, ',"event_type":"", ', vj, ',', sj, ',', kj, '}')
    ELSE concat('{', body, ',', sj, ',', kj, '}')
  END AS payload
FROM shaped
"""

SHAPED_SQL = """
SELECT *, concat(uj, ',', tj, ',', vj) AS body,
  concat('"timestamp":', cast(cast(floor(us / 1000000) AS bigint) AS string)) AS sj,
  cast(floor(us / 1000) AS bigint) AS us_ms,
  cast(CASE WHEN copy = 1 AND event_id % 5 = 0 THEN (sender + 1) % 6 ELSE sender % 6 END AS int) AS part
FROM (
  SELECT event_id, k, us, iso, v, event_type, copy, sender, tj, vj, kj,
    (event_id + 50 * copy) * 4 + copy AS off,
    concat('"user_id":"', cast(sender AS string), '"') AS uj
  FROM (
    SELECT *, 0 AS copy, user_id AS sender FROM base
    UNION ALL SELECT *, 1 AS copy, user_id AS sender FROM base WHERE event_id % 7 = 3
    UNION ALL SELECT *, 2 AS copy, user_id + 1 AS sender FROM base WHERE event_id % 11 = 5
  ) AS delivered
) AS placed
"""

BASE_SQL = """
SELECT event_id, user_id, event_type, cast(event_id % 40 AS int) AS k, @micros AS us, @iso AS iso,
  cast(value AS string) AS v,
  concat('"event_type":"', event_type, '"') AS tj,
  concat('"value":', cast(value AS string)) AS vj,
  concat('"trace_id":"tr-', cast(event_id AS string), '"') AS kj
FROM events
"""


def _base_sql(words: dict[str, str], events: str) -> str:
    base = BASE_SQL.replace("FROM events", f"FROM {events}")
    for word, text in words.items():
        base = base.replace(word, text)
    return base


def check_log_sql() -> str:
    """The log as one statement of the checking engine."""
    return f"WITH base AS ({_base_sql(CHECK_WORDS, 'events')}), shaped AS ({SHAPED_SQL}) {LOG_SQL}"


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with the columns of ``RAW_SCHEMA``, written once per session as a source table."""
    place = (spark.sparkContext.applicationId, sf_dir)
    if place not in _WRITTEN:
        folder = f"{shared_dir(spark)}/sample-log-{uuid.uuid4().hex}"
        # Spread evenly, so that a small log still feeds all cores.
        built = _build(spark, sf_dir).repartition(spark.sparkContext.defaultParallelism)
        built.write.parquet(folder)
        _WRITTEN[place] = folder
    return spark.read.schema(RAW_SCHEMA).parquet(_WRITTEN[place])


def _build(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    spark.read.parquet(f"{sf_dir}/events.parquet").createOrReplaceTempView("sample_log_events")
    base = _base_sql(SPARK_WORDS, "sample_log_events")
    shaped = stage(spark.sql(f"WITH base AS ({base}) {SHAPED_SQL}"), "shaped")
    shaped.createOrReplaceTempView("shaped")
    built = spark.sql(LOG_SQL)
    return built.select(
        "topic",
        F.col("part").alias("partition"),
        F.col("off").alias("offset"),
        F.col("sender").alias("key"),
        F.col("payload").alias("value"),
        F.timestamp_micros("arrived_us").alias("arrived_at"),
    )

"""Every operator as a query over the driver's tables, with DuckDB oracles.

Times are given as epoch microseconds, dates as text, arrays joined, so both
engines' rows compare value by value. The clock is fixed.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable
from contextlib import suppress
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .catalog import load_seeds
from .config import Config
from .functions.avro import decoded, encoded
from .functions.rules import soft_metrics
from .functions.units import to_liters
from .operators import asof
from .operators.bronze import to_bronze
from .operators.enrich import current, dma_columns, enrich, enrich_as_of, meter_columns, with_customer
from .operators.governance import expired, masked, row_filter, top_similar
from .operators.merge import insert_absent, merge_latest
from .operators.vectors import VectorIndex
from .operators.route import latest, quarantine, recent, valid, with_lateness
from .plans import apportion, forecast, leaks, maintain, marts, quality, runs
from .plans.reconcile import reconciled, validated
from .plans.reconcile import run as reconcile
from .schemas import BRONZE, EVENT, SILVER_COLUMNS
from .session import in_utc
from .sources import fixtures, synthetic
from .sources.fixtures import EXPRESSIONS, LAG_SECONDS, NOW
from .sources.log import as_log, produce, replay_stream
from .sources.tables import BY_POSITION, BY_READING, Table
from .streaming import events
from .streaming.pipeline import bronze_stream, silver_stream
from .streaming.state import HOUR, alert_stream, session_stream, state_store

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
LATE = "kafka_offset % 53 = 0"
TODAY = "2024-01-20"


def query(sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(in_utc(spark), sf_dir)

        QUERIES[f.__name__] = run
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return run

    return register


def flat(df: DataFrame) -> DataFrame:
    """Scalars only: times in microseconds, dates and arrays as text, binary in hex."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.TimestampType):
            c = F.unix_micros(c)
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, "|")
        elif isinstance(f.dataType, T.BinaryType):
            c = F.hex(c)
        elif isinstance(f.dataType, T.DoubleType):
            c = F.round(c, 4)
        out.append(c.alias(f.name))
    return df.select(*out)


def scratch(spark: SparkSession) -> str:
    """A new folder that all nodes share: under spark.checkpoint.dir, or a temporary one where that is unset."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all nodes share")
    folder = f"{named.rstrip('/')}/aquilith-{uuid.uuid4().hex}" if named else f"file://{tempfile.mkdtemp(prefix='aquilith-')}"
    atexit.register(_remove, spark, folder)
    return folder


def _remove(spark: SparkSession, folder: str) -> None:
    """Results are read lazily, so what a query wrote goes when the driver exits."""
    with suppress(Exception):  # the JVM may be gone
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


# -- the tables that oracles share


def _sql_bronze() -> str:
    cols = ", ".join(f"{x.format(s='VARCHAR')} AS {n}" for n, x in EXPRESSIONS.items())
    return f"""ev AS (SELECT event_id AS e, ts AS t, user_id AS u, value AS w FROM events),
tried AS (SELECT e, t, u, w AS v, 0 AS a FROM ev UNION ALL SELECT e, t, u, w + 1, 1 FROM ev WHERE e % 13 = 0),
bronze AS (SELECT {cols}, CASE WHEN e % 89 = 0 THEN NULL ELSE t END AS reading_timestamp, t + to_seconds({LAG_SECONDS}) AS ingest_timestamp,
  CAST(t + to_seconds({LAG_SECONDS}) AS DATE) AS ingest_date, 'p' || e AS payload, e FROM tried)"""


_DIMS = """dim_meter AS (SELECT c_custkey AS k, CAST(c_custkey AS VARCHAR) AS m_id, 'C' || c_custkey AS ref_customer_id, CAST(c_custkey % 25 AS VARCHAR) AS ref_meter_dma_id,
  CASE WHEN c_custkey % 2 = 0 THEN 'ULTRASONIC' ELSE 'MECHANICAL' END AS ref_meter_type, CAST(15 + 5 * (c_custkey % 3) AS INT) AS ref_meter_size_mm,
  CASE c_custkey % 3 WHEN 0 THEN 'LITERS' WHEN 1 THEN 'GALLONS' ELSE 'CUBIC_METERS' END AS ref_meter_expected_unit,
  CASE WHEN c_custkey % 7 = 0 THEN DATE '2024-01-10' ELSE DATE '2020-01-01' END AS ref_meter_install_date,
  CASE WHEN c_custkey % 11 = 0 THEN 'DECOMMISSIONED' ELSE 'ACTIVE' END AS ref_meter_status FROM customer WHERE c_custkey % 20 <> 5),
dim_dma AS (SELECT CAST(n_nationkey AS VARCHAR) AS ref_dma_id, n_name AS ref_dma_name, 'R' || n_regionkey AS ref_dma_region, CAST(-300 + 60 * (n_nationkey % 3) AS INT) AS off,
  CAST(5 + n_nationkey % 10 AS DOUBLE) AS target_nrw_pct FROM nation)"""
_FACTOR = "CASE unit WHEN 'LITERS' THEN 1.0::DOUBLE WHEN 'GALLONS' THEN 3.785411784::DOUBLE WHEN 'CUBIC_METERS' THEN 1000.0::DOUBLE END"
_REASONS = [
    ("bronze_parse_error", "parse_error IS NULL"),
    ("missing_meter_id", "meter_id IS NOT NULL"),
    ("missing_reading_timestamp", "reading_timestamp IS NOT NULL"),
    ("missing_reading_value", "reading_value IS NOT NULL"),
    ("invalid_unit", "coalesce(unit IN ('LITERS', 'GALLONS', 'CUBIC_METERS'), FALSE)"),
    ("negative_reading", "coalesce(reading_value >= 0, TRUE)"),
    ("implausible_reading_magnitude", "coalesce(reading_value <= 1e9, TRUE)"),
    ("reading_timestamp_in_future", "coalesce(reading_timestamp <= TIMESTAMP '2024-01-25 01:00:00', TRUE)"),
    ("unknown_meter_id", "ref_meter_status IS NOT NULL"),
    ("meter_not_active", "coalesce(ref_meter_status = 'ACTIVE', TRUE)"),
    ("reading_before_install", "coalesce(CAST(reading_timestamp AS DATE) >= ref_meter_install_date, TRUE)"),
    ("unit_mismatch", "coalesce(unit = ref_meter_expected_unit, TRUE)"),
    ("unknown_dma_id", "ref_dma_id IS NOT NULL"),
]
_CODES = ", ".join(f"CASE WHEN NOT ({ok}) THEN '{code}' END" for code, ok in _REASONS)
_WITH = f"""WITH {_sql_bronze()}, {_DIMS},
enriched AS (SELECT *, reading_value * ({_FACTOR}) AS reading_value_liters, reading_timestamp + to_minutes(coalesce(off, 0)) AS reading_local_timestamp
  FROM bronze LEFT JOIN dim_meter ON meter_id = m_id LEFT JOIN dim_dma ON dma_id = ref_dma_id),
judged AS (SELECT *, concat_ws('|', {_CODES}) AS quarantine_reasons FROM enriched),
ranked AS (SELECT *, row_number() OVER (PARTITION BY meter_id, reading_timestamp ORDER BY ingest_timestamp DESC, kafka_offset DESC, kafka_partition DESC) AS rn FROM judged WHERE quarantine_reasons = ''),
silver AS (SELECT * FROM ranked WHERE rn = 1),
deltas AS (SELECT *, reading_value_liters - lag(reading_value_liters) OVER w AS delta_liters,
  greatest(coalesce(reading_value_liters - lag(reading_value_liters) OVER w, 0), 0) AS used_liters FROM silver WINDOW w AS (PARTITION BY meter_id ORDER BY reading_timestamp))
"""
_TIMES = {"reading_timestamp", "ingest_timestamp", "reading_local_timestamp", "kafka_timestamp"}
_DOUBLES = {"reading_value", "reading_value_liters", "flow_rate"}


def _sql_flat(columns) -> str:
    out = []
    for c in columns:
        if c in _TIMES:
            out.append(f"epoch_us({c}) AS {c}")
        elif c == "ingest_date":
            out.append("CAST(ingest_date AS VARCHAR) AS ingest_date")
        elif c in _DOUBLES:
            out.append(f"round({c}, 4) AS {c}")
        elif c == "raw_payload":
            out.append("hex(payload) AS raw_payload")
        else:
            out.append(c)
    return ", ".join(out)


def _bronze(spark, sf_dir):
    return fixtures.bronze(spark, sf_dir)


def _judged(spark, sf_dir):
    return validated(_bronze(spark, sf_dir), fixtures.dim_meter(spark, sf_dir), fixtures.dim_dma(spark, sf_dir), now=NOW)


def _silver(spark, sf_dir):
    return latest(valid(_judged(spark, sf_dir)))


# -- Bronze

_EVENT_COLUMNS = EVENT.fieldNames()
_BRONZE_COLUMNS = [*_EVENT_COLUMNS, "raw_payload", "parse_error", "kafka_partition", "kafka_offset", "kafka_timestamp", "ingest_date"]


_ENCODABLE = "meter_id IS NOT NULL AND reading_timestamp IS NOT NULL AND reading_value IS NOT NULL AND unit IN ('LITERS', 'GALLONS', 'CUBIC_METERS')"
_MILLIS = lambda c: f"CAST(floor(epoch_us({c}) / 1000) AS BIGINT) * 1000 AS {c}"


_DOUBLE_EVENT = [c for c in _EVENT_COLUMNS if c not in _TIMES]
_WIRE = f"""wire AS (SELECT kafka_partition, kafka_offset, ingest_timestamp AS kafka_timestamp, ok, CASE WHEN ok THEN NULL ELSE 'avro_deserialization_failed' END AS parse_error, sent,
{", ".join(f"CASE WHEN ok THEN {c} END AS {c}" for c in _EVENT_COLUMNS)} FROM (SELECT *, coalesce({_ENCODABLE}, FALSE) AS sent, coalesce({_ENCODABLE}, FALSE) {{more}} AS ok FROM bronze))"""


@query(
    _WITH
    + f""", {_WIRE.format(more="AND kafka_offset % 7 <> 0 AND kafka_offset % 11 <> 0")}
SELECT kafka_partition, kafka_offset, epoch_us(kafka_timestamp) AS kafka_timestamp, {_sql_flat(_DOUBLE_EVENT)}, {_MILLIS('reading_timestamp')}, {_MILLIS('ingest_timestamp')}, parse_error,
CAST(CASE WHEN ok THEN CAST(ingest_timestamp AS DATE) ELSE DATE '2024-01-25' END AS VARCHAR) AS ingest_date, epoch_us(TIMESTAMP '2024-01-25 00:00:00') AS ingested_at, kafka_offset % 11 <> 0 AND sent AS has_payload FROM wire"""
)
def q01_bronze_project(spark, sf_dir):
    """Log rows through the Bronze projection; some payloads are cut short and some are missing."""
    log = as_log(_bronze(spark, sf_dir))
    cut = F.expr("substring(value, 1, length(value) - 1)")
    value = F.when(F.col("offset") % 11 == 0, F.lit(None)).when(F.col("offset") % 7 == 0, cut).otherwise(F.col("value"))
    rows = to_bronze(log.withColumn("value", value), NOW)
    return flat(rows.withColumn("has_payload", F.col("raw_payload").isNotNull()).drop("raw_payload"))


@query(
    _WITH
    + f"SELECT kafka_partition, kafka_offset, {_sql_flat([c for c in _EVENT_COLUMNS if c not in _TIMES])}, {_MILLIS('reading_timestamp')}, {_MILLIS('ingest_timestamp')} FROM bronze WHERE {_ENCODABLE}"
)
def q02_avro_roundtrip(spark, sf_dir):
    wire = _bronze(spark, sf_dir).select("kafka_partition", "kafka_offset", encoded().alias("value"))
    read = wire.select("kafka_partition", "kafka_offset", decoded(F.col("value")).alias("event")).filter("event is not null")
    return flat(read.select("kafka_partition", "kafka_offset", "event.*"))


@query(_WITH + f"SELECT kafka_offset, unit, round(reading_value * ({_FACTOR}), 4) AS liters FROM bronze")
def q03_to_liters(spark, sf_dir):
    return flat(_bronze(spark, sf_dir).select("kafka_offset", "unit", to_liters(F.col("reading_value"), F.col("unit")).alias("liters")))


# -- enrichment


@query(
    _WITH
    + """SELECT m_id AS id, ref_customer_id AS a, ref_meter_type AS b, ref_meter_expected_unit AS c, ref_meter_status AS d, CAST(ref_meter_install_date AS VARCHAR) AS e FROM dim_meter
UNION ALL SELECT ref_dma_id, ref_dma_name, ref_dma_region, CAST(off AS VARCHAR), NULL, NULL FROM dim_dma"""
)
def q04_current_dims(spark, sf_dir):
    m = meter_columns(current(fixtures.dim_meter(spark, sf_dir, history=True), "meter_id"))
    d = dma_columns(current(fixtures.dim_dma(spark, sf_dir), "dma_id"))
    return flat(m.selectExpr("meter_id as id", "ref_customer_id as a", "ref_meter_type as b", "ref_meter_expected_unit as c", "ref_meter_status as d", "cast(ref_meter_install_date as string) as e")).unionByName(
        d.selectExpr("ref_dma_id as id", "ref_dma_name as a", "ref_dma_region as b", "cast(ref_dma_utc_offset_minutes as string) as c", "cast(null as string) as d", "cast(null as string) as e")
    )


_ENRICHED = ["kafka_offset", "meter_id", "dma_id", "reading_value_liters", "reading_local_timestamp", "ref_customer_id", "ref_meter_type", "ref_meter_size_mm", "ref_meter_status", "ref_dma_id", "ref_dma_name", "ref_dma_region"]


@query(_WITH + f"SELECT {_sql_flat(_ENRICHED)} FROM enriched")
def q05_enrich(spark, sf_dir):
    return flat(enrich(_bronze(spark, sf_dir), fixtures.dim_meter(spark, sf_dir), fixtures.dim_dma(spark, sf_dir)).select(*_ENRICHED))


@query(_WITH + f"SELECT kafka_offset, CAST(ingest_date AS VARCHAR) AS ingest_date FROM bronze WHERE ingest_date >= DATE '{TODAY}' - 3")
def q06_lookback(spark, sf_dir):
    return flat(recent(_bronze(spark, sf_dir), 3, F.lit(TODAY).cast("date")).select("kafka_offset", "ingest_date"))


# -- rules and routing


@query(_WITH + "SELECT kafka_partition, kafka_offset, quarantine_reasons, quarantine_reasons = '' AS is_valid FROM judged")
def q07_quarantine_reasons(spark, sf_dir):
    return flat(_judged(spark, sf_dir).select("kafka_partition", "kafka_offset", "quarantine_reasons", "is_valid"))


@query(_WITH + "SELECT reason, count(*) AS n_rows FROM (SELECT unnest(string_split(quarantine_reasons, '|')) AS reason FROM judged WHERE quarantine_reasons <> '') GROUP BY reason")
def q08_reason_histogram(spark, sf_dir):
    return marts.reason_histogram(_judged(spark, sf_dir))


@query(_WITH + f"SELECT {_sql_flat(SILVER_COLUMNS)} FROM silver")
def q09_silver_projection(spark, sf_dir):
    return flat(_silver(spark, sf_dir))


_QUARANTINE = "meter_id reading_timestamp ingest_timestamp reading_value unit dma_id raw_payload quarantine_reasons kafka_partition kafka_offset ingest_date".split()


@query(_WITH + f"SELECT {_sql_flat(_QUARANTINE)}, epoch_us(TIMESTAMP '2024-01-25 00:00:00') AS quarantined_at FROM judged WHERE quarantine_reasons <> ''")
def q10_quarantine_projection(spark, sf_dir):
    return flat(quarantine(_judged(spark, sf_dir), NOW))


@query(
    _WITH
    + """SELECT meter_id, epoch_us(reading_timestamp) AS reading_timestamp, epoch_us(ingest_timestamp) AS ingest_timestamp, kafka_offset, round(reading_value, 4) AS reading_value FROM
(SELECT *, row_number() OVER (PARTITION BY meter_id, reading_timestamp ORDER BY ingest_timestamp DESC, kafka_offset DESC, kafka_partition DESC) AS r FROM bronze) WHERE r = 1"""
)
def q11_latest_wins(spark, sf_dir):
    return flat(latest(_bronze(spark, sf_dir)).select("meter_id", "reading_timestamp", "ingest_timestamp", "kafka_offset", "reading_value"))


@query(
    _WITH
    + """SELECT 'battery_pct_in_range' AS rule, count(*) FILTER (WHERE battery_pct IS NULL OR battery_pct BETWEEN 0 AND 100) AS passed, count(*) FILTER (WHERE NOT (battery_pct IS NULL OR battery_pct BETWEEN 0 AND 100)) AS failed FROM bronze
UNION ALL SELECT 'signal_quality_in_range', count(*) FILTER (WHERE signal_quality IS NULL OR signal_quality BETWEEN 0 AND 100), count(*) FILTER (WHERE NOT (signal_quality IS NULL OR signal_quality BETWEEN 0 AND 100)) FROM bronze"""
)
def q12_soft_metrics(spark, sf_dir):
    return soft_metrics(_judged(spark, sf_dir))


# -- merges: rows of LATE offsets arrive after the others


@query(_WITH + f"SELECT {_sql_flat(SILVER_COLUMNS)} FROM silver")
def q13_merge_valid(spark, sf_dir):
    rows = valid(_judged(spark, sf_dir))
    return flat(merge_latest(latest(rows.filter(f"not ({LATE})")), rows))


@query(_WITH + f"SELECT {_sql_flat(_QUARANTINE)} FROM judged WHERE quarantine_reasons <> ''")
def q14_merge_quarantine(spark, sf_dir):
    rows = quarantine(_judged(spark, sf_dir), NOW).drop("quarantined_at")
    held = rows.filter(f"not ({LATE})")
    return flat(held.unionByName(insert_absent(held, rows)))


_SEEN = f"(kafka_offset % 53 <> 0 OR ingest_date >= DATE '{TODAY}' - 3)"


@query(
    _WITH
    + f"""SELECT 'silver' AS kind, meter_id, epoch_us(reading_timestamp) AS reading_timestamp, kafka_offset, '' AS reasons FROM
(SELECT *, row_number() OVER (PARTITION BY meter_id, reading_timestamp ORDER BY ingest_timestamp DESC, kafka_offset DESC, kafka_partition DESC) AS r FROM judged WHERE quarantine_reasons = '' AND {_SEEN}) WHERE r = 1
UNION ALL SELECT 'quarantine', meter_id, epoch_us(reading_timestamp), kafka_offset, quarantine_reasons FROM judged WHERE quarantine_reasons <> '' AND {_SEEN}"""
)
def q15_reconcile_e2e(spark, sf_dir):
    bronze = _bronze(spark, sf_dir)
    on_time = _judged(spark, sf_dir).filter(f"not ({LATE})")
    silver, bad = reconciled(bronze, latest(valid(on_time)), quarantine(on_time, NOW), fixtures.dim_meter(spark, sf_dir), fixtures.dim_dma(spark, sf_dir), now=NOW, today=TODAY)
    s = silver.select(F.lit("silver").alias("kind"), "meter_id", "reading_timestamp", "kafka_offset", F.lit("").alias("reasons"))
    return flat(s.unionByName(bad.select(F.lit("quarantine").alias("kind"), "meter_id", "reading_timestamp", "kafka_offset", F.array_join("quarantine_reasons", "|").alias("reasons"))))


@query(
    _WITH
    + """SELECT kafka_partition, kafka_offset, coalesce(reading_timestamp < seen - INTERVAL 24 HOUR, FALSE) AS is_late FROM
(SELECT *, max(CASE WHEN reading_timestamp <= TIMESTAMP '2024-01-25 01:00:00' THEN reading_timestamp END) OVER (PARTITION BY kafka_partition ORDER BY kafka_offset ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM bronze)"""
)
def q16_watermark_split(spark, sf_dir):
    return with_lateness(_bronze(spark, sf_dir), 24, now=NOW).select("kafka_partition", "kafka_offset", "is_late")


@query(
    _WITH
    + f""", {_WIRE.format(more="")},
told AS (SELECT *, concat_ws('|', {_CODES}) AS reasons, reading_value * ({_FACTOR}) AS liters FROM wire LEFT JOIN dim_meter ON meter_id = m_id LEFT JOIN dim_dma ON dma_id = ref_dma_id),
kept AS (SELECT *, row_number() OVER (PARTITION BY meter_id, reading_timestamp ORDER BY ingest_timestamp DESC, kafka_offset DESC, kafka_partition DESC) AS r FROM told WHERE reasons = '')
SELECT kind, kafka_partition, kafka_offset, meter_id, {_MILLIS('reading_timestamp')}, unit, round(reading_value, 4) AS reading_value, round(liters, 4) AS liters, dma_id, area, reasons FROM
(SELECT 'silver' AS kind, *, ref_dma_name AS area FROM (SELECT * EXCLUDE (r) FROM kept WHERE r = 1) UNION ALL SELECT 'quarantine', * REPLACE (NULL AS liters), NULL FROM told WHERE reasons <> '')"""
)
def q17_stream_bronze_silver(spark, sf_dir):
    """The log replayed through both streams, several micro-batches each: Silver, and what is quarantined."""
    root = scratch(spark)
    produce(_bronze(spark, sf_dir), f"{root}/log", files=3)
    dims = lambda: (fixtures.dim_meter(spark, sf_dir), fixtures.dim_dma(spark, sf_dir))
    bronze = Table(spark, f"{root}/bronze", BRONZE)
    bronze_stream(replay_stream(spark, f"{root}/log"), bronze, f"{root}/cp-bronze", now=NOW, once=True).awaitTermination()
    judged = validated(bronze.read(), *dims(), now=NOW)
    silver = Table(spark, f"{root}/silver", valid(judged).schema, parts=BY_READING[:1], merge_on_read=True)  # by day alone: a small table
    bad = Table(spark, f"{root}/quarantine", quarantine(judged, NOW).schema, parts=BY_POSITION[:1])
    silver_stream(bronze, silver, bad, dims, f"{root}/cp-silver", now=NOW, once=True).awaitTermination()
    return _told(silver, bad)


def _told(silver: Table, bad: Table) -> DataFrame:
    """Silver's and quarantine's rows as the stream queries tell them."""
    columns = ["kafka_partition", "kafka_offset", "meter_id", "reading_timestamp", "unit", "reading_value"]
    s = silver.read().select(F.lit("silver").alias("kind"), *columns, F.col("reading_value_liters").alias("liters"), "dma_id", F.col("ref_dma_name").alias("area"), F.lit("").alias("reasons"))
    q = bad.read().select(F.lit("quarantine").alias("kind"), *columns, F.lit(None).cast("double").alias("liters"), "dma_id", F.lit(None).cast("string").alias("area"), F.array_join("quarantine_reasons", "|").alias("reasons"))
    return flat(s.unionByName(q))


# -- marts (designed but not built by the original)


@query(
    _WITH
    + """SELECT meter_id, sequence_no, kafka_offset, gap FROM (SELECT meter_id, sequence_no, kafka_offset, sequence_no - lag(sequence_no) OVER (PARTITION BY meter_id ORDER BY sequence_no, kafka_offset) - 1 AS gap FROM bronze WHERE meter_id IS NOT NULL) WHERE gap <> 0"""
)
def q18_seq_gaps(spark, sf_dir):
    return marts.sequence_gaps(_bronze(spark, sf_dir).filter("meter_id is not null"))


@query(_WITH + "SELECT meter_id, epoch_us(reading_timestamp) AS reading_timestamp, round(delta_liters, 4) AS delta_liters, round(used_liters, 4) AS used_liters FROM deltas")
def q19_delta(spark, sf_dir):
    return flat(marts.deltas(_silver(spark, sf_dir)).select("meter_id", "reading_timestamp", "delta_liters", "used_liters"))


@query(_WITH + "SELECT meter_id, epoch_us(date_trunc('hour', reading_timestamp)) AS period, round(sum(used_liters::DECIMAL(38,9))::DOUBLE, 4) AS liters, count(*) AS n_readings FROM deltas GROUP BY meter_id, date_trunc('hour', reading_timestamp)")
def q20_hourly(spark, sf_dir):
    return flat(marts.consumption(_silver(spark, sf_dir), "hour"))


@query(
    _WITH
    + "SELECT meter_id, epoch_us(CAST(CAST(reading_timestamp AS DATE) AS TIMESTAMP)) AS period, round(sum(used_liters::DECIMAL(38,9))::DOUBLE, 4) AS liters, count(*) AS n_readings, sum(used_liters::DECIMAL(38,9))::DOUBLE > 5000 AS is_anomaly FROM deltas GROUP BY meter_id, CAST(reading_timestamp AS DATE)"
)
def q21_daily(spark, sf_dir):
    return flat(marts.daily_usage(_silver(spark, sf_dir), 5000.0))


def _areas(spark, sf_dir, silver=None):
    silver = _silver(spark, sf_dir) if silver is None else silver
    supply = silver.select("dma_id", F.to_date("reading_timestamp").alias("day")).distinct().withColumn("supplied_liters", F.lit(40000.0) + 1000.0 * F.col("dma_id").cast("int"))
    return marts.area_balance(silver, fixtures.dim_dma(spark, sf_dir), supply)


_AREAS = """areas AS (SELECT *, 100 * (supplied_liters - metered_liters) / supplied_liters AS nrw_pct FROM
(SELECT dma_id, CAST(reading_timestamp AS DATE) AS day, any_value(ref_dma_name) AS dma_name, any_value(target_nrw_pct) AS target_nrw_pct, 40000.0::DOUBLE + 1000.0::DOUBLE * CAST(dma_id AS INT) AS supplied_liters, sum(used_liters::DECIMAL(38,9))::DOUBLE AS metered_liters FROM deltas GROUP BY dma_id, CAST(reading_timestamp AS DATE)))"""


@query(
    _WITH
    + f", {_AREAS} SELECT dma_id, CAST(day AS VARCHAR) AS day, dma_name, target_nrw_pct, supplied_liters, round(metered_liters, 4) AS metered_liters, round(nrw_pct, 4) AS nrw_pct, nrw_pct > target_nrw_pct AS over_target FROM areas"
)
def q22_dma(spark, sf_dir):
    return flat(_areas(spark, sf_dir))


_CUSTOMERS = """cust AS (SELECT 'C' || c_custkey AS cid, c_mktsegment AS customer_type, CASE WHEN c_acctbal < 0 THEN 'ARREARS' ELSE 'OPEN' END AS account_status, CASE WHEN c_custkey % 2 = 0 THEN 'MONTHLY' ELSE 'QUARTERLY' END AS billing_cycle FROM customer),
usage AS (SELECT ref_customer_id, customer_type, CAST(CASE WHEN billing_cycle = 'MONTHLY' THEN date_trunc('month', reading_timestamp) ELSE date_trunc('quarter', reading_timestamp) END AS DATE) AS period, sum(used_liters::DECIMAL(38,9))::DOUBLE AS liters, count(DISTINCT meter_id) AS n_meters
FROM deltas LEFT JOIN cust ON ref_customer_id = cid GROUP BY ALL)"""


def _customers(spark, sf_dir, silver=None):
    return marts.customer_usage(with_customer(_silver(spark, sf_dir) if silver is None else silver, fixtures.dim_customer(spark, sf_dir)))


@query(_WITH + f", {_CUSTOMERS} SELECT ref_customer_id, customer_type, CAST(period AS VARCHAR) AS period, round(liters, 4) AS liters, n_meters FROM usage")
def q23_customer(spark, sf_dir):
    return flat(_customers(spark, sf_dir))


@query(
    _WITH
    + f""", {_AREAS}, {_CUSTOMERS},
hourly AS (SELECT meter_id, date_trunc('hour', reading_timestamp) AS p, sum(used_liters::DECIMAL(38,9))::DOUBLE AS liters FROM deltas GROUP BY ALL),
daily AS (SELECT meter_id, CAST(reading_timestamp AS DATE) AS day, sum(used_liters::DECIMAL(38,9))::DOUBLE AS liters FROM deltas GROUP BY ALL)
SELECT 'operations' AS board, CAST(d.day AS VARCHAR) AS item, round(peak, 4) AS a, round(liters, 4) AS b, n AS c FROM (SELECT day, sum(liters::DECIMAL(38,9))::DOUBLE AS liters, count(*) FILTER (WHERE liters > 5000) AS n FROM daily GROUP BY day) d
JOIN (SELECT CAST(p AS DATE) AS day, max(liters) AS peak FROM hourly GROUP BY 1) h ON d.day = h.day
UNION ALL SELECT 'executive', customer_type, round(liters, 4), s, n FROM (SELECT customer_type, sum(liters::DECIMAL(38,9))::DOUBLE AS liters, count(DISTINCT ref_customer_id) AS n FROM usage GROUP BY 1), (SELECT round(sum(supplied_liters::DECIMAL(38,9))::DOUBLE, 4) AS s FROM areas)"""
)
def q24_dashboards(spark, sf_dir):
    # the deltas once, for the four marts that need them
    shared = f"{scratch(spark)}/deltas"
    marts.deltas(_silver(spark, sf_dir)).write.parquet(shared)
    silver = spark.read.parquet(shared)
    ops = marts.operations(marts.consumption(silver, "hour"), marts.daily_usage(silver, 5000.0))
    top = marts.executive(_areas(spark, sf_dir, silver), _customers(spark, sf_dir, silver))
    a = ops.select(F.lit("operations").alias("board"), F.col("day").cast("string").alias("item"), F.col("peak_hour_liters").alias("a"), F.col("liters").alias("b"), F.col("n_anomalies").alias("c"))
    return flat(a.unionByName(top.select(F.lit("executive").alias("board"), F.col("customer_type").alias("item"), F.col("liters").alias("a"), F.col("supplied_liters").alias("b"), F.col("n_customers").alias("c"))))


@query(
    _WITH
    + "SELECT meter_id, round(avg(flow_rate), 4) AS avg_flow, min(flow_rate) AS min_flow, count(*) AS n_rows, min(flow_rate) >= 0.5 AS is_leak FROM silver WHERE hour(reading_timestamp) IN (2, 3) AND flow_rate IS NOT NULL GROUP BY meter_id"
)
def q25_night_flow(spark, sf_dir):
    return flat(marts.night_flow(_silver(spark, sf_dir)))


@query(
    _WITH
    + """SELECT meter_id, epoch_us(reading_timestamp) AS reading_timestamp, round(avg(used_liters) OVER (w ROWS BETWEEN 3 PRECEDING AND CURRENT ROW), 4) AS avg_last4, round(max(used_liters) OVER (w ROWS BETWEEN 3 PRECEDING AND CURRENT ROW), 4) AS max_last4,
count(*) OVER (PARTITION BY meter_id ORDER BY CAST(floor(epoch_us(reading_timestamp) / 1000000) AS BIGINT) RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) AS n_last_day, round(lag(used_liters, 2) OVER w, 4) AS lag2 FROM deltas WINDOW w AS (PARTITION BY meter_id ORDER BY reading_timestamp)"""
)
def q26_features(spark, sf_dir):
    return flat(marts.features(_silver(spark, sf_dir)))


@query(
    _WITH
    + """, revisions AS (SELECT m_id, CASE WHEN k % 4 = 0 THEN DATE '2024-01-12' ELSE DATE '2020-01-01' END AS s, NULL::DATE AS f, ref_meter_type AS kind, ref_meter_status AS status FROM dim_meter
UNION ALL SELECT m_id, DATE '2020-01-01', DATE '2024-01-12', 'MECHANICAL', 'ACTIVE' FROM dim_meter WHERE k % 4 = 0)
SELECT kafka_offset, kind AS ref_meter_type, status AS ref_meter_status FROM bronze LEFT JOIN revisions ON meter_id = m_id AND CAST(reading_timestamp AS DATE) >= s AND (f IS NULL OR CAST(reading_timestamp AS DATE) < f)"""
)
def q27_asof_dim(spark, sf_dir):
    return enrich_as_of(_bronze(spark, sf_dir), fixtures.dim_meter(spark, sf_dir, history=True)).select("kafka_offset", "ref_meter_type", "ref_meter_status")


@query(_WITH + f", {_CUSTOMERS} SELECT kafka_offset, ref_customer_id, customer_type, account_status, billing_cycle FROM silver LEFT JOIN cust ON ref_customer_id = cid")
def q28_customer_join(spark, sf_dir):
    return with_customer(_silver(spark, sf_dir), fixtures.dim_customer(spark, sf_dir)).select("kafka_offset", "ref_customer_id", "customer_type", "account_status", "billing_cycle")


_UNIT = "('0x' || md5('42:' || {keys})[1:12])::BIGINT::DOUBLE / 281474976710656::DOUBLE"


@query(
    f"""WITH grid AS (SELECT 'MTR-' || lpad(CAST(m AS VARCHAR), 8, '0') AS meter_id, 1704067200000000 + s * 900000000 AS t FROM range(40) AS a(m), range(96) AS b(s)),
sent AS (SELECT * FROM grid WHERE {_UNIT.format(keys="meter_id || ':' || t || ':drop'")} >= 0.02)
SELECT meter_id, count(*) AS n, TRUE AS monotone, TRUE AS gapless, TRUE AS in_bounds, min(t) AS first, max(t) AS last FROM sent GROUP BY meter_id"""
)
def q29_synth_invariants(spark, sf_dir):
    """A day of synthetic readings: how many each meter sends, and whether its register, numbering, flow, battery and delay hold."""
    master = synthetic.meters(spark, 40)
    rows = synthetic.readings(master, datetime(2024, 1, 1, tzinfo=UTC), datetime(2024, 1, 2, tzinfo=UTC), leaks=synthetic.leaking(master, 0.1), leak_rate=0.5)
    before = "over (partition by meter_id order by reading_timestamp)"
    steps = rows.selectExpr(
        "meter_id", "reading_timestamp", f"reading_value - lag(reading_value) {before} as rise", f"sequence_no - lag(sequence_no) {before} as step", f"lag(battery_pct) {before} - battery_pct as drained", "sequence_no",
        f"flow_rate >= 0 and abs(flow_rate * 15 - (reading_value - coalesce(lag(reading_value) {before}, 0))) < 0.01 and battery_pct between 1 and 100 and signal_quality between 40 and 100"
        " and unix_micros(ingest_timestamp) - unix_micros(reading_timestamp) between 1000000 and 45000000 as ok",
    )
    return steps.groupBy("meter_id").agg(
        F.count("*").alias("n"),
        F.coalesce(F.min("rise") >= 0, F.lit(True)).alias("monotone"),
        (F.coalesce((F.min("step") == 1) & (F.max("step") == 1), F.lit(True)) & (F.min("sequence_no") == 1)).alias("gapless"),
        (F.bool_and("ok") & F.coalesce(F.min("drained").between(0, 1), F.lit(True))).alias("in_bounds"),
        F.unix_micros(F.min("reading_timestamp")).alias("first"),
        F.unix_micros(F.max("reading_timestamp")).alias("last"),
    )


# -- governance


@query("SELECT c_custkey, c_name, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey IN (1, 3)")
def q30_row_filter(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet").join(spark.read.parquet(f"{sf_dir}/nation.parquet"), F.col("c_nationkey") == F.col("n_nationkey"))
    allowed = spark.createDataFrame([("ana", 1), ("ana", 3), ("ben", 0)], "user string, n_regionkey int")
    return row_filter(rows.select("c_custkey", "c_name", "n_regionkey"), allowed, "ana", on="n_regionkey")


@query("SELECT c_custkey, sha256(c_name) AS c_name, c_mktsegment FROM customer")
def q31_mask(spark, sf_dir):
    return masked(spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_name", "c_mktsegment"), columns=("c_name",))


@query(
    """WITH q AS (SELECT vec_id AS query_id, embedding AS q FROM embeddings WHERE vec_id % 50 = 0),
s AS (SELECT query_id, vec_id, list_inner_product(embedding::DOUBLE[], q::DOUBLE[]) / (sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) * sqrt(list_inner_product(q::DOUBLE[], q::DOUBLE[]))) AS cosine FROM embeddings, q WHERE vec_id <> query_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, vec_id) AS rank FROM s)
SELECT query_id, vec_id, round(cosine, 4) AS cosine, CAST(rank AS INT) AS rank FROM r WHERE rank <= 5"""
)
def q32_vector_topk(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return flat(top_similar(vectors, vectors.filter("vec_id % 50 = 0"), 5))


# -- catalog, sessions, alerts, storage, settings


@query(
    """WITH i AS (SELECT unnest(range(1, 31)) AS i), m AS (SELECT i, 'M-' || lpad(CAST(i AS VARCHAR), 4, '0') AS meter_id, 'C-' || lpad(CAST(i AS VARCHAR), 4, '0') AS customer_id, i % 8 + 1 AS a FROM i)
SELECT meter_id, customer_id, 'A-' || lpad(CAST(a AS VARCHAR), 2, '0') AS dma_id, 'Area ' || a AS dma_name, ['LITERS', 'GALLONS', 'CUBIC_METERS'][i % 3 + 1] AS expected_unit, CASE WHEN i % 13 = 0 THEN 'DECOMMISSIONED' ELSE 'ACTIVE' END AS status,
CASE WHEN i % 2 = 0 THEN 'ULTRASONIC' ELSE 'AMR' END AS meter_type, CASE WHEN i % 7 = 0 THEN 2 ELSE 1 END AS n_revisions, CASE WHEN i % 2 = 0 THEN 'MONTHLY' ELSE 'QUARTERLY' END AS billing_cycle FROM m"""
)
def q33_seed_load(spark, sf_dir):
    """Reference tables created with comments, seeded twice, read back through views."""
    where = scratch(spark)
    prefix = f"t{uuid.uuid4().hex[:12]}_"
    for _ in range(2):
        names = load_seeds(spark, prefix=prefix, location=where)
    out = spark.sql(
        f"""SELECT m.meter_id, m.customer_id, m.dma_id, dma_name, expected_unit, status, meter_type, n_revisions, billing_cycle
        FROM {names[0]} m JOIN (SELECT meter_id, cast(count(*) as int) AS n_revisions FROM {names[0]} GROUP BY meter_id) r ON m.meter_id = r.meter_id
        JOIN {names[1]} d ON m.dma_id = d.dma_id JOIN {names[2]} c ON m.customer_id = c.customer_id WHERE m.is_current"""
    )
    return out


@query(
    """WITH t AS (SELECT CAST(user_id AS VARCHAR) AS meter_id, ts, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) AS gap FROM events),
s AS (SELECT *, count(*) FILTER (WHERE gap IS NULL OR gap >= 7200000000) OVER (PARTITION BY meter_id ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n FROM t)
SELECT meter_id, epoch_us(min(ts)) AS started, epoch_us(max(ts)) AS ended, count(*) AS n_rows FROM s GROUP BY meter_id, n"""
)
def q34_sessions(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return flat(marts.sessions(events.select(F.col("user_id").cast("string").alias("meter_id"), F.col("ts").cast("timestamp").alias("reading_timestamp")), "2 hours"))


@query(
    _WITH
    + """SELECT meter_id, epoch_us(reading_timestamp) AS reading_timestamp, round(used_liters, 4) AS used_liters, round(used_liters / top, 4) AS score FROM
(SELECT *, max(used_liters) OVER (PARTITION BY meter_id ORDER BY reading_timestamp ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS top FROM deltas) WHERE top > 0 AND used_liters / top > 1.5"""
)
def q35_anomaly_alerts(spark, sf_dir):
    return flat(marts.anomalies(_silver(spark, sf_dir), 1.5))


@query(
    _WITH
    + """SELECT DISTINCT CAST(ingest_date AS VARCHAR) AS ingest_date, CASE WHEN DATE '2024-03-31' - ingest_date > 80 THEN 'archive' WHEN DATE '2024-03-31' - ingest_date > 70 THEN 'cool' ELSE 'hot' END AS tier FROM bronze"""
)
def q36_storage_tiers(spark, sf_dir):
    return flat(expired(_bronze(spark, sf_dir), "2024-03-31", cool_days=70, archive_days=80))


@query("SELECT CAST(days AS INT) AS days, CAST(hours AS INT) AS hours, days * 24 > hours AS allowed FROM range(0, 6) AS d(days), (SELECT unnest([0, 12, 24, 48, 72, 96]) AS hours)")
def q37_lookback_guard(spark, sf_dir):
    """Which lookbacks the settings allow for which watermarks."""

    def allowed(days: int, hours: int) -> bool:
        try:
            return bool(Config(lookback_days=days, watermark_hours=hours).guard())
        except ValueError:
            return False

    return spark.createDataFrame([(d, h, allowed(d, h)) for d in range(6) for h in (0, 12, 24, 48, 72, 96)], "days int, hours int, allowed boolean")


@query("SELECT c_custkey, sha256(c_name) AS c_name, sha256(c_mktsegment) AS c_mktsegment, c_nationkey FROM customer")
def q38_tagged_mask(spark, sf_dir):
    """Columns masked by the tags in their metadata."""
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet")
    tagged = [F.col("c_custkey"), F.col("c_name").alias("c_name", metadata={"tag": "pii"}), F.col("c_mktsegment").alias("c_mktsegment", metadata={"pii": "yes"}), F.col("c_nationkey")]
    return masked(rows.select(*tagged))


# -- consumption shared out by time, and marts that follow Silver's changes

_FLOWED = "((micros::HUGEINT * {x}::HUGEINT) // total::HUGEINT)"


def _sql_pieces(name: str, source: str, unit: str, step: str) -> str:
    """``source`` cut at the bounds of a unit, its step an interval."""
    return f"""{name} AS (SELECT *, {_FLOWED.format(x="upto")} - {_FLOWED.format(x="start")} AS part, upto - start AS covered, upto - start < total AS is_cut FROM
(SELECT *, greatest(epoch_us(period) - epoch_us(since), 0) AS start, least(epoch_us(period + {step}) - epoch_us(since), total) AS upto FROM
(SELECT *, epoch_us(until) - epoch_us(since) AS total, unnest(range(date_trunc({unit}, since), until, {step})) AS period FROM {source})) WHERE upto > start)"""


_INTERVALS = """cust AS (SELECT 'C' || c_custkey AS cid, c_mktsegment AS customer_type, CASE WHEN c_custkey % 2 = 0 THEN 'MONTHLY' ELSE 'QUARTERLY' END AS billing_cycle FROM customer),
stretches AS (SELECT meter_id, dma_id, ref_customer_id, customer_type, billing_cycle, lag(reading_timestamp) OVER w AS since, reading_timestamp AS until,
  CAST(floor(greatest(reading_value_liters - lag(reading_value_liters) OVER w, 0) * 1e6 + 0.5) AS BIGINT) AS micros FROM silver LEFT JOIN cust ON ref_customer_id = cid WINDOW w AS (PARTITION BY meter_id ORDER BY reading_timestamp))"""
_SPANS = _INTERVALS + ", spans AS (SELECT * FROM stretches WHERE since IS NOT NULL)"
_SUMS = "sum(part)::BIGINT AS micros, sum(covered)::BIGINT AS covered, count(*) AS n_intervals, count(*) FILTER (WHERE is_cut) AS n_cut"
_HOURLY = f"{_sql_pieces('hours', 'spans', chr(39) + 'hour' + chr(39), 'INTERVAL 1 HOUR')}"
_DAILY = f"{_sql_pieces('days', 'spans', chr(39) + 'day' + chr(39), 'INTERVAL 1 DAY')}"
_MONTHLY = f"{_sql_pieces('months', '(SELECT * FROM spans WHERE billing_cycle = ' + chr(39) + 'MONTHLY' + chr(39) + ')', chr(39) + 'month' + chr(39), 'INTERVAL 1 MONTH')}"
_QUARTERLY = f"{_sql_pieces('quarters', '(SELECT * FROM spans WHERE billing_cycle IS DISTINCT FROM ' + chr(39) + 'MONTHLY' + chr(39) + ')', chr(39) + 'quarter' + chr(39), 'INTERVAL 3 MONTH')}"


@query(_WITH + f", {_SPANS}, {_HOURLY} SELECT meter_id, epoch_us(period) AS period, {_SUMS} FROM hours GROUP BY meter_id, period")
def q39_hourly_apportioned(spark, sf_dir):
    """Liters by meter and hour, the rise after a dropout shared by the hours it took."""
    return flat(apportion.consumption(_silver(spark, sf_dir), "hour").drop("liters", "seconds"))


_SHARED_AREAS = """areas AS (SELECT s.dma_id, s.day, any_value(ref_dma_name) AS dma_name, any_value(target_nrw_pct) AS target_nrw_pct, any_value(supplied_liters) AS supplied_liters, coalesce(any_value(metered), 0) AS metered_liters FROM
(SELECT dma_id, CAST(reading_timestamp AS DATE) AS day, any_value(ref_dma_name) AS ref_dma_name, any_value(target_nrw_pct) AS target_nrw_pct, 40000.0::DOUBLE + 1000.0::DOUBLE * CAST(dma_id AS INT) AS supplied_liters FROM silver GROUP BY ALL) s
LEFT JOIN (SELECT dma_id, CAST(period AS DATE) AS day, sum(part)::BIGINT::DOUBLE / 1e6 AS metered FROM days GROUP BY ALL) m ON m.dma_id = s.dma_id AND m.day = s.day GROUP BY s.dma_id, s.day)"""


@query(
    _WITH
    + f""", {_SPANS}, {_DAILY}, {_SHARED_AREAS}
SELECT dma_id, CAST(day AS VARCHAR) AS day, dma_name, target_nrw_pct, supplied_liters, CAST(round(metered_liters * 1e6) AS BIGINT) AS metered_micros, round(nrw_pct, 4) AS nrw_pct, nrw_pct > target_nrw_pct AS over_target
FROM (SELECT *, 100 * (supplied_liters - metered_liters) / supplied_liters AS nrw_pct FROM areas)"""
)
def q40_areas_apportioned(spark, sf_dir):
    """The areas' balance, each interval shared by the days it covers."""
    silver = _silver(spark, sf_dir)
    supply = silver.select("dma_id", F.to_date("reading_timestamp").alias("day")).distinct().withColumn("supplied_liters", F.lit(40000.0) + 1000.0 * F.col("dma_id").cast("int"))
    areas = marts.balance(apportion.metered(silver), fixtures.dim_dma(spark, sf_dir), supply)
    return flat(areas.withColumn("metered_micros", F.round(F.col("metered_liters") * 1e6).cast("long")).drop("metered_liters"))


_BILLS = "(SELECT * FROM months UNION ALL BY NAME SELECT * FROM quarters)"


@query(_WITH + f", {_SPANS}, {_MONTHLY}, {_QUARTERLY} SELECT ref_customer_id, customer_type, epoch_us(period) AS period, {_SUMS} FROM {_BILLS} GROUP BY ALL")
def q41_billing_apportioned(spark, sf_dir):
    """Liters by customer and billing period, shared over the periods' bounds."""
    return flat(apportion.billing(with_customer(_silver(spark, sf_dir), fixtures.dim_customer(spark, sf_dir))).drop("liters", "seconds"))


@query(
    _WITH
    + f""", {_SPANS}, {_HOURLY}, {_DAILY}, {_MONTHLY}, {_QUARTERLY}
SELECT 'hourly' AS mart, meter_id AS owner, epoch_us(period) AS period, {_SUMS} FROM hours GROUP BY meter_id, period
UNION ALL SELECT 'areas', dma_id, epoch_us(period), {_SUMS} FROM days GROUP BY dma_id, period
UNION ALL SELECT 'billing', ref_customer_id, epoch_us(period), {_SUMS} FROM {_BILLS} GROUP BY ref_customer_id, customer_type, period"""
)
def q42_marts_maintained(spark, sf_dir):
    """The three marts after four batches in no order of time, with late rows and replacements, each of which touched only its own days."""
    rows = with_customer(valid(_judged(spark, sf_dir)), fixtures.dim_customer(spark, sf_dir))
    kept = maintain.MaintainedMarts(spark, scratch(spark), rows.schema, parts=BY_READING[:1])
    for n in range(4):
        kept.apply(rows.filter(F.pmod(F.xxhash64("kafka_partition", "kafka_offset"), F.lit(4)) == n), n)
    found = [kept.read(name).select(F.lit(name).alias("mart"), F.col(by[0]).alias("owner"), "period", "micros", "covered", "n_intervals", "n_cut") for name, (by, _) in maintain.MARTS.items()]
    return flat(found[0].unionByName(found[1]).unionByName(found[2]))


@query()
def q43_vector_index(spark, sf_dir):
    """Every vector whose id is divisible by 50 against all, through the fitted index."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    index = VectorIndex(spark, f"{scratch(spark)}/vectors").build(vectors)
    return flat(index.search(vectors.filter("vec_id % 50 = 0"), 5))


# -- event time and arbitrary state: readings replayed in parts by time, and a stream stopped and started again


def _replayed(spark: SparkSession, rows: DataFrame, stream: Callable[[DataFrame], DataFrame], files: int = 4) -> DataFrame:
    """What a stream makes of ``rows``, given in parts by time, with a restart behind each; a heartbeat ends it.

    The rows are computed once. A part is all that a start of the stream finds, so it is
    one micro-batch, however many files it has.
    """
    root, at = scratch(spark), F.col("reading_timestamp")
    rows.write.parquet(f"{root}/rows")
    rows = spark.read.schema(rows.schema).parquet(f"{root}/rows")
    bounds = rows.filter(at.isNotNull()).select(F.unix_micros(at).alias("t")).agg(F.min("t").alias("low"), F.max("t").alias("high")).first()
    beat = [tuple("heartbeat" if f.name == "meter_id" else None for f in rows.schema)]
    beat = spark.createDataFrame(beat, rows.schema).withColumn("reading_timestamp", F.timestamp_micros(F.lit((bounds.high or 0) + 400 * 24 * HOUR)))
    part = F.least(F.lit(files - 1), F.floor((F.unix_micros(at) - (bounds.low or 0)) * files / ((bounds.high or 0) - (bounds.low or 0) + 1)))
    with state_store(spark):
        for n in range(files):
            rows.filter(part == n).write.mode("append").parquet(f"{root}/in")
            if n == files - 1:
                beat.write.mode("append").parquet(f"{root}/in")
            read = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
            sink = stream(read).writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{root}/checkpoint")
            sink.trigger(availableNow=True).start(f"{root}/out").awaitTermination()
    return spark.read.parquet(f"{root}/out").filter("meter_id <> 'heartbeat'")


@query(ORACLE_SQL["q17_stream_bronze_silver"])
def q44_event_time_state(spark, sf_dir):
    """The log through Bronze files and a Silver that drops repeated positions within the watermark, rows that come days late, then reconciliation."""
    root, rows = scratch(spark), _bronze(spark, sf_dir)
    dims = lambda: (fixtures.dim_meter(spark, sf_dir), fixtures.dim_dma(spark, sf_dir))
    half = rows.filter(f"not ({LATE})").withColumn("second", F.col("ingest_date") >= F.lit("2024-01-16").cast("date"))
    for part in (half.filter("not second"), half.filter("second").unionByName(half.filter("kafka_offset % 5 = 0")), rows.filter(LATE)):
        produce(part, f"{root}/log")
    bronze = events.FileBronze(spark, f"{root}/bronze")
    events.bronze_files(replay_stream(spark, f"{root}/log"), bronze.path, f"{root}/cp-bronze", now=NOW, once=True).awaitTermination()
    judged = validated(bronze.read(), *dims(), now=NOW)
    silver = Table(spark, f"{root}/silver", valid(judged).schema, parts=BY_READING[:1], merge_on_read=True)
    bad = Table(spark, f"{root}/quarantine", quarantine(judged, NOW, ("kafka_timestamp",)).schema, parts=BY_POSITION[:1])
    events.silver_events(bronze.stream(), silver, bad, dims, f"{root}/cp-silver", now=NOW, once=True).awaitTermination()
    reconcile(spark, Config(lookback_days=60), bronze=bronze, silver=silver, quarantined=bad, dim_meter=dims()[0], dim_dma=dims()[1], now=NOW)
    return _told(silver, bad)


@query(ORACLE_SQL["q34_sessions"])
def q45_sessions_stateful(spark, sf_dir):
    """Sessions as state with timers; the stream is stopped behind each part and goes on from its checkpoint."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("user_id").cast("string").alias("meter_id"), F.col("ts").cast("timestamp").alias("reading_timestamp"))
    return flat(_replayed(spark, rows, lambda s: session_stream(s, 2 * HOUR)))


@query(
    _WITH
    + """SELECT meter_id, epoch_us(reading_timestamp) AS reading_timestamp, 'spike' AS kind, round(used_liters, 4) AS used_liters, round(used_liters / top, 4) AS score FROM
(SELECT *, max(used_liters) OVER (PARTITION BY meter_id ORDER BY reading_timestamp ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS top FROM deltas) WHERE top > 0 AND used_liters / top > 1.5
UNION ALL SELECT meter_id, epoch_us(reading_timestamp), 'silent', NULL, NULL FROM
(SELECT *, lead(reading_timestamp) OVER (PARTITION BY meter_id ORDER BY reading_timestamp) AS next FROM silver) WHERE next IS NULL OR next - reading_timestamp >= INTERVAL 36 HOUR"""
)
def q46_alerts_stateful(spark, sf_dir):
    """Spikes and silences as state with timers, over restarts; scores are held from batch to batch."""
    rows = _silver(spark, sf_dir).select("meter_id", "reading_timestamp", "reading_value_liters")
    return flat(_replayed(spark, rows, lambda s: alert_stream(s, threshold=1.5, silence_micros=36 * HOUR)))


# -- numbers out of order, leaks, overlapping revisions, demand, quality over time


@query(
    _WITH
    + """, each AS (SELECT meter_id, sequence_no, count(*) AS n FROM bronze WHERE meter_id IS NOT NULL GROUP BY ALL),
islands AS (SELECT *, sequence_no - row_number() OVER (PARTITION BY meter_id ORDER BY sequence_no) AS island FROM each),
found AS (SELECT meter_id, min(sequence_no) AS low, max(sequence_no) AS high, sum(n)::BIGINT AS n FROM islands GROUP BY meter_id, island)
SELECT 'gap' AS kind, meter_id, high AS low, next AS high, next - high - 1 AS numbers, NULL::BIGINT AS n_rows FROM (SELECT *, lead(low) OVER (PARTITION BY meter_id ORDER BY low) AS next FROM found) WHERE next IS NOT NULL
UNION ALL SELECT 'meter', meter_id, min(low), max(high), sum(high - low + 1)::BIGINT, sum(n)::BIGINT FROM found GROUP BY meter_id"""
)
def q47_number_runs(spark, sf_dir):
    """Gaps and totals of sequence numbers from runs kept over batches that arrive in no order."""
    rows = _bronze(spark, sf_dir)
    kept = runs.NumberRuns(spark, f"{scratch(spark)}/runs")
    for n in (2, 0, 1):
        kept.add(rows.filter(F.pmod(F.xxhash64("kafka_offset", "kafka_partition"), F.lit(3)) == n), n)
    found = kept.read()
    gap = runs.gaps(found).select(F.lit("gap").alias("kind"), F.col("key").alias("meter_id"), F.col("after").alias("low"), F.col("before").alias("high"), F.col("missing").alias("numbers"), F.lit(None).cast("long").alias("n_rows"))
    return gap.unionByName(runs.totals(found).select(F.lit("meter").alias("kind"), F.col("key").alias("meter_id"), "low", "high", F.col("n_numbers").alias("numbers"), "n_rows"))


@query(
    _WITH.replace("WITH ev", "WITH RECURSIVE ev", 1)
    + """, nights AS (SELECT meter_id, CAST(reading_timestamp AS DATE) AS night, min(flow_rate) AS flow FROM bronze WHERE hour(reading_timestamp) IN (2, 3) AND flow_rate IS NOT NULL AND meter_id IS NOT NULL GROUP BY ALL),
numbered AS (SELECT *, row_number() OVER (PARTITION BY meter_id ORDER BY night) AS i, max(night) OVER (PARTITION BY meter_id) AS final FROM nights),
-- night by night: the sum, and the night its stretch began
walk AS (SELECT meter_id, i, night, final, greatest(flow - 0.5, 0) AS s, CASE WHEN flow > 0.5 THEN night END AS onset FROM numbered WHERE i = 1
  UNION ALL SELECT n.meter_id, n.i, n.night, n.final, greatest(w.s + n.flow - 0.5, 0), CASE WHEN w.s + n.flow - 0.5 <= 0 THEN NULL ELSE coalesce(w.onset, n.night) END FROM walk w JOIN numbered n ON n.meter_id = w.meter_id AND n.i = w.i + 1),
tops AS (SELECT meter_id, onset, final, min(night) FILTER (WHERE s > 3) AS alarmed, max(s) AS excess, max({'s': s, 'night': night, 'i': i}) AS top, min(i) AS first FROM walk WHERE onset IS NOT NULL GROUP BY ALL)
SELECT meter_id, CAST(onset AS VARCHAR) AS onset, CAST(alarmed AS VARCHAR) AS alarmed, CAST(CASE WHEN top.night < final THEN top.night END AS VARCHAR) AS ended, top.i - first + 1 AS nights, round(excess, 4) AS excess FROM tops WHERE alarmed IS NOT NULL"""
)
def q48_leak_onset(spark, sf_dir):
    """Leaks by the night they began and ended, from the cumulative sum of nightly least flows."""
    return flat(leaks.leaks(_bronze(spark, sf_dir)))


@query(
    _WITH
    + """, revisions AS (SELECT m_id, CASE WHEN k % 4 = 0 THEN DATE '2024-01-12' ELSE DATE '2020-01-01' END AS s, NULL::DATE AS f, ref_meter_type AS kind, ref_meter_status AS status FROM dim_meter
UNION ALL SELECT m_id, DATE '2020-01-01', DATE '2024-01-12', 'MECHANICAL', 'ACTIVE' FROM dim_meter WHERE k % 4 = 0
UNION ALL SELECT m_id, DATE '2024-01-08', DATE '2024-01-18', 'BENCH', 'REPAIR' FROM dim_meter WHERE k % 6 = 0
UNION ALL SELECT m_id, DATE '2024-01-09', DATE '2024-01-10', 'BENCH', 'LOST' FROM dim_meter WHERE k % 6 = 0),
points AS (SELECT DISTINCT m_id, unnest([s, f]) AS day FROM revisions),
held AS (SELECT p.m_id, p.day, max_by({'kind': kind, 'status': status}, s) AS r FROM points p LEFT JOIN revisions v ON v.m_id = p.m_id AND p.day >= s AND (f IS NULL OR p.day < f) WHERE p.day IS NOT NULL GROUP BY ALL)
SELECT kafka_offset, r.kind AS ref_meter_type, r.status AS ref_meter_status FROM bronze ASOF LEFT JOIN held ON meter_id = m_id AND CAST(reading_timestamp AS DATE) >= day"""
)
def q49_asof_scan(spark, sf_dir):
    """Readings with the meter revision that held, where revisions overlap, by one sorted scan."""
    revisions = fixtures.dim_meter(spark, sf_dir, history=True).select("meter_id", "meter_type", "status", "effective_start_date", "effective_end_date")
    repairs = fixtures.dim_meter(spark, sf_dir).filter("cast(meter_id as int) % 6 = 0")
    for status, start, end in (("REPAIR", "2024-01-08", "2024-01-18"), ("LOST", "2024-01-09", "2024-01-10")):
        dates = (F.lit(d).cast("date").alias(c) for d, c in ((start, "effective_start_date"), (end, "effective_end_date")))
        revisions = revisions.unionByName(repairs.select("meter_id", F.lit("BENCH").alias("meter_type"), F.lit(status).alias("status"), *dates))
    facts = _bronze(spark, sf_dir).select("kafka_offset", "meter_id", "reading_timestamp")
    found = asof.as_of(facts, revisions, "meter_id", F.to_date("reading_timestamp"))
    return found.select("kafka_offset", F.col("revision.meter_type").alias("ref_meter_type"), F.col("revision.status").alias("ref_meter_status"))


@query()
def q50_demand_forecast(spark, sf_dir):
    """Every meter's fit and its errors over the last week, beside those of the week before."""
    hourly = apportion.consumption(_silver(spark, sf_dir), "hour").select("meter_id", "period", "liters")
    models = forecast.fit(forecast.sums(hourly))
    scored = forecast.backtest(hourly, F.lit(datetime(2024, 1, 18, tzinfo=UTC)))
    weights = [F.round(F.col("weights")[i], 6).alias(f"w{i}") for i in range(forecast.N)]
    return flat(models.join(scored, "meter_id", "left").select("meter_id", "n_hours", *weights, "n", "error", "baseline_error"))


@query()
def q51_quality_over_time(spark, sf_dir):
    """By area and week: rows, violations, meters and quantiles from merged daily sketches, and the drift against the week before."""
    days = quality.daily(_judged(spark, sf_dir)).withColumn("week", F.date_trunc("week", "day").cast("date"))
    weeks = quality.merged(days, "area", "week")
    told = quality.profile(weeks, "area", "week")
    shift = quality.drift(weeks.withColumn("week", F.date_add("week", 7)), weeks, "area", "week")
    counts = weeks.select("area", "week", "n_rows", "n_valid")
    return flat(told.join(counts, ["area", "week"]).join(shift, ["area", "week", "measure"], "left"))


def bronze_from_log(log: DataFrame) -> DataFrame:
    """Log rows as Bronze rows at the fixed clock."""
    return to_bronze(log, NOW)


__all__ = ["ORACLE_SQL", "QUERIES", "Config", "bronze_from_log"]

"""Nested metadata documents and event messages as JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Shapes of the messages by topic.
MESSAGE_SCHEMAS = {
    "raw_images": (
        "image_data string, metadata struct<telescope_id: string, timestamp: string, exposure_ms: double, "
        "filter: string, coordinates: struct<ra_deg: double, dec_deg: double>>, "
        "quality_flags struct<cloud_coverage: double, seeing_arcsec: double>"
    ),
    "threat_detections": (
        "detection_id string, source string, timestamp string, threat_type string, confidence double, "
        "object_parameters struct<position_eci: array<double>, velocity_eci: array<double>, "
        "estimated_size_m: double, approach_velocity_km_s: double>, "
        "risk_assessment struct<collision_probability: double, time_to_closest_approach_s: double, "
        "miss_distance_km: double>"
    ),
    "control_commands": (
        "command_id string, timestamp string, command_type string, "
        "actuator_commands struct<thruster_x: double, thruster_y: double, thruster_z: double, "
        "reaction_wheel_x: double, reaction_wheel_y: double, reaction_wheel_z: double>, "
        "execution_params struct<burn_duration_s: double, delta_v_m_s: array<double>, fuel_cost_kg: double>, "
        "validation struct<signature: string, authority: string>"
    ),
    "conjunction_states": (
        "object_state struct<position: array<double>, velocity: array<double>, "
        "covariance: array<array<double>>, timestamp: string>, "
        "debris_catalog array<struct<norad_id: string, tle_line1: string, tle_line2: string, rcs: double, mass: double>>, "
        "environmental struct<solar_flux: double, geomagnetic_index: double, atmospheric_density: double>"
    ),
    # Our shapes for topics that have a name only: what the library reads and makes of them.
    "light_curves": "id string, target string, time array<double>, flux array<double>, flux_err array<double>",
    "debris_tracks": (
        "object_id string, timestamp string, position_eci array<double>, velocity_eci array<double>, "
        "covariance array<array<double>>, estimated_size_m double"
    ),
    "risk_assessments": "detection_id string, timestamp string, source string, risk double, category string, priority int",
}


def parse_messages(df: DataFrame, topic: str, value: str = "value", broken: str | None = None) -> DataFrame:
    """Columns of a topic's JSON messages; broken messages have all columns null.

    ``broken`` names a column for the text of a message that does not parse, null for the others.
    """
    schema, options = MESSAGE_SCHEMAS[topic], {}
    if broken:
        schema, options = f"{schema}, `{broken}` string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken}
    parsed = df.withColumn("_m", F.from_json(F.col(value).cast("string"), schema, options))
    return parsed.select("*", "_m.*").drop("_m", value)


def curve_rows(messages: DataFrame) -> DataFrame:
    """Parsed ``light_curves`` as series rows ``(id, time, flux, flux_err)``; samples end with the shortest array, errors may lack."""
    n = F.least(F.size("time"), F.size("flux"))
    places = F.explode(F.when(n > 0, F.sequence(F.lit(0), n - 1)))
    return messages.filter(n > 0).select("*", places.alias("_i")).select(
        "id", *[F.get(F.col(c), F.col("_i")).alias(c) for c in ("time", "flux", "flux_err")]
    )


def to_messages(df: DataFrame, key: str) -> DataFrame:
    """``key`` and JSON ``value`` for a topic."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def event_time(column: str) -> Column:
    """ISO-8601 text in UTC as a timestamp, null if it does not parse."""
    return F.try_to_timestamp(F.col(column))


def write_documents(documents: DataFrame, path: str, mode: str = "errorifexists") -> None:
    documents.write.mode(mode).json(path)


def read_documents(spark: SparkSession, path: str, schema: str, multi_line: bool = False) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", str(multi_line).lower()).json(path)

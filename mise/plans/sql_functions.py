"""SQL scalar functions of the clip library, for users who write Spark SQL.

Each is a SQL expression that the optimiser puts in place of its call; no Python runs.  They say
the same as their column functions and are checked against the same oracles."""

from __future__ import annotations

from pyspark.sql import SparkSession

FUNCTIONS = {
    "elapsed_seconds(t STRING) RETURNS DOUBLE":
        "CASE WHEN size(split(t, ':')) = 3 THEN try_cast(split(t, ':')[0] AS DOUBLE) * 3600.0D"
        " + try_cast(split(t, ':')[1] AS DOUBLE) * 60.0D + try_cast(split(t, ':')[2] AS DOUBLE) END",
    "seconds_to_frame(s DOUBLE, fps INT) RETURNS BIGINT": "CAST(s * CAST(fps AS DOUBLE) AS BIGINT)",
    "sample_frames(start BIGINT, stop BIGINT, n INT) RETURNS ARRAY<BIGINT>":
        "CASE WHEN n = 1 THEN array(start) ELSE transform(sequence(0, n - 1), i -> CASE WHEN i = n - 1 THEN stop"
        " ELSE CAST(CAST(i AS DOUBLE) * (CAST(stop - start AS DOUBLE) / CAST(n - 1 AS DOUBLE)) + start AS BIGINT) END) END",
    "frame_path(video STRING, frame_no BIGINT) RETURNS STRING": "format_string('frames/%s/frame_%010d.jpg', video, frame_no)",
    "frame_number(path STRING) RETURNS INT":
        "CASE WHEN startswith(substring_index(path, '/', -1), 'frame_') THEN try_cast(substring_index(substring_index("
        "substring(substring_index(path, '/', -1), 7), '_', 1), '.', 1) AS INT) END",
    "frame_buckets(start BIGINT, stop BIGINT, width INT) RETURNS ARRAY<BIGINT>":
        "sequence(CAST(floor(least(start, stop) / width) AS BIGINT), CAST(floor(greatest(start, stop) / width) AS BIGINT))",
}


def register_functions(spark: SparkSession) -> None:
    """Make the functions known in the session (temporary functions, replaced if they exist)."""
    for head, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")

"""Table layouts and fixed values shared by the library."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values that must equal the reference's for the same results:
# frame rate of the source videos, frames sampled per clip, feature widths
# of the text, object and visual streams, and the decode default.
FPS = 60
FRAMES_PER_CLIP = 3
TEXT_DIM = 384
UNKNOWN_CLASS = "unknown"
UNSEEN_ID = -1

# Clip metadata as written by the data-preparation stage.  Test clips carry
# only the first columns; the label columns are then NULL.
CLIP_SCHEMA = T.StructType([
    T.StructField("narration_id", T.StringType()),
    T.StructField("participant_id", T.StringType()),
    T.StructField("video_id", T.StringType()),
    T.StructField("start_timestamp", T.StringType()),
    T.StructField("stop_timestamp", T.StringType()),
    T.StructField("start_frame", T.LongType()),
    T.StructField("stop_frame", T.LongType()),
    T.StructField("narration", T.StringType()),
    T.StructField("verb", T.StringType()),
    T.StructField("verb_class", T.IntegerType()),
    T.StructField("noun", T.StringType()),
    T.StructField("noun_class", T.IntegerType()),
    T.StructField("duration_sec", T.DoubleType()),
    T.StructField("action_label", T.StringType()),
    T.StructField("duration_frames", T.LongType()),
])

MAPPING_SCHEMA = T.StructType([
    T.StructField("class_name", T.StringType()),
    T.StructField("class_id", T.LongType()),
])

"""Registered queries: one per operator of the inventory, each a
``(spark, data_dir) -> DataFrame`` built from the library, and its DuckDB
oracle (SQL over the same parquet tables) where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mise.functions import columns as C
from mise.operators import evaluate as EV
from mise.operators import features as FE
from mise.operators import frames as FR
from mise.operators import labels as LB
from mise.operators import profile as PR
from mise.operators import report as RP
from mise.operators import split as SP
from mise.plans import standins as S
from mise.plans.standins import oracle
from mise.session import cut_lineage, scratch_path
from mise.sources import clips as SC
from mise.sources import features as SF
from mise.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


R6 = 6  # float results are rounded to 6 decimals on both sides


# ------------------------------------------------------------------ helpers

def _pooled(spark, d, keep=("split",), meet=None):
    """Clip visual vectors: 3 sampled frames → frame join → mean pool."""
    return FR.pool_samples(S.clips(spark, d), S.frames(spark, d), dim=64, keep=keep, dtype="double", meet=meet)


def _noun_mapping(spark, d):
    c = S.clips(spark, d)
    return LB.fit_mapping(c.filter(F.col("split") == "train"), "noun_class")


def _verb_mapping(spark, d):
    c = S.clips(spark, d)
    return LB.fit_mapping(c.filter(F.col("split") == "train"), "verb_class")


def _val_encoded(spark, d):
    c = S.clips(spark, d).filter(F.col("split") == "val")
    c = LB.encode_labels(c, _verb_mapping(spark, d), "verb_class", out="yv")
    return LB.encode_labels(c, _noun_mapping(spark, d), "noun_class", out="yn")


def _two_head(spark, d, features="embedding"):
    """Centroid scorers for the verb and noun heads on the embeddings."""
    from mise.model.linear import fit_centroids
    train, test = S.scored_split(spark, d)
    mv = fit_centroids(train.filter(F.col("label") != 9), features, "label")
    mn = fit_centroids(train, features, "yn")
    return mn.transform(mv.transform(test, features, "zv"), features, "zn")


def _scored(spark, d):
    return EV.with_predictions(_two_head(spark, d), {"pv": "zv", "pn": "zn"})


# ------------------------------------------------------------ scans, sinks

@query("scan_clips", oracle(["clips"], "select * from clips"))
def q_scan_clips(spark, d):
    """CSV round trip: prepared sink (S2) then header scan with a schema (S1)."""
    from pyspark.sql import types as T
    path = scratch_path(spark, "clips-csv")
    SC.write_clips(S.clips(spark, d), path, fmt="csv")
    schema = T.StructType([
        T.StructField("clip_id", T.LongType()), T.StructField("video_id", T.StringType()),
        T.StructField("split", T.StringType()), T.StructField("start_frame", T.LongType()),
        T.StructField("stop_frame", T.LongType()), T.StructField("verb_class", T.LongType()),
        T.StructField("noun_class", T.LongType()), T.StructField("verb", T.StringType()),
        T.StructField("noun", T.StringType()), T.StructField("narration", T.StringType())])
    return SC.read_clips(spark, path, schema=schema)


@query("feature_load", oracle(["pool", "clips"], f"""
select clips.clip_id, round(coalesce(n2, 0), {R6}) n2, q.clip_id is not null has_visual
from clips left join (select clip_id, sum(a * a) n2 from pool group by clip_id) q on clips.clip_id = q.clip_id
where split = 'val'"""))
def q_feature_load(spark, d):
    """Long feature layout written partitioned by split/modality, read back
    for one split and one modality (partition pruning)."""
    p = _pooled(spark, d)
    feats = p.select("clip_id", "split", F.when(F.col("found") > 0, F.col("vec")).alias("visual"),
                     F.array(F.lit(1.0)).alias("marker"))
    path = scratch_path(spark, "features")
    SF.write_features(SF.to_long(feats, "clip_id", "split", {"visual": "visual", "marker": "marker"}, "double"), path)
    wide = SF.read_features(spark, path, "val", ["visual", "marker"])
    return wide.select(F.col("clip_id").cast("long").alias("clip_id"),
                       F.round(F.coalesce(C.sq_norm("visual"), F.lit(0.0)), R6).alias("n2"),
                       F.col("visual").isNotNull().alias("has_visual"))


# ------------------------------------------------------------- projections

@query("action_label", oracle(["clips"], "select clip_id, verb || ' ' || noun action_label from clips"))
def q_action_label(spark, d):
    return S.clips(spark, d).select("clip_id", C.action_label("verb", "noun").alias("action_label"))


@query("duration_frames", oracle(["clips"], "select clip_id, stop_frame - start_frame + 1 duration_frames from clips"))
def q_duration_frames(spark, d):
    return S.clips(spark, d).select("clip_id", C.duration_frames().alias("duration_frames"))


_SEC = ("(cast(split_part({t}, ':', 1) as double) * 3600 + cast(split_part({t}, ':', 2) as double) * 60"
        " + cast(split_part({t}, ':', 3) as double))")


@query("elapsed_seconds", oracle(["clip_times"], f"""
select clip_id, round({_SEC.format(t='start_timestamp')}, {R6}) start_sec,
  round({_SEC.format(t='stop_timestamp')}, {R6}) stop_sec,
  round({_SEC.format(t='stop_timestamp')} - {_SEC.format(t='start_timestamp')}, 2) duration_sec
from clip_times"""))
def q_elapsed_seconds(spark, d):
    t = S.clip_times(spark, d)
    return t.select("clip_id", F.round(C.elapsed_seconds("start_timestamp"), R6).alias("start_sec"),
                    F.round(C.elapsed_seconds("stop_timestamp"), R6).alias("stop_sec"),
                    C.duration_seconds("start_timestamp", "stop_timestamp").alias("duration_sec"))


@query("seconds_to_frames", oracle(["clip_times"], f"""
select clip_id, cast(floor({_SEC.format(t='start_timestamp')} * 60e0) as bigint) start_frame,
  cast(floor({_SEC.format(t='stop_timestamp')} * 60e0) as bigint) stop_frame from clip_times"""))
def q_seconds_to_frames(spark, d):
    t = S.clip_times(spark, d)
    return t.select("clip_id", C.seconds_to_frame(C.elapsed_seconds("start_timestamp")).alias("start_frame"),
                    C.seconds_to_frame(C.elapsed_seconds("stop_timestamp")).alias("stop_frame"))


@query("frame_sample", oracle(["clip_frame"], "select clip_id, cast(i as int) i, fno frame_no from clip_frame"))
def q_frame_sample(spark, d):
    return FR.explode_samples(S.clips(spark, d)).select("clip_id", "i", "frame_no")


@query("frame_path", oracle(["clip_frame", "clips"], """
select clip_frame.clip_id, cast(i as int) i,
  'frames/' || clips.video_id || '/frame_' || lpad(cast(fno as varchar), 10, '0') || '.jpg' path
from clip_frame join clips on clip_frame.clip_id = clips.clip_id"""))
def q_frame_path(spark, d):
    s = FR.explode_samples(S.clips(spark, d), keys=("video_id",))
    return s.select("clip_id", "i", C.frame_path("video_id", "frame_no").alias("path"))


def _mixed_names_duck():
    return """
select clip_frame.clip_id, cast(i as int) i,
  'frames/' || clips.video_id || '/' || case i when 0 then 'frame_' || lpad(cast(fno as varchar), 10, '0') || '.jpg'
                                       when 1 then 'frame_' || cast(fno as varchar) || '_x.png'
                                       else 'thumb_' || cast(fno as varchar) || '.jpg' end path
from clip_frame join clips on clip_frame.clip_id = clips.clip_id"""


@query("frame_parse", oracle(["clip_frame", "clips"], f"""
with p as ({_mixed_names_duck()}),
 b as (select clip_id, i, regexp_extract(path, '([^/]*)$', 1) base from p)
select clip_id, i, try_cast(regexp_extract(base, '^frame_([^_.]*)', 1) as integer) frame_no from b
where base like 'frame\\_%' escape '\\' and try_cast(regexp_extract(base, '^frame_([^_.]*)', 1) as integer) is not null"""))
def q_frame_parse(spark, d):
    """Frame numbers back from file names; names that do not parse are
    dropped.  Names mix the canonical form, a suffixed form and non-frame
    files."""
    s = FR.explode_samples(S.clips(spark, d), keys=("video_id",))
    name = (F.when(F.col("i") == 0, F.format_string("frame_%010d.jpg", F.col("frame_no")))
            .when(F.col("i") == 1, F.format_string("frame_%d_x.png", F.col("frame_no")))
            .otherwise(F.format_string("thumb_%d.jpg", F.col("frame_no"))))
    p = s.select("clip_id", "i", F.concat(F.lit("frames/"), F.col("video_id"), F.lit("/"), name).alias("path"))
    return p.select("clip_id", "i", C.parse_frame_no("path").alias("frame_no")).filter(F.col("frame_no").isNotNull())


@query("text_clean", oracle(["clips"], "select clip_id, coalesce(cast(narration as varchar), '') text from clips"))
def q_text_clean(spark, d):
    return S.clips(spark, d).select("clip_id", C.clean_text("narration").alias("text"))


@query("l2_normalize", oracle(["vec_el"], f"""
with n as (select vec_id, sqrt(sum(cast(v as double) * cast(v as double))) nrm from vec_el group by vec_id)
select e.vec_id, round(max(case when pos = 0 then cast(v as double) / nrm end), {R6}) e0,
  round(sum((cast(v as double) / nrm) * (cast(v as double) / nrm)), {R6}) n2
from vec_el e join n on e.vec_id = n.vec_id group by e.vec_id"""))
def q_l2_normalize(spark, d):
    e = S.embeddings(spark, d).withColumn("u", C.l2_normalize("embedding", "double"))
    return e.select("vec_id", F.round(F.get("u", 0), R6).alias("e0"), F.round(C.sq_norm("u"), R6).alias("n2"))


@query("zero_fill", oracle(["pool", "clips"], f"""
select clips.clip_id, 64 width, round(coalesce(n2, 0), {R6}) n2, q.clip_id is null is_zero
from clips left join (select clip_id, sum(a * a) n2 from pool group by clip_id) q on clips.clip_id = q.clip_id"""))
def q_zero_fill(spark, d):
    p = _pooled(spark, d).withColumn("visual", F.when(F.col("found") > 0, F.col("vec")))
    v = C.zero_fill("visual", 64, "double")
    return p.select("clip_id", F.size(v).alias("width"), F.round(C.sq_norm(v), R6).alias("n2"),
                    (~C.has_modality(v)).alias("is_zero"))


@query("fit_width", oracle(["pool", "clips"], f"""
select clips.clip_id, round(coalesce(n48, 0), {R6}) n48, round(coalesce(n80, 0), {R6}) n80
from clips left join (select clip_id, sum(case when pos < 48 then a * a else 0 end) n48, sum(a * a) n80
                      from pool group by clip_id) q on clips.clip_id = q.clip_id"""))
def q_fit_width(spark, d):
    p = _pooled(spark, d)
    w48, w80 = C.fit_width("vec", 48, "double"), C.fit_width("vec", 80, "double")
    return p.select("clip_id", F.round(C.sq_norm(w48), R6).alias("n48"), F.round(C.sq_norm(w80), R6).alias("n80"))


# ------------------------------------------------------------------ frames

@query("needed_frames", oracle(["clip_frame", "clips"], """
select distinct video_id, fno frame_no from clip_frame"""))
def q_needed_frames(spark, d):
    return FR.needed_frames(S.clips(spark, d), keys=("video_id",))


@query("available_videos", oracle(["clips", "archives"], """
select clip_id from clips where video_id in (select video_id from archives)"""))
def q_available_videos(spark, d):
    return FR.available(S.clips(spark, d), S.archives(spark, d)).select("clip_id")


@query("clip_frame_join", oracle(["clip_frame", "frames"], """
select clip_id, cast(i as int) i, fno frame_no, f.frame_no is not null found
from clip_frame c left join frames f on c.video_id = f.video_id and c.fno = f.frame_no"""))
def q_clip_frame_join(spark, d):
    j = FR.join_frames(FR.explode_samples(S.clips(spark, d)), S.frames(spark, d))
    return j.select("clip_id", "i", "frame_no", F.col("hit").isNotNull().alias("found"))


@query("frame_pool", oracle(["pool", "clips"], f"""
select clips.clip_id, round(coalesce(n2, 0), {R6}) n2 from clips
left join (select clip_id, sum(a * a) n2 from pool group by clip_id) q on clips.clip_id = q.clip_id"""))
def q_frame_pool(spark, d):
    p = _pooled(spark, d)
    return p.select("clip_id", F.round(C.sq_norm("vec"), R6).alias("n2"))


_ARCHIVE_FEATURES = oracle(["unit_pool", "clips"], """
select clips.clip_id, round(coalesce(n2, 0), 4) n2 from clips
left join (select clip_id, sum(a * a) n2 from unit_pool group by clip_id) q on clips.clip_id = q.clip_id""")


def _from_archives(spark, d, **kw):
    """Clip vectors built from tar archives of 50 frames, each frame stored as its numbers in text."""
    from mise.operators.encoders import number_text, visual_features
    from mise.plans.frame_files import write_frame_archives
    frames = S.frames(spark, d).select(
        "video_id", "frame_no",
        F.encode(F.array_join(F.transform("embedding", lambda x: x.cast("string")), ","), "US-ASCII").alias("content"))
    listing_path = scratch_path(spark, "archive-listing")
    write_frame_archives(frames, scratch_path(spark, "archives"), per_archive=50, gzip_odd=bool(kw)).write.parquet(listing_path)
    archives = spark.read.parquet(listing_path)  # archives written once, listing read back
    pooled = visual_features(S.clips(spark, d), archives, 64, factory=lambda: number_text(64), normalize=True, dtype="double", **kw)
    return pooled.select("clip_id", F.round(C.sq_norm("vec"), 4).alias("n2"))


@query("archive_features", _ARCHIVE_FEATURES)
def q_archive_features(spark, d):
    """Frame archives end to end: needed frames, header listing, semi join, ranged reads, one
    decode per needed frame, L2 step in float32, frame join, mean pool."""
    return _from_archives(spark, d)


@query("archive_stream", _ARCHIVE_FEATURES)
def q_archive_stream(spark, d):
    """The same from archives of which every other one is compressed: one sequential pass over each,
    the needed frames of its video beside it as bitmaps."""
    return _from_archives(spark, d, streamed=True)


@query("archive_source", oracle(["frames"], """
select video_id, cast(frame_no as int) frame_no, cast(length(video_id || ':' || cast(frame_no as varchar)) as bigint) size from frames
where video_id in ('V1', 'V3', 'V5') and frame_no >= 2"""))
def q_archive_source(spark, d):
    """Archives read as a data source: other videos' archives aren't opened, earlier frames' bytes not kept."""
    from mise.plans.frame_files import write_frame_archives
    from mise.sources.archive_source import read_archives
    root = scratch_path(spark, "archive-source")
    frames = S.frames(spark, d).select("video_id", "frame_no", F.encode(
        F.concat_ws(":", "video_id", F.col("frame_no").cast("string")), "UTF-8").alias("content"))
    write_frame_archives(frames, root, per_archive=50, gzip_odd=True).write.format("noop").mode("overwrite").save()
    read = read_archives(spark, root).filter(F.col("video_id").isin("V1", "V3", "V5") & (F.col("frame_no") >= 2))
    return read.select("video_id", "frame_no", F.octet_length("content").cast("long").alias("size"))


#: Frames drawn as 8 x 8 grey images; every 41st file of the table is broken.
_PIXEL = "least(greatest(floor(({v} + 1e0) * 128e0), 0e0), 255e0)"


def _images(spark, d):
    from mise.plans.frame_files import with_png, write_frame_files
    from mise.sources.frames import read_images
    e = S.frames(spark, d)
    byte = F.transform("embedding", lambda v: F.lpad(F.hex(F.least(F.greatest(F.floor((v.cast("double") + 1.0) * 128.0), F.lit(0)), F.lit(255))), 2, "0"))
    pixels = F.when((F.col("frame_no") * 27 + F.substring("video_id", 2, 9).cast("long")) % 41 != 7, F.unhex(F.array_join(byte, "")))
    root = scratch_path(spark, "frame-images")
    write_frame_files(with_png(e.select("video_id", "frame_no", pixels.alias("pixels")), "pixels", 8), root).write.format("noop").mode("overwrite").save()
    return read_images(spark, root)


@query("image_files", oracle(["frames", "frame_el"], f"""
with p as (select video_id, frame_no, cast(sum({_PIXEL.format(v='cast(v as double)')}) as bigint) light from frame_el group by video_id, frame_no),
 b as (select *, (frame_no * 27 + cast(substr(video_id, 2) as bigint)) % 41 <> 7 ok from p)
select video_id, count(*) files, count(*) filter (not ok) broken, cast(coalesce(sum(light) filter (ok), 0) as bigint) light,
  cast(max(case when ok then 64 end) as bigint) pixels from b group by video_id"""))
def q_image_files(spark, d):
    """Image files decoded: per video its files, those that can't be decoded, and the sum of all pixels."""
    i = _images(spark, d)
    light = F.aggregate("pixels", F.lit(0).cast("long"), lambda a, x: a + x)
    return i.groupBy("video_id").agg(
        F.count(F.lit(1)).alias("files"), F.count_if(~F.col("ok")).alias("broken"), F.coalesce(F.sum(light), F.lit(0)).alias("light"),
        F.max(F.col("height") * F.col("width") * F.col("channels")).cast("long").alias("pixels"))


@query("image_features", oracle(["clip_frame", "frame_el", "clips"], f"""
with px as (select video_id, frame_no, pos, {_PIXEL.format(v='cast(v as double)')} / 255e0 x from frame_el
            where (frame_no * 27 + cast(substr(video_id, 2) as bigint)) % 41 <> 7),
 p as (select clip_id, pos, avg(x) a, count(*) n from clip_frame c join px f on c.video_id = f.video_id and c.fno = f.frame_no group by clip_id, pos)
select clips.clip_id, coalesce(n, 0) found, round(coalesce(n2, 0), {R6}) n2 from clips
left join (select clip_id, max(n) n, sum(a * a) n2 from p group by clip_id) q on clips.clip_id = q.clip_id"""))
def q_image_features(spark, d):
    """Mean pixels of the clips' sampled frames, from image files; broken files are missing frames."""
    # a byte per pixel (less 128) until the pixels are added up
    vectors = _images(spark, d).filter("ok").select("video_id", "frame_no", F.transform("pixels", lambda x: (x - 128).cast("tinyint")).alias("embedding"))
    pooled = FR.pool_frames(FR.join_frames(FR.explode_samples(S.clips(spark, d)), vectors), 64, dtype="double",
                            value=lambda x: (x.cast("int") + 128) / F.lit(255.0))
    return pooled.select("clip_id", "found", F.round(C.sq_norm("vec"), R6).alias("n2"))


@query("frame_files", oracle(["frames"], """
select video_id, frame_no, cast(length(video_id || ':' || cast(frame_no as varchar)) as bigint) size from frames"""))
def q_frame_files(spark, d):
    """Frames written as one file each and read back as binary files."""
    from mise.plans.frame_files import write_frame_files
    from mise.sources.frames import read_frames
    root = scratch_path(spark, "frame-files")
    frames = S.frames(spark, d).select("video_id", "frame_no", F.encode(
        F.concat_ws(":", "video_id", F.col("frame_no").cast("string")), "UTF-8").alias("content"))
    write_frame_files(frames, root).write.format("noop").mode("overwrite").save()
    return read_frames(spark, root).select("video_id", F.col("frame_no").cast("long").alias("frame_no"),
                                           F.octet_length("content").cast("long").alias("size"))


@query("missing_frames", oracle(["clip_frame", "clips", "frames"], """
select split, sum(case when frame_no is null then 1e0 else 0e0 end) missing
from clip_frame c join clips on c.clip_id = clips.clip_id
left join frames f on c.video_id = f.video_id and c.fno = f.frame_no group by split"""))
def q_missing_frames(spark, d):
    s = FR.explode_samples(S.clips(spark, d), keep=("split",))
    return FR.missing_frames(FR.join_frames(s, S.frames(spark, d)), by=("split",))


@query("frame_range_join", oracle(["clips", "frames"], """
select clip_id, count(*) n_frames, cast(sum(frame_no) as bigint) sum_frame
from clips join frames on clips.video_id = frames.video_id and frame_no between start_frame and stop_frame group by clip_id"""))
def q_frame_range_join(spark, d):
    pairs = FR.frames_in_range(S.clips(spark, d), S.frames(spark, d))
    return pairs.groupBy("clip_id").agg(F.count(F.lit(1)).alias("n_frames"), F.sum("frame_no").alias("sum_frame"))


@query("range_pool", oracle(["clips", "frames", "frame_el"], f"""
with p as (select clip_id, pos, avg(cast(v as double)) a, count(*) n from clips join frame_el f
           on clips.video_id = f.video_id and f.frame_no between start_frame and stop_frame group by clip_id, pos)
select clips.clip_id, coalesce(n, 0) found, round(coalesce(n2, 0), {R6}) n2, round(coalesce(e0, 0), {R6}) e0 from clips
left join (select clip_id, max(n) n, sum(a * a) n2, max(case when pos = 0 then a end) e0 from p group by clip_id) q on clips.clip_id = q.clip_id"""))
def q_range_pool(spark, d):
    """Mean of all frames of each clip, by running sums."""
    p = FR.pool_ranges(S.clips(spark, d), S.frames(spark, d), dim=64, dtype="double")
    return p.select("clip_id", "found", F.round(C.sq_norm("vec"), R6).alias("n2"), F.round(F.get("vec", 0), R6).alias("e0"))


@query("needed_bitmaps", oracle(["clip_frame"], """
select video_id, fno // 32768 bucket, count(distinct fno) n from clip_frame group by video_id, fno // 32768"""))
def q_needed_bitmaps(spark, d):
    """The needed frames as bitmaps, counted by their bits."""
    b = FR.needed_bitmaps(FR.explode_samples(S.clips(spark, d)))
    return b.select("video_id", "bucket", F.bitmap_count("bitmap").alias("n"))


@query("has_modality", oracle(["pool"], "select clip_id from pool group by clip_id having max(abs(a)) > 0"))
def q_has_modality(spark, d):
    return _pooled(spark, d).filter(C.has_modality("vec")).select("clip_id")


@query("modality_coverage", oracle(["pool", "clips"], f"""
with r as (select clip_id from pool group by clip_id having max(abs(a)) > 0)
select split, count(r.clip_id) n_real, count(*) n, round(count(r.clip_id) / count(*), {R6}) coverage
from clips left join r on clips.clip_id = r.clip_id group by split"""))
def q_modality_coverage(spark, d):
    return PR.coverage(_pooled(spark, d), "vec", by=("split",))


# --------------------------------------------------------------- profiling

@query("top_classes", oracle(["clips"], """
select verb, count(*) n from clips where split = 'train' group by verb order by n desc, verb limit 20"""))
def q_top_classes(spark, d):
    return PR.class_counts(S.clips(spark, d).filter(F.col("split") == "train"), "verb", k=20)


@query("top_nouns", oracle(["clips"], """
select noun, count(*) n from clips where split = 'train' group by noun order by n desc, noun limit 20"""))
def q_top_nouns(spark, d):
    return PR.class_counts(S.clips(spark, d).filter(F.col("split") == "train"), "noun", k=20)


@query("top_actions", oracle(["clips"], """
select verb || ' ' || noun action_label, count(*) n from clips where split = 'train'
group by 1 order by n desc, action_label limit 20"""))
def q_top_actions(spark, d):
    c = S.clips(spark, d).filter(F.col("split") == "train").select(C.action_label().alias("action_label"))
    return PR.class_counts(c, "action_label", k=20)


@query("class_cardinality", oracle(["clips"], """
select count(distinct verb_class) verb_class_distinct, count(distinct noun_class) noun_class_distinct,
  count(distinct (verb_class, noun_class)) pairs_distinct from clips where split = 'train'"""))
def q_class_cardinality(spark, d):
    return PR.class_cardinality(S.clips(spark, d).filter(F.col("split") == "train"))


@query("imbalance_index", oracle(["clips"], """
select round(1 - sum(n * 1e0 * n) / (sum(n) * 1e0 * sum(n)), 6) g, count(*) k
from (select verb_class, count(*) n from clips where split = 'train' group by verb_class) t"""))
def q_imbalance_index(spark, d):
    return PR.imbalance(S.clips(spark, d).filter(F.col("split") == "train"), "verb_class")


_CLIP_COLS = ["clip_id", "video_id", "start_frame", "stop_frame", "verb_class", "noun_class", "verb", "noun", "narration"]


@query("split_summary", oracle(["clips"], f"""
select split, count(*) rows, count(distinct video_id) videos,
  cast({" + ".join(f"(case when count({c}) > 0 then 1 else 0 end)" for c in _CLIP_COLS)} as int) columns,
  bool_or(narration is not null) has_narration,
  bool_or(verb_class is not null or noun_class is not null) has_labels from clips group by split"""))
def q_split_summary(spark, d):
    return PR.split_summary(S.clips(spark, d))


@query("n_classes", oracle(["clips"], """
select cast(max(verb_class) + 1 as bigint) verb_class_n, cast(max(noun_class) + 1 as bigint) noun_class_n
from clips where split = 'train'"""))
def q_n_classes(spark, d):
    return PR.n_classes(S.clips(spark, d).filter(F.col("split") == "train"), ["verb_class", "noun_class"])


@query("rare_classes", oracle(["clips"], """
select verb_class, count(*) n from clips where split = 'train' group by verb_class having count(*) < 10"""))
def q_rare_classes(spark, d):
    return PR.rare_classes(S.clips(spark, d).filter(F.col("split") == "train"), "verb_class")


@query("sample_rows", oracle(["clips"], """
select clip_id, video_id, narration from clips where split = 'val' order by clip_id limit 10"""))
def q_sample_rows(spark, d):
    c = S.clips(spark, d).filter(F.col("split") == "val")
    return c.orderBy("clip_id").limit(10).select("clip_id", "video_id", "narration")


# ------------------------------------------------------------------ labels

_NOUN_MAP = "noun_map"


@query("label_mapping", oracle([_NOUN_MAP], "select class_name, class_id from noun_map"))
def q_label_mapping(spark, d):
    return _noun_mapping(spark, d)


@query("label_encode", oracle(["clips", _NOUN_MAP], """
select clip_id, coalesce(class_id, -1) y from clips
left join noun_map m on cast(noun_class as string) = class_name where split = 'val'"""))
def q_label_encode(spark, d):
    c = S.clips(spark, d).filter(F.col("split") == "val")
    return LB.encode_labels(c, _noun_mapping(spark, d), "noun_class", out="y").select("clip_id", "y")


@query("label_encode_strict", oracle(["clips", "verb_map"], """
select clip_id, class_id y from clips join verb_map m on cast(verb_class as string) = class_name where split = 'train'"""))
def q_label_encode_strict(spark, d):
    """Strict encoding, which raises on a class outside the mapping; training rows have none."""
    c = S.clips(spark, d).filter(F.col("split") == "train")
    return LB.encode_labels(c, _verb_mapping(spark, d), "verb_class", out="y", on_unseen="error").select("clip_id", "y")


@query("mapping_io", oracle([_NOUN_MAP], "select class_name, class_id, 'string' kind from noun_map"))
def q_mapping_io(spark, d):
    """A mapping saved and loaded again; class names stay strings."""
    path = scratch_path(spark, "mapping")
    SF.write_mapping(_noun_mapping(spark, d), path)
    m = SF.read_mapping(spark, path)
    return m.withColumn("kind", F.typeof("class_name"))


@query("unseen_rows", oracle(["clips", _NOUN_MAP, "verb_map"], """
select count(*) filter (where coalesce(v.class_id, -1) = -1) yv_unseen,
       count(*) filter (where coalesce(n.class_id, -1) = -1) yn_unseen
from clips left join verb_map v on cast(verb_class as string) = v.class_name
left join noun_map n on cast(noun_class as string) = n.class_name where split = 'val'"""))
def q_unseen_rows(spark, d):
    return LB.unseen_rows(_val_encoded(spark, d), ["yv", "yn"])


@query("known_label_mask", oracle(["clips", _NOUN_MAP, "verb_map"], """
select clip_id, coalesce(v.class_id, -1) >= 0 verb_known, coalesce(n.class_id, -1) >= 0 noun_known,
  coalesce(v.class_id, -1) >= 0 and coalesce(n.class_id, -1) >= 0 both_known
from clips left join verb_map v on cast(verb_class as string) = v.class_name
left join noun_map n on cast(noun_class as string) = n.class_name where split = 'val'"""))
def q_known_label_mask(spark, d):
    e = _val_encoded(spark, d)
    return e.select("clip_id", C.known("yv").alias("verb_known"), C.known("yn").alias("noun_known"),
                    (C.known("yv") & C.known("yn")).alias("both_known"))


@query("label_decode", oracle(["clips", _NOUN_MAP], """
with e as (select clip_id, coalesce(class_id, -1) y from clips
           left join noun_map m on cast(noun_class as string) = class_name where split = 'val')
select clip_id, y, coalesce(m.class_name, 'unknown') name from e left join noun_map m on y = m.class_id"""))
def q_label_decode(spark, d):
    c = S.clips(spark, d).filter(F.col("split") == "val")
    m = _noun_mapping(spark, d)
    e = LB.encode_labels(c, m, "noun_class", out="y").select("clip_id", "y")
    return LB.decode(e, m, "y", "name")


@query("label_decode_text", oracle(["clips", _NOUN_MAP], """
with ref as (select cast(noun_class as string) class_name, max_by(noun, clip_id) text from clips
             where split = 'train' group by noun_class),
 e as (select clip_id, coalesce(class_id, -1) y from clips
       left join noun_map m on cast(noun_class as string) = class_name where split = 'val')
select clip_id, coalesce(ref.text, m.class_name, cast(y as varchar)) name
from e left join noun_map m on y = m.class_id left join ref on m.class_name = ref.class_name"""))
def q_label_decode_text(spark, d):
    c = S.clips(spark, d)
    m = _noun_mapping(spark, d)
    ref = LB.text_reference(c.filter(F.col("split") == "train"), "noun_class", "noun", "clip_id")
    e = LB.encode_labels(c.filter(F.col("split") == "val"), m, "noun_class", out="y").select("clip_id", "y")
    return LB.decode_text(e, m, ref, "y", "name").select("clip_id", "name")


def _class_weights_sql(subset: str) -> str:
    return f"""
with k as (select max(verb_class) + 1 n_cls from clips where split = 'train'),
 r as (select unnest(range(0, n_cls)) cid from k),
 c as (select verb_class, count(*) n from clips where split = 'train'{subset} group by verb_class),
 w as (select cid, 1e0 / greatest(coalesce(n, 0), 1) w from r left join c on cid = verb_class),
 t as (select sum(w) s from w)
select cid class_id, round(w / s * n_cls, {R6}) w from w, t, k"""


def _class_weights(spark, d, subset=None):
    train = S.clips(spark, d).filter(F.col("split") == "train")
    n = LB.class_space(train, "verb_class")
    w = LB.class_weights(train if subset is None else train.filter(subset), "verb_class", n)
    return w.select("class_id", F.round("w", R6).alias("w"))


@query("class_weights", oracle(["clips"], _class_weights_sql("")))
def q_class_weights(spark, d):
    return _class_weights(spark, d)


@query("class_weights_masked", oracle(["clips"], _class_weights_sql(" and video_id = 'V1'")))
def q_class_weights_masked(spark, d):
    """Weights of the training subset of one video, over the full class space."""
    return _class_weights(spark, d, F.col("video_id") == "V1")


@query("one_hot", oracle(["clips", _NOUN_MAP], """
select clip_id, coalesce(class_id, -1) hot, (select count(*) from noun_map) width from clips
left join noun_map m on cast(noun_class as string) = class_name where split = 'val'"""))
def q_one_hot(spark, d):
    c = S.clips(spark, d).filter(F.col("split") == "val")
    v = FE.one_hot(c, _noun_mapping(spark, d), "noun_class", out="v").select("clip_id", C.sparse("v").alias("v"))
    return v.select("clip_id", C.first_index("v").alias("hot"), F.col("v.size").cast("long").alias("width"))


# ------------------------------------------------------- split and leakage

@query("group_split", oracle(["clips"], """
select clip_id, video_id, case when b < 80 then 'train' when b < 90 then 'val' else 'test' end split
from (select clip_id, video_id, (('0x' || substr(md5(video_id), 1, 8))::bigint) % 100 b from clips) t"""))
def q_group_split(spark, d):
    c = S.clips(spark, d).select("clip_id", "video_id")
    return SP.assign_split(c, "video_id")


@query("group_split_sized", oracle(["clips"], """
with g as (select video_id, count(*) n from clips group by video_id),
 c as (select video_id, n, sum(n) over (order by md5(video_id), video_id rows between unbounded preceding and current row) - n before, sum(n) over () total from g)
select clip_id, clips.video_id, case when before * 100 < total * 80 then 'train' when before * 100 < total * 90 then 'val' else 'test' end split
from clips join c on clips.video_id = c.video_id"""))
def q_group_split_sized(spark, d):
    """Whole videos dealt so that every split meets its share of the clips."""
    return SP.assign_split_by_size(S.clips(spark, d).select("clip_id", "video_id"), "video_id").select("clip_id", "video_id", "split")


@query("split_leakage", oracle(["clips"], """
select video_id, count(distinct s) n from
 (select video_id, case when clip_id % 1000 = 7 then 'demo' else split end s from clips) t
group by video_id having count(distinct s) > 1"""))
def q_split_leakage(spark, d):
    """No video is shared by design; clips with id ending in 007 are relabelled
    'demo' (as the reference's demo clips came from a training video)."""
    c = S.clips(spark, d).withColumn(
        "split", F.when(F.col("clip_id") % 1000 == 7, F.lit("demo")).otherwise(F.col("split")))
    return SP.split_leakage(c, "video_id", "split").select("video_id", "n")


@query("text_label_leak", oracle(["clips"], """
select round(avg(case when position(lower(concat('noun_', cast(noun_class as string))) in lower(coalesce(narration, ''))) > 0 then 1e0 else 0e0 end), 6) noun_leak,
  round(avg(case when position(lower(verb) in lower(coalesce(narration, ''))) > 0 then 1e0 else 0e0 end), 6) verb_leak
from clips"""))
def q_text_label_leak(spark, d):
    c = S.clips(spark, d)
    return SP.text_label_leak(c, "narration", {
        "noun_leak": F.concat(F.lit("noun_"), F.col("noun_class").cast("string")),
        "verb_leak": F.col("verb")})


# -------------------------------------------------------------- evaluation

@query("argmax_pred", oracle(["rk_v"], "select vec_id, cls pred from rk_v where r = 1"))
def q_argmax_pred(spark, d):
    return _scored(spark, d).select("vec_id", F.col("pv").alias("pred"))


@query("score_logits", oracle(["logits"], f"select vec_id, cls, round(z, {R6}) z from logits"))
def q_score_logits(spark, d):
    s = _two_head(spark, d)
    return s.select("vec_id", F.posexplode("zv").alias("cls", "z")).select(
        "vec_id", "cls", F.round("z", R6).alias("z"))


@query("topk_classes", oracle(["rk_v"], "select vec_id, cast(r as int) rank, cls from rk_v where r <= 5"))
def q_topk_classes(spark, d):
    s = _two_head(spark, d)
    return s.select("vec_id", F.posexplode(C.topk_classes("zv", 5)).alias("rank", "cls")).select(
        "vec_id", (F.col("rank") + 1).alias("rank"), "cls")


@query("topk_accuracy", oracle(["rk_v"], """
select count(distinct vec_id) n,
  round(sum(case when r = 1 and cls = y then 1e0 else 0e0 end) / count(distinct vec_id), 6) top1,
  round(sum(case when r <= 5 and cls = y then 1e0 else 0e0 end) / count(distinct vec_id), 6) top5
from rk_v where y >= 0"""))
def q_topk_accuracy(spark, d):
    return EV.topk_accuracy(_two_head(spark, d), "yv", "zv", ks=(1, 5))


@query("macro_f1", oracle(["rk_v"], """
with o as (select y, cls p from rk_v where r = 1 and y >= 0),
 u as (select y c, count(*) sup, 0 pr, sum(case when y = p then 1 else 0 end) tp from o group by y
       union all select p, 0, count(*), 0 from o group by p),
 a as (select c, sum(sup) sup, sum(pr) pr, sum(tp) tp from u group by c)
select count(*) n_cls, round(avg(2e0 * tp / (sup + pr)), 6) f1 from a"""))
def q_macro_f1(spark, d):
    return EV.macro_f1(_scored(spark, d), "yv", "pv")


@query("confusion_topk", oracle(["rk_v"], """
select y, cls p, count(*) n from rk_v where r = 1 and y >= 0 and y <> cls
group by y, cls order by n desc, y, p limit 10"""))
def q_confusion_topk(spark, d):
    return EV.top_confusions(_scored(spark, d), "yv", "pv", k=10)


@query("confusion_counts", oracle(["rk_v"], "select y, cls p, count(*) n from rk_v where r = 1 and y >= 0 group by y, cls"))
def q_confusion_counts(spark, d):
    return EV.confusion(_scored(spark, d), "yv", "pv")


_LOSS_W = """
 cw as (select cid, 1e0 / greatest(coalesce(n, 0), 1) w0 from (select unnest(range(0, 9)) cid) r
        left join (select label, count(*) n from embeddings where vec_id % 5 <> 0 group by label) c on cid = label),
 w as (select cid, w0 / (select sum(w0) from cw) * 9 w from cw),"""


@query("weighted_log_loss", oracle(["logits"], "with " + _LOSS_W.strip() + """
 l as (select vec_id, y, max(z) mx from logits where y >= 0 group by vec_id, y),
 e as (select l.vec_id, l.y, mx + ln(sum(exp(z - mx))) lse from l join logits on l.vec_id = logits.vec_id group by l.vec_id, l.y, mx),
 n as (select e.y, lse - z nll from e join logits on e.vec_id = logits.vec_id and e.y = cls)
select round(sum(nll * w.w) / sum(w.w), 6) loss from n join w on n.y = w.cid"""))
def q_weighted_log_loss(spark, d):
    """Weights from the training rows' label counts over the head's nine classes."""
    train, _ = S.scored_split(spark, d)
    w = cut_lineage(LB.class_weights(train.filter(F.col("label") != 9), "label", 9))
    return EV.weighted_log_loss(_two_head(spark, d), "yv", "zv", w)


@query("topk_narrow_space", oracle(["rk_v"], """
with o as (select vec_id, y, cls, row_number() over (partition by vec_id order by r) r from rk_v where y >= 0 and cls < 5)
select count(distinct vec_id) n,
  round(sum(case when r = 1 and cls = y then 1e0 else 0e0 end) / count(distinct vec_id), 6) top1,
  round(sum(case when r <= 5 and cls = y then 1e0 else 0e0 end) / count(distinct vec_id), 6) top5 from o"""))
def q_topk_narrow_space(spark, d):
    """Logits of the first five classes only: labels outside them are misses."""
    s = _two_head(spark, d).withColumn("zv", F.slice("zv", 1, 5))
    return EV.topk_accuracy(s, "yv", "zv", ks=(1, 5))


@query("correct_flags", oracle(["two_head"], """
select vec_id, yv = pv verb_ok, yn = pn noun_ok, yv = pv and yn = pn action_ok from two_head"""))
def q_correct_flags(spark, d):
    return EV.with_correct_flags(_scored(spark, d)).select("vec_id", "verb_ok", "noun_ok", "action_ok")


@query("known_mask_heads", oracle(["two_head"], """
select count(*) filter (where yv >= 0) verb_n, count(*) filter (where yn >= 0) noun_n,
  count(*) filter (where yv >= 0 and yn >= 0) action_n from two_head"""))
def q_known_mask_heads(spark, d):
    s = _scored(spark, d)
    return s.agg(F.count_if(C.known("yv")).alias("verb_n"), F.count_if(C.known("yn")).alias("noun_n"),
                 F.count_if(C.known("yv") & C.known("yn")).alias("action_n"))


@query("error_rows", oracle(["two_head"], """
select vec_id, yv, pv, yn, pn from two_head where yv >= 0 and yn >= 0 and not (yv = pv and yn = pn)"""))
def q_error_rows(spark, d):
    return EV.errors(_scored(spark, d)).select("vec_id", "yv", "pv", "yn", "pn")


@query("action_top1", oracle(["two_head"], """
select count(*) filter (where yv >= 0 and yn >= 0) action_n,
  round(avg(case when yv >= 0 and yn >= 0 then (case when yv = pv and yn = pn then 1e0 else 0e0 end) end), 6) action_top1
from two_head"""))
def q_action_top1(spark, d):
    return EV.action_accuracy(_scored(spark, d))


@query("error_breakdown", oracle(["two_head"], """
with e as (select * from two_head where yv >= 0 and yn >= 0 and not (yv = pv and yn = pn)),
 c as (select count(*) errors, count(*) filter (where yv <> pv) verb_wrong, count(*) filter (where yn <> pn) noun_wrong,
        count(*) filter (where yv <> pv and yn <> pn) both_wrong from e)
select *, round(verb_wrong / nullif(errors, 0), 6) verb_wrong_share, round(noun_wrong / nullif(errors, 0), 6) noun_wrong_share,
  round(both_wrong / nullif(errors, 0), 6) both_wrong_share from c"""))
def q_error_breakdown(spark, d):
    return EV.error_breakdown(_scored(spark, d))


@query("distribution_compare", oracle(["two_head"], """
with a as (select label class_name, count(*) left_n from embeddings where vec_id % 5 <> 0 group by label),
 b as (select pv class_name, count(*) right_n from two_head group by pv)
select coalesce(a.class_name, b.class_name) class_name, coalesce(left_n, 0) left_n, coalesce(right_n, 0) right_n
from a full outer join b on a.class_name = b.class_name"""))
def q_distribution_compare(spark, d):
    train, _ = S.scored_split(spark, d)
    return PR.distribution_compare(train, "label", _scored(spark, d), "pv")


# ------------------------------------------- sketches, SQL functions

@query("sketched_classes", oracle(["clips"], """
with l as (select split, 'verb_class' col, cast(verb_class as varchar) class, clip_id from clips
           union all select split, 'noun_class', cast(noun_class as varchar), clip_id from clips union all select split, 'clip_id', cast(clip_id as varchar), clip_id from clips),
 n as (select col, class, count(*) n from l group by col, class),
 t as (select *, row_number() over (partition by col order by n desc, class) r from n)
select col "column", count(*) exact, true is_near, cast(max(case when r = 1 then n end) as bigint) most from t group by col"""))
def q_sketched_classes(spark, d):
    """Distinct and frequent classes from states stored per split and merged later; the estimate
    lies within four standard errors of the exact number."""
    c = S.clips(spark, d)
    cols = ("verb_class", "noun_class", "clip_id")
    path = scratch_path(spark, "class-sketches")
    PR.class_sketches(c, cols).write.parquet(path)
    merged = PR.merged_sketches(spark.read.parquet(path), 1)
    exact = c.select(*[F.count_distinct(x).alias(x) for x in cols]).unpivot([], list(cols), "column", "exact")
    near = F.abs(F.col("distinct") - F.col("exact")) <= F.col("exact") * (4 * 0.83 / 2 ** 6)
    # a state has room for all classes of a head; of the clips' ids each occurs once
    most = F.when(F.col("column") == "clip_id", F.lit(1)).otherwise(F.get("top", F.lit(0))["count"]).cast("long")
    return merged.join(F.broadcast(exact), "column").select("column", "exact", near.alias("is_near"), most.alias("most"))


def _sql(spark, d, text):
    from mise.plans.sql_functions import register_functions
    register_functions(spark)
    return spark.sql(text, clips=S.clips(spark, d), times=S.clip_times(spark, d), frames=S.frames(spark, d))


@query("sql_seconds_to_frames", ORACLES["seconds_to_frames"])
def q_sql_seconds_to_frames(spark, d):
    return _sql(spark, d, """select clip_id, seconds_to_frame(elapsed_seconds(start_timestamp), 60) start_frame,
      seconds_to_frame(elapsed_seconds(stop_timestamp), 60) stop_frame from {times}""")


@query("sql_frame_sample", ORACLES["frame_sample"])
def q_sql_frame_sample(spark, d):
    return _sql(spark, d, """with c as (select clip_id, sample_frames(start_frame, stop_frame, 3) numbers from {clips})
      select clip_id, s.i, s.frame_no from c lateral view posexplode(numbers) s as i, frame_no""")


@query("sql_frame_parse", ORACLES["frame_parse"])
def q_sql_frame_parse(spark, d):
    return _sql(spark, d, """with c as (select clip_id, video_id, sample_frames(start_frame, stop_frame, 3) numbers from {clips}),
      p as (select clip_id, s.i, case s.i when 0 then frame_path(video_id, s.n)
        when 1 then concat('frames/', video_id, '/frame_', s.n, '_x.png') else concat('frames/', video_id, '/thumb_', s.n, '.jpg') end path
      from c lateral view posexplode(numbers) s as i, n)
      select clip_id, i, frame_number(path) frame_no from p where frame_number(path) is not null""")


@query("sql_range_join", ORACLES["frame_range_join"])
def q_sql_range_join(spark, d):
    return _sql(spark, d, """with k as (select *, frame_buckets(start_frame, stop_frame, 64) buckets from {clips}),
      c as (select clip_id, video_id, start_frame, stop_frame, b.bucket from k lateral view explode(buckets) b as bucket)
      select clip_id, count(*) n_frames, sum(frame_no) sum_frame from c join {frames} f
      on c.video_id = f.video_id and c.bucket = floor(f.frame_no / 64) and f.frame_no between start_frame and stop_frame group by clip_id""")


# ----------------------------------------------------------------- features

def _object_visual(spark, d):
    """Clips with the noun one-hot (object stream, sparse) and the pooled visual
    vector (NULL when no frame was found)."""
    c = S.clips(spark, d)
    m = _noun_mapping(spark, d)
    width = m.count()
    o = FE.one_hot(c, m, "noun_class", out="obj", width=width)
    v = _pooled(spark, d, keep=()).select("clip_id", F.when(F.col("found") > 0, F.col("vec")).alias("visual"))
    return FE.align("clip_id", o, v), width


_POOL_N2 = "(select clip_id, sum(a * a) n2, sum(case when pos < (select count(*) from noun_map) then a * a else 0 end) nk from pool group by clip_id)"


@query("fuse_features", oracle(["clips", _NOUN_MAP, "pool"], f"""
select clips.clip_id, cast((select count(*) from noun_map) + 64 as int) width, coalesce(class_id, -1) hot,
  round(case when class_id is null then 0e0 else 1e0 end + coalesce(q.n2, 0), {R6}) n2
from clips left join noun_map m on cast(noun_class as string) = class_name
left join {_POOL_N2} q on clips.clip_id = q.clip_id"""))
def q_fuse_features(spark, d):
    t, k = _object_visual(spark, d)
    x = FE.assemble_vectors(t, "ov", {"o": "obj", "v": "visual"}, {"o": k, "v": 64}).select("clip_id", C.sparse("x").alias("x"))
    return x.select("clip_id", F.col("x.size").alias("width"), C.first_index("x", 0, k).alias("hot"),
                    F.round(C.sq_norm("x.values"), R6).alias("n2"))


@query("text_object_fusion", oracle(["clips", _NOUN_MAP], """
select clip_id, 384 + (select count(*) from noun_map) width, 'array<float>' kind, coalesce(class_id, -1) hot,
  case when narration is null then 0e0 else 1e0 end text_n2, case when class_id is null then 0e0 else 1e0 end object_n2
from clips left join noun_map m on cast(noun_class as string) = class_name"""))
def q_text_object_fusion(spark, d):
    """Text and object streams in their fixed order, as float32: the hashed
    narration (unit length, zeros without one), then the noun one-hot."""
    m = _noun_mapping(spark, d)
    k = m.count()
    t = FE.one_hot(FE.encode_text(S.clips(spark, d), "narration", "t", 384, as_vector=True), m, "noun_class", "o", width=k)
    x = FE.assemble_vectors(t, "ot", {"t": "t", "o": "o"}, {"t": 384, "o": k}).select("clip_id", C.sparse("x", "float").alias("x"))
    return x.select("clip_id", F.col("x.size").cast("long").alias("width"), F.typeof("x.values").alias("kind"),
                    C.first_index("x", 384, k).alias("hot"),
                    F.round(C.slice_sq_norm("x", 0, 384), 4).alias("text_n2"),
                    F.round(C.slice_sq_norm("x", 384, k), 4).alias("object_n2"))


@query("feature_fallback", oracle(["clips", _NOUN_MAP, "pool"], f"""
select clips.clip_id,
  case when narration is not null then 'primary' when q.clip_id is not null then 'secondary' else 'zeros' end source,
  round(case when narration is not null then (case when class_id is null then 0e0 else 1e0 end)
             else coalesce(q.nk, 0) end, {R6}) n2
from clips left join noun_map m on cast(noun_class as string) = class_name
left join {_POOL_N2} q on clips.clip_id = q.clip_id"""))
def q_feature_fallback(spark, d):
    """Primary stream (object one-hot) where the clip has narration, else
    the visual vector fitted to the object width, else zeros."""
    t, k = _object_visual(spark, d)
    primary = F.when(F.col("narration").isNotNull(), F.col("obj"))
    t = t.withColumn("x", FE.fallback_vectors(primary, "visual", k))
    source = (F.when(F.col("narration").isNotNull(), F.lit("primary"))
              .when(F.col("visual").isNotNull(), F.lit("secondary")).otherwise(F.lit("zeros")))
    return t.select("clip_id", source.alias("source"), F.round(C.sq_norm(F.unwrap_udt("x")["values"]), R6).alias("n2"))


@query("align_modalities", oracle(["clips", _NOUN_MAP, "clip_frame", "frames"], """
with f as (select clip_id, count(frames.frame_no) found from clip_frame c
           left join frames on c.video_id = frames.video_id and c.fno = frames.frame_no group by clip_id)
select clips.clip_id, video_id, found, coalesce(class_id, -1) y
from clips join f on clips.clip_id = f.clip_id
left join noun_map m on cast(noun_class as string) = class_name"""))
def q_align_modalities(spark, d):
    c = S.clips(spark, d)
    meta = c.select("clip_id", "video_id")
    vis = _pooled(spark, d, keep=()).select("clip_id", "found")
    lab = LB.encode_labels(c, _noun_mapping(spark, d), "noun_class", out="y").select("clip_id", "y")
    return FE.align("clip_id", meta, vis, lab)


@query("bucketed_align", ORACLES["align_modalities"])
def q_bucketed_align(spark, d):
    """Three modalities stored in buckets of the clip id and aligned without a shuffle."""
    c = S.clips(spark, d)
    tables = {"meta": c.select("clip_id", "video_id"), "visual": _pooled(spark, d, keep=()).select("clip_id", "found"),
              "label": LB.encode_labels(c, _noun_mapping(spark, d), "noun_class", out="y").select("clip_id", "y")}
    stored = [SF.write_bucketed(t, f"mise_{n}_features", scratch_path(spark, f"bucketed-{n}")) for n, t in tables.items()]
    return FE.align("clip_id", *stored)


@query("text_features", """
select doc_id, cast(len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+')) as int) tokens,
  case when len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+')) > 0 then 1e0 else 0e0 end n2
from documents""")
def q_text_features(spark, d):
    """Built-in text encoder over whole documents: token count and the norm
    of the hashed, normalised term vector."""
    docs = read_table(spark, d, "documents").select("doc_id", "text")
    enc = FE.encode_text(docs, "text", out="tv", dim=384)
    return enc.select("doc_id", F.col("tv_tokens").alias("tokens"), F.round(C.sq_norm("tv"), R6).alias("n2"))


# ----------------------------------------------- ablation, best, gain

_MODES = (("a", 0, 31), ("b", 32, 63), ("ab", 0, 63))
METRICS = ["verb_top1", "verb_top5", "verb_f1", "noun_top1", "noun_top5", "noun_f1", "action_top1"]

_ABL = """
with m(mode, lo, hi) as (values ('a', 0, 31), ('b', 32, 63), ('ab', 0, 63)),
 el as (select mode, vec_id, label, pos, v from vec_el join m on pos between lo and hi),
 cv as (select mode, label cls, pos, avg(cast(v as double)) c from el where vec_id % 5 <> 0 and label <> 9 group by mode, label, pos),
 cn as (select mode, label % 3 cls, pos, avg(cast(v as double)) c from el where vec_id % 5 <> 0 group by mode, label % 3, pos),
 zv as (select el.mode, vec_id, case when label = 9 then -1 else label end y, cls, sum(cast(v as double) * c) z
        from el join cv on el.mode = cv.mode and el.pos = cv.pos where vec_id % 5 = 0 group by el.mode, vec_id, label, cls),
 zn as (select el.mode, vec_id, label % 3 y, cls, sum(cast(v as double) * c) z
        from el join cn on el.mode = cn.mode and el.pos = cn.pos where vec_id % 5 = 0 group by el.mode, vec_id, label % 3, cls),
 rv as (select mode, vec_id, y, cls, row_number() over (partition by mode, vec_id order by z desc, cls) r from zv),
 rn as (select mode, vec_id, y, cls, row_number() over (partition by mode, vec_id order by z desc, cls) r from zn),
 tv as (select mode, vec_id, y, max(case when cls = y and r = 1 then 1e0 else 0e0 end) t1,
               max(case when cls = y and r <= 5 then 1e0 else 0e0 end) t5 from rv group by mode, vec_id, y),
 tn as (select mode, vec_id, y, max(case when cls = y and r = 1 then 1e0 else 0e0 end) t1,
               max(case when cls = y and r <= 5 then 1e0 else 0e0 end) t5 from rn group by mode, vec_id, y),
 accv as (select mode, count(*) filter (where y >= 0) verb_n, round(avg(t1) filter (where y >= 0), 6) verb_top1,
                 round(avg(t5) filter (where y >= 0), 6) verb_top5 from tv group by mode),
 accn as (select mode, count(*) filter (where y >= 0) noun_n, round(avg(t1) filter (where y >= 0), 6) noun_top1,
                 round(avg(t5) filter (where y >= 0), 6) noun_top5 from tn group by mode),
 pv as (select mode, vec_id, y, cls p from rv where r = 1),
 pn as (select mode, vec_id, y, cls p from rn where r = 1),
 act as (select pv.mode, count(*) filter (where pv.y >= 0 and pn.y >= 0) action_n,
                round(avg(case when pv.y >= 0 and pn.y >= 0 then (case when pv.y = pv.p and pn.y = pn.p then 1e0 else 0e0 end) end), 6) action_top1
         from pv join pn on pv.mode = pn.mode and pv.vec_id = pn.vec_id group by pv.mode),
 uv as (select mode, y c, 1 sup, 0 pr, case when y = p then 1 else 0 end tp from pv where y >= 0
        union all select mode, p, 0, 1, 0 from pv where y >= 0),
 un as (select mode, y c, 1 sup, 0 pr, case when y = p then 1 else 0 end tp from pn where y >= 0
        union all select mode, p, 0, 1, 0 from pn where y >= 0),
 fv as (select mode, round(avg(2e0 * tp / (sup + pr)), 6) verb_f1 from
        (select mode, c, sum(sup) sup, sum(pr) pr, sum(tp) tp from uv group by mode, c) t group by mode),
 fn as (select mode, round(avg(2e0 * tp / (sup + pr)), 6) noun_f1 from
        (select mode, c, sum(sup) sup, sum(pr) pr, sum(tp) tp from un group by mode, c) t group by mode),
 abl as (select * from accv join accn using (mode) join act using (mode) join fv using (mode) join fn using (mode))
"""

_ABL_LONG = " union all ".join(
    f"select mode, '{m}' metric, cast({m} as double) value from abl" for m in METRICS)


def _ablation(spark, d):
    """Every mode (feature slice) in one plan: rows tagged with their mode,
    centroids of all modes from one grouped aggregate per head, scoring by
    the row's mode, metrics in one grouped pass."""
    from mise.model.linear import fit_centroids_grouped, score_grouped
    train, test = S.scored_split(spark, d)

    def tagged(df):
        modes = F.array(*[F.struct(F.lit(mode).alias("mode"), F.slice("embedding", lo + 1, hi - lo + 1).alias("x")) for mode, lo, hi in _MODES])
        return df.select(F.explode(modes).alias("m"), *[c for c in df.columns if c != "embedding"]).select("m.*", *[c for c in df.columns if c != "embedding"])
    tr, te = tagged(train), tagged(test)
    mv = fit_centroids_grouped(tr.filter(F.col("label") != 9), "x", "label", "mode")
    mn = fit_centroids_grouped(tr, "x", "yn", "mode")
    scored = score_grouped(score_grouped(te, "x", mv, "mode", "zv"), "x", mn, "mode", "zn")
    return EV.evaluate_heads(scored.select("mode", "vec_id", "yv", "yn", "zv", "zn"), by=("mode",))


@query("ablation_table", oracle(["vec_el"], _ABL + "select * from abl"))
def q_ablation_table(spark, d):
    return _ablation(spark, d)


@query("best_flags", oracle(["vec_el"], _ABL + f", l as ({_ABL_LONG})\n"
                             "select mode, metric, value, value = max(value) over (partition by metric) is_best from l"))
def q_best_flags(spark, d):
    return RP.flag_best(_ablation(spark, d), METRICS)


@query("metrics_display", oracle(["vec_el"], _ABL + "select mode, verb_n, noun_n, action_n, "
                                  + ", ".join(f"round({m}, 3) {m}" for m in METRICS) + " from abl"))
def q_metrics_display(spark, d):
    """The ablation's metrics saved as JSON lines, loaded and rounded for display."""
    path = scratch_path(spark, "metrics")
    SF.write_metrics(_ablation(spark, d), path)
    return RP.round_metrics(SF.read_metrics(spark, path), METRICS, 3)


@query("metric_gain", oracle(["vec_el"], _ABL + f", l as ({_ABL_LONG})\n" + """
select l.mode, l.metric, l.value, b.value base_value, round(l.value - b.value, 6) abs_gain,
  round(l.value / nullif(b.value, 0) - 1, 6) rel_gain
from l join (select metric, value from l where mode = 'a') b on l.metric = b.metric"""))
def q_metric_gain(spark, d):
    return RP.metric_gain(_ablation(spark, d), METRICS, base="a")


# -------------------------------------------------------------- predictions

_PREDICTIONS = oracle(["clips", "verb_map"], """
with tr as (select noun_class, m.class_id yv from clips join verb_map m on cast(verb_class as string) = m.class_name
            where split = 'train'),
 cnt as (select noun_class, yv, count(*) n from tr group by noun_class, yv),
 best as (select noun_class, yv from (select *, row_number() over (partition by noun_class order by n desc, yv) r from cnt) t where r = 1),
 vref as (select cast(verb_class as string) class_name, max_by(verb, clip_id) text from clips where split = 'train' group by verb_class),
 nref as (select cast(noun_class as string) class_name, max_by(noun, clip_id) text from clips where split = 'train' group by noun_class),
 p as (select clip_id, video_id, start_frame, stop_frame, best.yv pred_verb_class, clips.noun_class pred_noun_class
       from clips left join best on clips.noun_class = best.noun_class where split = 'val'),
 named as (select p.*, coalesce(vref.text, vm.class_name, cast(pred_verb_class as varchar)) pred_verb,
                  coalesce(nref.text, cast(pred_noun_class as varchar)) pred_noun
           from p left join verb_map vm on pred_verb_class = vm.class_id
           left join vref on vm.class_name = vref.class_name
           left join nref on cast(pred_noun_class as varchar) = nref.class_name)
select *, pred_verb || ' ' || pred_noun pred_action from named""")


@query("prediction_table", _PREDICTIONS)
def q_prediction_table(spark, d):
    """Object-only baseline: the most frequent (encoded) verb of the clip's
    noun class in training; noun = the object class.  Decoded to text
    through the mapping and the last-row-wins text reference."""
    from mise.model.predict import decode_predictions, fit_majority, to_predictions
    c = S.clips(spark, d)
    train = c.filter(F.col("split") == "train")
    vmap = _verb_mapping(spark, d)
    enc = LB.encode_labels(train, vmap, "verb_class", out="yv")
    model = fit_majority(enc, "noun_class", "yv", out="pred_verb_class")
    # a row per noun class of the training set, its size checked; no clip is shuffled by its class
    val = c.filter(F.col("split") == "val").join(LB.sized(cut_lineage(model)), "noun_class", "left").withColumn(
        "pred_noun_class", F.col("noun_class"))
    vref = LB.text_reference(train, "verb_class", "verb", "clip_id")
    nref = LB.text_reference(train, "noun_class", "noun", "clip_id")
    # the noun prediction is a raw class: an identity mapping over the reference's classes
    nmap = nref.select("class_name", F.col("class_name").cast("long").alias("class_id"))
    named = decode_predictions(val, vmap, vref, nmap, nref)
    return to_predictions(named, ["clip_id", "video_id", "start_frame", "stop_frame"])


@query("prediction_sink", _PREDICTIONS)
def q_prediction_sink(spark, d):
    """The prediction table written and read again."""
    path = scratch_path(spark, "predictions")
    SF.write_predictions(q_prediction_table(spark, d), path)
    return spark.read.parquet(path)


#: The stand-in's frames are noise, so the classes are planted in a clip's visual vector, where it has one:
#: a step at the verb's place and a chirp of the noun's own.
_STEP, _WAVE = 6.0, 1.5


def _with_signal(df, nouns):
    """``nouns``: the clips' ``noun_class`` values; a noun's chirp is worked out once, not for each of its clips."""
    place = F.when(F.col("verb_class") < 59, F.col("verb_class")).otherwise(59 + F.col("verb_class") % 5).cast("int")
    wave = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: _WAVE * F.cos((F.col("_noun") + 1) * (i + 1).cast("double") * (i + 1)))
    waves = LB.sized(cut_lineage(nouns.select(F.col("noun_class").alias("_noun")).distinct().withColumn("_wave", wave)), limit=50_000)
    stepped = F.concat(F.slice("vec", 1, place), F.array(F.get("vec", place) + _STEP), F.slice("vec", place + 2, F.size("vec")))
    stepped = F.when(place.between(0, F.size("vec") - 1), stepped).otherwise(F.col("vec"))
    planted = F.zip_with(stepped, "_wave", lambda x, w: x + w)
    df = df.join(waves, F.col("noun_class").eqNullSafe(F.col("_noun")), "left")
    return df.withColumn("vec", F.when(F.col("found") > 0, planted).otherwise(F.col("vec"))).drop("_noun", "_wave")


def _trained_inputs(spark, d):
    """Per clip the three streams and the encoded labels, written once as Parquet by
    split, with the fitted mappings: text = hashed narration (sparse), object =
    noun one-hot (sparse), visual = pooled frame vectors with a planted signal (zeros without a frame).
    ``clear`` marks clips whose classes a right model must find from the object or the
    visual stream alone."""
    from pyspark.ml.functions import array_to_vector
    c = S.clips(spark, d)
    train = c.filter(F.col("split") == "train")
    vmap, nmap = _verb_mapping(spark, d), LB.fit_mapping(train, "noun_class")
    feats = FE.one_hot(FE.encode_text(c, "narration", "t", 384, as_vector=True), nmap, "noun_class", "o")
    feats = LB.encode_labels(LB.encode_labels(feats, vmap, "verb_class", "yv"), nmap, "noun_class", "yn")
    clear = LB.sized(cut_lineage(_clear_nouns(feats.filter("split = 'train' and clip_id is not null")))).withColumn("one", F.lit(True))
    # aligned before a vector is there: none is shuffled
    lab = _pooled(spark, d, keep=(), meet=lambda rows: FE.align("clip_id", feats, rows))
    lab = _with_signal(lab, c).join(clear, "yn", "left")
    found = F.coalesce("one", F.lit(False)) & (F.col("found") > 0) & (F.col("verb_class") < 59) & C.known("yv") & C.known("yn")
    path = scratch_path(spark, "trained-inputs")
    (lab.select("clip_id", "video_id", "start_frame", "stop_frame", "split", "yv", "yn", "t", "o", "vec",
                found.alias("clear"))
     .write.partitionBy("split").parquet(path))
    # the vector form is made where it is read: written, it would be the same numbers twice
    return spark.read.parquet(path).withColumn("v", array_to_vector("vec")), vmap, nmap, {"verb": vmap.count(), "noun": nmap.count()}


#: A noun is clear where its likeliest verb leads the next by this factor.
_LEAD = 1.5


def _clear_nouns(train):
    """Nouns whose verb a class-weighted model of the noun alone must predict.  Such a model
    has a parameter for every (noun, verb), so its optimum is known: a verb's odds are its clips with
    the noun over all its clips."""
    pairs = train.groupBy("yn", "yv").agg(F.count(F.lit(1)).alias("n"))
    total = train.groupBy("yv").agg(F.count(F.lit(1)).alias("of"))
    odds = pairs.join(total, "yv").groupBy("yn").agg(F.array_sort(F.collect_list(F.col("n") / F.col("of"))).alias("odds"))
    return odds.filter((F.size("odds") == 1) | (F.element_at("odds", -1) >= _LEAD * F.try_element_at("odds", F.lit(-2)))).select("yn")


_CLEAR = f"""
tr as (select verb_class v, noun_class n from clips where split = 'train'),
 odds as (select n, v, count(*) / max(total)::double o from tr join (select v, count(*) total from tr group by v) using (v) group by n, v),
 lead as (select n, v, row_number() over w r, coalesce(lead(o) over w, 0) nxt, o from odds window w as (partition by n order by o desc, v)),
 best as (select n, v from lead where r = 1 and o >= {_LEAD} * nxt),
 seen as (select clip_id from clip_frame c join frames f on c.video_id = f.video_id and c.fno = f.frame_no group by clip_id),
 val as (select clips.*, seen.clip_id is not null has_visual, verb_class in (select v from tr) known_v, noun_class in (select n from tr) known_n,
                best.v best_verb from clips left join seen on clips.clip_id = seen.clip_id left join best on noun_class = best.n
         where split = 'val'),
 clear as (select * from val where best_verb is not null and has_visual and verb_class < 59 and known_v and known_n)
"""


@query("blind_predictions", oracle(["clips", "clip_frame", "frames", "verb_map", "noun_map"], "with " + _CLEAR.strip() + """
select clip_id, video_id, start_frame, stop_frame, v.class_id pred_verb_class, m.class_id pred_noun_class, vt.text pred_verb, nt.text pred_noun,
  vt.text || ' ' || nt.text pred_action
from clear join verb_map v on cast(verb_class as string) = v.class_name join noun_map m on cast(noun_class as string) = m.class_name
join (select verb_class c, max_by(verb, clip_id) text from clips where split = 'train' group by verb_class) vt on vt.c = verb_class
join (select noun_class c, max_by(noun, clip_id) text from clips where split = 'train' group by noun_class) nt on nt.c = noun_class"""))
def q_blind_predictions(spark, d):
    """The blind predictions of the clips whose classes the visual stream tells: the planted ones must be found."""
    named, data = blind_table(spark, d)
    return named.join(data.filter("split = 'val' and clear").select("clip_id"), "clip_id", "left_semi")


def blind_table(spark, d):
    """Visual-only two-head model trained on the training clips that have a
    real visual vector (weights recomputed on that subset, class space of
    the full training set), applied to validation clips that carry neither labels nor
    narration (the columns aren't there), decoded to a prediction table.  With the inputs."""
    from mise.model.predict import decode_predictions, to_predictions
    from mise.model.two_head import fit_two_head
    data, vmap, nmap, spaces = _trained_inputs(spark, d)
    model = fit_two_head(data.filter(F.col("split") == "train"), "vec", {"verb": "yv", "noun": "yn"}, n_classes=spaces,
                         require=C.has_modality("vec"))
    blind = data.filter(F.col("split") == "val").select("clip_id", "video_id", "start_frame", "stop_frame", "vec")
    val = model.transform(blind, {"verb": "zv", "noun": "zn"})
    pred = val.select("clip_id", "video_id", "start_frame", "stop_frame",
                      C.argmax("zv").cast("long").alias("pred_verb_class"),
                      C.argmax("zn").cast("long").alias("pred_noun_class"))
    train_rows = S.clips(spark, d).filter(F.col("split") == "train")
    vref = LB.text_reference(train_rows, "verb_class", "verb", "clip_id")
    nref = LB.text_reference(train_rows, "noun_class", "noun", "clip_id")
    return to_predictions(decode_predictions(pred, vmap, vref, nmap, nref),
                          ["clip_id", "video_id", "start_frame", "stop_frame"]), data


@query("fusion_ablation", oracle(["clips", "clip_frame", "frames"], "with " + _CLEAR.strip() + """,
 mv as (select v from tr group by v order by count(*) desc, cast(v as varchar) limit 1),
 mn as (select n from tr group by n order by count(*) desc, cast(n as varchar) limit 1),
 s as (select count(*) filter (known_v) verb_n, count(*) filter (known_n) noun_n, count(*) filter (known_v and known_n) action_n,
  round(avg(case when verb_class = (select v from mv) then 1e0 else 0e0 end) filter (known_v), 6) verb_majority,
  round(avg(case when noun_class = (select n from mn) then 1e0 else 0e0 end) filter (known_n), 6) noun_majority from val),
 pred as (select 'o' mode, verb_class y, best_verb p from clear union all select 'v', verb_class, verb_class from clear),
 f1 as (select mode, avg(2e0 * tp / (sup + pr)) f from (select mode, c, sum(sup) sup, sum(pr) pr, sum(tp) tp from
   (select mode, y c, 1 sup, 0 pr, case when y = p then 1 else 0 end tp from pred union all select mode, p, 0, 1, 0 from pred) group by mode, c) group by mode),
 nouns as (select mode, count(*) clear_n, avg(case when y = p then 1e0 else 0e0 end) top1 from pred group by mode)
select m.mode, verb_n, noun_n, action_n, verb_majority, noun_majority, verb_beats, noun_beats, cast(clear_n as double) clear_n,
  round(top1, 6) verb_top1, round(f, 6) verb_f1, case when clear_n > 0 then 1e0 end noun_top1, case when clear_n > 0 then 1e0 end noun_top5,
  case when clear_n > 0 then 1e0 end noun_f1, round(top1, 6) action_top1
from s, (values ('t', true, true), ('o', null, true), ('to', true, true), ('v', true, true)) m(mode, verb_beats, noun_beats)
left join nouns on nouns.mode = m.mode left join f1 on f1.mode = m.mode"""))
def q_fusion_ablation(spark, d):
    """The trained ablation as far as SQL can state it: per mode the heads' denominators and that a head
    beats the commonest class where its mode has seen what tells the class; and of the object
    and the video model all metrics on the clips whose predictions have a known optimum
    (the noun's likeliest verb; the planted classes), which a wrong model misses."""
    inputs = _trained_inputs(spark, d)
    data = inputs[0]
    scored = trained_scores(inputs)
    table = EV.evaluate_heads(scored, by=("mode",))
    rates = data.filter("split = 'train'")
    majority = {}
    for head, y in (("verb", "yv"), ("noun", "yn")):
        top = rates.groupBy(y).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), y).limit(1).select(y).scalar()
        majority[head] = (data.filter((F.col("split") == "val") & C.known(y))
                          .agg(F.round(F.avg((F.col(y) == top).cast("double")), R6)).scalar())
    seen = {"verb": F.col("mode").isin("t", "to", "v"), "noun": F.lit(True)}
    told = ["verb_top1", "verb_f1", "noun_top1", "noun_top5", "noun_f1", "action_top1"]
    clear = EV.evaluate_heads(scored.filter(F.col("clear") & F.col("mode").isin("o", "v")), by=("mode",))
    clear = clear.select("mode", F.col("action_n").cast("double").alias("clear_n"), *told)
    return (table.withColumns({f"{h}_majority": m for h, m in majority.items()})
            .select("mode", "verb_n", "noun_n", "action_n", "verb_majority", "noun_majority",
                    *[F.when(seen[h], F.col(f"{h}_top1") > F.col(f"{h}_majority")).alias(f"{h}_beats") for h in majority])
            .join(clear, "mode", "left"))


def trained_ablation(inputs) -> DataFrame:
    """The trained ablation's metrics, one row per mode, evaluated on the validation clips in one grouped pass."""
    return EV.evaluate_heads(trained_scores(inputs), by=("mode",))


def trained_scores(inputs) -> DataFrame:
    """Scored validation clips per mode (text, object, text+object, video): a
    class-weighted two-head model on the training clips, fitted to its
    tolerance.  The
    video mode trains only on clips with a real visual vector.  A mode's
    features are its streams in the fixed order text, object, visual."""
    from functools import reduce

    from pyspark.ml.feature import VectorAssembler

    from mise.model.two_head import fit_two_head
    data, _, _, spaces = inputs

    def run(mode):
        dm = VectorAssembler(inputCols=FE.mode_streams(mode), outputCol="x").transform(data)
        model = fit_two_head(dm.filter(F.col("split") == "train"), "x", {"verb": "yv", "noun": "yn"},
                             n_classes=spaces, require=C.has_modality("vec") if mode == "v" else None)
        scored = model.transform(dm.filter(F.col("split") == "val"), {"verb": "zv", "noun": "zn"})
        return scored.select(F.lit(mode).alias("mode"), "clip_id", "yv", "yn", "zv", "zn", "clear")

    # the modes' models are independent: fit them concurrently (jobs from a thread pool)
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=4) as pool:
        return reduce(DataFrame.unionByName, list(pool.map(run, ("t", "o", "to", "v"))))


@query("saved_model", oracle(["clips"], "select clip_id, true same_verb, true same_noun from clips where split = 'val'"))
def q_saved_model(spark, d):
    """An object model saved and loaded again: every validation clip gets the same logits."""
    from mise.model.two_head import TwoHeadModel, fit_two_head
    c = S.clips(spark, d)
    train = c.filter(F.col("split") == "train")
    vmap, nmap = _verb_mapping(spark, d), _noun_mapping(spark, d)
    t = FE.one_hot(LB.encode_labels(LB.encode_labels(c, vmap, "verb_class", "yv"), nmap, "noun_class", "yn"), nmap, "noun_class", "o")
    model = fit_two_head(t.filter(F.col("split") == "train"), "o", {"verb": "yv", "noun": "yn"}, max_iter=5)
    path = scratch_path(spark, "two-head-model")
    model.save(path)
    both = TwoHeadModel.load(path).transform(model.transform(t.filter(F.col("split") == "val"), {"verb": "v1", "noun": "n1"}), {"verb": "v2", "noun": "n2"})
    return both.select("clip_id", (F.col("v1") == F.col("v2")).alias("same_verb"), (F.col("n1") == F.col("n2")).alias("same_noun"))


@query("training_curve", oracle(["clips"], """
select 'verb' head, round(ln(count(distinct verb_class)), 6) first_loss, true falls, true ends_lowest from clips where split = 'train'
union all select 'noun', round(ln(count(distinct noun_class)), 6), true, true from clips where split = 'train'"""))
def q_training_curve(spark, d):
    """The loss curve of a trained text model: it starts at the log of the number of classes (all
    classes weigh alike before the first step), falls, and ends lowest."""
    from mise.model.two_head import fit_two_head
    c = S.clips(spark, d).filter(F.col("split") == "train")
    c = FE.encode_text(c, "narration", "t", 384, as_vector=True)
    c = LB.encode_labels(c, _verb_mapping(spark, d), "verb_class", "yv")
    c = LB.encode_labels(c, _noun_mapping(spark, d), "noun_class", "yn")
    curve = fit_two_head(c, "t", {"verb": "yv", "noun": "yn"}).training_curve(spark)
    return curve.groupBy("head").agg(F.round(F.min_by("loss", "step"), R6).alias("first_loss"),
                                     (F.max_by("loss", "step") < F.min_by("loss", "step")).alias("falls"),
                                     (F.max_by("loss", "step") <= F.min("loss") + 1e-9).alias("ends_lowest"))

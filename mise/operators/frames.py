"""Clip ↔ frame operators: sampling, needed-frame sets, the frame join,
mean pooling, missing counts and the frame-range join.

Frame tables are keyed by ``(video_id, frame_no)``; ``keys`` names the
columns besides ``frame_no`` that identify a frame (``()`` when every clip
shares one frame set).  The join key is always fine-grained (a frame, never a
whole video), so a video holding a third of all clips still spreads over all
tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mise.functions.columns import sample_frames, zero_vector
from mise.schema import FRAMES_PER_CLIP
from mise.session import cut_lineage

#: Frame numbers that one bitmap holds (4 KB), and the bitmaps that are broadcast at most (64 MB).
BITMAP_FRAMES = 32_768
BROADCAST_BITMAPS = 16_384
#: Bytes of frame vectors that are broadcast at most.
BROADCAST_VECTORS = 64 << 20
#: Bytes of pooled vectors that one task makes, so that a sort of them (for a sink, say) stays in memory.
POOLED_BYTES = 64 << 20
#: Clips of one place that are looked up together.
PLACE_CLIPS = 50_000
#: Frame numbers of one block of a place: as many as a long has bits.
PLACE_FRAMES = 64
#: Frame numbers of one block of running sums.
SCAN_BLOCK = 1_024


def explode_samples(clips: DataFrame, n: int = FRAMES_PER_CLIP, key: str = "clip_id",
                    keys=("video_id",), start: str = "start_frame", stop: str = "stop_frame",
                    keep=()) -> DataFrame:
    """One row per sampled frame: ``(key, *keys, *keep, i, frame_no)``."""
    return clips.select(key, *keys, *keep,
                        F.posexplode(sample_frames(start, stop, n)).alias("i", "frame_no"))


def needed_frames(clips: DataFrame, n: int = FRAMES_PER_CLIP, keys=("video_id",), **kw) -> DataFrame:
    """Distinct frames any clip samples.  Clips overlap, so this dedupes the
    work of any per-frame step (decode, encode) before it runs."""
    samples = explode_samples(clips, n=n, keys=keys, **kw)
    return samples.select(*keys, "frame_no").distinct()


def needed_bitmaps(samples: DataFrame, keys=("video_id",)) -> DataFrame:
    """The sampled frames as bitmaps: ``(*keys, bucket, bitmap)``, one of 4 KB for each
    32,768 frame numbers of a video that any clip samples from.  Tasks combine their own bits
    first, so a frame that many clips sample costs no more than one."""
    return (samples.groupBy(*keys, F.floor(F.col("frame_no") / BITMAP_FRAMES).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.pmod(F.col("frame_no"), F.lit(BITMAP_FRAMES)).cast("long")).alias("bitmap")))


def in_bitmap(bitmap: str, position: Column) -> Column:
    """Whether the bit at a position is set."""
    byte = F.conv(F.hex(F.substring(F.col(bitmap), (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.get(F.array(*[byte.bitwiseAND(F.lit(1 << i)) != 0 for i in range(8)]), (position % 8).cast("int"))


def prune_frames(frames: DataFrame, samples: DataFrame, keys=("video_id",), limit: int = BROADCAST_BITMAPS) -> DataFrame:
    """Frames that some clip samples.  The needed set goes to the frames as bitmaps of checked
    number, so vectors that nobody needs are dropped where they are read and never enter a
    shuffle; with more bitmaps than ``limit`` it is a semi join on the frame key."""
    bitmaps = cut_lineage(needed_bitmaps(samples, keys))
    if bitmaps.count() > limit:
        return frames.join(samples.select(*keys, "frame_no"), [*keys, "frame_no"], "left_semi")
    own = frames.withColumn("bucket", F.floor(F.col("frame_no") / BITMAP_FRAMES))
    position = F.pmod(F.col("frame_no"), F.lit(BITMAP_FRAMES))
    return own.join(F.broadcast(bitmaps), [*keys, "bucket"]).filter(in_bitmap("bitmap", position)).select(*frames.columns)


def join_frames(samples: DataFrame, frames: DataFrame, vec: str = "embedding", keys=("video_id",),
                pruned: bool = False) -> DataFrame:
    """Left join of sampled frames to frame vectors on ``(*keys, frame_no)``;
    a frame that is not there leaves ``vec`` NULL and ``hit`` NULL, and a frame
    that is there twice is one frame.  Frames that nobody samples are left out
    before anything is shuffled (``pruned=True``: the caller has done so).  The
    strategy (broadcast or shuffle) is left to the planner and AQE, which
    measure the frame side at run time."""
    if not pruned:
        frames = prune_frames(frames, samples, keys)
    return samples.join(_listed_once(frames, vec, keys).withColumn("hit", F.lit(True)), [*keys, "frame_no"], "left")


def _listed_once(frames: DataFrame, vec: str, keys) -> DataFrame:
    """A frame listed twice counts once (the smallest vector, whichever file it came from)."""
    return frames.groupBy(*keys, "frame_no").agg(F.min(F.col(vec)).alias(vec))


def pool_samples(clips: DataFrame, frames: DataFrame, dim: int, n: int = FRAMES_PER_CLIP, key: str = "clip_id", vec: str = "embedding",
                 keys=("video_id",), keep=(), dtype: str = "float", limit: int = BROADCAST_VECTORS, meet=None) -> DataFrame:
    """What ``explode_samples``, ``join_frames`` and ``pool_frames`` give together.

    A clip's rows meet first, by its key and frame numbers alone; its vectors are looked up and added up where it
    is, so no clip's vector is shuffled or spilled.  Where the sampled frames' vectors have at most ``limit`` bytes
    (measured), they go to the clips; larger frame sets meet the clips by places (``_by_place``).  A key on several rows
    takes the join on the frame key.  ``meet`` joins the clips' rows with what else is known of a clip, by its key, before
    any vector is there; its columns come first."""
    frames = prune_frames(frames, explode_samples(clips, n=n, key=key, keys=keys, keep=keep), keys)
    small, right = _vector_bytes(frames, vec) <= limit, _listed_once(frames, vec, keys)
    right = F.broadcast(right) if small else right
    parts = max(clips.sparkSession.sparkContext.defaultParallelism, clips.count() * (8 * dim + 64) // POOLED_BYTES)
    met = (clips.select(key, *keep, F.struct(*keys, sample_frames("start_frame", "stop_frame", n).alias("_at")).alias("_row"))
           .repartition(parts, key).groupBy(key, *keep).agg(F.collect_list("_row").alias("_rows")))
    own, at = [f"_key_{k}" for k in keys], [f"_at{i}" for i in range(n)]
    one = met.filter(F.size("_rows") == 1).select(key, *keep, F.col("_rows")[0].alias("_row"))
    one = one.select(key, *keep, *[F.col("_row")[k].alias(o) for k, o in zip(keys, own)], *[F.col("_row._at")[i].alias(a) for i, a in enumerate(at)])
    more = (met.filter(F.size("_rows") > 1).select(key, *keep, F.explode("_rows").alias("_row"))
            .select(key, *keep, *[F.col("_row")[k].alias(k) for k in keys], F.explode("_row._at").alias("frame_no")))
    more = pool_frames(more.join(right, [*keys, "frame_no"], "left"), dim, key, vec, keep, dtype)
    more = more.select(key, *keep, F.struct("found", "sampled", "vec").alias("_pooled"))
    rows = one.unionByName(more, allowMissingColumns=True)
    rows = meet(rows) if meet else rows
    carried = [c for c in rows.columns if c not in {*own, *at, "_pooled"}]
    if small:
        for i, a in enumerate(at):
            there = right.select(*[F.col(k).alias(o) for k, o in zip(keys, own)], F.col("frame_no").alias(a), F.col(vec).alias(f"_v{i}"))
            rows = rows.join(there, [*own, a], "left")
        found = [F.col(f"_v{i}") for i in range(n)]
    else:
        rows = _by_place(rows, one, right, key, vec, keys, own, at, parts)
        found = [F.get("_vecs", (F.array_position("_nos", F.col(a)) - 1).cast("int")) for a in at]
    # the array is a step of its own: a place's vectors must not be copied for every clip
    rows = rows.select(*carried, "_pooled", F.array(*found).alias("_raw"))
    rows = rows.select(*carried, "_pooled", F.filter("_raw", lambda x: x.isNotNull()).alias("_vs"),
                       sum((F.get("_raw", F.lit(i)).isNotNull().cast("long") for i in range(n)), F.lit(0).cast("long")).alias("found"))
    return rows.select(*carried, F.coalesce("_pooled.found", "found").alias("found"), F.coalesce("_pooled.sampled", F.lit(n).cast("long")).alias("sampled"),
                       F.coalesce("_pooled.vec", _mean_of(dim, dtype)).alias("vec"))


def _by_place(rows: DataFrame, one: DataFrame, frames: DataFrame, key: str, vec: str, keys, own, at, parts: int) -> DataFrame:
    """The rows, each with the frames (``_nos``, ``_vecs``) that the clips of its place sample.

    Clips whose samples are in the same blocks of ``PLACE_FRAMES`` frame numbers are at one place, which
    so has at most that many frames a sample, whatever the clips.  A frame goes once to each place where it is sampled, not
    to each clip; a place with more than ``PLACE_CLIPS`` clips is several."""
    def placed(df):
        return df.withColumns({f"_b{i}": F.coalesce(F.floor(F.col(a) / PLACE_FRAMES), F.lit(0)) for i, a in enumerate(at)})

    blocks = [f"_b{i}" for i in range(len(at))]
    place = [*own, *blocks]
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.col(a), F.lit(PLACE_FRAMES)).cast("int")) for a in at]
    sampled = placed(one).groupBy(*place).agg(F.count(F.lit(1)).alias("_n"), *[F.bit_or(b).alias(f"_m{i}") for i, b in enumerate(bits)])
    sampled = sampled.withColumn("_salts", F.ceil(F.col("_n") / PLACE_CLIPS))
    offsets = F.sequence(F.lit(0), F.lit(PLACE_FRAMES - 1))

    def numbers(mask, block):
        return F.transform(F.filter(offsets, lambda x: F.getbit(F.coalesce(F.col(mask), F.lit(0).cast("long")), x) == 1),
                           lambda x: F.col(block) * PLACE_FRAMES + x)

    needed = F.array_distinct(F.concat(*[numbers(f"_m{i}", b) for i, b in enumerate(blocks)]))
    held = sampled.select(*[F.col(o).alias(k) for k, o in zip(keys, own)], *blocks, "_salts", F.explode(needed).alias("frame_no"))
    held = held.join(frames, [*keys, "frame_no"]).select(
        *[F.col(k).alias(o) for k, o in zip(keys, own)], *blocks, F.struct("frame_no", vec).alias("_frame"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("_salts") - 1)).alias("_salt"))
    held = held.repartition(parts, *place, "_salt").groupBy(*place, "_salt").agg(F.collect_list("_frame").alias("_held"))
    held = held.select(*place, "_salt", F.col("_held.frame_no").alias("_nos"), F.col(f"_held.{vec}").alias("_vecs"))
    hot = sampled.filter("_salts > 1").select(*place, "_salts")
    salts = F.when(F.col("_pooled").isNotNull(), F.lit(parts).cast("long")).otherwise(F.coalesce("_salts", F.lit(1).cast("long")))
    rows = placed(rows).join(F.broadcast(hot), place, "left").withColumn("_salt", F.pmod(F.xxhash64(key), salts)).drop("_salts")
    return rows.repartition(parts, *place, "_salt").join(held, [*place, "_salt"], "left")


def _vector_bytes(frames: DataFrame, vec: str) -> int:
    """Bytes of the frames' vectors, with what a row takes besides."""
    of = frames.schema[vec].dataType
    each = {"byte": 1, "short": 2, "integer": 4, "float": 4}.get(of.elementType.typeName(), 8)
    row = frames.agg(F.count(F.lit(1)).alias("n"), F.sum(F.greatest(F.size(vec), F.lit(0))).alias("numbers")).first()
    return 64 * row["n"] + each * (row["numbers"] or 0)


def _mean_of(dim: int, dtype: str, value=lambda x: x.cast("double")) -> Column:
    """The element mean of the vectors in ``_vs``, ``found`` in number; zeros if there are none."""
    total = F.aggregate(F.col("_vs"), zero_vector(dim, "double"),
                        lambda acc, x: F.zip_with(acc, x, lambda a, b: a + value(b)))
    mean = F.transform(total, lambda x: (x / F.col("found")).cast(dtype))
    return F.when(F.col("found") > 0, mean).otherwise(zero_vector(dim, dtype))


def pool_frames(joined: DataFrame, dim: int, key: str = "clip_id", vec: str = "embedding",
                keep=(), dtype: str = "float", bounded: bool = True, value=None) -> DataFrame:
    """Element mean of the found frame vectors of each clip.

    ``bounded=True`` (frame samples): every clip has exactly ``n`` sampled
    rows, so its found vectors -- at most ``n``, a parameter, not a data size
    -- are gathered and summed element-wise with array functions; the cost is
    linear in the width.  ``bounded=False`` (groups of any size, e.g. all
    frames in a clip's range): ``dim`` typed ``sum`` aggregates with a
    map-side partial step, no list at all.

    Missing frames (NULL vectors) add nothing; the sum is divided by the
    number found.  A clip with no frame found gets a zero vector (not NULL),
    mirroring the feature layout; ``found`` tells the two apart.  The mean is
    not re-normalised.  ``dtype`` is the element type of the result (float
    for storage, double to keep full precision downstream).  ``value`` turns a
    stored element into its number (a double by default): vectors whose elements
    are narrow, such as pixels, stay so until they are added up.
    """
    v = F.col(vec)
    value = value or (lambda x: x.cast("double"))
    counts = [F.count(v).alias("found"), F.count(F.lit(1)).alias("sampled")]
    if bounded:
        grouped = joined.groupBy(key, *keep).agg(*counts, F.collect_list(v).alias("_vs"))
        pooled = _mean_of(dim, dtype, value)
    else:
        sums = [F.sum(value(v[i])).alias(f"_s{i}") for i in range(dim)]
        grouped = joined.groupBy(key, *keep).agg(*counts, *sums)
        mean = F.array(*[(F.col(f"_s{i}") / F.col("found")).cast(dtype) for i in range(dim)])
        pooled = F.when(F.col("found") > 0, mean).otherwise(zero_vector(dim, dtype))
    return grouped.select(key, *keep, "found", "sampled", pooled.alias("vec"))


def missing_frames(joined: DataFrame, by=("split",)) -> DataFrame:
    """Sampled frames that were not found, per group (double, like a sum of
    flags)."""
    return joined.groupBy(*by).agg(F.sum(F.when(F.col("hit").isNull(), 1.0).otherwise(0.0)).alias("missing"))


def frames_in_range(clips: DataFrame, frames: DataFrame, key: str = "clip_id", keys=("video_id",),
                    start: str = "start_frame", stop: str = "stop_frame", bucket: int = 64,
                    frame_cols=()) -> DataFrame:
    """All frames with ``start <= frame_no <= stop`` of the clip's video.

    A bare ``between`` join would be a nested loop over all pairs.  Instead
    each clip is expanded to the frame buckets (``frame_no div bucket``) it
    covers and joined on ``(*keys, bucket)`` before the exact ``between``
    filter: an equi join on a fine-grained key, then the range check.
    """
    lo, hi = F.least(F.col(start), F.col(stop)), F.greatest(F.col(start), F.col(stop))
    c = clips.select(key, *keys, F.col(start).alias("_s"), F.col(stop).alias("_e"),
                     F.explode(F.sequence(F.floor(lo / bucket), F.floor(hi / bucket))).alias("_b"))
    f = frames.select(*keys, "frame_no", *frame_cols, F.floor(F.col("frame_no") / bucket).alias("_b"))
    j = c.join(f, [*keys, "_b"], "inner").filter(F.col("frame_no").between(F.col("_s"), F.col("_e")))
    return j.select(key, *keys, "frame_no", *frame_cols)


def pool_ranges(clips: DataFrame, frames: DataFrame, dim: int, key: str = "clip_id", vec: str = "embedding", keys=("video_id",),
                start: str = "start_frame", stop: str = "stop_frame", keep=(), dtype: str = "float",
                block: int = SCAN_BLOCK) -> DataFrame:
    """Element mean of **all** frames of each clip's range, from running sums.

    A clip's sum is the running sum at its end less the one before its start, so a clip
    costs two rows however long it is; no pairs of clips and frames.  Running sums take two
    levels: sums of blocks of ``block`` frame numbers, added up per video over the blocks before (one row a
    block), and sums inside each block.  The places where clips begin and end are put among the
    frames as rows of their own (each place once, so a place that a third of all clips share is
    one row) and read the running sum off.  A block's window holds at most ``2 * block`` rows.

    Returns ``(key, *keep, found, vec)``; ``found`` is the number of frames in the range, a clip without
    one gets zeros.  A range given backwards is the same range.  A frame listed twice counts
    once; NULL vectors are missing frames."""
    lo, hi = F.least(F.col(start), F.col(stop)), F.greatest(F.col(start), F.col(stop))
    ends = clips.select(key, *keys, *keep, (lo - 1).alias("_lo"), hi.alias("_hi"))
    places = ends.select(*keys, F.explode(F.array("_lo", "_hi")).alias("frame_no")).filter("frame_no is not null").distinct()
    own = frames.filter(F.col(vec).isNotNull()).groupBy(*keys, "frame_no").agg(F.min(vec).alias("_v"))
    empty = F.lit(None).cast(own.schema["_v"].dataType)
    rows = (own.withColumn("_place", F.lit(False)).unionByName(places.select(*keys, "frame_no", empty.alias("_v"), F.lit(True).alias("_place")))
            .withColumn("_b", F.floor(F.col("frame_no") / block)))
    names = ["_n", *[f"_s{i}" for i in range(dim)]]
    values = [F.when(F.col("_v").isNotNull(), 1).otherwise(0).cast("long").alias("_n"),
              *[F.coalesce(F.get("_v", F.lit(i)).cast("double"), F.lit(0.0)).alias(f"_s{i}") for i in range(dim)]]
    flat = rows.select(*keys, "_b", "frame_no", "_place", *values)
    blocks = flat.groupBy(*keys, "_b").agg(*[F.sum(n).alias(n) for n in names])
    earlier = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(*keys, "_b", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_o{n}") for n in names])
    inside = Window.partitionBy(*keys, "_b").orderBy("frame_no", "_place").rowsBetween(Window.unboundedPreceding, 0)
    local = flat.select(*keys, "_b", "frame_no", "_place", *[F.sum(n).over(inside).alias(n) for n in names]).filter("_place")
    read = (local.join(offsets, [*keys, "_b"])
            .select(*keys, F.col("frame_no").alias("_at"), (F.col("_n") + F.col("_o_n")).alias("_n"),
                    F.array(*[F.col(n) + F.col(f"_o{n}") for n in names[1:]]).alias("_p")))
    for side in ("_lo", "_hi"):
        at = read.select(*keys, F.col("_at").alias(side), F.col("_n").alias(f"{side}_n"), F.col("_p").alias(f"{side}_p"))
        ends = ends.join(at, [*keys, side], "left")
    found = F.coalesce(F.col("_hi_n") - F.col("_lo_n"), F.lit(0))
    mean = F.zip_with("_hi_p", "_lo_p", lambda b, a: ((b - a) / found).cast(dtype))
    return ends.select(key, *keep, found.alias("found"), F.when(found > 0, mean).otherwise(zero_vector(dim, dtype)).alias("vec"))


def available(clips: DataFrame, archives: DataFrame, video: str = "video_id") -> DataFrame:
    """Clips whose video has a frame archive (semi join)."""
    return clips.join(archives.select(video), video, "left_semi")

"""Stand-in clip tables derived from the shared test tables.

The reference's own inputs (clip CSVs, feature matrices, frame archives) are
not available, so clips, frames and scored rows are derived from the given
tables: every clip is an ``orders`` row, every frame an ``embeddings`` row of one
of 27 videos, and clips start anywhere in their video.  The work of every query grows with
those tables.

Each view exists twice: as a Spark DataFrame (used by the queries) and as
DuckDB SQL text (used by the oracle queries).  The modulo arithmetic below is
how the synthetic clips get their videos and classes; it defines the data, it
does not sample it -- every row of ``orders`` and ``embeddings`` is used.  Missing
frames, missing videos and unseen classes arise from the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mise.sources.tables import read_table

# ---------------------------------------------------------------- Spark side


VIDEOS = 27


def _verb_class(c, o):
    """A long tail: cubic, and a few classes of single clips."""
    m = c % 100
    return F.when(o % 9973 == 0, 59 + F.floor(o / 9973) % 50).otherwise(F.floor(m * m * m * 59 / F.lit(1e6))).cast("long")


def _noun_class(c, o):
    """Quadratic; a tenth of the validation clips shows objects that no training video has."""
    m = o % 100
    new = F.when((c % VIDEOS >= 22) & (o % 10 == 0), 300).otherwise(0)
    return (F.floor(m * m * 229 / F.lit(1e4)) + new).cast("long")


def _frames_per_video(spark: SparkSession, d: str):
    """How many frame numbers the videos reach, as a scalar subquery."""
    e = read_table(spark, d, "embeddings")
    return e.select((F.floor(F.max("vec_id") / VIDEOS) + 1).cast("long")).scalar()


def _elapsed_text(cs):
    """Centiseconds to ``HH:MM:SS.cc``."""
    def two(x):
        return F.lpad(x.cast("string"), 2, "0")
    return F.concat(two(F.expr(f"{cs} div 360000")), F.lit(":"), two(F.expr(f"({cs} div 6000) % 60")), F.lit(":"),
                    two(F.expr(f"({cs} div 100) % 60")), F.lit("."), two(F.expr(f"{cs} % 100")))


def clips(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders").select("o_orderkey", "o_custkey")
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    v, n = _verb_class(ck, ok), _noun_class(ck, ok)
    start = ok % _frames_per_video(spark, d)
    return o.select(
        ok.alias("clip_id"),
        F.concat(F.lit("V"), (ck % 27).cast("string")).alias("video_id"),
        F.when(ck % 27 < 22, F.lit("train")).otherwise(F.lit("val")).alias("split"),
        start.alias("start_frame"),
        (start + ck % 30).alias("stop_frame"),
        v.alias("verb_class"),
        n.alias("noun_class"),
        F.concat(F.lit("verb_"), v.cast("string")).alias("verb"),
        F.concat(F.lit("noun_"), n.cast("string"), F.when(ok % 3 == 0, F.lit("b")).otherwise(F.lit("a"))).alias("noun"),
        F.when(ok % 5 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("verb_"), v.cast("string"), F.lit(" the noun_"), n.cast("string"))).alias("narration"),
    )


def clip_times(spark: SparkSession, d: str) -> DataFrame:
    """Clips with elapsed-time texts (``start_timestamp``, ``stop_timestamp``)."""
    o = read_table(spark, d, "orders").select("o_orderkey", "o_custkey")
    o = o.withColumn("_s", (F.col("o_orderkey") * 37) % 360000).withColumn(
        "_e", F.col("_s") + F.col("o_custkey") % 900 + 10)
    return o.select(F.col("o_orderkey").alias("clip_id"),
                    _elapsed_text("_s").alias("start_timestamp"), _elapsed_text("_e").alias("stop_timestamp"))


def frames(spark: SparkSession, d: str) -> DataFrame:
    """Frames keyed by video and number; every ``embeddings`` row is one.  Clips
    that end behind their video's last frame have missing frames."""
    e = read_table(spark, d, "embeddings")
    return e.select(F.concat(F.lit("V"), (F.col("vec_id") % VIDEOS).cast("string")).alias("video_id"),
                    F.floor(F.col("vec_id") / VIDEOS).cast("long").alias("frame_no"), "embedding")


def embeddings(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "embeddings").select("vec_id", "embedding", "label")


def archives(spark: SparkSession, d: str) -> DataFrame:
    """Archive listing: one row per video that has frames on disk (a video per
    ``nation`` row, so two of the 27 have none)."""
    return read_table(spark, d, "nation").select(F.concat(F.lit("V"), F.col("n_nationkey").cast("string")).alias("video_id"))


# Verb head: the embedding label, label 9 held out of training (unseen).
# Noun head: label modulo 3 (all seen).  Training rows: vec_id % 5 <> 0.
def scored_split(spark: SparkSession, d: str):
    e = embeddings(spark, d)
    train = e.filter(F.col("vec_id") % 5 != 0).withColumn("yn", (F.col("label") % 3).cast("int"))
    test = e.filter(F.col("vec_id") % 5 == 0).select(
        "vec_id", "embedding", "label",
        F.when(F.col("label") == 9, F.lit(-1)).otherwise(F.col("label")).cast("int").alias("yv"),
        (F.col("label") % 3).cast("int").alias("yn"))
    return train, test


# ---------------------------------------------------------------- DuckDB side

DUCK = {
    "clips": """
select clip_id, video_id, split, start_frame, start_frame + o_custkey % 30 stop_frame, verb_class, noun_class,
  concat('verb_', cast(verb_class as string)) verb,
  concat('noun_', cast(noun_class as string), case when clip_id % 3 = 0 then 'b' else 'a' end) noun,
  case when clip_id % 5 = 0 then null
       else concat('verb_', cast(verb_class as string), ' the noun_', cast(noun_class as string)) end narration
from (select o_orderkey clip_id, o_custkey, concat('V', cast(o_custkey % 27 as string)) video_id,
        case when o_custkey % 27 < 22 then 'train' else 'val' end split,
        o_orderkey % (select max(vec_id) // 27 + 1 from embeddings) start_frame,
        case when o_orderkey % 9973 = 0 then cast(59 + (o_orderkey // 9973) % 50 as bigint)
             else cast(floor((o_custkey % 100)*(o_custkey % 100)*(o_custkey % 100)*59 / 1e6) as bigint) end verb_class,
        cast(floor((o_orderkey % 100)*(o_orderkey % 100)*229 / 1e4) as bigint)
          + case when o_custkey % 27 >= 22 and o_orderkey % 10 = 0 then 300 else 0 end noun_class
      from orders) t""",
    "clip_times": """
select clip_id,
  lpad(cast(s // 360000 as varchar), 2, '0') || ':' || lpad(cast((s // 6000) % 60 as varchar), 2, '0') || ':' ||
  lpad(cast((s // 100) % 60 as varchar), 2, '0') || '.' || lpad(cast(s % 100 as varchar), 2, '0') start_timestamp,
  lpad(cast(e // 360000 as varchar), 2, '0') || ':' || lpad(cast((e // 6000) % 60 as varchar), 2, '0') || ':' ||
  lpad(cast((e // 100) % 60 as varchar), 2, '0') || '.' || lpad(cast(e % 100 as varchar), 2, '0') stop_timestamp
from (select o_orderkey clip_id, (o_orderkey * 37) % 360000 s, (o_orderkey * 37) % 360000 + o_custkey % 900 + 10 e
      from orders) t""",
    "frames": """
select concat('V', cast(vec_id % 27 as string)) video_id, vec_id // 27 frame_no, embedding from embeddings""",
    "frame_el": """
select video_id, frame_no, unnest(range(0, len(embedding))) pos, unnest(embedding) v from frames""",
    "vec_el": "select vec_id, label, unnest(range(0, len(embedding))) pos, unnest(embedding) v from embeddings",
    "clip_frame": """
select clip_id, video_id, 0 i, start_frame fno from clips
union all select clip_id, video_id, 1, cast(floor(start_frame + (stop_frame - start_frame) / 2e0) as bigint) from clips
union all select clip_id, video_id, 2, stop_frame from clips""",
    "archives": "select concat('V', cast(n_nationkey as string)) video_id from nation",
    # centroid logits, verb head (label; 9 unseen) and noun head (label % 3)
    "ce_v": """
select label cls, pos, avg(cast(v as double)) c from vec_el where vec_id % 5 <> 0 and label <> 9 group by label, pos""",
    "ce_n": """
select label % 3 cls, pos, avg(cast(v as double)) c from vec_el where vec_id % 5 <> 0 group by label % 3, pos""",
    "logits": """
select vec_id, case when label = 9 then -1 else label end y, cls, sum(cast(v as double) * c) z
from vec_el join ce_v on vec_el.pos = ce_v.pos where vec_id % 5 = 0 group by vec_id, label, cls""",
    "logits_n": """
select vec_id, label % 3 y, cls, sum(cast(v as double) * c) z
from vec_el join ce_n on vec_el.pos = ce_n.pos where vec_id % 5 = 0 group by vec_id, label % 3, cls""",
    "rk_v": "select vec_id, y, cls, row_number() over (partition by vec_id order by z desc, cls) r from logits",
    "rk_n": "select vec_id, y, cls, row_number() over (partition by vec_id order by z desc, cls) r from logits_n",
    "two_head": """
select v.vec_id, v.y yv, v.cls pv, n.y yn, n.cls pn
from rk_v v join rk_n n on v.vec_id = n.vec_id where v.r = 1 and n.r = 1""",
    "noun_map": """
select class_name, cast(row_number() over (order by class_name) - 1 as bigint) class_id
from (select distinct cast(noun_class as string) class_name from clips where split = 'train') t""",
    "verb_map": """
select class_name, cast(row_number() over (order by class_name) - 1 as bigint) class_id
from (select distinct cast(verb_class as string) class_name from clips where split = 'train') t""",
    "pool": """
select clip_id, pos, avg(cast(v as double)) a from clip_frame c
join frame_el f on c.video_id = f.video_id and c.fno = f.frame_no group by clip_id, pos""",
    "unit_pool": """
with n as (select video_id, frame_no, sqrt(sum(cast(v as double) * cast(v as double))) nrm from frame_el group by video_id, frame_no)
select clip_id, pos, avg(cast(v as double) / nrm) a from clip_frame c
join frame_el f on c.video_id = f.video_id and c.fno = f.frame_no
join n on f.video_id = n.video_id and f.frame_no = n.frame_no group by clip_id, pos""",
}

# Which views each view reads (so an oracle pulls in what it needs, in order).
DEPS = {
    "clip_frame": ["clips"],
    "ce_v": ["vec_el"], "ce_n": ["vec_el"],
    "logits": ["vec_el", "ce_v"], "logits_n": ["vec_el", "ce_n"],
    "rk_v": ["logits"], "rk_n": ["logits_n"],
    "two_head": ["rk_v", "rk_n"],
    "noun_map": ["clips"], "verb_map": ["clips"],
    "frame_el": ["frames"],
    "pool": ["clip_frame", "frame_el"], "unit_pool": ["clip_frame", "frame_el"],
}


def _order(names) -> list[str]:
    seen: list[str] = []

    def visit(n):
        if n in seen:
            return
        for dep in DEPS.get(n, []):
            visit(dep)
        seen.append(n)
    for n in names:
        visit(n)
    return seen


def oracle(views, sql: str) -> str:
    """Prefix ``sql`` with the CTEs of the stand-in views it reads.  ``sql``
    may start with its own ``WITH``; its CTEs then follow the views'."""
    names = _order(views)
    ctes = [f"{n} as ({DUCK[n].strip()})" for n in names]
    body = sql.strip()
    if body[:5].lower() == "with ":
        return "with " + ",\n".join(ctes) + ",\n" + body[5:]
    return ("with " + ",\n".join(ctes) + "\n" + body) if ctes else body


def register_views(spark: SparkSession, d: str) -> None:
    """Expose the stand-in views (and the base tables) as temp views so users
    can write Spark SQL over them: ``clips``, ``clip_times``, ``frames``,
    ``archives`` plus every table of the data directory."""
    from mise.sources.tables import register_tables
    register_tables(spark, d)
    for name, build in (("clips", clips), ("clip_times", clip_times), ("frames", frames), ("archives", archives)):
        build(spark, d).createOrReplaceTempView(name)

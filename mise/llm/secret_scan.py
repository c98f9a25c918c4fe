"""Secrets: fixed patterns and high-entropy strings (DataFrame functions only).

Three base patterns (an assignment to a telling name, an access key, a long hexadecimal
string) always stay.  Every unbroken string of ``WINDOW`` or more of the letters, digits and signs
that keys are written in is a candidate.  It belongs to the narrowest character class that holds
all of it, and a window slides over it: the character that enters and the one that leaves change
their counts, and with them the sum of ``c * log2(c)`` over the counts, so the window's Shannon
entropy is known at every place without counting again.  The windows that reach the class's
entropy make a span, from the first one's start to the last one's end.  The sums are whole numbers (a
fixed table of ``c * log2(c)``), so no rounding piles up and a place's verdict doesn't
depend on what lies before it.

An allow list takes back what looks alike but is none: words and numbers (a key mixes letters
and digits), identifiers, placeholders, counting and keyboard runs, and strings that their left context
calls a checksum, a commit or embedded data.  Spans that overlap a base span are left out.

Offsets count code points, end exclusive.  A text is split by the pattern; the lengths of gaps
and matches, one short row for each match, are summed up in order.

Defined results: a null or empty text has no span; repeated rows each get the same result; a null
``doc_id`` is kept as it is; spans go by start, then kind in the order of ``KINDS``; an empty
table gives an empty result; whole texts are read, further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mise.llm.common import text_of, written

#: The base patterns and the least length of group 1 (assign) or of the match.
BASE = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"(AKIA[A-Z0-9]+)",
    "hex": r"([0-9a-f]{24,}+)",
}
LEAST = {"assign": 6, "access": 20, "hex": 24}
#: What must be there for a pattern to match at all.
NEEDS = {"assign": r"(?i:word|passwd|secret|token|key)[\"']?\x20*[:=]", "access": "AKIA", "hex": "[0-9a-f]{24}"}

WINDOW = 20
#: Per class its characters and the entropy (bits) from which a window of it is random.
CLASSES = {
    "entropy_hex": ("0123456789abcdefABCDEF", 2.95),
    "entropy_upper": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 3.55),
    "entropy_base64": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.75),
}
CANDIDATE = r"([A-Za-z0-9+/_=-]{20,}+)"
KINDS = [*BASE, *CLASSES]
LEFT = 24
#: Strings (first list) and left contexts (second list) that are no secrets.
ALLOWED = (
    r"^[^0-9]*+$", r"^[^A-Za-z]*+$",                                                    # words, numbers
    r"^(?:[A-Za-z]+[-_/=+]+)*[A-Za-z]+[-_/=+]*[0-9]{1,4}$",                             # words with a number behind
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",   # identifiers
    r"(?i)example|sample|dummy|changeme|placeholder|redacted|your[-_]",
    r"(?i)01234567|12345678|abcdefgh|qwerty|(.)\1{7}",
)
ALLOWED_LEFT = (
    r"(?i)(?:sha-?(?:1|224|256|384|512)|md5|crc32|checksum|digest|integrity|etag|commit|revision|isbn|uuid)[\"']?[\x20:=\-/]*[\"']?$",
    r"(?i)base64,[\x20]*$", r"[@/.][A-Za-z0-9._-]*$",
)
_SCALE = 10 ** 9
#: c * log2(c) as whole numbers, for all counts of a window (and one more, before the oldest leaves).
_POWERS = [round(c * math.log2(c) * _SCALE) if c else 0 for c in range(WINDOW + 2)]


def largest_sum(bits: float) -> int:
    """The sum of ``c * log2(c)`` up to which a window has an entropy of ``bits``."""
    return math.floor(WINDOW * (math.log2(WINDOW) - bits) * _SCALE)


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def random_part(string: Column, alphabet: str, bits: float) -> Column:
    """``(start, stop)`` of the windows of ``string`` that reach ``bits``, null without one.

    One pass: the state has the characters' counts, their sum, the place, and the windows found."""
    table = F.array(*[F.lit(p).cast("long") for p in _POWERS])
    codes = F.transform(F.split(string, ""), lambda c: F.instr(F.lit(alphabet), c))
    start = F.struct(F.array_repeat(F.lit(0), len(alphabet)).alias("counts"), F.lit(0).cast("long").alias("total"), F.lit(0).alias("at"),
                     F.lit(-1).alias("start"), F.lit(-1).alias("stop"))

    def step(state: Column, now: Column) -> Column:
        enters, leaves = now["enters"], now["leaves"]
        had = F.get(state["counts"], enters - 1)
        # the one that leaves is counted after the one that enters
        lost = F.when(leaves > 0, F.get(state["counts"], leaves - 1) + F.when(leaves == enters, 1).otherwise(0)).otherwise(0)
        total = (state["total"] + F.get(table, had + 1) - F.get(table, had)
                 - F.get(table, lost) + F.get(table, F.greatest(lost - 1, F.lit(0))))
        counts = F.transform(state["counts"], lambda c, i: c + F.when(i == enters - 1, 1).otherwise(0) - F.when(i == leaves - 1, 1).otherwise(0))
        hit = (state["at"] >= WINDOW - 1) & (total <= F.lit(largest_sum(bits)).cast("long"))
        return F.struct(counts.alias("counts"), total.alias("total"), (state["at"] + 1).alias("at"),
                        F.when(hit & (state["start"] < 0), state["at"] - (WINDOW - 1)).otherwise(state["start"]).alias("start"),
                        F.when(hit, state["at"] + 1).otherwise(state["stop"]).alias("stop"))

    def scan(own: Column) -> Column:
        before = F.slice(F.concat(F.array_repeat(F.lit(0), WINDOW), own), F.lit(1), F.size(own))
        moves = F.zip_with(own, before, lambda a, b: F.struct(a.alias("enters"), b.alias("leaves")))
        return F.aggregate(moves, start, step, lambda s: F.when(s["start"] >= 0, F.struct(s["start"].alias("start"), s["stop"].alias("stop"))))

    return _let(codes, scan)


def _matches(text: Column, kind: str, pattern: str) -> Column:
    """Each match with the length of the gap before it, group 1, and the left context."""
    parts = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"),
                     F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias("values"))
    return _let(parts, lambda h: F.transform(h["hits"], lambda m, k: F.struct(
        F.lit(kind).alias("kind"), k.alias("k"), F.length(F.get(h["gaps"], k)).alias("gap"), m.alias("match"),
        F.get(h["values"], k).alias("value"), F.substring(F.get(h["gaps"], k), -LEFT, LEFT).alias("left"))))


def candidates(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, kind, at, stop, value, left``: matches of the base patterns
    that are long enough, and of kind ``candidate`` the strings to look at."""
    own = docs.select(docs["doc_id"], text_of(docs).alias("text"))
    none = F.array().cast("array<struct<kind:string,k:int,gap:int,match:string,value:string,left:string>>")
    needs = NEEDS | {"candidate": "[A-Za-z0-9+/_=-]{20}"}
    found = [F.when(F.col("text").rlike(needs[kind]), _matches(F.col("text"), kind, pattern)).otherwise(none)
             for kind, pattern in (BASE | {"candidate": CANDIDATE}).items()]
    rows = (own.select("doc_id", F.xxhash64("text").alias("text_hash"), F.explode(F.concat(*found)).alias("c"))
            .select("doc_id", "text_hash", "c.*").dropDuplicates(["doc_id", "text_hash", "kind", "k"]))
    order = Window.partitionBy("doc_id", "text_hash", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.sum(F.col("gap") + F.length("match")).over(order)
    short = F.lit(False)
    for kind, least in LEAST.items():
        short = short | ((F.col("kind") == kind) & (F.length("value") < least))
    return (rows.withColumn("stop", stop).filter(~short)
            .select("doc_id", "text_hash", "kind", (F.col("stop") - F.length("match")).alias("at"), "stop", "value", "left"))


def suspects(found: DataFrame) -> DataFrame:
    """The random parts of candidates that the allow list doesn't take back."""
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | F.col("value").rlike(pattern)
    for pattern in ALLOWED_LEFT:
        allowed = allowed | F.col("left").rlike(pattern)
    rows = found.filter((F.col("kind") == "candidate") & ~allowed)
    kind = part = None
    for name, (alphabet, bits) in CLASSES.items():
        inside = F.col("value").rlike("^[" + alphabet.replace("-", r"\-") + "]+$")
        kind = F.when(inside, name) if kind is None else kind.when(inside, name)
        scanned = random_part(F.col("value"), alphabet, bits)
        part = F.when(inside, scanned) if part is None else part.when(inside, scanned)
    rows = rows.select("doc_id", "text_hash", "at", kind.alias("kind"), part.alias("part")).filter("part is not null")
    return rows.select("doc_id", "text_hash", "kind", (F.col("at") + F.col("part.start")).alias("at"),
                       (F.col("at") + F.col("part.stop")).alias("stop"))


def spans(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, kind, at, stop, base``: base spans and the random strings beside them."""
    found = written(candidates(docs), "secret-candidates")
    columns = ["doc_id", "text_hash", "kind", "at", "stop"]
    base = found.filter("kind <> 'candidate'").select(*columns, F.lit(True).alias("base"))
    both = base.unionByName(suspects(found).select(*columns, F.lit(False).alias("base")))
    # a span overlaps a base span if one that begins at or before it ends behind its start, or one begins inside it
    before = Window.partitionBy("doc_id", "text_hash").orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
    behind = Window.partitionBy("doc_id", "text_hash").orderBy("at").rangeBetween(0, Window.unboundedFollowing)
    ends = F.max(F.when(F.col("base"), F.col("stop"))).over(before)
    begins = F.min(F.when(F.col("base"), F.col("at"))).over(behind)
    return (both.withColumns({"ends": ends, "begins": begins})
            .filter(F.col("base") | ((F.coalesce("ends", F.lit(-1)) <= F.col("at"))
                                     & (F.col("begins").isNull() | (F.col("begins") >= F.col("stop")))))
            .select(*columns, "base"))


def _listed(rows: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(rows), lambda s: F.concat_ws(":", s["kind"], s["at"], s["stop"])), ",")


def secrets(docs: DataFrame) -> DataFrame:
    """Per document counts of base spans, their digest, and all spans as text."""
    place = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    found = spans(docs).select("doc_id", "text_hash", "base", F.struct("at", place.alias("place"), "kind", "stop").alias("s"))
    per = (found.groupBy("doc_id", "text_hash")
           .agg(F.collect_list(F.when(F.col("base"), F.col("s"))).alias("kept"), F.collect_list("s").alias("all"),
                *[F.count_if(F.col("base") & (F.col("s.kind") == k)).alias(f"n_{k}") for k in BASE])
           .select(F.col("doc_id").alias("span_id"), F.col("text_hash").alias("span_hash"), _listed(F.col("kept")).alias("kept"),
                   _listed(F.col("all")).alias("all"), *[f"n_{k}" for k in BASE]))
    own = docs.select(docs["doc_id"], F.xxhash64(text_of(docs)).alias("text_hash"))
    joined = own.join(per, own["doc_id"].eqNullSafe(per["span_id"]) & (own["text_hash"] == per["span_hash"]), "left")
    return joined.select("doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE],
                         F.sha2(F.coalesce("kept", F.lit("")), 256).alias("base_sha256"),
                         F.coalesce("all", F.lit("")).alias("spans"))

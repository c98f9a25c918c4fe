"""Personal data: generators, boosted trees, calibrated thresholds (DataFrame functions only).

Generators are patterns with high recall; each proposes its leftmost
non-overlapping matches, and matches of different generators may overlap.  Matches
of the four base patterns that pass their check (Luhn, parts, digits) are always
kept.  The other generators' matches are judged by a model.  Nothing labels them, so
lessons are made from the base matches of the whole corpus: a kept one's digits and names are
written in the other generators' formats (local numbers, spelt-out mail, bank and national
numbers, long addresses) where it stands, which is right, and with a broken check, a format that nobody uses or in
another context (an order, a version, a key), which is wrong; base matches themselves are right
if they pass and wrong if not.  A candidate's format and context become a set of
yes/no features, and boosted regression trees are fitted on how many right and wrong
lessons have each set (a table of at most ``MASKS`` rows; the trees
become one column expression).  Every fifth text's lessons, of all sets, are held
out, scored in Spark and summed up per score, to choose the score from which precision reaches the wanted one; other
generators' candidates from that score on are added unless they overlap a base span.

Offsets count code points, end exclusive.  A text is split by the pattern; the
lengths of gaps and matches, one short row for each match, are summed up in order.

Defined results: a null or empty text has no span; without both kept and failed
candidates nothing is added; repeated rows each get the same result; a null
``doc_id`` is kept as it is; an empty table gives an empty result; whole texts
are read, further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mise.llm.common import text_of, written
from mise.session import cut_lineage

#: The base patterns.  Runs are entered only at their beginning or behind
#: the match before, and repeated groups don't give back (nothing follows them): the
#: same leftmost matches, in linear time and without recursion.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Further generators, of which the model selects.
MORE = {
    "email_spelt": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}[\x20]?(?:\(at\)|\[at\]|\{at\}|&#64;|[\x20]at[\x20])[\x20]?"
                   r"[a-z0-9-]{1,64}(?:(?:[\x20]?(?:\(dot\)|\[dot\]|\{dot\})[\x20]?|[\x20]dot[\x20]|\.)[a-z0-9-]{2,32}){1,4}",
    "phone_local": r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\)[\x20]?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])",
    "phone_zero": r"(?<![0-9A-Za-z+.-])0{1,2}[1-9][0-9]{0,3}[\x20/.-][0-9][\x20.0-9-]{4,16}[0-9](?![0-9A-Za-z])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:[\x20]?[A-Z0-9]{4}){3,7}(?:[\x20]?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "national_id": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "ip6": r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
}
#: Taught as failures, never selected: tokens and keys.
DECOYS = {"token": r"(?<![0-9A-Za-z])(?=[0-9A-Za-z]{0,40}[0-9])[0-9A-Za-z]{16,}+"}
KINDS = [*BASE, *MORE]
LESSON = "lesson"  # the kind of made candidates; they have no place
LEFT, RIGHT = 24, 8
PRECISION = 0.95
TREES, DEPTH, RATE = 30, 3, 0.3
MASKS = 50_000  # feature sets that the fit sees at most, the commonest first
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _matches(text: Column, kind: str, pattern: str) -> Column:
    """Each match with the length of the gap before it, and its context."""
    halves = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"))
    return _let(halves, lambda h: F.transform(h["hits"], lambda m, k: F.struct(
        F.lit(kind).alias("kind"), k.alias("k"), F.length(F.get(h["gaps"], k)).alias("gap"), m.alias("match"),
        F.substring(F.get(h["gaps"], k), -LEFT, LEFT).alias("left"),
        F.substring(F.coalesce(F.get(h["gaps"], k + 1), F.lit("")), 1, RIGHT).alias("right"))))


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    numbers = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 1, d.cast("int") * 2).otherwise(d.cast("int")))
    folded = F.transform(F.filter(numbers, lambda n: n.isNotNull()), lambda n: F.when(n > 9, n - 9).otherwise(n))
    return F.aggregate(folded, F.lit(0), lambda a, b: a + b) % 10 == 0


def _passes(kind: Column, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    return (F.when(kind == "email", True)
            .when(kind == "ip", match.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"))
            .when(kind == "card", F.when(n.between(12, 19), luhn(digits)).otherwise(False))
            .when(kind == "phone", n.between(9, 15)))


def iban_passes(match: Column) -> Column:
    """Whether a bank number's remainder by 97 is 1 (letters count from 10)."""
    plain = F.regexp_replace(match, " ", "")
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))
    rest = F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), lambda a, c: F.when(
        c.between("0", "9"), a * 10 + c.try_cast("int")).otherwise(a * 100 + F.ascii(c) - 55) % 97)
    return F.when(match.rlike("^[A-Z]{2}[0-9]{2}[A-Z0-9 ]{8,40}$"), rest == 1).otherwise(False)


def lessons(kind: Column, match: Column, left: Column, right: Column) -> Column:
    """Made candidates of a kept base match: ``array<struct<match, left, right, good>>``."""
    digits = F.regexp_replace(match, "[^0-9]", "")

    def made(text: Column, good: bool, before: str | None = None, after: str | None = None) -> Column:
        # a made context keeps the old one's beginning
        return F.struct(text.alias("match"), (left if before is None else F.concat(F.substring(left, 1, 6), F.lit(before))).alias("left"),
                        (right if after is None else F.lit(after)).alias("right"), F.lit(good).alias("good"))

    ten = F.lpad(F.substring(digits, -10, 10), 10, "2")
    area, office, line = (F.substring(ten, i, n) for i, n in ((1, 3), (4, 3), (7, 4)))
    local, dashed = F.concat(F.lit("("), area, F.lit(") "), office, F.lit("-"), line), F.concat_ws("-", area, office, line)
    zero = F.concat(F.lit("03"), F.substring(ten, 2, 2), F.lit(" "), F.substring(ten, 4, 7))
    same = F.concat_ws("-", F.repeat(F.substring(ten, 1, 1), 3), F.repeat(F.substring(ten, 1, 1), 3), F.repeat(F.substring(ten, 1, 1), 4))
    phone = [made(local, True), made(dashed, True), made(F.concat_ws(" ", area, office, line), True), made(zero, True), made(local, True, " call "), made(zero, True, " tel: "),
             made(dashed, False, " order "), made(dashed, False, " version "), made(F.concat_ws(".", area, office, line), False, " section "),
             made(zero, False, " invoice "), made(dashed, False, " key="), made(zero, False, " isbn "), made(same, False), made(local, False, " page ")]
    user, host = F.substring_index(match, "@", 1), F.substring_index(match, "@", -1)
    spelt = F.regexp_replace(host, r"\.", " dot ")
    word = F.concat(F.lit("x"), F.substring(F.regexp_replace(user, "[^a-z]", ""), 1, 6))
    mail = [made(F.concat(user, F.lit(" (at) "), F.regexp_replace(host, r"\.", " (dot) ")), True), made(F.concat(user, F.lit("[at]"), host), True),
            made(F.concat(user, F.lit(" at "), spelt), True), made(F.concat(user, F.lit("&#64;"), host), True, " mail "),
            made(F.concat(F.lit("look at "), word, F.lit(".this")), False), made(F.concat(word, F.lit(" at "), word, F.lit(".then")), False),
            made(F.concat(F.lit("arrive at home."), word), False)]
    number = F.rpad(F.substring(digits, 1, 18), 18, "7")
    check = F.lit(98) - F.concat(number, F.lit("131400")).cast("decimal(38,0)") % 97
    bank = F.concat(F.lit("DE"), F.lpad(check.cast("int").cast("string"), 2, "0"), number)
    broken = F.concat(F.lit("DE"), F.lpad((check.cast("int") % 96 + 2).cast("string"), 2, "0"), number)
    grouped = F.regexp_replace(bank, "(.{4})(?=.)", "$1 ")
    part = F.substring(digits, 1, 9).cast("long")
    person = F.concat_ws("-", (100 + part % 560).cast("string"), F.lpad((1 + part % 97).cast("string"), 2, "0"), F.lpad((1 + part % 9973).cast("string"), 4, "0"))
    nobody = F.concat(F.lit("000"), F.substring(person, 4, 8))
    card = [made(bank, True), made(grouped, True), made(grouped, True, " iban "), made(broken, False), made(F.regexp_replace(broken, "(.{4})(?=.)", "$1 "), False),
            made(person, True), made(person, True, " ssn "), made(nobody, False), made(person, False, " order "), made(person, False, " part no. ")]
    wide = F.regexp_replace(F.md5(match.cast("binary")), "(.{4})(?=.)", "$1:")
    ip = [made(wide, True), made(wide, True, " host "), made(wide, False, " key="), made(wide, False, " token: ")]
    none = F.array().cast("array<struct<match:string,left:string,right:string,good:boolean>>")
    # each kind's own array only: concat would make all of them for every match
    return (F.when(kind == "phone", F.array(*phone)).when(kind == "email", F.array(*mail)).when(kind == "card", F.array(*card))
            .when(kind == "ip", F.array(*ip)).otherwise(none))


def features(match: Column, left: Column, right: Column) -> list[Column]:
    """Yes/no features of a candidate's format and context; the generator isn't one."""
    digits = F.length(F.regexp_replace(match, "[^0-9]", ""))
    near = F.lower(left)
    return [
        match.rlike(r"@|(?i)\(at\)|\[at\]|\{at\}|&#64;| at "), match.rlike(r"(?i)(?:\.|dot\W{0,2})[a-z]{2,}$"),
        digits >= 7, digits >= 9, digits >= 10, digits >= 12, digits >= 16, digits > 19,
        match.rlike(r"^(?:\+|00)"), match.rlike(r"[()]"), match.rlike("-"), match.rlike(r"^[^.]*\.[^.]*\.[^.]*\.[^.]*$"),
        match.rlike("[A-Za-z]"), match.rlike("[a-f][0-9]|[0-9][a-f]"), match.rlike(r"^[0-9]+$"),
        match.rlike(r"[0-9]{3}\D{1,2}[0-9]{3}\D[0-9]{4}$"), match.rlike(r"^[0-9]{4}\D[0-9]{4}\D[0-9]{4}"),
        match.rlike(r"([0-9])\1{5}"), match.rlike("^0[^0]"), match.contains(" "),
        left.rlike(r"[0-9A-Za-z_]$"), right.rlike(r"^[0-9A-Za-z_]"), left.rlike(r"[=\"':/#$]$"), right.rlike(r"^[\"'/%]"),
        near.rlike(r"\b(?:tel|phone|call|fax|mobile|cell|contact|mail|write|card|visa|account|iban|ssn|social|host|address)\b"),
        match.rlike(r"(?i)\(at\)|\[at\]|\{at\}|&#64;"), match.rlike(r"(?i)\bdot\b"), iban_passes(match),
        match.rlike("^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$"),
        near.rlike(r"\b(?:version|v|isbn|issn|token|key|secret|password|order|invoice|section|figure|page|license|no)\b"),
    ]


def candidates(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, kind, at, stop, base, mask, held``; ``base`` is true for a
    base match that passes and a right lesson, false for one that fails and a wrong lesson, null for
    the others and for failing matches in the format of another generator."""
    own = docs.select(docs["doc_id"], text_of(docs).alias("text"))
    digit = F.col("text").rlike("[0-9]")
    needs = {"email": F.col("text").contains("@"), "phone": F.col("text").contains("+"),
             "email_spelt": F.col("text").rlike(r"(?i)\(at\)|\[at\]|\{at\}|&#64;| at ")}
    none = F.array().cast("array<struct<kind:string,k:int,gap:int,match:string,left:string,right:string>>")
    found = [F.when(needs.get(kind, digit), _matches(F.col("text"), kind, pattern)).otherwise(none)
             for kind, pattern in (BASE | MORE | DECOYS).items()]
    rows = (own.select("doc_id", F.xxhash64("text").alias("text_hash"), F.explode(F.concat(*found)).alias("c"))
            .select("doc_id", "text_hash", "c.*").dropDuplicates(["doc_id", "text_hash", "kind", "k"]))
    order = Window.partitionBy("doc_id", "text_hash", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.sum(F.col("gap") + F.length("match")).over(order)
    # what fails as one kind and has another generator's format says nothing about that format
    other = F.col("match").rlike("^(?:" + "|".join(f"(?:{p})" for p in MORE.values()) + ")$")
    passes = _passes(F.col("kind"), F.col("match"))
    base = F.when(F.col("kind").isin(*DECOYS), False).otherwise(F.when(passes | ~other, passes))
    rows = rows.withColumn("stop", stop).withColumn("base", base)
    own_row = F.struct("kind", F.col("stop") - F.length("match"), "stop", "match", "left", "right", "base")
    fields = "struct<kind:string,at:bigint,stop:bigint,match:string,left:string,right:string,base:boolean>"
    taught = F.transform(lessons(F.col("kind"), F.col("match"), F.col("left"), F.col("right")), lambda e: F.struct(
        F.lit(LESSON), F.lit(0).cast("long"), F.lit(0).cast("long"), e["match"], e["left"], e["right"], e["good"]).cast(fields))
    every = F.when(F.coalesce(base_kept(), F.lit(False)), F.concat(F.array(own_row.cast(fields)), taught)).otherwise(F.array(own_row.cast(fields)))
    rows = rows.select("doc_id", "text_hash", F.explode(every).alias("e")).select("doc_id", "text_hash", "e.*")
    bits = [F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(features(F.col("match"), F.col("left"), F.col("right")))]
    mask = bits[0]
    for b in bits[1:]:
        mask = mask + b
    return rows.select("doc_id", "text_hash", "kind", "at", "stop", "base", mask.cast("long").alias("mask"),
                       (F.pmod("text_hash", F.lit(5)) == 0).alias("held"))


def base_kept() -> Column:
    return F.col("base") & F.col("kind").isin(*BASE)


@dataclass
class Tree:
    """A leaf, or a split on one feature's bit."""

    value: float
    bit: int = -1
    no: Tree | None = None
    yes: Tree | None = None

    def of(self, mask: int) -> float:
        node = self
        while node.bit >= 0:
            node = node.yes if mask >> node.bit & 1 else node.no
        return node.value

    def column(self, mask: Column) -> Column:
        if self.bit < 0:
            return F.lit(self.value)
        return F.when(mask.bitwiseAND(F.lit(1 << self.bit)) != 0, self.yes.column(mask)).otherwise(self.no.column(mask))


def _grow(rows: Sequence[tuple[int, float, float]], bits: int, depth: int) -> Tree:
    """A regression tree on (mask, gradient, curvature), by gain, ridge 1."""
    g, h = sum(r[1] for r in rows), sum(r[2] for r in rows)
    best = None
    if depth:
        for bit in range(bits):
            g1 = sum(r[1] for r in rows if r[0] >> bit & 1)
            h1 = sum(r[2] for r in rows if r[0] >> bit & 1)
            gain = g1 * g1 / (h1 + 1) + (g - g1) ** 2 / (h - h1 + 1) - g * g / (h + 1)
            if gain > 1e-6 and (best is None or gain > best[0]):
                best = gain, bit
    if best is None:
        return Tree(-g / (h + 1))
    bit = best[1]
    return Tree(0.0, bit, _grow([r for r in rows if not r[0] >> bit & 1], bits, depth - 1),
                _grow([r for r in rows if r[0] >> bit & 1], bits, depth - 1))


@dataclass
class Model:
    trees: list[Tree]
    start: float
    threshold: float

    def score(self, mask: Column) -> Column:
        z = F.lit(self.start)
        for tree in self.trees:
            z = z + F.lit(RATE) * tree.column(mask)
        return z

    def rounded(self, mask: Column) -> Column:
        """The score in steps of 1/1000, by which the threshold is chosen."""
        return F.round(self.score(mask), 3)

    def of(self, mask: int) -> float:
        z = self.start
        for tree in self.trees:  # in the order of the column's sum
            z += RATE * tree.of(mask)
        return z


def fit(counts: Sequence[tuple[int, int, int, int, int]], bits: int, precision: float = PRECISION) -> Model | None:
    """Boosted trees from (mask, kept, failed, kept held out, failed held out)."""
    kept, failed = sum(c[1] for c in counts), sum(c[2] for c in counts)
    if not kept or not failed:
        return None
    model = Model([], math.log(kept / failed), math.inf)
    z = {c[0]: model.start for c in counts}
    for _ in range(TREES):
        rows = []
        for mask, k, f, _, _ in counts:
            p = 1 / (1 + math.exp(-z[mask]))
            rows.append((mask, (k + f) * p - k, (k + f) * p * (1 - p)))
        tree = _grow(rows, bits, DEPTH)
        model.trees.append(tree)
        for mask in z:
            z[mask] += RATE * tree.of(mask)
    per: dict[float, list[int]] = {}
    for mask, _, _, k, f in counts:
        own = per.setdefault(z[mask], [0, 0])
        own[0] += k
        own[1] += f
    model.threshold = threshold_of([(score, k, f) for score, (k, f) in per.items()], precision)
    return model


def trained(found: DataFrame, precision: float = PRECISION) -> Model | None:
    """The model of a table of candidates: trees from the commonest feature sets (all, up to
    ``MASKS``), the threshold from the held-out counts of every set."""
    kept, failed, held = F.col("base"), ~F.col("base"), F.col("held")
    counts = cut_lineage(found.filter("base is not null").groupBy("mask")
                         .agg(F.count_if(kept & ~held).alias("k"), F.count_if(failed & ~held).alias("f"),
                              F.count_if(kept & held).alias("kh"), F.count_if(failed & held).alias("fh"), F.count("*").alias("n")))
    bits = len(features(F.lit(""), F.lit(""), F.lit("")))
    rows = counts.orderBy(F.desc("n"), "mask").limit(MASKS).collect()  # bounded: a row per set of features
    model = fit([(r["mask"], r["k"], r["f"], r["kh"], r["fh"]) for r in rows], bits, precision)
    if model is None:
        return None
    # scores are rounded, so this has some ten thousand rows at most
    per = counts.groupBy(model.rounded(F.col("mask")).alias("z")).agg(F.sum("kh").alias("kh"), F.sum("fh").alias("fh")).collect()
    model.threshold = threshold_of([(r["z"], r["kh"], r["fh"]) for r in per], precision)
    return model


def threshold_of(rows: Sequence[tuple[float, int, int]], precision: float) -> float:
    """The lowest score above 0 from which the held-out (score, right, wrong) counts are as precise as wanted."""
    right = wrong = 0
    lowest = math.inf
    for z, k, f in sorted(rows, reverse=True):
        right, wrong = right + k, wrong + f
        if right and right >= precision * (right + wrong) and z > 0:
            lowest = z
    return lowest


def spans(docs: DataFrame, precision: float = PRECISION) -> DataFrame:
    """``doc_id, text_hash, kind, at, stop, base``: all selected spans."""
    found = written(candidates(docs), "pii-candidates")
    model = trained(found, precision)
    base = found.filter("base and kind in ({})".format(", ".join(f"'{k}'" for k in BASE)))
    columns = ["doc_id", "text_hash", "kind", "at", "stop"]
    kept = base.select(*columns, F.lit(True).alias("base"))
    if model is None or model.threshold == math.inf:
        return kept
    likely = found.filter(F.col("kind").isin(*MORE) & (model.rounded(F.col("mask")) >= F.lit(model.threshold)))
    both = kept.unionByName(likely.select(*columns, F.lit(False).alias("base")))
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


def personal_data(docs: DataFrame, precision: float = PRECISION) -> DataFrame:
    """Per document counts of base spans, their digest, and all spans as text."""
    place = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    found = spans(docs, precision).select("doc_id", "text_hash", "base", F.struct("at", place.alias("place"), "kind", "stop").alias("s"))
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


def redacted(docs: DataFrame, precision: float = PRECISION, mask: str = "█") -> DataFrame:
    """``doc_id, text`` with every selected span's code points masked."""
    found = spans(docs, precision).groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set(F.struct("at", "stop"))).alias("cuts"))
    per = found.select(F.col("doc_id").alias("span_id"), F.col("text_hash").alias("span_hash"), "cuts")
    own = docs.select(docs["doc_id"], text_of(docs).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    joined = own.join(per, own["doc_id"].eqNullSafe(per["span_id"]) & (own["text_hash"] == per["span_hash"]), "left")
    covered = F.aggregate("cuts", F.col("text"), lambda t, c: F.concat(
        F.substr(t, F.lit(1), c["at"].cast("int")), F.repeat(F.lit(mask), (c["stop"] - c["at"]).cast("int")),
        F.substr(t, (c["stop"] + 1).cast("int"))))
    return joined.select("doc_id", F.when(F.col("cuts").isNull(), F.col("text")).otherwise(covered).alias("text"))

"""Registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mise.llm import (
    exact_dedup,
    html_text,
    line_dedup,
    maxent_lm,
    mixing,
    periodic_runs,
    pieces,
    pii,
    ranked_search,
    secret_scan,
    simhash,
    spotsigs,
    toxicity,
)
from mise.llm.common import WORD, read_table, text_of

_NORM = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"


def _held_out(remainder: int, of: int):
    """Null ids are held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % of == remainder, F.lit(True))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(~_held_out(1, 3)))
    return (toxicity.scored(docs.select("doc_id", "text"), model)
            .select("doc_id", _held_out(1, 3).alias("held_out"), "score",
                    (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (line_dedup.without_runs(read_table(spark, sf_dir, "documents"))
            .select("doc_id", "n_lines", "n_deleted", F.sha2("text", 256).alias("text_sha256")))


# Windows are the shortest runs with three lines or fifty words, grown to the right up to three lines.
_OP2 = r"""
with raw as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
                    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as raw_no from documents),
norm as (select *, trim(regexp_replace(line, '[ 	-
]+', ' ', 'g')) as norm from raw),
num as (select *, row_number() over (partition by doc_id order by raw_no) as no,
               len(string_split(norm, ' ')) as words from norm where norm <> ''),
nxt as (select *, lead(norm, 1) over w as n1, lead(norm, 2) over w as n2, lead(words, 1) over w as w1
        from num window w as (partition by doc_id order by no)),
len as (select nxt.*, size from nxt, (values (1), (2), (3)) s(size)
        where size >= case when words >= 50 then 1 when words + w1 >= 50 then 2 else 3 end),
win as (select doc_id, no, size, case size when 1 then norm when 2 then norm || chr(10) || n1
                                  else norm || chr(10) || n1 || chr(10) || n2 end as content from len),
pos as (select *, first_value(doc_id) over f as d0, first_value(no) over f as no0 from win where content is not null
        window f as (partition by content, size order by doc_id, no)),
cut as (select doc_id, case when d0 = doc_id then greatest(no, no0 + size) else no end as a, no + size as b
        from pos where d0 <> doc_id or no0 <> no),
gone as (select distinct doc_id, unnest(range(a, b)) as no from cut where a < b),
kept as (select n.doc_id, n.raw_no, n.line, m.no is not null as is_line, g.no is not null as is_gone
         from norm n left join num m on n.doc_id = m.doc_id and n.raw_no = m.raw_no
                     left join gone g on m.doc_id = g.doc_id and m.no = g.no)
select doc_id, count(*) filter (is_line) as n_lines, count(*) filter (is_gone) as n_deleted,
       sha256(coalesce(string_agg(line, chr(10) order by raw_no) filter (not is_gone), '')) as text_sha256
from kept group by doc_id
"""


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(read_table(spark, sf_dir, "documents"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent_lm.scored(read_table(spark, sf_dir, "documents"), _held_out(0, 10))


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(read_table(spark, sf_dir, "pages"))


def op6_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.fingerprints(read_table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.copy_groups(read_table(spark, sf_dir, "documents"))


_OP7 = f"""
with d as (select doc_id, {_NORM} as norm from documents),
g as (select norm, min(doc_id) as keep_id, count(*) as group_size from d group by norm)
select d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id as kept, sha256(d.norm) as text_sha256
from d join g on d.norm = g.norm
"""


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(read_table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return (mixing.mixed(docs)
            .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"))


# Sources in the order of cap / weight fill up first; the level is that of the
# first source that the rest of the goal, dealt by weight, doesn't fill.
_OP10 = r"""
with d as (select doc_id, source, text,
                  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (select *, case (row_number() over (order by encode(source) nulls last) - 1) % 3
                when 0 then 3.0::double when 1 then 1.0::double else 2.0::double end as weight from s),
c as (select *, coalesce(sum(source_size) over before, 0) as filled, sum(weight) over onward as open_weight,
             1.5::double * sum(source_size) over () as goal
      from w window before as (order by source_size / weight, weight, source rows between unbounded preceding and 1 preceding),
                    onward as (order by source_size / weight, weight, source rows between current row and unbounded following)),
o as (select *, weight * (goal - 2.0::double * filled) / open_weight > 2.0::double * source_size as is_full from c),
l as (select min(filled) as filled, max(open_weight) as open_weight, max(goal) as goal from o where not is_full),
t as (select o.source, o.source_size, case when o.is_full then 2.0::double * o.source_size
             else o.weight * (l.goal - 2.0::double * l.filled) / l.open_weight end as target from o, l),
r as (select d.doc_id, d.size, t.source_size, t.target,
             case when t.source_size > 0 then t.target / t.source_size else 0 end as rate,
             ('0x' || substr(md5('10:' || coalesce(d.doc_id::varchar, md5(coalesce(d.text, '')))), 1, 13))::bigint
               / 4503599627370496.0::double as draw
      from d join t on d.source is not distinct from t.source),
k as (select *, (floor(rate) + case when draw < rate - floor(rate) then 1 else 0 end)::bigint as copies from r)
select doc_id, size, source_size, target, size * copies as taken, copies from k
"""


def with_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: texts of which a tenth, by the id's hash, repeats a block of its words to the end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    own = docs.select("doc_id", text_of(docs).alias("text"), h.alias("h"), F.floor(h / 10).alias("g"))
    words = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    own = own.withColumn("words", words).withColumn("n", F.size("words"))
    own = own.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rest = F.col("n") - F.col("a")
    own = own.withColumn("p", (1 + F.floor(rest / (3 + F.col("g") % 8))).cast("int"))
    block = F.slice("words", F.col("a") + 1, F.col("p"))
    tail = F.slice(F.flatten(F.array_repeat(block, (F.floor(rest / F.col("p")) + 1).cast("int"))), F.lit(1), rest)
    made = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return own.select("doc_id", F.when(F.col("a").isNotNull(), made).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_periods(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    best = F.element_at(F.array_sort(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")))), 1)
    listed = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    found = periodic_runs.periodic_runs(docs)
    some = F.size("runs") > 0
    found = found.withColumn("best", F.when(some, best))
    length = -F.col("best.less")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), length.alias("length"),
        F.col("best.period").alias("period"), F.floor(1000 * length / F.col("best.period")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))



def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


_TERMS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
          r" '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

_OP12 = f"""
with doc as (select doc_id, row_number() over () as row, {_TERMS} as terms from documents),
own as (select row, doc_id, len(terms)::bigint as n, unnest(terms) as term from doc where len(terms) > 0),
total as (select count(*)::bigint as docs, sum(len(terms))::bigint as terms from doc where len(terms) > 0),
asked as (select item_id, term, count(*)::bigint as times
          from (select item_id, unnest({_TERMS}) as term from (select distinct item_id, text from benchmark)) group by item_id, term),
found as (select row, doc_id, n, term, count(*)::bigint as tf from own where term in (select term from asked) group by row, doc_id, n, term),
weight as (select term, floor(1000 * ln((2 * max(docs) + 2)::double / (2 * count(*) + 1)))::bigint as w from found, total group by term),
scored as (select item_id, row, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total.terms))))::bigint as score
           from asked join found using (term) join weight using (term), total group by item_id, row, doc_id),
placed as (select *, row_number() over (partition by item_id order by score desc, doc_id, row) as rank from scored where score > 0)
select item_id, rank::int as rank, doc_id, score from placed where rank <= 10
"""


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(read_table(spark, sf_dir, "documents"))



def _op13_sql() -> str:
    """Every window counted anew; RE2 has no possessive repeats and no back references."""
    def text(pattern: str) -> str:
        return "'" + pattern.replace("}+", "}").replace("*+", "*").replace("'", "''") + "'"

    same = "|".join(("\\" + c if c in "+/=-" else c) + "{8}" for c in secret_scan.CLASSES["entropy_base64"][0])
    allowed = [p.replace(r"|(.)\1{7}", "|" + same) for p in secret_scan.ALLOWED]
    kinds = " union all ".join(
        f"select row, '{kind}' as kind, {place} as place, string_split_regex(text, {text(pattern)}) as gaps,"
        f" regexp_extract_all(text, {text(pattern)}) as hits, regexp_extract_all(text, {text(pattern)}, 1) as vals from d"
        for place, (kind, pattern) in enumerate([*secret_scan.BASE.items(), ("candidate", secret_scan.CANDIDATE)]))
    short = " or ".join(f"(kind = '{kind}' and length(val) < {least})" for kind, least in secret_scan.LEAST.items())
    classes = " ".join(f"when regexp_full_match(val, '[{alphabet.replace('-', chr(92) + '-')}]+')"
                       f" then {{'kind': '{kind}', 'place': {3 + place}, 'most': {secret_scan.largest_sum(bits)}::bigint}}"
                       for place, (kind, (alphabet, bits)) in enumerate(secret_scan.CLASSES.items()))
    window = f"substr(val, i, {secret_scan.WINDOW})"
    powers = ", ".join(f"{p}::bigint" for p in secret_scan._POWERS[1:])
    return f"""
with d as (select doc_id, row_number() over () as row, coalesce(text, '') as text from documents),
k as ({kinds}),
u as (select row, kind, place, unnest(range(1, len(hits) + 1)) as k, gaps, hits, vals from k),
m as (select row, kind, place, hits[k] as hit, vals[k] as val, right(gaps[k], {secret_scan.LEFT}) as before,
             list_sum(list_transform(gaps[1:k], lambda g: length(g)))::bigint
               + coalesce(list_sum(list_transform(hits[1:k - 1], lambda g: length(g))), 0)::bigint as pos from u),
base as (select row, kind, place, pos, pos + length(hit) as stop from m where kind <> 'candidate' and not ({short})),
cand as (select row, pos, val, case {classes} end as class from m where kind = 'candidate'
         and not ({' or '.join(f'regexp_matches(val, {text(p)})' for p in allowed)})
         and not ({' or '.join(f'regexp_matches(before, {text(p)})' for p in secret_scan.ALLOWED_LEFT)})),
win as (select *, unnest(range(1, length(val) - {secret_scan.WINDOW} + 2)) as i from cand),
hit as (select row, pos, class, i from win where list_sum(list_transform(list_distinct(string_split({window}, '')),
          lambda c: ([{powers}])[length({window}) - length(replace({window}, c, ''))])) <= class.most),
found as (select row, class.kind as kind, class.place as place, pos + min(i) - 1 as pos, pos + max(i) - 1 + {secret_scan.WINDOW} as stop
          from hit group by row, pos, class),
more as (select * from found f where not exists (select 1 from base b where b.row = f.row and b.pos < f.stop and f.pos < b.stop)),
spans as (select *, true as is_base from base union all select *, false from more),
listed as (select row, string_agg(kind || ':' || pos || ':' || stop, ',' order by pos, place) as spans,
                  string_agg(kind || ':' || pos || ':' || stop, ',' order by pos, place) filter (is_base) as kept,
                  {', '.join(f"count(*) filter (kind = '{kind}') as n_{kind}" for kind in secret_scan.BASE)} from spans group by row)
select doc_id, {', '.join(f'coalesce(n_{kind}, 0) as n_{kind}' for kind in secret_scan.BASE)},
       sha256(coalesce(kept, '')) as base_sha256, coalesce(spans, '') as spans
from d left join listed using (row)
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_line_dedup": op2_line_dedup,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_html": op5_html,
    "op6_spotsigs": op6_spotsigs,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_pii": op8_pii,
    "op9_simhash": op9_simhash,
    "op10_mixing": op10_mixing,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_ranked_search": op12_ranked_search,
    "op13_secret_scan": op13_secret_scan,
}

ORACLES: dict[str, str] = {
    "op2_line_dedup": _OP2,
    "op7_exact_dedup": _OP7,
    "op10_mixing": _OP10,
    "op12_ranked_search": _OP12,
    "op13_secret_scan": _op13_sql(),
}

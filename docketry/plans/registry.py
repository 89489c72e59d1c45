"""Named queries over the shared tables and their SQL twins.

The shared tables hold no notices, so roles are played by them: a document's source is its
case and the document a file; users, assistants and system turns of conversations are
notice, reply and order; labels are partial answers; the most repeated lines are the
heading vocabulary; figures are written from orders. Window sizes shrink accordingly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import vocab as V
from ..operators import checks, evidence, files, items, resolve, segment

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(SQL)


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


#: Rows of narrow tables that a task decodes: files split by bytes would give a task millions of them.
_ROWS = 25_000


def _spread(spark: SparkSession, d: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table, the first its key, in as many partitions as its rows ask for."""
    rows = _t(spark, d, name).select(*columns)
    return rows.repartition(max(1, -(-rows.count() // _ROWS)), columns[0])


# ------------------------------------------------------------------ files

@query("select source, doc_id, n_chars from (select *, row_number() over (partition by source order by n_chars desc, doc_id) as r from documents) where r = 1")
def biggest_file_per_case(spark, d):
    return resolve.first_by(_t(spark, d, "documents").select("source", "doc_id", "n_chars"), ["source"], F.col("n_chars").desc(), "doc_id")


_ARGUES = "(^| )(the|der|les|los) "


@query(f"""
with s as (select source, doc_id, length(text) as len, floor(1000.0::double * len(regexp_extract_all(substr(text, 1, 60000), '{_ARGUES}')) / greatest(1, length(substr(text, 1, 60000))) * 100 + 0.5) / 100 as argues from documents where length(text) >= 400)
select source, doc_id, argues, file_rank from (select *, row_number() over (partition by source order by argues desc, len desc, doc_id) as file_rank from s) where file_rank <= 2""")
def top2_by_score(spark, d):
    docs = _t(spark, d, "documents").select("source", "doc_id", "text", F.col("doc_id").alias("size_rank"))
    return files.pick_replies(docs, "source", _ARGUES).select("source", "doc_id", "argues", F.col("file_rank").cast("long").alias("file_rank"))


@query("select role, count(*) as turns, count(distinct conv_id) as cases from conversations group by role")
def role_inventory_counts(spark, d):
    return _t(spark, d, "conversations").groupBy("role").agg(F.count("*").alias("turns"), F.count_distinct("conv_id").alias("cases"))


@query("select c.conv_id, r.role from (select distinct conv_id from conversations) c, (values ('user'), ('assistant'), ('system')) r(role) where not exists (select 1 from conversations x where x.conv_id = c.conv_id and x.role = r.role)")
def cases_missing_role(spark, d):
    c = _t(spark, d, "conversations").select("conv_id", "role").distinct()
    roles = F.explode(F.array(*map(F.lit, ("user", "assistant", "system"))))
    return resolve.orphans(c.select("conv_id").distinct().select("conv_id", roles.alias("role")), c, ["conv_id", "role"])


@query("""
with f as (select distinct case when doc_id % 3 = 0 then '33ABCDE1234F1Z' || (doc_id % 7)::varchar || '_' || source else source || '_' || (doc_id % 2)::varchar end as folder from documents),
k as (select folder, case when regexp_matches(folder, '\\d{2}[A-Z]{5}\\d{4}[A-Z]\\d[A-Z\\d]{2}') then regexp_extract(folder, '(\\d{2}[A-Z]{5}\\d{4}[A-Z]\\d[A-Z\\d]{2})', 1) else folder end as key from f)
select folder, case when r = 1 then key else key || '_' || r::varchar end as case_id from (select *, row_number() over (partition by key order by folder) as r from k)""".replace("\\\\", "\\"))
def case_key_dedup(spark, d):
    x = F.col("doc_id")
    gst = F.concat(F.lit("33ABCDE1234F1Z"), (x % 7).cast("string"), F.lit("_"), F.col("source"))
    folder = F.when(x % 3 == 0, gst).otherwise(F.concat_ws("_", "source", (x % 2).cast("string")))
    return files.case_keys(_t(spark, d, "documents").select(folder.alias("folder")))


# ------------------------------------------------------------------ text routing

@query(r"select doc_id, n, n > 0.02 * greatest(1, length(text)) as garbled from (select doc_id, text, length(text) - length(regexp_replace(text, '[\x00-\x08\x0b\x0e-\x1f\x7f]', '', 'g')) as n from (select doc_id, case when doc_id % 5 = 0 then repeat(chr(1), (doc_id % 40)::int) || text else text end as text from documents))")
def garbled_flag(spark, d):
    t = F.when(F.col("doc_id") % 5 == 0, F.concat(F.repeat(F.lit("\x01"), (F.col("doc_id") % 40).cast("int")), "text")).otherwise(F.col("text"))
    return _t(spark, d, "documents").select("doc_id", t.alias("text")).select("doc_id", X.count_class("text", V.CONTROL).cast("long").alias("n"), X.garbled("text").alias("garbled"))


@query(r"select doc_id, length(text) - length(regexp_replace(text, '\p{L}', '', 'g')) as letters, (length(text) - length(regexp_replace(text, '\p{Nd}', '', 'g'))) / greatest(1, length(text) - length(regexp_replace(text, '[\p{L}\p{N}]', '', 'g'))) as digits from documents")
def letters_digits_ratio(spark, d):
    return _t(spark, d, "documents").select("doc_id", X.letters("text").cast("long").alias("letters"), X.digit_ratio("text").alias("digits"))


@query("select case when length(text) < 600 * greatest(1, 1 + doc_id % 4) then 'ocr' else 'native' end as how, count(*) as files, sum(length(text))::bigint as chars from documents group by 1")
def needs_reread_route(spark, d):
    how = F.when(X.needs_reread("text", 1 + F.col("doc_id") % 4), "ocr").otherwise("native")
    return _t(spark, d, "documents").groupBy(how.alias("how")).agg(F.count("*").alias("files"), F.sum(F.length("text")).cast("long").alias("chars"))


_LINES = "select doc_id, unnest(range(0, len(ls))) as i, unnest(ls) as line, len(ls) as n from (select doc_id, case when ends_with(text, chr(10)) then string_split(text, chr(10))[:-2] else string_split(text, chr(10)) end as ls from documents)"


def _lines(spark, d):
    return segment.split_lines(_t(spark, d, "documents").select("doc_id", "text"), "doc_id")


@query(f"select doc_id, i + 1 as line_no, line from ({_LINES})")
def split_lines(spark, d):
    return _lines(spark, d).select("doc_id", (F.col("i") + 1).cast("long").alias("line_no"), "line")


@query(f"with l as (select doc_id, count(*) as n from ({_LINES}) group by 1) select doc_id, s as start, least(20, n - s) as lines from (select doc_id, n, unnest(range(0, n, 15)) as s from l)")
def window_split(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", X.lines("text").alias("lines"))
    return segment.windows(docs, "doc_id", 20, 5).select("doc_id", F.col("start").cast("long").alias("start"), F.size("lines").cast("long").alias("lines"))


@query(f"select doc_id, count(*) as lines, sum(length(regexp_replace(lower(line), '[^a-z0-9]', '', 'g')))::bigint as squashed from ({_LINES}) group by 1")
def squash_lines(spark, d):
    return _lines(spark, d).groupBy("doc_id").agg(F.count("*").alias("lines"), F.sum(F.length(X.squash("line"))).cast("long").alias("squashed"))


_LABELLED = "case i % 6 when 0 then 'Point No. ' || (i + 1)::varchar || ') ' || line when 1 then '(iv) ' || line when 2 then '3. ' || line when 3 then '• ' || line when 4 then 'Defect 2): ' || line else line end"


@query(rf"select doc_id, i, regexp_replace(text, '(?i){V.PREFIX}', '') as rest from (select doc_id, i, {_LABELLED} as text from ({_LINES}))")
def prefix_strip(spark, d):
    return _lines(spark, d).select("doc_id", F.col("i").cast("long").alias("i"), X.strip_prefix(F.expr(_LABELLED.replace("::varchar", " ").replace("|| (i + 1) ", "|| string(i + 1) "))).alias("rest"))


# ------------------------------------------------------------------ segmentation

_VOCAB = f"select sq as key, 'H' || r::varchar as id, r from (select sq, row_number() over (order by length(sq) desc, sq) as r from (select sq, row_number() over (order by c desc, sq) as k from (select regexp_replace(lower(line), '[^a-z0-9]', '', 'g') as sq, count(*) as c from ({_LINES}) group by 1) where length(sq) >= 6) where k <= 12)"


def _squashed_lines(spark, d) -> DataFrame:
    """(sq): lines of six letters or digits at least, squashed once, before the filter."""
    return _t(spark, d, "documents").select(F.explode(X.squashed_lines("text")).alias("sq")).where(F.length("sq") >= 6)


def _vocabulary(spark, d) -> list[tuple[str, str]]:
    """The twelve most repeated lines, longest first: a fixed number of short strings."""
    n = _squashed_lines(spark, d).groupBy("sq").agg(F.count("*").alias("c"))
    top = [r["sq"] for r in n.orderBy(F.col("c").desc(), "sq").limit(12).collect()]
    return [(k, f"H{r}") for r, k in enumerate(sorted(top, key=lambda k: (-len(k), k)), 1)]


_RAW = rf"regexp_replace(line, '(?i){V.PREFIX}', '')"
_MATCH = rf"""
select doc_id, i, n, id from (
  select l.*, v.id, row_number() over (partition by l.doc_id, l.i order by cand, v.r) as w from (
    select doc_id, i, n, unnest([0, 1]) as cand, unnest([regexp_replace(lower({_RAW}), '[^a-z0-9]', '', 'g'), case when contains({_RAW}, ':') then regexp_replace(lower(string_split({_RAW}, ':')[1]), '[^a-z0-9]', '', 'g') end]) as sq from ({_LINES})) l
  join ({_VOCAB}) v on length(sq) <= 200 and instr(sq, key) between 1 and 5 and length(sq) - length(key) - instr(sq, key) + 1 <= 12) where w = 1"""


def _heads(spark, d):
    return segment.headings(_lines(spark, d), "doc_id", _vocabulary(spark, d), wrap=1, fuzzy=False, compat=True)


@query(f"select doc_id, i, id from ({_MATCH})")
def heading_match(spark, d):
    return _heads(spark, d).select("doc_id", F.col("i").cast("long").alias("i"), "id")


_ONE = f"select sq, row_number() over (order by c desc, sq) as k from (select regexp_replace(lower(line), '[^a-z0-9]', '', 'g') as sq, count(*) as c from ({_LINES}) group by 1) where length(sq) >= 6"
_NEXT = f"select *, lead(line) over (partition by doc_id order by i) as line1, lead(line, 2) over (partition by doc_id order by i) as line2 from ({_LINES})"
_TWO = f"select sq, row_number() over (order by c desc, sq) as k from (select a || b as sq, count(*) as c from (select regexp_replace(lower(line), '[^a-z0-9]', '', 'g') as a, regexp_replace(lower(line1), '[^a-z0-9]', '', 'g') as b from ({_NEXT})) where length(a) >= 6 and length(b) >= 6 and length(a) + length(b) <= 150 group by 1)"
_VOCAB2 = f"select sq as key, 'H' || r::varchar as id, r from (select sq, row_number() over (order by length(sq) desc, sq) as r from (select sq from ({_ONE}) where k <= 8 union select sq from ({_TWO}) where k <= 8))"


def _wrapped_vocabulary(spark, d) -> list[tuple[str, str]]:
    """The eight most repeated lines and the eight most repeated pairs of lines, longest first."""
    # both from one pass over the texts: a line is alone, and with the next where both are long enough
    sq = _t(spark, d, "documents").select(X.squashed_lines("text").alias("s"))
    line = sq.select(F.explode(F.transform("s", lambda x, i: F.struct(x.alias("a"), F.get("s", i + 1).alias("b")))).alias("p")).select("p.*").where("length(a) >= 6")
    pair = F.when(F.expr("length(b) >= 6 and length(a) + length(b) <= 150"), F.concat("a", "b"))
    each = line.select(F.explode(F.array(F.struct(F.lit(1).alias("of"), F.col("a").alias("sq")), F.struct(F.lit(2).alias("of"), pair.alias("sq")))).alias("x")).select("x.*").where("sq is not null")
    counts = each.groupBy("of", "sq").agg(F.count("*").alias("c"))
    rank = F.row_number().over(Window.partitionBy("of").orderBy(F.col("c").desc(), "sq"))  # tasks send on their first eight only
    top = {r["sq"] for r in counts.withColumn("r", rank).where("r <= 8").collect()}
    return [(k, f"H{r}") for r, k in enumerate(sorted(top, key=lambda k: (-len(k), k)), 1)]


def _spans() -> str:
    """The spans of one to three lines, each whole and up to a colon."""
    strip = lambda c: f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"
    raw = [f"regexp_replace({s}, '(?i){V.PREFIX}', '')" for s in (strip("line"), f"{strip('line')} || ' ' || {strip('line1')}", f"{strip('line')} || ' ' || {strip('line1')} || ' ' || {strip('line2')}")]
    squash = lambda c: f"regexp_replace(lower({c}), '[^a-z0-9]', '', 'g')"
    sq = [x for r in raw for x in (squash(r), f"case when contains({r}, ':') then {squash(f"string_split({r}, ':')[1]")} end")]
    return f"select doc_id, i, unnest([0, 0, 1, 1, 2, 2]) as w, unnest([0, 1, 0, 1, 0, 1]) as c, unnest([{', '.join(sq)}]) as sq from ({_NEXT}) where {squash(raw[0].replace(strip('line'), 'line'))} <> ''"


def _wrapped(compat: bool) -> str:
    wide = "" if compat else "when id0 is not null and id0 not in ('H1', 'H3', 'H5', 'H7', 'H9', 'H11') and coalesce(wide1, wide2) is not null then coalesce(wide1, wide2)"
    return f"""
with s as ({_spans()}), v as ({_VOCAB2}),
m as (select doc_id, i, w, arg_min(id, c * 1000 + r) as id from s join v on length(sq) between 1 and 200 and instr(sq, key) between 1 and 5 and length(sq) - length(key) - instr(sq, key) + 1 <= 12 group by 1, 2, 3),
p as (select doc_id, i, max(case when w = 0 then id end) as id0, max(case when w = 1 then id end) as id1, max(case when w = 2 then id end) as id2 from m group by 1, 2),
q as (select *, case when id1 in ('H1', 'H3', 'H5', 'H7', 'H9', 'H11') then struct_pack(id := id1, width := 2) end as wide1, case when id2 in ('H1', 'H3', 'H5', 'H7', 'H9', 'H11') then struct_pack(id := id2, width := 3) end as wide2 from p),
x as (select doc_id, i, case {wide} when id0 is not null then struct_pack(id := id0, width := 1) when id1 is not null then struct_pack(id := id1, width := 2) else struct_pack(id := id2, width := 3) end as h from q)
select doc_id, i, h.width as width, h.id as id from x"""


def _wrapped_heads(spark, d, compat):
    lines = segment.split_lines(_t(spark, d, "documents").select("doc_id", "text"), "doc_id", ahead=2)
    found = segment.headings(lines, "doc_id", _wrapped_vocabulary(spark, d), wrap=3, fuzzy=False, compat=compat, reported=[f"H{k}" for k in range(1, 12, 2)])
    return found.select("doc_id", F.col("i").cast("long").alias("i"), "width", "id")


@query(_wrapped(False))
def heading_wrapped(spark, d):
    """Headings over up to three lines; a reported one over several lines wins over a boundary on the first."""
    return _wrapped_heads(spark, d, False)


@query(_wrapped(True))
def heading_wrapped_narrowest(spark, d):
    return _wrapped_heads(spark, d, True)


_ENDS = f"select doc_id, any_value(n) as n, coalesce(min(case when regexp_matches(line, '^[A-Z][a-z]+\\.$') then i end), max(case when regexp_matches(line, '^The ') and i > greatest(0, floor(n * 2 / 3)) then i end), any_value(n)) as body_end from ({_LINES}) group by 1".replace("\\\\", "\\")


def _ends(spark, d):
    return segment.body_end(_lines(spark, d), "doc_id", r"^[A-Z][a-z]+\.$", "^The ")


@query(f"select doc_id, body_end, n from ({_ENDS})")
def body_end(spark, d):
    return _ends(spark, d).select("doc_id", F.col("body_end").cast("long").alias("body_end"), F.col("n").cast("long").alias("n"))


@query(f"select sum(n)::bigint as lines, sum(n - body_end)::bigint as dropped, sum(n - body_end) / sum(n) as share from ({_ENDS})")
def dropped_share(spark, d):
    return _ends(spark, d).agg(F.sum("n").alias("lines"), F.sum(F.col("n") - F.col("body_end")).alias("dropped"), (F.sum(F.col("n") - F.col("body_end")) / F.sum("n")).alias("share"))


_MARKS = f"select m.doc_id, m.i, m.id, coalesce(lead(m.i) over (partition by m.doc_id order by m.i), m.n) as stop from ({_MATCH}) m"
_SECTIONS = f"""
select doc_id, id, start_line, end_line, text from (
  select *, row_number() over (partition by doc_id, id order by length(text) desc, start_line) as r from (
    select a.doc_id, a.id, a.i + 1 as start_line, a.stop as end_line, regexp_replace(string_agg(l.line, chr(10) order by l.i), '^\\s+|\\s+$', '', 'g') as text
    from ({_MARKS}) a join ({_LINES}) l on l.doc_id = a.doc_id and l.i >= a.i and l.i < a.stop group by all) where text <> '') where r = 1""".replace("\\\\", "\\")


def _sections(spark, d):
    keys = _vocabulary(spark, d)
    docs = _t(spark, d, "documents").select("doc_id", "text")
    return segment.sections(docs, "doc_id", keys, [i for _, i in keys], False, True, "^~summary~$", "^~tail~$", 1)


@query(f"select doc_id, id as param_id, start_line, end_line, text from ({_SECTIONS})")
def anchor_sections(spark, d):
    return _sections(spark, d).select("doc_id", "param_id", F.col("start_line").cast("long").alias("start_line"), F.col("end_line").cast("long").alias("end_line"), "text")


@query(f"select id as param_id, count(*) as cases, count(distinct doc_id) as docs from ({_SECTIONS}) group by 1")
def cases_per_parameter(spark, d):
    return _sections(spark, d).groupBy("param_id").agg(F.count("*").alias("cases"), F.count_distinct("doc_id").alias("docs"))


# ------------------------------------------------------------------ figures and evidence

_TABLES = "select o_orderkey, 'Total ' || (o_orderkey * 37)::varchar || ' of ' || o_custkey::varchar || chr(10) || case when o_orderkey % 4 = 0 then '        ' || (o_custkey % 100)::varchar || ' ' || (o_orderkey % 10)::varchar when o_orderkey % 4 = 1 then 'a ' || (o_orderkey * 1000)::varchar || ' ' || (o_custkey % 10)::varchar || ' b' else o_orderstatus end as text from orders"


def _figures(spark, d):
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    second = F.when(key % 4 == 0, F.concat(F.lit("        "), (cust % 100).cast("string"), F.lit(" "), (key % 10).cast("string"))).when(key % 4 == 1, F.concat(F.lit("a "), (key * 1000).cast("string"), F.lit(" "), (cust % 10).cast("string"), F.lit(" b"))).otherwise(F.col("o_orderstatus"))
    return _t(spark, d, "orders").select("o_orderkey", "o_custkey", F.concat(F.lit("Total "), (key * 37).cast("string"), F.lit(" of "), cust.cast("string"), F.lit("\n"), second).alias("text"))


@query(rf"select o_orderkey, regexp_matches(string_split(text, chr(10))[2], '^\s{{6,}}[\d\s]{{1,40}}$') or regexp_matches(text, '\d{{4,}}\s\d{{1,3}}([^0-9]|$)') as damaged from ({_TABLES})")
def damaged_tables(spark, d):
    return _figures(spark, d).select("o_orderkey", evidence.damaged("text").alias("damaged"))


@query("select o_orderkey, array_to_string(list_distinct([((o_orderkey + 1) * 1000)::varchar, (o_custkey + 100)::varchar]).list_sort(), ',') as figures from orders")
def figure_extract(spark, d):
    key = (F.col("o_orderkey") + 1) * 1000
    grouped = F.concat((key / 1000).cast("long").cast("string"), F.lit(",000"))
    t = F.concat(F.lit("Pay "), grouped, F.lit(" and "), (F.col("o_custkey") + 100).cast("string"), F.lit(" not v"), key.cast("string"), F.lit("x or 12"))
    return _t(spark, d, "orders").select("o_orderkey", F.array_join(F.array_sort(X.figures(t)), ",").alias("figures"))


@query("""
select o_orderkey, array_to_string(list_filter(list_distinct([(o_orderkey * 37)::varchar, (o_custkey * 11)::varchar]), lambda f: length(f) between 4 and 12 and not contains(regexp_replace(text, '[^0-9]', '', 'g'), f)), ',') as bad
from (select o_orderkey, o_custkey, 'Total ' || (o_orderkey * 37)::varchar || ' and ' || (o_custkey * case when o_orderkey % 2 = 0 then 11 else 13 end)::varchar as text from orders)""")
def figure_containment(spark, d):
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    src = F.concat(F.lit("Total "), (key * 37).cast("string"), F.lit(" and "), (cust * F.when(key % 2 == 0, 11).otherwise(13)).cast("string"))
    said = F.concat(F.lit("says "), (key * 37).cast("string"), F.lit(" then "), (cust * 11).cast("string"))
    return _t(spark, d, "orders").select("o_orderkey", src.alias("src"), said.alias("said")).select("o_orderkey", F.array_join(X.unseen_figures("said", "src"), ",").alias("bad"))


@query("""
select o_orderkey, array_to_string(list_sort(list_filter(a, lambda f: not list_contains(b, f))), ',') as lost, array_to_string(list_sort(list_filter(b, lambda f: not list_contains(a, f))), ',') as invented
from (select o_orderkey, list_distinct([(o_orderkey * 37 + 100)::varchar, (o_custkey + 100)::varchar]) as a, list_distinct([(o_orderkey * 37 + 100)::varchar, (o_custkey + 100 + o_orderkey % 2)::varchar]) as b from orders)""")
def lost_invented_figures(spark, d):
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    src = F.concat_ws(" ", (key * 37 + 100).cast("string"), F.lit("of"), (cust + 100).cast("string"))
    out = F.concat_ws(" ", F.lit("The"), (key * 37 + 100).cast("string"), F.lit("and"), (cust + 100 + key % 2).cast("string"))
    t = _t(spark, d, "orders").select("o_orderkey", src.alias("src"), out.alias("said"))
    return t.select("o_orderkey", F.array_join(evidence.lost_figures("src", "said"), ",").alias("lost"), F.array_join(evidence.invented_figures("src", "said"), ",").alias("invented"))


def _runs(key: str, frame: str, n: int, text: str = "text") -> str:
    return f"select distinct {key}, array_to_string(w[i:i + {n - 1}], ' ') as run from (select {key}, w, unnest(range(1, len(w) - {n - 2})) as i from (select {key}, regexp_extract_all(lower({text}), '[a-z0-9]+') as w from {frame}) where len(w) >= {n})"


@query(f"with b as ({_runs('item_id', 'benchmark', 5)}), s as ({_runs('doc_id', 'documents', 5)}), t as (select item_id, count(*) as total from b group by 1) select item_id, doc_id, count(*) / any_value(total) as ground from b join s using (run) join t using (item_id) group by item_id, doc_id having count(*) / any_value(total) >= 0.55")
def grounding_5gram(spark, d):
    return evidence.grounding_join(_t(spark, d, "benchmark"), _t(spark, d, "documents"), "item_id", "doc_id")


@query(f"""
with p as (select a.doc_id, a.text as m, b.text as w from documents a join documents b on b.doc_id = a.doc_id + 11),
ra as ({_runs('doc_id', 'p', 3, 'm')}), rb as ({_runs('doc_id', 'p', 3, 'w')}),
o as (select ra.doc_id, count(rb.run) / count(*) as ov from ra left join rb using (doc_id, run) group by 1),
q as (select doc_id, m, w, coalesce(ov, 1) as ov, length(regexp_replace(m, '^\\s+|\\s+$', '', 'g')) as lm, length(regexp_replace(w, '^\\s+|\\s+$', '', 'g')) as lw from p left join o using (doc_id))
select doc_id, case when lm = 0 then 'blank' when lw < 120 and lm > 400 then 'invented-on-blank-page' when lw < 120 then 'ok-sparse' when ov < 0.15 and length(m) > 2.0 * length(w) then 'drift' else 'ok' end as verdict, case when lm = 0 then case when lw >= 120 then length(w) else 0 end when lw < 120 and lm > 400 then 0 when lw >= 120 and ov < 0.15 and length(m) > 2.0 * length(w) then length(w) else length(m) end as chars from q""".replace("\\\\", "\\"))
def page_judge_3gram(spark, d):
    docs = _t(spark, d, "documents")
    b = docs.select((F.col("doc_id") - 11).alias("doc_id"), F.col("text").alias("w"))
    p = docs.join(b, "doc_id").select("doc_id", evidence.judge_page("text", "w").alias("j"))
    return p.select("doc_id", F.regexp_replace("j.verdict", r"-\d\.\d\d$", "").alias("verdict"), F.length("j.text").cast("long").alias("chars"))


@query(r"""
select conv_id, turn, said, case when said = 'unclear' or (said = 'dropped' and regexp_matches(text, '(?i)(the|les) [a-z]{3}\b')) or (said = 'confirmed' and regexp_matches(text, '(?i)ing[^.]{0,40}tion')) then said else 'unclear' end as verdict
from (select conv_id, turn, text, case turn % 4 when 0 then 'dropped' when 1 then 'confirmed' when 2 then 'unclear' else 'settled' end as said from conversations)""")
def verdict_support(spark, d):
    said = F.lit("settled")
    for k, word in enumerate(("dropped", "confirmed", "unclear")):
        said = F.when(F.col("turn") % 4 == k, word).otherwise(said)
    patterns = {"dropped": X.re2(r"(the|les) [a-z]{3}\b"), "confirmed": X.re2(r"ing[^.]{0,40}tion")}
    return _t(spark, d, "conversations").select("conv_id", "turn", said.alias("said"), "text").select("conv_id", "turn", "said", evidence.judge_verdict("said", "text", patterns)["verdict"].alias("verdict"))


@query(r"select role, count(*) as turns, count_if(regexp_matches(text, '(?i)(the (and|of) |en de la)')) as recitals from conversations group by 1")
def recital_filter(spark, d):
    return _t(spark, d, "conversations").groupBy("role").agg(F.count("*").alias("turns"), F.count_if(evidence.is_recital("text", X.re2("(the (and|of) |en de la)"))).alias("recitals"))


# ------------------------------------------------------------------ resolution and joins

@query("select conv_id, role, turn, length(text) as chars from (select *, row_number() over (partition by conv_id, role order by length(text) desc, turn) as r from conversations) where r = 1")
def best_record(spark, d):
    c = _t(spark, d, "conversations")
    return resolve.first_by(c, ["conv_id", "role"], F.length("text").desc(), "turn").select("conv_id", "role", "turn", F.length("text").cast("long").alias("chars"))


@query("select conv_id, role, turn, length(text) as chars from (select *, row_number() over (partition by conv_id, role order by length(text) % 2 desc, turn desc, length(text) desc) as r from conversations) where r = 1")
def best_finding(spark, d):
    c = _t(spark, d, "conversations").withColumns({"is_recital": F.length("text") % 2 == 0, "verified": F.lit(True), "window": F.col("turn"), "ordinal": F.lit(0)})
    return resolve.best_findings(c, ["conv_id", "role"]).select("conv_id", "role", "turn", F.length("text").cast("long").alias("chars"))


@query("select d.doc_id, d.source, l.quality, l.toxic from documents d left join labels l using (doc_id)")
def spine_left_join(spark, d):
    return _t(spark, d, "documents").select("doc_id", "source").join(_t(spark, d, "labels"), "doc_id", "left")


@query("select doc_id, quality from labels where doc_id not in (select doc_id from documents where lang = 'en')")
def orphans(spark, d):
    spine = _t(spark, d, "documents").where("lang = 'en'").select("doc_id")
    return resolve.orphans(_t(spark, d, "labels").select("doc_id", "quality"), spine, ["doc_id"])


@query("select d.doc_id, case when l.doc_id is not null then case when quality = 1 then 'verified' else 'dropped' end when f.doc_id is not null then 'failed' else 'silent' end as status from documents d left join labels l using (doc_id) left join (select doc_id from documents where doc_id % 10 = 3) f using (doc_id)")
def closed_world_defaults(spark, d):
    docs = _t(spark, d, "documents").select("doc_id")
    found = _t(spark, d, "labels").select("doc_id", F.when(F.col("quality") == 1, "verified").otherwise("dropped").alias("status"))
    return resolve.closed_world(docs, found, ["doc_id"], docs.where("doc_id % 10 = 3"))


@query("select doc_id, quality, toxic from labels where doc_id % 3 <> 0 union all select doc_id, 1 - quality, toxic from labels where doc_id % 3 = 0")
def merge_upsert(spark, d):
    old = _t(spark, d, "labels")
    new = old.where("doc_id % 3 = 0").select("doc_id", (1 - F.col("quality")).alias("quality"), "toxic")
    return resolve.upsert(old, new, ["doc_id"])


@query("select count_if(a and b) as both, count_if(a and not b) as only_a, count_if(b and not a) as only_b from (select d.doc_id is not null as a, l.doc_id is not null as b from (select doc_id from documents where lang = 'en') d full join labels l using (doc_id))")
def agreement_metrics(spark, d):
    return resolve.agreement(_t(spark, d, "documents").where("lang = 'en'"), _t(spark, d, "labels"), ["doc_id"])


@query("select event_id, (props::json->>'k')::bigint as k from events where (props::json->>'k')::bigint between 10 and 60")
def json_items(spark, d):
    k = F.from_json("props", "k bigint", {"allowUnquotedControlChars": "true"})["k"]
    return _t(spark, d, "events").select("event_id", k.alias("k")).where("k between 10 and 60")


# ------------------------------------------------------------------ register and checks

_REGISTER = f"""
select s.doc_id as case_id, s.id as param_id, substr(s.text, 1, {V.MAX_CELL}) as notice, coalesce(case when l.quality = 1 then 'Reply of ' || l.doc_id::varchar end, 'No reply') as reply, coalesce(case when l.toxic = 1 then 'confirmed' when l.toxic = 0 then 'dropped' end, 'No finding') as finding
from ({_SECTIONS}) s left join labels l using (doc_id)"""


def _register(spark, d):
    """Labels are partial answers: a good document replies, a toxic one is confirmed, another labelled one dropped.

    Cells hold as much as a cell of a workbook does, in the operator and in its SQL.
    """
    from ..operators import register as operator

    s = _sections(spark, d).withColumnRenamed("doc_id", "case_id").persist()  # joined four times
    said = s.select("case_id", "param_id").join(_t(spark, d, "labels").withColumnRenamed("doc_id", "case_id"), "case_id", "left")
    reply = F.when(F.col("quality") == 1, F.concat(F.lit("Reply of "), F.col("case_id").cast("string")))
    finding = F.when(F.col("toxic") == 1, "confirmed").when(F.col("toxic") == 0, "dropped")

    def answers(words):
        status = F.when(words.isNotNull(), "verified").otherwise("silent")
        return said.select("case_id", "param_id", status.alias("status"), words.alias("text"), F.lit(None).cast(evidence.TABLES).alias("tables"), F.lit(None).cast("string").alias("fallback_text"))

    notices = s.select("case_id").distinct().withColumn("trade_name", F.lit(""))
    return operator.register(s, notices, answers(reply), answers(finding)).select("case_id", "param_id", "notice", "reply", "finding")


@query(_REGISTER)
def register(spark, d):
    return _register(spark, d)


@query(f"""
select v.id as param_id, count(r.case_id) as companies, count_if(r.case_id is not null and reply <> 'No reply') as replies, count_if(r.case_id is not null and reply = 'No reply') as no_reply, count_if(r.case_id is not null and finding <> 'No finding') as findings, count_if(r.case_id is not null and finding = 'No finding') as no_finding
from (select 'H' || range::varchar as id from range(1, 22)) v left join ({_REGISTER}) r on r.param_id = v.id group by 1""")
def contents_tally(spark, d):
    from ..operators.register import contents

    dim = spark.range(1, 22).select(F.concat(F.lit("H"), F.col("id").cast("string")).alias("param_id"), F.col("id").alias("position"), F.lit("").alias("sheet"), F.lit("").alias("title"))
    return contents(_register(spark, d), dim).select("param_id", "companies", "replies", "no_reply", "findings", "no_finding")


@query(f"""
with s as ({_SECTIONS}), x as (select doc_id, id, start_line, end_line, case when doc_id % 5 = 0 then text || ' zzz' when doc_id % 7 = 0 then ' ' else text end as text from s), e as ({_ENDS})
select "check", case_id, param_id from (
select 'verbatim' as "check", x.doc_id::varchar as case_id, id as param_id from x join documents d using (doc_id) where not contains(regexp_replace(d.text, '\\s+', '', 'g'), regexp_replace(x.text, '\\s+', '', 'g'))
union all select 'inside body', x.doc_id::varchar, id from x join e using (doc_id) where start_line > body_end or end_line > body_end
union all select 'not empty', doc_id::varchar, id from x where trim(text) = ''
union all select 'known parameter', doc_id::varchar, id from x where id = 'H3')""".replace("\\\\", "\\"))
def quality_checks(spark, d):
    s = _sections(spark, d).withColumnRenamed("doc_id", "case_id")
    s = s.withColumn("text", F.when(F.col("case_id") % 5 == 0, F.concat("text", F.lit(" zzz"))).when(F.col("case_id") % 7 == 0, " ").otherwise(F.col("text")))
    docs = _t(spark, d, "documents").select(F.col("doc_id").alias("case_id"), "text")
    known = [f"H{k}" for k in range(1, 13) if k != 3]
    return checks.notice_checks(s, docs, _ends(spark, d).withColumnRenamed("doc_id", "case_id"), known).drop("detail")


@query(f"with s as ({_SECTIONS}), n as (select count(distinct doc_id) as cases, count(*) as cells from s), r as (select 'cases' as measure, cases as value, floor(cases * 2 * 0.9)::bigint as floor from n union all select 'cells', cells, floor((cells - 1) * 0.9)::bigint from n) select measure, value, floor, value >= floor as ok from r")
def coverage_floor(spark, d):
    now = checks.coverage(_sections(spark, d).withColumnRenamed("doc_id", "case_id"))
    best = now.select((F.col("cases") * 2).alias("cases"), (F.col("cells") - 1).alias("cells"))
    return checks.coverage_floor(now, best)


# ------------------------------------------------------------------ whole operators

@query(r"""
select event_id, 'A' || event_id::varchar as id, 2 as line_from, 10 as line_to, case when event_id % 3 = 2 then '' else 'x ' || event_type end as text, case when event_id % 3 = 2 then 1 else 0 end as n_tables, case when event_id % 3 = 2 then 1 else 0 end as dropped_rows, 0 as ordinal from events""")
def answer_items(spark, d):
    """Answers in three forms: well-formed, with a comma too many, and with a table of which one row does not fit."""
    number = F.col("event_id").cast("string")
    head = F.concat(F.lit('said: {"items": [{"id": " a'), number, F.lit('", "lines": [12, "2"], '))
    words = F.concat(F.lit('"text": " x '), F.col("event_type"), F.lit(' "'))
    form = F.when(F.col("event_id") % 3 == 0, F.concat(head, words, F.lit('}, {"id": "B1", "text": "not asked"}]}'))).when(F.col("event_id") % 3 == 1, F.concat(head, words, F.lit(',}, {"id": "B1", "text": "not asked"},]}')))
    table = F.concat(head, F.lit('"tables": [{"title": "t", "headers": ["a", "b"], "rows": [["1", 2], ["x"]]}, {"headers": [], "rows": []}]}]}'))
    answers = _spread(spark, d, "events", "event_id", "event_type").select("event_id", F.coalesce(form, table).alias("response"), F.array(F.concat(F.lit("A"), number)).alias("allowed"), F.lit(10).alias("n_lines"))
    return items.parse_items(answers).select("event_id", "id", "line_from", "line_to", "text", F.size("tables").alias("n_tables"), "dropped_rows", "ordinal")


@query("select conv_id, role, turn, length(text) as chars from (select *, row_number() over (partition by conv_id, role order by length(text) % 2 desc, length(text) desc, turn % 2, turn) as r from conversations) where r = 1")
def best_reply(spark, d):
    c = _t(spark, d, "conversations").withColumns({"verified": F.length("text") % 2 == 1, "file_rank": F.col("turn") % 2, "window": F.col("turn"), "ordinal": F.lit(0)})
    return resolve.best_replies(c, ["conv_id", "role"]).select("conv_id", "role", "turn", F.length("text").cast("long").alias("chars"))


@query("""
with f as (select source as case_id, case doc_id % 3 when 0 then 'scn' when 1 then 'reply' else 'order' end as role, doc_id::varchar || '.pdf' as file, n_chars as bytes from documents where doc_id % 10 <> 9)
select case_id, role, file, bytes, row_number() over (partition by case_id, role order by bytes desc, file) as size_rank from f""")
def inventory_files(spark, d):
    """Documents as files of three roles; every tenth is no PDF."""
    n = F.col("doc_id")
    folder = F.element_at(F.array(*map(F.lit, V.ROLE_NAMES.values())), (n % 3 + 1).cast("int"))
    file = F.concat(n.cast("string"), F.when(n % 10 == 9, ".txt").otherwise(".pdf"))
    f = _t(spark, d, "documents").select(F.col("source").alias("folder"), folder.alias("dir"), file.alias("file"), F.col("n_chars").alias("bytes"), F.lit(1).alias("pages"))
    return files.inventory(f).where("file is not null").select("case_id", "role", "file", "bytes", F.col("size_rank").cast("long").alias("size_rank"))


@query("""
select d.doc_id as case_id, 'H' || (d.doc_id % 5)::varchar as param_id, d.lang as trade_name, substr(d.text, 1, 30000) as notice,
  case when l.quality = 1 then 'Reply of ' || l.doc_id::varchar when l.quality = 0 and l.doc_id % 2 = 0 then 'lines of ' || l.doc_id::varchar else 'No reply' end as reply,
  case when l.toxic = 0 then 'cleared' || chr(10) || chr(10) || 'T' || chr(10) || 'k' || chr(10) || '-' || chr(10) || (l.doc_id % 10)::varchar else 'No finding' end as finding,
  case when l.quality = 1 then 'verified' when l.quality = 0 and l.doc_id % 2 = 0 then 'fallback' when l.quality = 0 then 'dropped' end as reply_status
from documents d left join labels l using (doc_id)""")
def register_rows(spark, d):
    """The register itself: verified answers, answers that fall back to lines, dropped and missing ones, and a table in a cell."""
    from ..operators.register import register as whole

    docs = _t(spark, d, "documents")
    param = F.concat(F.lit("H"), (F.col("doc_id") % 5).cast("string")).alias("param_id")
    case, number = F.col("doc_id").alias("case_id"), F.col("doc_id").cast("string")
    labels = _t(spark, d, "labels")
    status = F.when(F.col("quality") == 1, "verified").when(F.col("doc_id") % 2 == 0, "fallback").otherwise("dropped")
    replies = labels.where("quality in (0, 1)").select(case, param, status.alias("status"), F.concat(F.lit("Reply of "), number).alias("text"), F.lit(None).cast(evidence.TABLES).alias("tables"), F.concat(F.lit("lines of "), number).alias("fallback_text"))
    table = F.array(F.struct(F.lit("T").alias("title"), F.array(F.lit("k")).alias("headers"), F.array(F.array((F.col("doc_id") % 10).cast("string"))).alias("rows")))
    findings = labels.where("toxic in (0, 1)").select(case, param, F.when(F.col("toxic") == 0, "verified").otherwise("dropped").alias("status"), F.lit("cleared").alias("text"), table.alias("tables"), F.lit(None).cast("string").alias("fallback_text"))
    r = whole(docs.select(case, param, "text"), docs.select(case, F.col("lang").alias("trade_name")), replies, findings)
    return r.drop("finding_status")


@query("""
with t as (select o_orderkey, o_orderkey::varchar as a, o_custkey::varchar as b, o_orderstatus as c from orders),
w as (select *, greatest(3, length(a)) as wa, greatest(4, length(b), length(c)) as wb from t)
select o_orderkey, 'Orders' || chr(10) || rtrim(rpad('key', wa::int, ' ') || '  ' || rpad('cust', wb::int, ' ')) || chr(10) || repeat('-', wa) || '  ' || repeat('-', wb) || chr(10) || rtrim(rpad(a, wa::int, ' ') || '  ' || rpad(b, wb::int, ' ')) || chr(10) || rtrim(rpad('', wa::int, ' ') || '  ' || rpad(c, wb::int, ' ')) as cell from w""")
def table_cells(spark, d):
    rows = F.array(F.array(F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")), F.array(F.lit(""), F.col("o_orderstatus")))
    t = F.struct(F.lit("Orders").alias("title"), F.array(F.lit("key"), F.lit("cust")).alias("headers"), rows.alias("rows"))
    return _t(spark, d, "orders").select("o_orderkey", t.alias("t")).select("o_orderkey", X.render_table("t").alias("cell"))


@query("select count(*) as cells, count_if(quality = 1 or doc_id % 2 = 0) as answered, count_if(quality = 1 or doc_id % 2 = 0) / count(*) as share, count_if(quality <> 1 and doc_id % 2 = 0) as unverified from labels where quality in (0, 1)")
def reply_summary(spark, d):
    status = F.when(F.col("quality") == 1, "verified").when(F.col("doc_id") % 2 == 0, "fallback").otherwise("dropped")
    return checks.reply_summary(_t(spark, d, "labels").where("quality in (0, 1)").select(status.alias("status")))


@query("select v.verdict, count(c.turn) as findings from (values ('dropped'), ('confirmed'), ('partly confirmed'), ('unclear')) v(verdict) left join (select turn, case turn % 4 when 0 then 'dropped' when 1 then 'confirmed' when 2 then 'unclear' else 'settled' end as verdict from conversations) c using (verdict) group by 1")
def verdict_histogram(spark, d):
    said = F.element_at(F.array(*map(F.lit, ("dropped", "confirmed", "unclear", "settled"))), (F.col("turn") % 4 + 1).cast("int"))
    return checks.verdict_counts(_t(spark, d, "conversations").select(said.alias("verdict")))


# ------------------------------------------------------------------ pages, stored answers, the gate

_PAGE_READS = f"""select *, length(regexp_replace(m, '^\\s+|\\s+$', '', 'g')) as lm, length(regexp_replace(w, '^\\s+|\\s+$', '', 'g')) as lw from (
select doc_id, page, k, case when (doc_id + page) % 5 = 0 then '' else t end as w, case when k = 1 then '<<BLANK>>' when k = 3 then repeat('made up words of ' || doc_id::varchar || ' ', 400) when k > 3 then t || ' seen' end as m
from (select doc_id, i // 8 + 1 as page, (doc_id + (i // 8 + 1) * 3) % 7 as k, string_agg(line, chr(10) order by i) as t from ({_LINES}) group by all))""".replace("\\\\", "\\")
_JUDGED = f"""
with p as ({_PAGE_READS}), ra as ({_runs('doc_id, page', 'p', 3, 'm')}), rb as ({_runs('doc_id, page', 'p', 3, 'w')}),
o as (select doc_id, page, count(rb.run) / count(*) as ov from ra left join rb using (doc_id, page, run) group by 1, 2),
q as (select p.*, coalesce(ov, 1) as ov, lm = 0 or m = '<<BLANK>>' as empty from p left join o using (doc_id, page)),
v as (select *, case when k = 2 then 'model-failed-missing' when k = 0 then 'model-failed-TimeoutError' when empty then 'blank' when lw < 120 and lm > 400 then 'invented-on-blank-page' when lw < 120 then 'ok-sparse' when ov < 0.15 and length(m) > 2.0 * length(w) then 'drift' else 'ok' end as verdict from q),
j as (select doc_id, page, verdict, case when verdict like 'model-failed%' or verdict = 'drift' then w when verdict = 'blank' then case when lw >= 120 then w else '' end when verdict like 'invented%' then '' else m end as text from v)"""


def _judged_pages(spark, d):
    """Eight lines are a page. The witness misses a fifth of the pages; the model fails, answers blank, says nothing, makes words up, or reads."""
    from ..operators import pages

    docs = _t(spark, d, "documents").select("doc_id", X.lines("text").alias("ls"))
    page = docs.select("doc_id", F.size("ls").alias("n"), "ls").select("doc_id", F.posexplode(F.transform(F.sequence(F.lit(0), F.greatest(F.size("ls"), F.lit(1)) - 1, F.lit(8)), lambda at: F.when(at < F.size("ls"), F.array_join(F.slice("ls", at + 1, 8), "\n")))).alias("p", "t"))
    page = page.where("t is not null").select("doc_id", (F.col("p") + 1).alias("page"), "t").withColumn("k", (F.col("doc_id") + F.col("page") * 3) % 7)
    witness = page.select("doc_id", "page", F.when((F.col("doc_id") + F.col("page")) % 5 != 0, F.col("t")).alias("text"))
    made_up = F.repeat(F.concat(F.lit("made up words of "), F.col("doc_id").cast("string"), F.lit(" ")), F.lit(400))
    said = F.when(F.col("k") == 1, V.BLANK).when(F.col("k") == 3, made_up).when(F.col("k") > 3, F.concat("t", F.lit(" seen")))
    model = page.where("k <> 2").select("doc_id", "page", said.alias("response"), F.when(F.col("k") == 0, "TimeoutError: slow").alias("error"))
    return pages.judged(model, witness, ["doc_id"])


@query(f"{_JUDGED} select doc_id, page, verdict, length(text) as chars from j")
def page_verdicts(spark, d):
    shown = F.regexp_replace("verdict", r"-\d\.\d\d$", "")
    return _judged_pages(spark, d).select("doc_id", F.col("page").cast("long").alias("page"), shown.alias("verdict"), F.length("text").cast("long").alias("chars"))


@query(f"""{_JUDGED} select doc_id, count(*) as pages, md5(coalesce(string_agg(text, chr(10) order by page) filter (regexp_matches(text, '\\S')), '')) as digest, coalesce(string_agg('p' || page::varchar || ':' || verdict, ',' order by page) filter (not starts_with(verdict, 'ok')), '') as caught from j group by 1""".replace("\\\\", "\\"))
def page_texts(spark, d):
    from ..operators import pages

    r = pages.reassembled(_judged_pages(spark, d), ["doc_id"])
    return r.select("doc_id", F.col("pages").cast("long").alias("pages"), F.md5(F.encode("text", "utf-8")).alias("digest"), F.regexp_replace(F.array_join("caught", ","), r"-\d\.\d\d", "").alias("caught"))


def _answers(spark, d):
    """Turns are answers to the request that a conversation and a role make; every third one failed."""
    c = _t(spark, d, "conversations")
    bad = F.col("turn") % 3 == 0
    return c.select(F.concat_ws("/", F.col("conv_id").cast("string"), "role").alias("request_id"), F.when(~bad, F.col("text")).alias("response"), F.when(bad, "TimeoutError: slow").alias("error"), F.col("turn").cast("long").alias("asked_at"))


_BEST_ANSWERS = "select * from (select conv_id::varchar || '/' || role as request_id, case when turn % 3 <> 0 then text end as response, turn % 3 = 0 as failed, turn as asked_at, row_number() over (partition by conv_id, role order by turn % 3 = 0, turn desc) as r from conversations) where r = 1"


@query(f"select request_id, length(response) as chars, failed, asked_at from ({_BEST_ANSWERS})")
def best_answers(spark, d):
    from ..sources import completions

    return completions.best_answers(_answers(spark, d)).select("request_id", F.length("response").cast("long").alias("chars"), F.col("error").isNotNull().alias("failed"), F.col("asked_at").cast("int").alias("asked_at"))


@query(f"select c.conv_id::varchar || '/' || r.role as request_id from (select distinct conv_id from conversations) c, (values ('user'), ('assistant'), ('system')) r(role) where c.conv_id::varchar || '/' || r.role not in (select request_id from ({_BEST_ANSWERS}) where not failed)")
def pending_requests(spark, d):
    from ..sources import completions

    roles = F.explode(F.array(*map(F.lit, ("user", "assistant", "system"))))
    asked = _t(spark, d, "conversations").select("conv_id").distinct().select(F.col("conv_id").cast("string").alias("conv_id"), roles.alias("role"))
    return completions.pending(asked.select(F.concat_ws("/", "conv_id", "role").alias("request_id")), completions.best_answers(_answers(spark, d)))


@query(f"""
with v as ({SQL['quality_checks']}), n as (select unnest(['verbatim', 'inside body', 'not empty', 'known parameter', 'verdict']) as "check"),
e as (select "check", string_agg(row, ', ' order by row) as examples from (select "check", case_id || '/' || param_id as row, row_number() over (partition by "check" order by case_id || '/' || param_id) as r from v) where r <= 4 group by 1)
select n."check", count(v.case_id) as violations, count(v.case_id) = 0 as ok, coalesce(any_value(e.examples), '') as examples from n left join v using ("check") left join e using ("check") group by 1""")
def gate_report(spark, d):
    from . import gate

    found = quality_checks(spark, d).withColumn("detail", F.lit(""))
    return gate.report(found, ["verbatim", "inside body", "not empty", "known parameter", "verdict"]).select("check", "violations", "ok", F.array_join("examples", ", ").alias("examples"))


# ------------------------------------------------------------------ not expressible in SQL

@query()
def fuzzy_heading(spark, d):
    """Squashed lines that are a repeated line but for a letter (a sequence-matcher ratio)."""
    n = _lines(spark, d).groupBy(X.squash("line").alias("sq")).agg(F.count("*").alias("c")).where(F.length("sq") >= V.FUZZY_KEY)
    keys = [(r["sq"], f"H{k}") for k, r in enumerate(n.orderBy(F.col("c").desc(), "sq").limit(12).collect(), 1)]
    near = _lines(spark, d).select(F.concat(F.substring(X.squash("line"), 1, 14), F.substring(X.squash("line"), 16, 200)).alias("sq"))
    return segment.fuzzy_ids(near, sorted(keys, key=lambda k: -len(k[0])))


@query()
def salvage_json(spark, d):
    """Items of answers that were cut off, one of four whole."""
    e = _spread(spark, d, "events", "event_id", "event_type")
    one = F.concat(F.lit('{"id": "a'), F.col("event_id").cast("string"), F.lit('", "lines": [4, "2"], "text": "x'), F.col("event_type"), F.lit('",}'))
    raw = F.concat(F.lit('{"items": ['), one, F.lit(", "), F.when(F.col("event_id") % 4 == 0, F.concat(one, F.lit("]}"))).otherwise('{"id": "b'))
    answers = e.select("event_id", raw.alias("response"), F.array(F.concat(F.lit("A"), F.col("event_id").cast("string"))).alias("allowed"), F.lit(10).alias("n_lines"))
    return items.parse_items(answers).select("event_id", "id", "line_from", "line_to", "text", "ordinal")


@query()
def trade_name(spark, d):
    """Names in the head of documents under three layouts."""
    w = F.initcap(F.element_at(X.words("text"), 1))
    docs = _t(spark, d, "documents").where(F.size(X.words("text")) > 0)
    head = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("Name : Tvl. "), w, F.lit(" Mills, Road\n"))).when(F.col("doc_id") % 3 == 1, F.concat(w, F.lit(" Traders\nTrade Name\n"))).otherwise(F.concat(F.lit("Sub : Act 2017 - Tvl. "), w, F.lit(" - Scrutiny\n")))
    return segment.trade_names(docs.select("doc_id", F.concat(head, F.col("text")).alias("text")), "doc_id")

"""Queries over spool text, report containers, index files, resources, manifests and incremental ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliant.functions import text as tx
from foliant.operators import aggregates as ag
from foliant.operators import containers as ct
from foliant.operators import filters as fl
from foliant.operators import generators as gen
from foliant.operators import mapindex as mi
from foliant.operators import mapsearch as ms
from foliant.operators import resources as rs
from foliant.operators import search as se
from foliant.operators import sets as st
from foliant.operators import spool as sp
from foliant.operators import textindex as ti
from foliant.operators import windows as wi
from foliant.plans.encode import container_bytes, index_bytes
from foliant.plans.registry import query, spread, table, view
from foliant.scale import cut_lineage, scratch_path
from foliant.sources import files as fs
from foliant.sources.pages import scan_pages
from foliant.sources.ranges import list_files, write_files
from foliant.streaming import ingest

# --- spool text --------------------------------------------------------------------------------

# documents as spool files: every seventh line gets a form feed in front, every third file ASA control characters
_LINES = """SELECT file, line_no, CASE WHEN file % 3 = 0 THEN (CASE WHEN line_no % 5 = 1 THEN '1 ' WHEN line_no % 5 = 3 THEN '0 ' ELSE '  ' END) || t
   WHEN line_no % 7 = 0 THEN chr(12) || t ELSE t END AS text FROM (SELECT doc_id AS file, CAST(i AS BIGINT) AS line_no, list_extract(l, i) AS t FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i
   FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents) AS a) AS b) AS c"""


def _lines(spark, sf):
    docs = spread(table(spark, sf, "documents").select(F.col("doc_id").alias("file"), "text"), "file")
    rows = fs.lines_of_text(docs, ["file"])
    asa = F.when(F.col("line_no") % 5 == 1, "1 ").when(F.col("line_no") % 5 == 3, "0 ").otherwise("  ")
    text = (
        F.when(F.col("file") % 3 == 0, F.concat(asa, "text")).when(F.col("line_no") % 7 == 0, F.concat(F.lit("\f"), "text")).otherwise(F.col("text"))
    )
    return rows.withColumn("text", text)


_ASA = f"SELECT file, bool_or(line_no <= 5 AND substr(text, 1, 1) IN ('1', '0', '-', ' ') AND substr(text, 2, 1) = ' ') AS asa FROM ({_LINES}) AS l GROUP BY file"
_PAGED = f"""SELECT l.file, line_no, text, asa, CAST(1 + sum(CASE WHEN line_no > 1 AND (substr(text, 1, 1) = chr(12) OR (asa AND substr(text, 1, 1) = '1')) THEN 1 ELSE 0 END)
   OVER (PARTITION BY l.file ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS page FROM ({_LINES}) AS l JOIN ({_ASA}) AS a ON a.file = l.file"""


@query("lines_of_text", f"SELECT file, line_no, text FROM ({_LINES}) AS l")
def _(spark, sf):
    return _lines(spark, sf)


@query("scan_spool", "SELECT text, count(*) AS copies FROM (SELECT unnest(string_split(text, chr(10))) AS text FROM documents) AS l GROUP BY text")
def _(spark, sf):
    path = scratch_path(spark, "spool")
    docs = table(spark, sf, "documents").select("doc_id", "text")
    fs.lines_of_text(docs, ["doc_id"]).select("text").write.text(path)
    rows = fs.scan_spool(spark, path)
    numbered = rows.groupBy("path").agg(F.count("*").alias("n"), F.max("line_no").alias("top"), F.count_distinct("line_no").alias("d"))
    broken = numbered.filter("n <> top OR n <> d").agg(F.count("*")).scalar()
    return rows.groupBy("text").agg((F.count("*") + broken).alias("copies"))


@query("detect_control", _ASA)
def _(spark, sf):
    return sp.detect_control(_lines(spark, sf))


@query(
    "detect_spool_format",
    f"SELECT file, CASE WHEN regexp_matches(head, '^(..)*0C') THEN 'form_feed' WHEN head LIKE '31%' THEN 'asa' ELSE 'form_feed' END AS format FROM (SELECT file, "
    f"left(hex(encode(string_agg(text, chr(10) ORDER BY line_no))), 200) AS head FROM ({_LINES}) AS l GROUP BY file) AS h",
)
def _(spark, sf):
    return sp.detect_spool_format(_lines(spark, sf))


@query(
    "paginate_dynamic",
    f"SELECT file, line_no, page, line_no - min(line_no) OVER (PARTITION BY file, page) AS line_in_page FROM ({_PAGED}) AS p",
)
def paginate_dynamic(spark, sf):
    return sp.paginate(_lines(spark, sf)).select("file", "line_no", "page", "line_in_page")


@query("paginate_fixed", f"SELECT file, line_no, CAST(floor((line_no - 1) / 66) + 1 AS BIGINT) AS page, (line_no - 1) % 66 AS line_in_page FROM ({_LINES}) AS l")
def _(spark, sf):
    return sp.paginate(_lines(spark, sf), 66).select("file", "line_no", "page", "line_in_page")


@query(
    "display_text",
    f"SELECT file, line_no, CASE WHEN substr(text, 1, 1) = chr(12) OR (asa AND substr(text, 1, 1) IN ('1', '0', '-', '+', ' ')) THEN substr(text, 2) ELSE text END AS text FROM ({_PAGED}) AS p",
)
def _(spark, sf):
    rows = sp.paginate(_lines(spark, sf))
    return rows.select("file", "line_no", tx.display_text(F.col("text"), F.col("asa")).alias("text"))


_HITS = """SELECT file, line_no, unnest(list_transform(range(1, len(s)), lambda i: CAST(list_sum(list_transform(list_slice(s, 1, i), lambda p: length(p))) + (i - 1) * 2 AS BIGINT))) AS match_start
   FROM (SELECT file, line_no, string_split(lower(text), 'on') AS s FROM (SELECT * FROM (LINES) AS l) AS m) AS z WHERE len(s) > 1""".replace("LINES", _LINES)


@query("search_lines", _HITS)
def search_lines(spark, sf):
    return sp.search_lines(_lines(spark, sf), " oN ").select("file", "line_no", "match_start")


@query(
    "search_lines_case",
    _HITS.replace("lower(text), 'on'", "text, 'On'"),
)
def _(spark, sf):
    return sp.search_lines(_lines(spark, sf), "On", case_sensitive=True).select("file", "line_no", "match_start")


def text_index(spark, sf):
    """Text index of all documents' lines in the shared folder."""
    path = scratch_path(spark, "text-index")
    ti.build_text_index(sp.paginate(_lines(spark, sf)), path)
    return path


@query("search_lines_indexed", _HITS.replace("'on'", "'ation'").replace("* 2 AS", "* 5 AS"))
def _(spark, sf):
    return ti.search_text_index(spark, text_index(spark, sf), " aTion ").select("file", "line_no", "match_start")


@query(
    "page_context",
    f"""WITH p AS ({_PAGED}), q AS (SELECT *, line_no - min(line_no) OVER (PARTITION BY file, page) AS lip, CASE WHEN line_no % 9 = 2 THEN 'BRANCH : ' || CAST(file AS VARCHAR) || 'x  ' || text ELSE text END AS t FROM p)
    SELECT h.file, h.line_no, trim(substr(trim(regexp_extract(substr(b.t, strpos(b.t, 'BRANCH'), 15), ':(.*)$', 1)), 1, 5)) AS context FROM (SELECT file, line_no, page FROM p WHERE contains(text, 'th')) AS h
    LEFT JOIN (SELECT file, page, arg_min(t, line_no) AS t FROM q WHERE lip < 10 AND (contains(t, 'BRANCH:') OR contains(t, 'BRANCH :')) GROUP BY file, page) AS b ON b.file = h.file AND b.page = h.page""",
)
def _(spark, sf):
    paged = sp.paginate(_lines(spark, sf))
    hits = paged.filter(F.col("text").contains("th")).select("file", "line_no", "page")
    label = F.concat(F.lit("BRANCH : "), F.col("file").cast("string"), F.lit("x  "), "text")
    marked = paged.withColumn("text", F.when(F.col("line_no") % 9 == 2, label).otherwise(F.col("text")))
    return sp.page_context(hits, marked).select("file", "line_no", "context")


_POSITIONS = f"""WITH p AS (SELECT *, line_no - min(line_no) OVER (PARTITION BY file, page) AS line_in_page, sum(strlen(text) + 1) OVER (PARTITION BY file ORDER BY line_no) - strlen(text) - 1 AS byte_offset FROM ({_PAGED}) AS x)
    SELECT file, value, arg_min(line_no, line_no) AS line_no, arg_min(page, line_no) AS page, arg_min(line_in_page, line_no) AS line_in_page, CAST(arg_min(byte_offset, line_no) AS BIGINT) AS byte_offset
    FROM p JOIN (VALUES ('ation'), ('the'), ('eau'), ('und der')) AS v(value) ON contains(text, value) GROUP BY file, value"""


@query("spool_positions", _POSITIONS)
def _(spark, sf):
    return sp.spool_positions(["ation", "the", "eau", "und der"], sp.paginate(_lines(spark, sf)))


@query("spool_positions_indexed", _POSITIONS)
def _(spark, sf):
    return ti.positions_from_index(spark, text_index(spark, sf), ["ation", "the", "eau", "und der"])


@query(
    "spool_positions_many",
    _POSITIONS.replace("(VALUES ('ation'), ('the'), ('eau'), ('und der')) AS v(value)", "(SELECT DISTINCT substr(text, 1, 12) AS value FROM benchmark) AS v"),
)
def _(spark, sf):
    # the asked values are a list of the caller's, here the openings of all benchmark items
    values = [r[0] for r in table(spark, sf, "benchmark").select(F.substring("text", 1, 12)).distinct().collect()]
    return sp.spool_positions(values, sp.paginate(_lines(spark, sf)))


_LINE_DEF = "SELECT item_id % 4 AS STRUCTURE_DEF_ID, item_id AS LINE_ID, 'LINE ' || CAST(item_id AS STRING) AS NAME, regexp_replace(regexp_replace(substr(text, 1, 30), '[a-zA-Z]', 'A'{g}), '[0-9]', '9'{g}) || '*  ' AS TEMPLATE FROM {benchmark}"
_STRUCTURE = "doc_id % 4"


def _line_def(spark, sf):
    return spark.sql(_LINE_DEF.replace("{g}", ""), benchmark=table(spark, sf, "benchmark"))


def _pages_by_structure(spark, sf):
    return spread(table(spark, sf, "documents"), "doc_id").select(F.col("doc_id").alias("file"), F.lit(1).cast("long").alias("page"), (F.col("doc_id") % 4).alias("STRUCTURE_DEF_ID"), "text")


_BEST = f"""
WITH d AS (SELECT STRUCTURE_DEF_ID, LINE_ID, rtrim(regexp_replace(rtrim(TEMPLATE), '[*]$', '')) AS t FROM ({_LINE_DEF.replace("{g}", ", 'g'").replace("{benchmark}", "benchmark")}) AS q),
l AS (SELECT doc_id AS file, doc_id % 4 AS s, i AS line_no, list_extract(ls, i) AS text FROM (SELECT doc_id, string_split(text, chr(10)) AS ls, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents) AS x),
u AS (SELECT DISTINCT s, text FROM l),
c AS (SELECT u.s, u.text, d.LINE_ID, length(d.t) AS n, substr(d.t, k, 1) AS tc, CASE WHEN k > length(u.text) THEN ' ' ELSE substr(u.text, k, 1) END AS ch FROM u JOIN d ON d.STRUCTURE_DEF_ID = u.s, range(1, 41) AS r(k) WHERE k <= length(d.t)),
w AS (SELECT s, text, LINE_ID, max(n) AS n, sum(CASE tc WHEN 'A' THEN 10 WHEN '9' THEN 10 WHEN ' ' THEN 5 ELSE 30 END) AS total,
  sum(CASE tc WHEN 'A' THEN CASE WHEN regexp_full_match(ch, '[\\p{{L}}]') THEN 10 WHEN regexp_full_match(ch, '[0-9]') THEN 7 WHEN contains('*#@&()', ch) THEN 5 WHEN ch = ' ' THEN 3 ELSE 0 END
     WHEN '9' THEN CASE WHEN regexp_full_match(ch, '[0-9]') THEN 10 WHEN regexp_full_match(ch, '[\\p{{L}}]') THEN 7 WHEN contains('*#.,-+', ch) THEN 5 WHEN ch = ' ' THEN 3 ELSE 0 END
     WHEN ' ' THEN CASE WHEN ch = ' ' THEN 5 ELSE 1 END ELSE CASE WHEN ch = tc THEN 30 ELSE 0 END END) AS earned FROM c GROUP BY s, text, LINE_ID),
v AS (SELECT *, CASE WHEN rtrim(text) = '' AND n > 10 THEN 0 ELSE earned * 1.0 / total END AS score FROM w),
b AS (SELECT s, text, LINE_ID FROM (SELECT *, row_number() OVER (PARTITION BY s, text ORDER BY score DESC, LINE_ID) AS rn FROM v WHERE score > 0.55) AS z WHERE rn = 1)
SELECT l.file, l.line_no, b.LINE_ID, l.text FROM l LEFT JOIN b ON b.s = l.s AND b.text = l.text"""


@query("classify_lines", f"SELECT file, line_no, LINE_ID FROM ({_BEST}) AS x")
def classify_lines(spark, sf):
    return sp.classify_lines(_pages_by_structure(spark, sf), _line_def(spark, sf)).select("file", "line_no", "LINE_ID")


@query(
    "extract_fields",
    f"SELECT file, line_no, LINE_ID, FIELD_ID, CASE WHEN length(text) <= st THEN '' ELSE trim(substr(text, st + 1, en - st + 1), ' ' || chr(9) || chr(13)) END AS value FROM ({_BEST}) AS x "
    "JOIN (VALUES (1, 0, 5), (2, 6, 14), (3, 25, 60)) AS f(FIELD_ID, st, en) ON true WHERE LINE_ID IS NOT NULL",
)
def _(spark, sf):
    line_def = _line_def(spark, sf)
    cols = F.array(*[F.struct(F.lit(i).alias("FIELD_ID"), F.lit(a).alias("START_COLUMN"), F.lit(b).alias("END_COLUMN")) for i, a, b in ((1, 0, 5), (2, 6, 14), (3, 25, 60))])
    fields = line_def.select("STRUCTURE_DEF_ID", "LINE_ID", F.explode(cols).alias("f")).select("STRUCTURE_DEF_ID", "LINE_ID", "f.*", F.lit("F").alias("NAME"))
    rows = sp.extract_fields(sp.classify_lines(_pages_by_structure(spark, sf), line_def), fields)
    return rows.select("file", "line_no", "LINE_ID", "FIELD_ID", "value")


@query(
    "cut_field",
    "SELECT p_partkey, trim(substr(p_name, p_size % 8 + 1, 5)) AS value FROM part",
)
def _(spark, sf):
    start = F.col("p_size") % 8
    return table(spark, sf, "part").select("p_partkey", tx.cut_field(F.col("p_name"), start, start + 4).alias("value"))


# --- scalar functions on names and dates ---------------------------------------------------------


@query(
    "scalar_names_and_years",
    """SELECT o_orderkey, 'f' || CAST(o_orderkey AS VARCHAR) AS base, CAST(year(o_orderdate) AS VARCHAR) AS year_of_ts, '20' || substr('f' || CAST(o_orderkey AS VARCHAR), 1, 2) AS year_of_name,
      CASE o_orderkey % 3 WHEN 0 THEN CAST(o_custkey AS VARCHAR) WHEN 1 THEN CAST(year(o_orderdate) AS VARCHAR) ELSE 'UNKNOWN' END AS clean FROM orders""",
)
def _(spark, sf):
    key = F.col("o_orderkey").cast("string")
    path = F.concat(F.lit("A\\b/f"), key, F.when(F.col("o_orderkey") % 2 == 0, ".RPT").otherwise(".rpt"))
    year = F.year("o_orderdate").cast("string")
    messy = (
        F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(" ")))
        .when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("x1234 "), year, F.lit(" 2001")))
        .otherwise("n/a")
    )
    base = tx.strip_ext(tx.base_name(path))
    return table(spark, sf, "orders").select(
        "o_orderkey", base.alias("base"), tx.report_year(F.col("o_orderdate")).alias("year_of_ts"),
        tx.report_year(None, path, True).alias("year_of_name"), tx.clean_year(messy).alias("clean"),
    )


@query(
    "julian_date",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE strftime(make_date(1999 + CAST(o_orderkey % 9 AS INT) + 1, 1, 1) + CAST(o_custkey % 400 AS INT) - 1, '%Y-%m-%d') END AS report_date FROM orders",
)
def _(spark, sf):
    name = F.concat(
        F.lpad((F.col("o_orderkey") % 9).cast("string"), 2, "0"), F.lpad((F.col("o_custkey") % 400).cast("string"), 3, "0"), F.lit("XX")
    )
    name = F.when(F.col("o_orderkey") % 10 == 0, "24x1").otherwise(name)
    return table(spark, sf, "orders").select("o_orderkey", tx.julian_date(name).alias("report_date"))


@query("to_utc", "SELECT event_id, strftime(ts - INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS utc FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", tx.to_utc(F.col("ts"), "Asia/Singapore").alias("utc"))


@query(
    "country_of_name",
    "SELECT ITEM_ID, CASE WHEN upper(trim(NAME)) IN ('HK', 'MY', 'SG') THEN upper(trim(NAME)) END AS code FROM folder",
    ["folder"],
)
def _(spark, sf):
    return view(spark, sf, "folder").select("ITEM_ID", tx.country_of_name(F.col("NAME")).alias("code"))


@query(
    "resource_type",
    "SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN 'CharSet_Raster' WHEN 1 THEN 'Codepage' WHEN 2 THEN 'PageDef' WHEN 3 THEN 'CharSet' WHEN 4 THEN 'Unknown' ELSE 'Formdef' END AS resource_type FROM part",
)
def _(spark, sf):
    names = ["c0abc.RCS", "zz.rcp", "P1x", "q.RCS", "readme.txt", "F1.RCS"]
    name = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("p_size") % 6 + 1)
    return table(spark, sf, "part").select("p_partkey", tx.resource_type(name).alias("resource_type"))


@query("content_crc_groups", "SELECT count(DISTINCT text) AS contents, count(*) AS files FROM documents")
def _(spark, sf):
    rows = table(spark, sf, "documents").select(tx.content_crc(F.col("text").cast("binary")).alias("crc"))
    return rows.groupBy("crc").agg(F.count("*").alias("n")).agg(F.count("*").alias("contents"), F.sum("n").alias("files"))


@query(
    "segments_format_and_parse",
    "SELECT l_orderkey, string_agg(CAST(l_linenumber AS VARCHAR) || '#' || CAST(l_partkey AS VARCHAR) || '#' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR), '|' ORDER BY l_linenumber, l_partkey, CAST(l_quantity AS BIGINT)) AS segments, "
    "count(*) AS parts FROM lineitem GROUP BY l_orderkey",
)
def _(spark, sf):
    item = F.struct(F.col("l_linenumber").alias("section_id"), F.col("l_partkey").alias("start_page"), F.col("l_quantity").cast("long").alias("page_count"))
    rows = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(item)).alias("s"))
    rows = rows.select("l_orderkey", tx.format_segments(F.col("s")).alias("segments"))
    return rows.select("l_orderkey", "segments", F.size(tx.parse_segments(F.col("segments"))).cast("long").alias("parts"))


@query(
    "object_header",
    "SELECT conv_id, turn, role AS k_role, CAST(turn AS VARCHAR) AS k_turn FROM conversations",
)
def _(spark, sf):
    page = F.concat(
        F.lit("Vendor Object Header Page: v1\r\n Role : "), F.col("role"), F.lit("\r\nempty:\nTurn: old\nTurn: "), F.col("turn").cast("string"), F.lit("\nno pair")
    )
    rows = table(spark, sf, "conversations").select("conv_id", "turn", tx.object_header(page).alias("m"))
    return rows.select("conv_id", "turn", F.col("m")["Role"].alias("k_role"), F.col("m")["Turn"].alias("k_turn"))


@query(
    "page_metrics",
    "SELECT doc_id AS file, CAST(list_max(list_transform(l, lambda t: length(t))) AS INT) AS line_width, CAST(len(l) AS INT) AS line_count, CAST(strlen(text) AS INT) AS size FROM (SELECT *, string_split(text, chr(10)) AS l FROM documents) AS d",
)
def _(spark, sf):
    return ct.page_metrics(table(spark, sf, "documents").select(F.col("doc_id").alias("file"), "text"))


# --- report containers ---------------------------------------------------------------------------

_DOC_PAGES = """SELECT doc_id, lang, CAST(k AS BIGINT) AS page, array_to_string(list_slice(l, 4 * k - 3, 4 * k), chr(10)) AS text, n FROM (SELECT doc_id, lang, l, CAST(ceil(len(l) / 4) AS BIGINT) AS n,
  unnest(range(1, CAST(ceil(len(l) / 4) AS BIGINT) + 1)) AS k FROM (SELECT doc_id, lang, string_split(text, chr(10)) AS l FROM documents) AS a) AS b"""
_DOC_FILES = f"SELECT doc_id, max(n) AS n FROM ({_DOC_PAGES}) AS p GROUP BY doc_id"


_HEADER = "Object Header Page:\nObject File Name=report"
_HEADED_PAGES = f"""SELECT doc_id, CAST(page + CASE WHEN doc_id % 10 = 0 OR doc_id % 11 = 0 THEN 1 ELSE 0 END AS BIGINT) AS page, text, false AS header FROM ({_DOC_PAGES}) AS d
  UNION ALL SELECT doc_id, 1, '{_HEADER}', true FROM documents WHERE doc_id % 10 = 0 OR doc_id % 11 = 0"""


def _page_array():
    lines = F.split(F.col("text"), "\n")
    count = F.ceil(F.size(lines) / 4)
    return F.transform(F.sequence(F.lit(1), count), lambda k: F.array_join(F.slice(lines, (k * 4 - 3).cast("int"), F.lit(4)), "\n"))


def containers(spark, sf, headers=False):
    """Every document as a report container of four-line pages; every tenth carries a two-part PDF, every eleventh an AFP object.

    With ``headers`` a report with objects begins with an object header page.
    """
    doc = F.col("doc_id")
    pdf = F.array(F.lit(b"%PDF-1.4 part one "), F.concat(F.lit(b"part two "), doc.cast("string").cast("binary")))
    afp = F.array(F.concat(F.unhex(F.lit("5A0008D3A8A80000")), F.col("text").cast("binary")))
    objects = F.when(doc % 10 == 0, pdf).when(doc % 11 == 0, afp)
    pages = F.when(F.lit(headers) & objects.isNotNull(), F.concat(F.array(F.lit(_HEADER)), _page_array())).otherwise(_page_array())
    content = container_bytes(doc, pages, objects)
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    rows = docs.select(F.concat(F.lit("D"), doc.cast("string"), F.lit(".RPT")).alias("file"), content.alias("content"))
    return rows.withColumn("length", F.octet_length("content").cast("long"))


def _doc(col="file"):
    return F.regexp_extract(col, r"D(\d+)", 1).cast("long").alias("doc_id")


@query("rpt_header", f"SELECT doc_id, true AS valid, CAST(1 AS BIGINT) AS domain_id, doc_id AS species_id, '2024/01/02 03:04:05' AS timestamp, n AS page_count, CAST(ceil(n / 3) AS BIGINT) AS section_count FROM ({_DOC_FILES}) AS f")
def _(spark, sf):
    return ct.rpt_header(containers(spark, sf)).select(_doc(), "valid", "domain_id", "species_id", "timestamp", "page_count", "section_count")


_DOC_SECTIONS = f"SELECT doc_id, CAST(101 + i AS BIGINT) AS section_id, CAST(1 + 3 * i AS BIGINT) AS start_page, CAST(least(3, n - 3 * i) AS BIGINT) AS page_count FROM (SELECT doc_id, n, unnest(range(0, CAST(ceil(n / 3) AS BIGINT))) AS i FROM ({_DOC_FILES}) AS f) AS s"


@query("rpt_section", _DOC_SECTIONS)
def _(spark, sf):
    return ct.rpt_section(containers(spark, sf)).select(_doc(), "section_id", "start_page", "page_count")


def stored_containers(spark, sf):
    """The same containers as files in the shared folder, listed by name."""
    path = scratch_path(spark, "reports")
    write_files(containers(spark, sf).withColumn("file", F.concat(F.lit("folder"), F.pmod(F.hash("file"), F.lit(3)).cast("string"), F.lit("/"), "file")), path)
    return list_files(spark, path, by_name=True)


@query("scan_rpt_header", f"SELECT doc_id, true AS valid, doc_id AS species_id, n AS page_count FROM ({_DOC_FILES}) AS f")
def _(spark, sf):
    return ct.rpt_header(stored_containers(spark, sf)).select(_doc(), "valid", "species_id", "page_count")


@query("scan_rpt_section", _DOC_SECTIONS)
def _(spark, sf):
    return ct.rpt_section(stored_containers(spark, sf)).select(_doc(), "section_id", "start_page", "page_count")


@query("scan_rpt_pages", f"SELECT doc_id, page, 'ok' AS status, text FROM ({_DOC_PAGES}) AS p WHERE page % 2 = 0")
def _(spark, sf):
    """Every second page of every file, read by ranges."""
    files = stored_containers(spark, sf)
    wanted = ct.rpt_page(files).select("file", "page").where("page % 2 = 0")
    return ct.page_text(files, wanted).select(_doc(), "page", "status", "text")


@query("scan_rpt_pages_all", f"SELECT doc_id, page, 'ok' AS status, text FROM ({_DOC_PAGES}) AS p")
def _(spark, sf):
    """Every page of every file, read by ranges."""
    files = stored_containers(spark, sf)
    return ct.page_text(files, ct.rpt_page(files).select("file", "page")).select(_doc(), "page", "status", "text")


@query("rpt_page", f"SELECT doc_id, page, CAST(strlen(text) AS BIGINT) AS uncompressed_size, CAST(least(len(string_split(text, chr(10))), 65535) AS BIGINT) AS lines_per_page FROM ({_DOC_PAGES}) AS p")
def _(spark, sf):
    return ct.rpt_page(containers(spark, sf)).select(_doc(), "page", "uncompressed_size", "lines_per_page")


@query("page_text_all", f"SELECT doc_id, page, 'ok' AS status, text FROM ({_DOC_PAGES}) AS p")
def page_text_all(spark, sf):
    return ct.page_text(containers(spark, sf)).select(_doc(), "page", "status", "text")


@query(
    "page_text_selected",
    f"SELECT w.doc_id, w.page, CASE WHEN p.page IS NULL THEN 'out_of_range' ELSE 'ok' END AS status, p.text FROM (SELECT DISTINCT doc_id, unnest([CAST(2 AS BIGINT), 1 + quality + 2 * toxic]) AS page FROM labels) AS w "
    f"LEFT JOIN ({_DOC_PAGES}) AS p ON p.doc_id = w.doc_id AND p.page = w.page",
)
def page_text_selected(spark, sf):
    files = containers(spark, sf)
    wanted = table(spark, sf, "labels").select(
        F.concat(F.lit("D"), F.col("doc_id").cast("string"), F.lit(".RPT")).alias("file"),
        F.explode(F.array(F.lit(2), F.lit(1) + F.col("quality") + F.col("toxic") * 2)).alias("page"),
    )
    return ct.page_text(files, wanted).select(_doc(), "page", "status", "text")


@query(
    "page_text_of_sections",
    f"SELECT p.doc_id, p.page, p.text FROM ({_DOC_PAGES}) AS p WHERE p.page BETWEEN 4 AND 6",
)
def _(spark, sf):
    files = containers(spark, sf)
    pages, sections = ct.rpt_page(files).select("file", "page"), ct.rpt_section(files)
    chosen, _skipped = fl.pages_in_sections(pages, sections, [102])
    return ct.page_text(files, chosen).select(_doc(), "page", "text")


@query(
    "page_volume",
    f"SELECT doc_id, CAST(sum(strlen(text)) AS BIGINT) AS uncompressed, true AS packs FROM ({_DOC_PAGES}) AS p GROUP BY doc_id",
)
def _(spark, sf):
    rows = ag.page_volume(ct.rpt_page(containers(spark, sf)), ["file"])
    return rows.select(_doc(), "uncompressed", ((F.col("compressed") > 0) & (F.col("ratio") >= 0)).alias("packs"))


@query("rpt_object", "SELECT doc_id, CAST(i AS BIGINT) AS object_no FROM (SELECT doc_id, unnest(CASE WHEN doc_id % 10 = 0 THEN [1, 2] WHEN doc_id % 11 = 0 THEN [1] ELSE [] END) AS i FROM documents) AS o")
def _(spark, sf):
    return ct.rpt_object(containers(spark, sf)).select(_doc(), "object_no")


@query(
    "rpt_document",
    "SELECT doc_id, 'D' || CAST(doc_id AS VARCHAR) || '_binary' || CASE WHEN doc_id % 10 = 0 THEN '.pdf' ELSE '.afp' END AS document_name, CASE WHEN doc_id % 10 = 0 THEN 'PDF' ELSE 'AFP' END AS format, "
    "CAST(CASE WHEN doc_id % 10 = 0 THEN 27 + length(CAST(doc_id AS VARCHAR)) ELSE 8 + strlen(text) END AS INT) AS size FROM documents WHERE doc_id % 10 = 0 OR doc_id % 11 = 0",
)
def _(spark, sf):
    rows = ct.rpt_document(containers(spark, sf))
    return rows.select(_doc(), "document_name", "format", F.octet_length("document").alias("size"))


@query(
    "rpt_inventory",
    f"SELECT 'D' || CAST(doc_id AS VARCHAR) || '.RPT' AS RPT_FILE, doc_id AS REPORT_SPECIES_ID, CAST(ceil(n / 3) AS BIGINT) AS SECTION_COUNT, n AS PAGES, CASE WHEN doc_id % 10 = 0 THEN 'PDF' WHEN doc_id % 11 = 0 THEN 'AFP' ELSE '' END AS BINARY FROM ({_DOC_FILES}) AS f",
)
def _(spark, sf):
    return ct.rpt_inventory(containers(spark, sf))


_DOC_OBJECTS = """SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN encode('%PDF-1.4 part one part two ' || CAST(doc_id AS VARCHAR)) ELSE unhex('5A0008D3A8A80000') || encode(text) END AS document
  FROM documents WHERE doc_id % 10 = 0 OR doc_id % 11 = 0"""


@query("scan_rpt_document", f"SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 'PDF' ELSE 'AFP' END AS format, sha256(document) AS document_sha256 FROM ({_DOC_OBJECTS}) AS o")
def _(spark, sf):
    """Embedded documents of stored files, read by ranges."""
    return ct.rpt_document(stored_containers(spark, sf)).select(_doc(), "format", F.sha2("document", 256).alias("document_sha256"))


@query(
    "scan_rpt_inventory",
    f"SELECT 'D' || CAST(doc_id AS VARCHAR) || '.RPT' AS RPT_FILE, doc_id AS REPORT_SPECIES_ID, CAST(ceil(n / 3) AS BIGINT) AS SECTION_COUNT, n AS PAGES, CASE WHEN doc_id % 10 = 0 THEN 'PDF' WHEN doc_id % 11 = 0 THEN 'AFP' ELSE '' END AS BINARY FROM ({_DOC_FILES}) AS f",
)
def _(spark, sf):
    return ct.rpt_inventory(stored_containers(spark, sf))


@query("source_pages_all", f"SELECT doc_id, page, 'ok' AS status, text FROM ({_DOC_PAGES}) AS p")
def _(spark, sf):
    """Every page of every file through the data source of report pages."""
    path = scratch_path(spark, "reports")
    write_files(containers(spark, sf), path)
    return scan_pages(spark, path).select(_doc(), "page", "status", "text")


@query("report_text_concat", f"SELECT doc_id, string_agg(text, chr(12) || chr(10) ORDER BY page) AS text FROM ({_DOC_PAGES}) AS p GROUP BY doc_id")
def _(spark, sf):
    return ct.report_text(ct.page_text(containers(spark, sf)), "concat").select(_doc(), "text")


@query("report_text_page", f"SELECT doc_id, page, text FROM ({_HEADED_PAGES}) AS p WHERE NOT header")
def _(spark, sf):
    files = containers(spark, sf, headers=True)
    return ct.report_text(ct.page_text(files), "page", ct.rpt_object(files)).select(_doc(), "page", "text")


@query(
    "report_text_files",
    f"""WITH p AS (SELECT *, strlen(text) + 2 AS size, max(page) OVER (PARTITION BY doc_id) AS pages FROM ({_HEADED_PAGES}) AS h),
    o AS (SELECT *, sum(size) OVER (PARTITION BY doc_id ORDER BY page) - size AS begins FROM p)
    SELECT doc_id, CAST(floor(begins / 1024) AS BIGINT) AS part, string_agg(text || CASE WHEN page < pages THEN chr(12) ELSE '' END || chr(10), '' ORDER BY page) AS text FROM o GROUP BY ALL""",
)
def _(spark, sf):
    path = scratch_path(spark, "report-text")
    ct.write_report_text(ct.page_text(containers(spark, sf, headers=True)), path, part_bytes=1024)
    return ct.read_report_parts(spark, path).select(_doc(), "part", "text")


@query("readback", f"SELECT doc_id, page, 'only_a' AS status FROM ({_DOC_PAGES}) AS p WHERE page = 2")
def _(spark, sf):
    files = containers(spark, sf)
    expected = table(spark, sf, "documents").select(
        F.concat(F.lit("D"), F.col("doc_id").cast("string"), F.lit(".RPT")).alias("file"), F.posexplode(_page_array()).alias("pos", "text")
    ).select("file", (F.col("pos") + 1).cast("long").alias("page"), "text")
    parsed = ct.page_text(files).filter("page <> 2").select("file", "page", "text")
    return ct.readback(parsed, expected, ["file", "page"]).select(_doc(), "page", "status")


# --- index files ---------------------------------------------------------------------------------

_ENTRIES = f"""SELECT doc_id, page, trim(substr(regexp_replace(substr(list_extract(string_split(text, chr(10)), i), 1, 20), '[^A-Za-z0-9 ]', '', 'g'), 1, 12)) AS value
  FROM (SELECT *, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM ({_DOC_PAGES}) AS p) AS q"""
_VALUES = f"""SELECT doc_id, value, doc_id % 2 = 1 AS keyed, page FROM ({_ENTRIES}) AS e WHERE length(value) >= 3 AND regexp_matches(substr(value, 1, 5), '[A-Za-z0-9]')"""


def index_files(spark, sf):
    """Every document as an index file over a field in columns 0-19 of its lines; odd ones keyed through segment 0."""
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    value = lambda line: F.btrim(F.substring(F.regexp_replace(F.substring(line, 1, 20), "[^A-Za-z0-9 ]", ""), 1, 12))
    entry = lambda line, i: F.struct(value(line).alias("value"), (F.floor(i / 4) + 1).cast("long").alias("page"))
    real = lambda e: (F.length(e["value"]) >= 3) & F.substring(e["value"], 1, 5).rlike("[A-Za-z0-9]")
    files = docs.select("doc_id", F.filter(F.transform(F.split("text", "\n"), entry), real).alias("e")).filter(F.size("e") > 0)
    keyed = F.col("doc_id") % 2 == 1
    return files.select(
        F.concat(F.lit("D"), F.col("doc_id").cast("string"), F.lit(".MAP")).alias("file"), index_bytes(F.col("e.value"), F.col("e.page"), keyed).alias("content")
    )


@query("map_header", f"SELECT DISTINCT doc_id, true AS header_valid, CAST(2 AS BIGINT) AS segment_count, '02/01/2024' AS date_string, CAST(2 AS BIGINT) AS marker_count FROM ({_VALUES}) AS v")
def _(spark, sf):
    return mi.map_header(index_files(spark, sf)).select(_doc(), "header_valid", "segment_count", "date_string", "marker_count")


@query("map_segment", f"SELECT doc_id, CAST(s AS BIGINT) AS segment_no, CAST(CASE s WHEN 1 THEN 4 ELSE 0 END AS BIGINT) AS line_id, CAST(CASE s WHEN 1 THEN 12 ELSE 0 END AS BIGINT) AS field_width, CAST(CASE s WHEN 1 THEN n ELSE 0 END AS BIGINT) AS entry_count "
       f"FROM (SELECT doc_id, n, unnest([0, 1]) AS s FROM (SELECT doc_id, count(*) AS n FROM ({_VALUES}) AS v GROUP BY doc_id) AS c) AS d")
def _(spark, sf):
    return mi.map_segment(index_files(spark, sf)).select(_doc(), "segment_no", "line_id", "field_width", "entry_count")


@query("map_entry", f"SELECT doc_id, value, CASE WHEN keyed THEN 0 ELSE page END AS page, CASE WHEN keyed THEN 'u32_index' ELSE 'page' END AS format, count(*) AS copies FROM ({_VALUES}) AS v GROUP BY ALL")
def _(spark, sf):
    rows = mi.map_entry(index_files(spark, sf)).groupBy("file", "value", "page", "format").agg(F.count("*").alias("copies"))
    return rows.select(_doc(), "value", "page", "format", "copies")


@query("map_page_key", f"SELECT doc_id, count(*) AS keys, CAST(sum(page) AS BIGINT) AS page_sum FROM ({_VALUES}) AS v WHERE keyed GROUP BY doc_id")
def _(spark, sf):
    rows = mi.map_page_key(index_files(spark, sf)).groupBy("file").agg(F.count("*").alias("keys"), F.sum("page").alias("page_sum"))
    return rows.select(_doc(), "keys", "page_sum")


@query("map_lookup", f"SELECT DISTINCT doc_id, CAST(1 AS BIGINT) AS segment, CAST(4 AS BIGINT) AS line_id, CAST(2 AS BIGINT) AS field_id FROM ({_VALUES}) AS v")
def _(spark, sf):
    return mi.map_lookup(index_files(spark, sf)).select(_doc(), "segment", "line_id", "field_id")


@query("search_index", f"SELECT doc_id, value, count(*) AS hits FROM ({_VALUES}) AS v WHERE value LIKE 'The%' GROUP BY doc_id, value")
def search_index(spark, sf):
    rows = mi.map_entry(index_files(spark, sf), 4, 2, "The", prefix=True)
    return rows.groupBy("file", "value").agg(F.count("*").alias("hits")).select(_doc(), "value", "hits")


def stored_indexes(spark, sf):
    """A listing of the index files, written to the shared folder."""
    path = scratch_path(spark, "indexes")
    write_files(index_files(spark, sf), path)
    return list_files(spark, path, "*.MAP", by_name=True)


@query("search_stored_index", f"SELECT doc_id, value, page, count(*) AS hits FROM ({_VALUES}) AS v WHERE value LIKE 'The%' GROUP BY ALL")
def _(spark, sf):
    """As search_index, with pages, by seeks in stored files."""
    catalogue = cut_lineage(ms.index_catalogue(stored_indexes(spark, sf)))
    rows = ms.search_stored(catalogue, 4, 2, "The", prefix=True)
    return rows.groupBy("file", "value", "page").agg(F.count("*").alias("hits")).select(_doc(), "value", "page", "hits")


@query("index_catalogue", f"SELECT doc_id, 4::BIGINT AS line_id, 2::BIGINT AS field_id, keyed, true AS sorted, count(*) AS entries FROM ({_VALUES}) AS v GROUP BY doc_id, keyed")
def _(spark, sf):
    return ms.index_catalogue(stored_indexes(spark, sf)).select(_doc(), "line_id", "field_id", "keyed", "sorted", "entries")


@query("list_fields_stored", f"SELECT doc_id, CAST(4 AS BIGINT) AS line_id, CAST(2 AS BIGINT) AS field_id, CAST(12 AS BIGINT) AS field_width, count(*) AS entry_count FROM ({_VALUES}) AS v GROUP BY doc_id")
def _(spark, sf):
    """Indexed fields of stored files, of which headers alone are read."""
    return mi.list_fields(ms.read_segments(stored_indexes(spark, sf))).select(_doc(), "line_id", "field_id", "field_width", "entry_count")


@query("search_index_table", f"SELECT doc_id, value, count(*) AS hits FROM ({_VALUES}) AS v WHERE value = 'The' OR value = 'And' GROUP BY doc_id, value")
def _(spark, sf):
    path = scratch_path(spark, "entries")
    mi.write_entries(mi.map_entry(index_files(spark, sf)), path)
    stored = spark.read.parquet(path)
    rows = mi.search_index(stored, 4, 2, " The ").unionByName(mi.search_index(stored, 4, 2, "And"))
    return rows.groupBy("file", "value").agg(F.count("*").alias("hits")).select(_doc(), "value", "hits")


@query("entries_with_pages", f"SELECT doc_id, value, page, count(*) AS copies FROM ({_VALUES}) AS v GROUP BY ALL")
def _(spark, sf):
    rows = mi.map_entry(index_files(spark, sf), resolve=True).groupBy("file", "value", "page").agg(F.count("*").alias("copies"))
    return rows.select(_doc(), "value", "page", "copies")


@query("resolve_pages", f"SELECT DISTINCT doc_id, page FROM ({_VALUES}) AS v WHERE value >= 'T'")
def resolve_pages(spark, sf):
    files = index_files(spark, sf)
    entries = mi.map_entry(files).filter("value >= 'T'")
    return mi.found_pages(mi.resolve_pages(entries, mi.map_page_key(files))).select(_doc(), "page")


@query("list_fields", f"SELECT doc_id, CAST(4 AS BIGINT) AS line_id, CAST(2 AS BIGINT) AS field_id, 'Account' AS field_name, count(*) AS entry_count FROM ({_VALUES}) AS v GROUP BY doc_id")
def _(spark, sf):
    meta = table(spark, sf, "region").filter("r_regionkey = 0").select(
        F.struct(F.col("r_name").alias("name")).alias("species"),
        F.array(F.struct(F.lit(" Account ").alias("name"), F.lit(4).cast("long").alias("line_id"), F.lit(2).cast("long").alias("field_id"), F.lit(0).cast("long").alias("start_column"), F.lit(11).cast("long").alias("end_column"))).alias("indexed_fields"),
    )
    names = fs.fields_of_metadata(meta).withColumn("field_name", F.btrim("field_name"))
    return mi.list_fields(mi.map_segment(index_files(spark, sf)), names).select(_doc(), "line_id", "field_id", "field_name", "entry_count")


@query("index_value_counts", f"SELECT value, count(*) AS occurrences FROM ({_VALUES}) AS v GROUP BY value")
def _(spark, sf):
    return ag.value_counts(mi.map_entry(index_files(spark, sf)))


@query("index_value_counts_capped", f"SELECT doc_id, value, count(*) AS occurrences FROM (SELECT doc_id, value, row_number() OVER (PARTITION BY doc_id ORDER BY value, page) AS rn FROM ({_VALUES}) AS v) AS r WHERE rn <= 6 GROUP BY doc_id, value")
def _(spark, sf):
    return ag.value_counts(mi.map_entry(index_files(spark, sf)), 6, ["file"]).select(_doc(), "value", "occurrences")


def mixed_maps(spark, sf):
    """The index files, and for every region one with a header only and one that is no index at all."""
    named = lambda kind: F.concat(F.lit(kind), F.col("r_regionkey").cast("string"), F.lit(".MAP")).alias("file")
    regions = table(spark, sf, "region")
    empty = regions.select(named("E"), F.lit(bytearray(mi.SIGNATURE.ljust(90, b"\0"))).alias("content"))
    broken = regions.select(named("B"), F.encode("r_name", "UTF-8").alias("content"))
    return index_files(spark, sf).unionByName(empty).unionByName(broken)


@query(
    "verify_maps",
    f"SELECT n + 2 * r AS files, n AS ok, r AS empty, r AS errors, 2 * n AS total_segments, 2.0::DOUBLE AS average_segments FROM (SELECT count(DISTINCT doc_id) AS n, (SELECT count(*) FROM region) AS r FROM ({_VALUES}) AS v) AS c",
)
def _(spark, sf):
    return ag.verify_maps(mi.map_header(mixed_maps(spark, sf)))


@query("scan_map_header", f"SELECT DISTINCT doc_id, true AS header_valid, CAST(2 AS BIGINT) AS segment_count, CAST(2 AS BIGINT) AS marker_count FROM ({_VALUES}) AS v")
def _(spark, sf):
    """The index files written to the shared folder and scanned there."""
    path = scratch_path(spark, "indexes")
    write_files(index_files(spark, sf), path)
    return mi.map_header(fs.scan_map(spark, path)).select(_doc(), "header_valid", "segment_count", "marker_count")


@query(
    "index_integrity",
    f"SELECT d.doc_id, CAST(2 AS BIGINT) AS marker_count, coalesce(s.n, 0) AS db_segments, coalesce(s.n, 0) = 2 AS segments_match FROM (SELECT DISTINCT doc_id FROM ({_VALUES}) AS v) AS d LEFT JOIN (SELECT l_orderkey AS doc_id, count(*) AS n FROM lineitem GROUP BY 1) AS s ON s.doc_id = d.doc_id",
)
def _(spark, sf):
    files = index_files(spark, sf)
    key = [F.lit(1).alias("DOMAIN_ID"), F.lit("t").alias("AS_OF_TIMESTAMP")]
    catalogue = table(spark, sf, "orders").select(F.concat(F.lit("D"), F.col("o_orderkey").cast("string"), F.lit(".MAP")).alias("file"), F.col("o_orderkey").alias("REPORT_SPECIES_ID"), *key)
    ris = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("REPORT_SPECIES_ID"), *key)
    rows = mi.index_integrity(mi.map_header(files), mi.map_segment(files), catalogue, ris)
    return rows.select(_doc(), "marker_count", "db_segments", "segments_match")


@query(
    "search_and_extract",
    f"""WITH latest AS (SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY lang, source ORDER BY doc_id DESC) AS rn FROM documents WHERE contains(source, 'src1')) AS x WHERE rn = 1),
      hit AS (SELECT DISTINCT v.doc_id, page FROM ({_VALUES}) AS v JOIN latest USING (doc_id) WHERE value LIKE 'T%'),
      ln AS (SELECT p.doc_id, p.page, i AS line_no, list_extract(string_split(text, chr(10)), i) AS t FROM (SELECT *, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM ({_DOC_PAGES}) AS z) AS p JOIN hit USING (doc_id, page)),
      sc AS (SELECT *, list_sum(list_transform(range(1, 9), lambda k: CASE WHEN k > length(t) THEN 3 WHEN regexp_full_match(substr(t, k, 1), '[\\p{{L}}]') THEN 10 WHEN regexp_full_match(substr(t, k, 1), '[0-9]') THEN 7
        WHEN contains('*#@&()', substr(t, k, 1)) THEN 5 WHEN substr(t, k, 1) = ' ' THEN 3 ELSE 0 END)) / 80.0 AS score FROM ln)
    SELECT doc_id, page, line_no, FIELD_NAME, CASE WHEN length(t) <= st THEN '' ELSE trim(substr(t, st + 1, en - st + 1)) END AS value FROM sc JOIN (VALUES ('ACCOUNT', 0, 11), ('REST', 12, 40)) AS f(FIELD_NAME, st, en) ON true WHERE score > 0.55""",
)
def search_and_extract(spark, sf):
    docs = table(spark, sf, "documents")
    species = docs.select("lang", "source").distinct().withColumn("REPORT_SPECIES_ID", F.xxhash64("lang", "source"))
    seen = docs.withColumn("REPORT_SPECIES_ID", F.xxhash64("lang", "source"))
    stamp = F.timestamp_add("SECOND", F.col("doc_id"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    key = [F.lit(1).alias("DOMAIN_ID"), "REPORT_SPECIES_ID", stamp.alias("AS_OF_TIMESTAMP"), F.lit(0).alias("REPROCESS_IN_PROGRESS")]
    name = lambda ext: F.concat(F.lit("X\\D"), F.col("doc_id").cast("string"), F.lit(ext))
    column = lambda i, n, a, b: F.struct(F.lit(i).alias("FIELD_ID"), F.lit(n).alias("NAME"), F.lit(a).alias("START_COLUMN"), F.lit(b).alias("END_COLUMN"))
    tables = {
        "REPORT_SPECIES_NAME": species.select(F.lit(1).alias("DOMAIN_ID"), "REPORT_SPECIES_ID", F.lit(0).alias("ITEM_ID"), F.col("source").alias("NAME")),
        "REPORT_INSTANCE": seen.select(*key, F.col("doc_id").alias("STRUCTURE_DEF_ID")),
        "SST_STORAGE": seen.select(*key, F.col("doc_id").alias("MAP_FILE_ID")),
        "MAPFILE": docs.select(F.col("doc_id").alias("MAP_FILE_ID"), name(".MAP").alias("FILENAME")),
        "RPTFILE_INSTANCE": seen.select(*key, F.col("doc_id").alias("RPT_FILE_ID")),
        "RPTFILE": docs.select(F.col("doc_id").alias("RPT_FILE_ID"), name(".RPT").alias("FILENAME")),
        "LINE": docs.select(F.col("doc_id").alias("STRUCTURE_DEF_ID"), F.lit(4).alias("LINE_ID"), F.lit("DETAIL").alias("NAME"), F.lit("AAAAAAAA*  ").alias("TEMPLATE")),
        "FIELD": docs.select(
            F.col("doc_id").alias("STRUCTURE_DEF_ID"), F.lit(4).alias("LINE_ID"), F.explode(F.array(column(2, "ACCOUNT ", 0, 11), column(3, "REST", 12, 40))).alias("f")
        ).select("STRUCTURE_DEF_ID", "LINE_ID", "f.*"),
    }
    rows = se.search_and_extract(tables, containers(spark, sf), index_files(spark, sf), "src1", " account", "T")
    return rows.select(_doc(), "page", "line_no", "FIELD_NAME", "value")


# --- resources and manifests ---------------------------------------------------------------------

_FOLD = """
WITH v AS (SELECT * FROM resource_version), f AS (SELECT namespace, filename, max(version) AS v1 FROM v GROUP BY ALL),
r AS (SELECT v.*, v.version = f.v1 AS newest, n.crc AS c1 FROM v JOIN f USING (namespace, filename) JOIN v AS n ON n.namespace = f.namespace AND n.filename = f.filename AND n.version = f.v1),
o AS (SELECT *, lag(crc) OVER w AS before, row_number() OVER w AS rn FROM r WHERE NOT newest AND crc IS DISTINCT FROM c1 WINDOW w AS (PARTITION BY namespace, filename ORDER BY version DESC))
SELECT namespace, filename, version, crc FROM r WHERE newest UNION ALL SELECT namespace, filename, version, crc FROM o WHERE rn = 1 OR crc IS DISTINCT FROM before"""


@query("dedupe_versions", _FOLD, ["resource_version"])
def dedupe_versions(spark, sf):
    return wi.dedupe_versions(view(spark, sf, "resource_version"))


@query(
    "version_matrix",
    f"SELECT namespace, filename, CAST(count(*) AS INT) AS version_count, string_agg(version, '|' ORDER BY version DESC) AS versions FROM ({_FOLD}) AS k GROUP BY namespace, filename",
    ["resource_version"],
)
def _(spark, sf):
    inventory, _kept = rs.resource_inventory(view(spark, sf, "resource_version").withColumn("resource_type", F.lit("CharSet_Raster")))
    return inventory.select("namespace", "filename", "version_count", F.array_join("versions", "|").alias("versions"))


@query(
    "resource_stats",
    f"SELECT count(*) AS unique_resources, max(b) AS max_versions, CAST(sum(b) AS BIGINT) AS versions_before, CAST(sum(a) AS BIGINT) AS versions_after, CAST(sum(b) - sum(a) AS BIGINT) AS removed FROM (SELECT namespace, filename, count(*) AS b FROM resource_version GROUP BY ALL) AS x "
    f"JOIN (SELECT namespace, filename, count(*) AS a FROM ({_FOLD}) AS k GROUP BY ALL) AS y USING (namespace, filename)",
    ["resource_version"],
)
def _(spark, sf):
    before = view(spark, sf, "resource_version")
    return ag.resource_stats(before, wi.dedupe_versions(before))


@query(
    "merge_namespaces",
    "SELECT 'ALL_NAMESPACES' AS namespace, filename, namespace || chr(92) || version AS version FROM resource_version",
    ["resource_version"],
)
def _(spark, sf):
    return rs.merge_namespaces(view(spark, sf, "resource_version")).select("namespace", "filename", "version")


@query(
    "versioned_files",
    "SELECT namespace, version, filename FROM resource_version WHERE substr(version, 1, 4) >= '2024'",
    ["resource_version"],
)
def _(spark, sf):
    rows = view(spark, sf, "resource_version").select(F.concat_ws("/", F.lit("file:/data/res"), "namespace", "version", "filename").alias("path"))
    junk = rows.limit(0).unionByName(table(spark, sf, "region").select(F.concat(F.lit("/data/res/"), "r_name", F.lit("/notes/readme.txt")).alias("path")))
    return fs.versioned_files(rows.unionByName(junk), "/data/res", from_year=2024).select("namespace", "version", "filename")


@query(
    "resource_copy_plan",
    f"SELECT namespace, filename, version, CASE WHEN rk = 1 THEN namespace || '/' || filename ELSE namespace || '/' || version || '/' || filename END AS target, substr(version, 10, 2) < '12' AS source_exists FROM (SELECT *, row_number() OVER "
    f"(PARTITION BY namespace, filename ORDER BY version DESC) AS rk FROM ({_FOLD}) AS k) AS r",
    ["resource_version"],
)
def _(spark, sf):
    versions = view(spark, sf, "resource_version")
    inventory, _kept = rs.resource_inventory(versions.withColumn("resource_type", F.lit("CharSet_Raster")))
    listing = versions.filter("substring(version, 10, 2) < '12'").select(F.concat_ws("/", F.lit("/base"), "version", "filename").alias("path"))
    plan = fs.resource_copy_plan(inventory, listing, "/base/")
    return plan.select("namespace", "filename", "version", "target", "source_exists")


_MANIFEST = """SELECT SPECIES_ID, FILENAME, y, b, CASE WHEN done THEN 'SKIPPED' WHEN files = 0 THEN 'NO_FILES_FOUND' ELSE 'PLANNED' END AS STATUS FROM (
  SELECT *, substr(FILENAME, 1, 14) AS b, CASE WHEN YEAR = 'n/a' THEN 'UNKNOWN' ELSE substr(YEAR, 1, 4) END AS y, CAST(substr(FILENAME, 6, 9) AS BIGINT) % 4 = 0 AS done,
  CASE WHEN CAST(substr(FILENAME, 6, 9) AS BIGINT) % 3 = 0 THEN 0 ELSE 2 END AS files FROM archive_instance WHERE trim(FILENAME) <> '') AS a"""


@query(
    "archive_manifest",
    f"SELECT SPECIES_ID, FILENAME, STATUS, CASE WHEN STATUS = 'NO_FILES_FOUND' THEN '' ELSE chr(92) || y || chr(92) || b || '.zip' END AS COMPRESSED_FILENAME FROM ({_MANIFEST}) AS m",
    ["archive_instance"],
)
def _(spark, sf):
    rows = view(spark, sf, "archive_instance")
    named = rows.filter("trim(FILENAME) <> ''").select(
        F.substring("FILENAME", 1, 14).alias("b"), tx.clean_year(F.col("YEAR")).alias("y"), F.substring("FILENAME", 6, 9).cast("long").alias("k")
    )
    listing = named.filter("k % 3 <> 0").select(F.explode(F.array(*[F.concat(F.lit("/in/"), "b", F.lit(e)) for e in (".TXT", ".PDF")])).alias("path"))
    existing = named.filter("k % 4 = 0").select(F.concat_ws("/", "y", F.concat("b", F.lit(".zip"))).alias("path"))
    manifest = rs.archive_manifest(rows, listing, existing)
    return manifest.select("SPECIES_ID", "FILENAME", "STATUS", "COMPRESSED_FILENAME")


@query(
    "file_plan_stats",
    "SELECT 'type' AS kind, t AS value, count(*) AS files FROM (SELECT unnest(CASE c WHEN 0 THEN ['TXT', 'AFP'] WHEN 1 THEN ['TXT', 'PDF'] WHEN 2 THEN ['TXT', 'PDF'] ELSE ['TXT'] END) AS t FROM (SELECT (row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1) % 10 AS c FROM orders) AS x) AS y GROUP BY t "
    "UNION ALL SELECT 'year', y, CAST(sum(n) AS BIGINT) FROM (SELECT CAST(year(o_orderdate) AS VARCHAR) AS y, CASE WHEN (row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1) % 10 <= 2 THEN 2 ELSE 1 END AS n FROM orders) AS z GROUP BY y",
)
def _(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", F.concat(F.lit("f"), F.col("o_orderkey").cast("string"), F.lit(".RPT")).alias("FILENAME"), F.year("o_orderdate").alias("YEAR")
    )
    return ag.file_stats(gen.file_plan(rows, ["o_custkey", "o_orderkey"], ["first.txt", "second.txt"]))


@query(
    "archive_log",
    f"SELECT CAST(SPECIES_ID AS VARCHAR) AS SPECIES_ID, STATUS, count(*) AS rows FROM ({_MANIFEST}) AS m GROUP BY ALL",
    ["archive_instance"],
)
def _(spark, sf):
    rows = view(spark, sf, "archive_instance")
    named = rows.filter("trim(FILENAME) <> ''").select(
        F.substring("FILENAME", 1, 14).alias("b"), tx.clean_year(F.col("YEAR")).alias("y"), F.substring("FILENAME", 6, 9).cast("long").alias("k")
    )
    listing = named.filter("k % 3 <> 0").select(F.concat(F.lit("/in/"), "b", F.lit(".TXT")).alias("path"))
    existing = named.filter("k % 4 = 0").select(F.concat_ws("/", "y", F.concat("b", F.lit(".zip"))).alias("path"))
    log = ingest.archive_log(rs.archive_manifest(rows, listing, existing))
    return log.groupBy("SPECIES_ID", "STATUS").agg(F.count("*").alias("rows"))


@query(
    "order_versions_merged",
    "SELECT 'ALL_NAMESPACES' AS namespace, filename, max(namespace || chr(92) || version) AS newest FROM resource_version GROUP BY filename",
    ["resource_version"],
)
def _(spark, sf):
    rows = wi.order_versions(view(spark, sf, "resource_version"), merged=True)
    return rows.groupBy("namespace", "filename").agg(F.max("version").alias("newest"))


@query(
    "match_documents",
    f"SELECT doc_id, count(*) AS match_count FROM ({_VALUES}) AS v GROUP BY doc_id",
)
def _(spark, sf):
    found = mi.map_entry(index_files(spark, sf), resolve=True).withColumn("field", F.lit("ACCOUNT"))
    docs = fs.match_documents(found, 100_000)
    complete = F.sum(F.size("matches")).cast("long").alias("match_count")
    return docs.groupBy("file").agg(complete, F.max("match_count").alias("n")).filter("match_count = n").select(_doc(), "match_count")


@query(
    "object_format",
    "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '.pdf' WHEN 1 THEN '.afp' WHEN 2 THEN '.pdf' ELSE '.bin' END AS format FROM documents",
)
def _(spark, sf):
    key = F.col("doc_id") % 4
    body = F.col("text").cast("binary")
    content = F.when(key == 0, F.concat(F.lit(b"%PDF"), body)).when(key == 1, F.concat(F.unhex(F.lit("5A")), body)).otherwise(F.concat(F.lit(b"x"), body))
    name = F.when(key == 2, "stmt.PDF").otherwise("stmt.txt")
    header = F.create_map(F.lit("Object File Name"), name)
    return table(spark, sf, "documents").select("doc_id", tx.object_format(content, header).alias("format"))


# --- incremental ingest --------------------------------------------------------------------------


@query("pending_rows", "SELECT event_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 200)")
def _(spark, sf):
    events = table(spark, sf, "events")
    done = events.filter("event_type = 'purchase' AND value > 200")
    return ingest.pending_rows(events, done, ["user_id"]).select("event_id")


@query("ingest_incremental", "SELECT event_id, user_id FROM events WHERE event_type <> 'view'")
def _(spark, sf):
    target, progress = scratch_path(spark, "ingest"), scratch_path(spark, "progress")
    schema = table(spark, sf, "events").schema
    keep = lambda df: df.filter("event_type <> 'view'").select("event_id", "user_id")
    for _run in range(2):  # the second run finds nothing new
        ingest.ingest_incremental(spark, sf, schema, target, progress, keep, glob="events.parquet")
    return spark.read.parquet(target).select("event_id", "user_id")


@query(
    "outcome_log",
    "SELECT CAST(user_id AS VARCHAR) AS SPECIES_ID, event_type || '_' || CAST(event_id AS VARCHAR) || '.TXT' AS FILENAME, CASE WHEN value > 100 THEN 'ERROR' ELSE 'SUCCESS' END AS STATUS FROM events",
)
def _(spark, sf):
    """Log of a stream in several batches, resumed after new files came and once more without any."""
    source, target, progress, log = (scratch_path(spark, n) for n in ("events", "outcomes", "progress", "log"))
    events = table(spark, sf, "events")
    half = F.pmod(F.xxhash64("event_id"), F.lit(2))
    status = F.when(F.col("value") > 100, "ERROR").otherwise("SUCCESS").alias("status")
    outcome = lambda df: df.select(
        F.col("user_id").alias("species_id"), F.concat("event_type", F.lit("_"), F.col("event_id").cast("string"), F.lit(".TXT")).alias("filename"), status
    )
    for arrived in (half == 0, half == 1, None):
        if arrived is not None:
            events.where(arrived).repartition(4, "event_id").write.mode("append").parquet(source)
        ingest.ingest_incremental(spark, source, events.schema, target, progress, outcome, files_per_batch=2, log=log)
    return ingest.read_log(spark, log).select("SPECIES_ID", "FILENAME", "STATUS")


@query("intersect_search_and_sections", f"SELECT DISTINCT v.doc_id, v.page FROM ({_VALUES}) AS v JOIN ({_DOC_SECTIONS}) AS s ON s.doc_id = v.doc_id AND s.section_id = 102 AND v.page BETWEEN s.start_page AND s.start_page + s.page_count - 1")
def _(spark, sf):
    files, maps = containers(spark, sf), index_files(spark, sf)
    found = mi.found_pages(mi.resolve_pages(mi.map_entry(maps), mi.map_page_key(maps))).withColumn("file", F.regexp_replace("file", "MAP$", "RPT"))
    chosen, _skipped = fl.pages_in_sections(ct.rpt_page(files).select("file", "page"), ct.rpt_section(files), [102])
    return st.intersect_pages(found, chosen).select(_doc(), "page")


@query(
    "candidate_ids",
    f"SELECT doc_id, CAST(s AS BIGINT) AS segment_no, s = 1 AS has_line_field_width FROM (SELECT DISTINCT doc_id FROM ({_VALUES}) AS v) AS d, (VALUES (0), (1)) AS t(s)",
)
def _(spark, sf):
    rows = mi.candidate_ids(index_files(spark, sf))
    known = F.size(F.array_intersect("candidates", F.array(*[F.lit(n).cast("long") for n in (2, 4, 12)]))) == 3
    marked = F.when(F.col("segment_no") > 0, known).otherwise(F.lit(False))
    return rows.select(_doc(), "segment_no", marked.alias("has_line_field_width"))


@query(
    "template_score",
    "SELECT o_orderkey, CAST(CASE WHEN substr(o_orderpriority, 1, 1) IN ('4', '5') THEN round(1000 * (10 + 30 + 10 + 10 + 10 + 3) / 80.0) "
    "ELSE 1000 END AS BIGINT) AS permille FROM orders",
)
def _(spark, sf):
    # digit, dash, four letters: a perfect fit, but for the blank after NOT and LOW
    score = sp.template_score(F.substring("o_orderpriority", 1, 6), F.lit("9-AAAA*  "))
    return table(spark, sf, "orders").select("o_orderkey", F.round(score * 1000).cast("long").alias("permille"))

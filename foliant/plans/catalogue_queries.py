"""Queries over the catalogue: scans, filters, joins, aggregates, windows, hierarchy, retention, sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliant.functions import text as tx
from foliant.operators import aggregates as ag
from foliant.operators import filters as fl
from foliant.operators import hashtree as ht
from foliant.operators import hierarchy as hi
from foliant.operators import instances as ins
from foliant.operators import retention as rt
from foliant.operators import sets as st
from foliant.operators import windows as wi
from foliant.plans.registry import query, table, view
from foliant.scale import scratch_path
from foliant.sources import catalogue as cat
from foliant.sources import files as fs

INSTANCE_TABLES = [
    "report_instance", "rptfile_instance", "rptfile", "sst_storage", "mapfile", "report_instance_segment", "section",
]
_KEY4 = "DOMAIN_ID, REPORT_SPECIES_ID, AS_OF_TIMESTAMP, REPROCESS_IN_PROGRESS"
_KEY3 = "DOMAIN_ID, REPORT_SPECIES_ID, AS_OF_TIMESTAMP"


def stamp(name: str):
    return F.date_format(F.col(name), "yyyy-MM-dd HH:mm:ss").alias(name)


_STAMP = "strftime(AS_OF_TIMESTAMP, '%Y-%m-%d %H:%M:%S') AS AS_OF_TIMESTAMP"


# --- scans, sources, sinks -----------------------------------------------------------------


@query("load_table", "SELECT p_partkey, rtrim(p_name) AS p_name FROM part")
def _(spark, sf):
    return cat.load_table(spark, sf, "part", ["p_partkey", "p_name"])


@query(
    "first_existing_and_row_counts",
    "SELECT 'customer' AS table_name, count(*) AS row_count FROM customer UNION ALL SELECT 'orders', count(*) FROM orders "
    "UNION ALL SELECT 'lineitem', count(*) FROM lineitem",
)
def _(spark, sf):
    for name in ("customer", "orders", "lineitem"):
        table(spark, sf, name).createOrReplaceTempView(f"foliant_{name}")
    names = [cat.first_existing(spark, ["foliant_absent", f"foliant_{n}"]) for n in ("customer", "orders", "lineitem")]
    cat.require_tables(spark, names)
    return cat.row_counts({n.removeprefix("foliant_"): spark.table(n) for n in names})


@query(
    "describe_table",
    "SELECT table_name, column_name, CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double' WHEN 'INTEGER' THEN 'int' "
    "WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END AS data_type, CAST(ordinal_position AS INT) AS ordinal "
    "FROM information_schema.columns WHERE table_name IN ('orders', 'lineitem')",
)
def _(spark, sf):
    parts = [cat.describe_table(table(spark, sf, n), n) for n in ("orders", "lineitem")]
    return parts[0].unionByName(parts[1]).drop("nullable")


@query("csv_round_trip", "SELECT p_partkey, p_name, p_size FROM part")
def _(spark, sf):
    path = scratch_path(spark, "csv")
    cat.write_csv(table(spark, sf, "part"), path, ["p_partkey", "p_name", "p_size"])
    rows = cat.read_csv_checked(spark, path, ["P_PARTKEY", "p_size"])
    return rows.select(F.col("p_partkey").cast("long"), "p_name", F.col("p_size").cast("int"))


@query(
    "write_per_species",
    "SELECT replace('Species:' || CAST(o_custkey % 40 AS VARCHAR), ':', '_') || '_1995_2001' AS species_file, count(*) AS row_count, "
    "CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders GROUP BY 1",
)
def _(spark, sf):
    path = scratch_path(spark, "species")
    rows = table(spark, sf, "orders").select(
        F.concat(F.lit("Species:"), (F.col("o_custkey") % 40).cast("string")).alias("REPORT_SPECIES_NAME"), "o_orderkey"
    )
    cat.write_per_species(rows, path, start=1995, end=2001)
    back = spark.read.csv(path, header=True, schema="REPORT_SPECIES_NAME string, o_orderkey long, species_file string")
    return back.groupBy("species_file").agg(F.count("*").alias("row_count"), F.sum("o_orderkey").alias("key_sum"))


@query(
    "export_clean",
    "SELECT USER_ID, trim(USERNAME) AS USERNAME, coalesce(trim(DESCRIPTION), '') AS DESCRIPTION FROM scm_users",
    ["scm_users"],
)
def _(spark, sf):
    return cat.export_clean(view(spark, sf, "scm_users").select("USER_ID", "USERNAME", "DESCRIPTION"))


@query("sample_export", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_custkey, o_orderkey LIMIT 100")
def _(spark, sf):
    return cat.sample_export(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), ["o_custkey", "o_orderkey"], 100)


@query(
    "with_file_flag",
    "SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN '' WHEN p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45) "
    "THEN 'Y' ELSE 'N' END AS FILE_EXISTS FROM part",
)
def _(spark, sf):
    name = F.when(F.col("p_size") % 5 != 0, F.concat(F.lit("p"), F.col("p_partkey").cast("string"), F.lit(".map")))
    listing = table(spark, sf, "lineitem").filter("l_quantity > 45").select(
        F.concat(F.lit("/maps/P"), F.col("l_partkey").cast("string"), F.lit(".MAP")).alias("path")
    )
    rows = table(spark, sf, "part").select("p_partkey", name.alias("MAP_FILENAME"))
    return ins.with_file_flag(rows, "MAP_FILENAME", listing).select("p_partkey", "FILE_EXISTS")


@query(
    "section_exchange_round_trip",
    "SELECT o_custkey AS Report_Species_Id, CAST(l_linenumber AS BIGINT) AS Section_Id, l_partkey AS Start_Page, CAST(l_quantity AS BIGINT) AS Pages "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
)
def _(spark, sf):
    rows = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.select(
        F.col("o_custkey").alias("species_id"), F.col("l_linenumber").alias("section_id"), F.col("l_partkey").alias("start_page"),
        F.col("l_quantity").cast("long").alias("page_count"),
    )
    path = scratch_path(spark, "sections")
    cat.write_csv(fs.export_sections(rows), path)
    return fs.import_sections(spark, path)


# --- filters -----------------------------------------------------------------------------------


@query(
    "year_window",
    "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'",
)
def _(spark, sf):
    return fl.year_window(table(spark, sf, "orders"), "o_orderdate", 1996, 1998).select("o_orderkey")


@query(
    "date_window",
    "SELECT 'midnight' AS rule, count(*) AS n FROM report_instance WHERE AS_OF_TIMESTAMP >= TIMESTAMP '1997-03-01' AND AS_OF_TIMESTAMP <= "
    "TIMESTAMP '1998-06-30' UNION ALL SELECT 'end_of_day', count(*) FROM report_instance WHERE AS_OF_TIMESTAMP >= TIMESTAMP '1997-03-01' "
    "AND AS_OF_TIMESTAMP < TIMESTAMP '1998-07-01'",
    ["report_instance"],
)
def _(spark, sf):
    ri = view(spark, sf, "report_instance")
    one = lambda rule, eod: fl.date_window(ri, "AS_OF_TIMESTAMP", "1997-03-01", "1998-06-30", eod).agg(F.count("*").alias("n")).select(
        F.lit(rule).alias("rule"), "n"
    )
    return one("midnight", False).unionByName(one("end_of_day", True))


@query(
    "on_day",
    f"SELECT REPORT_SPECIES_ID, {_STAMP} FROM report_instance WHERE CAST(AS_OF_TIMESTAMP AS DATE) = DATE '1997-05-28'",
    ["report_instance"],
)
def _(spark, sf):
    return fl.on_day(view(spark, sf, "report_instance"), "AS_OF_TIMESTAMP", "1997-05-28").select(
        "REPORT_SPECIES_ID", stamp("AS_OF_TIMESTAMP")
    )


@query(
    "pending_and_active_species",
    "SELECT REPORT_SPECIES_ID FROM (SELECT c_custkey + 1 AS REPORT_SPECIES_ID FROM customer WHERE c_custkey + 1 >= 20 AND c_nationkey <> 7 "
    "ORDER BY 1 LIMIT 200) AS a WHERE REPORT_SPECIES_ID > 50",
)
def _(spark, sf):
    rows = table(spark, sf, "customer").select(
        (F.col("c_custkey") + 1).alias("REPORT_SPECIES_ID"), F.when(F.col("c_nationkey") == 7, 0).otherwise(1).alias("IN_USE")
    )
    return fl.pending(fl.active_species(rows, 20, 200), "REPORT_SPECIES_ID", 50).select("REPORT_SPECIES_ID")


@query(
    "name_filters",
    "SELECT p_partkey, p_name, p_brand FROM part WHERE p_name LIKE '%ring%' AND p_brand LIKE 'Brand#1%' AND p_type IN ('PROMO', 'LARGE')",
)
def _(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    rows = fl.only_names(rows, ["PROMO", "LARGE"], "p_type")
    return fl.name_prefix(fl.name_contains(rows, "ring", "p_name"), "Brand#1", "p_brand").drop("p_type")


@query(
    "drop_sentinels",
    "SELECT ITEM_ID, REPORT_SPECIES_ID FROM folder_species WHERE REPORT_SPECIES_ID > 0",
    ["folder_species"],
)
def _(spark, sf):
    return fl.drop_sentinels(view(spark, sf, "folder_species"), positive_only=True).select("ITEM_ID", "REPORT_SPECIES_ID")


@query(
    "select_fields",
    "SELECT STRUCTURE_DEF_ID, LINE_ID, FIELD_ID, START_COLUMN FROM field WHERE IS_INDEXED = 1 AND IS_SIGNIFICANT = 1 AND (NAME LIKE '%_1%' OR NAME LIKE '%_2%')",
    ["field"],
)
def _(spark, sf):
    rows = fl.select_fields(view(spark, sf, "field"), True, True, ["%_1%", "%_2%"])
    return rows.select("STRUCTURE_DEF_ID", "LINE_ID", "FIELD_ID", "START_COLUMN")


@query(
    "filter_records",
    "SELECT STRUCTURE_DEF_ID, LINE_ID, START_COLUMN FROM field WHERE LINE_ID IN (2, 5)",
    ["field"],
)
def _(spark, sf):
    return fl.filter_records(view(spark, sf, "field"), lines=[2, 5]).select("STRUCTURE_DEF_ID", "LINE_ID", "START_COLUMN")


_PAGES = "SELECT conv_id AS file, turn + 1 AS page FROM conversations"


def _conv_pages(spark, sf):
    return table(spark, sf, "conversations").select(F.col("conv_id").alias("file"), (F.col("turn") + 1).alias("page"))


_CONV_SECTIONS = (
    "SELECT l_orderkey AS file, l_linenumber AS section_id, l_partkey % 4 AS start_page, CAST(l_quantity AS BIGINT) % 4 AS page_count, "
    "l_partkey * 1000 + l_suppkey AS position FROM lineitem"
)


def _conv_sections(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("file"), F.col("l_linenumber").alias("section_id"), (F.col("l_partkey") % 4).alias("start_page"),
        (F.col("l_quantity").cast("long") % 4).alias("page_count"), (F.col("l_partkey") * 1000 + F.col("l_suppkey")).alias("position"),
    )


@query(
    "pages_in_ranges",
    f"SELECT file, page FROM ({_PAGES}) AS p WHERE page BETWEEN 1 AND 2 OR page BETWEEN 4 AND 5",
)
def _(spark, sf):
    chosen = fl.parse_selection("pages: 1-2, 4-5, 5")
    return fl.pages_in_ranges(_conv_pages(spark, sf), chosen.ranges)


@query(
    "pages_in_named_ranges",
    f"SELECT DISTINCT p.file, p.page FROM ({_PAGES}) AS p JOIN ({_CONV_SECTIONS}) AS s ON p.file = s.file AND s.start_page >= 1 "
    "AND p.page BETWEEN s.start_page AND s.start_page + s.page_count - 1",
)
def _(spark, sf):
    return fl.pages_in_named_ranges(_conv_pages(spark, sf), _conv_sections(spark, sf)).distinct()


@query(
    "pages_in_sections",
    f"WITH s AS (SELECT * FROM ({_CONV_SECTIONS}) AS x WHERE section_id IN (5, 2, 99)), d AS (SELECT * FROM (SELECT *, row_number() OVER "
    "(PARTITION BY file, section_id ORDER BY position DESC, start_page DESC, page_count DESC) AS rn FROM s) AS y WHERE rn = 1) "
    "SELECT p.file, p.page, CAST(d.section_id AS BIGINT) AS section_id, CAST(CASE d.section_id WHEN 5 THEN 1 ELSE 2 END AS BIGINT) AS request_pos "
    f"FROM ({_PAGES}) AS p JOIN d ON p.file = d.file AND d.start_page >= 1 AND p.page BETWEEN d.start_page AND d.start_page + d.page_count - 1",
)
def _(spark, sf):
    chosen, _skipped = fl.pages_in_sections(
        _conv_pages(spark, sf), _conv_sections(spark, sf), fl.parse_selection("sections: 5, 2, 99").sections
    )
    return chosen.select("file", "page", F.col("section_id").cast("long").alias("section_id"), F.col("request_pos").cast("long").alias("request_pos"))


@query(
    "skipped_sections",
    f"SELECT r.section_id, r.request_pos FROM (VALUES (CAST(5 AS BIGINT), CAST(1 AS BIGINT)), (2, 2), (99, 3)) AS r(section_id, request_pos) "
    f"WHERE r.section_id NOT IN (SELECT section_id FROM ({_CONV_SECTIONS}) AS s)",
)
def _(spark, sf):
    _chosen, skipped = fl.pages_in_sections(_conv_pages(spark, sf), _conv_sections(spark, sf), [5, 2, 99])
    return skipped


@query(
    "pages_with_section",
    f"SELECT p.file, p.page, s.section_id FROM ({_PAGES}) AS p JOIN ({_CONV_SECTIONS}) AS s ON p.file = s.file AND s.start_page >= 1 "
    "AND p.page BETWEEN s.start_page AND s.start_page + s.page_count - 1",
)
def _(spark, sf):
    return fl.pages_with_section(_conv_pages(spark, sf), _conv_sections(spark, sf)).select("file", "page", "section_id")


@query(
    "expand_ranges",
    "SELECT l_orderkey, l_linenumber, unnest(range(least(a, b), greatest(a, b) + 1)) AS page FROM (SELECT l_orderkey, l_linenumber, "
    "least(greatest(l_suppkey % 9 - 1, 1), 7) AS a, least(greatest(l_partkey % 9 - 1, 1), 7) AS b FROM lineitem) AS r",
)
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_suppkey") % 9 - 1).alias("lo"), (F.col("l_partkey") % 9 - 1).alias("hi"),
        F.lit(7).cast("long").alias("max_page"),
    )
    return fl.expand_ranges(rows).select("l_orderkey", "l_linenumber", "page")


@query(
    "is_system_group",
    "SELECT GROUP_ID, NOT regexp_full_match(trim(GROUPNAME), '[0-9]+') AS is_system FROM scm_groups",
    ["scm_groups"],
)
def _(spark, sf):
    return view(spark, sf, "scm_groups").select("GROUP_ID", tx.is_system_group(F.col("GROUPNAME")).alias("is_system"))


@query(
    "versions_from_year",
    "SELECT namespace, filename, version FROM resource_version WHERE CAST(substr(version, 1, 4) AS INT) >= 2024",
    ["resource_version"],
)
def _(spark, sf):
    return fl.versions_from_year(view(spark, sf, "resource_version"), 2024).select("namespace", "filename", "version")


# --- joins -------------------------------------------------------------------------------------

_INSTANCES = f"""
SELECT ri.DOMAIN_ID, ri.REPORT_SPECIES_ID, ri.AS_OF_TIMESTAMP, rfi.RPT_FILE_ID, rtrim(rf.FILENAME) AS FILENAME,
       sst.MAP_FILE_ID, rtrim(mf.FILENAME) AS MAP_FILENAME
FROM report_instance ri
LEFT JOIN rptfile_instance rfi USING ({_KEY4})
LEFT JOIN rptfile rf ON rf.RPT_FILE_ID = rfi.RPT_FILE_ID
LEFT JOIN sst_storage sst USING ({_KEY4})
LEFT JOIN mapfile mf ON mf.MAP_FILE_ID = sst.MAP_FILE_ID
WHERE AS_OF_TIMESTAMP >= TIMESTAMP '1996-01-01' AND AS_OF_TIMESTAMP < TIMESTAMP '2000-01-01'"""


def _all(spark, sf, names):
    return [view(spark, sf, n) for n in names]


@query(
    "instances",
    f"SELECT REPORT_SPECIES_ID, {_STAMP}, RPT_FILE_ID, FILENAME FROM ({_INSTANCES}) AS i",
    INSTANCE_TABLES[:5],
)
def _(spark, sf):
    rows = ins.instances(*_all(spark, sf, INSTANCE_TABLES[:3]), 1996, 1999)
    return rows.select("REPORT_SPECIES_ID", stamp("AS_OF_TIMESTAMP"), "RPT_FILE_ID", "FILENAME")


@query(
    "instances_with_map",
    f"SELECT REPORT_SPECIES_ID, {_STAMP}, RPT_FILE_ID, FILENAME, MAP_FILENAME FROM ({_INSTANCES}) AS i",
    INSTANCE_TABLES[:5],
)
def _(spark, sf):
    ri, rfi, rf, sst, mf = _all(spark, sf, INSTANCE_TABLES[:5])
    rows = ins.instances(ri, rfi, rf, 1996, 1999, sst, mf)
    return rows.select("REPORT_SPECIES_ID", stamp("AS_OF_TIMESTAMP"), "RPT_FILE_ID", "FILENAME", "MAP_FILENAME")


_SEGMENT_TEXT = (
    "coalesce(rtrim(sec.NAME), '') || '#' || coalesce(CAST(SEGMENT_NUMBER AS VARCHAR), '') || '#' || CAST(coalesce(START_PAGE_NUMBER, 0) AS VARCHAR) "
    "|| '#' || coalesce(CAST(NUMBER_OF_PAGES AS VARCHAR), '')"
)


@query(
    "instances_with_segments",
    f"""SELECT REPORT_SPECIES_ID, {_STAMP}, RPT_FILE_ID, FILENAME, MAP_FILENAME, string_agg(entry, '|' ORDER BY SEGMENT_NUMBER, entry) AS segments
    FROM (SELECT i.*, SEGMENT_NUMBER, {_SEGMENT_TEXT} AS entry FROM ({_INSTANCES}) AS i
      LEFT JOIN report_instance_segment ris USING ({_KEY3})
      LEFT JOIN section sec ON sec.DOMAIN_ID = i.DOMAIN_ID AND sec.REPORT_SPECIES_ID = i.REPORT_SPECIES_ID AND sec.SECTION_ID = ris.SEGMENT_NUMBER) AS x
    GROUP BY REPORT_SPECIES_ID, AS_OF_TIMESTAMP, RPT_FILE_ID, FILENAME, MAP_FILENAME""",
    INSTANCE_TABLES,
)
def _(spark, sf):
    ri, rfi, rf, sst, mf, ris, section = _all(spark, sf, INSTANCE_TABLES)
    rows = ins.instances_with_segments(ri, rfi, rf, ris, section, sst, mf, 1996, 1999)
    return rows.withColumn("AS_OF_TIMESTAMP", F.date_format("AS_OF_TIMESTAMP", "yyyy-MM-dd HH:mm:ss"))


@query(
    "enrich_instances",
    f"""SELECT REPORT_SPECIES_ID, COUNTRY_CODE AS COUNTRY, base AS FILENAME, CAST(year(AS_OF_TIMESTAMP) AS VARCHAR) AS YEAR,
      CASE WHEN base = '' THEN '' ELSE strftime(make_date(2000 + CAST(substr(base, 1, 2) AS INT), 1, 1) + CAST(substr(base, 3, 3) AS INT) - 1, '%Y-%m-%d') END AS REPORT_DATE,
      strftime(AS_OF_TIMESTAMP - INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS UTC
    FROM (SELECT i.*, COUNTRY_CODE, regexp_replace(regexp_extract(coalesce(FILENAME, ''), '([^/' || chr(92) || chr(92) || ']*)$', 1), '(?i)[.]rpt$', '') AS base
      FROM ({_INSTANCES}) AS i JOIN species USING (REPORT_SPECIES_ID)) AS x""",
    [*INSTANCE_TABLES[:5], "species"],
)
def _(spark, sf):
    ri, rfi, rf, sst, mf = _all(spark, sf, INSTANCE_TABLES[:5])
    rows = ins.instances(ri, rfi, rf, 1996, 1999, sst, mf)
    out = ins.enrich_instances(rows, view(spark, sf, "species"))
    return out.select("REPORT_SPECIES_ID", "COUNTRY", "FILENAME", "YEAR", "REPORT_DATE", "UTC")


@query(
    "map_catalogue",
    f"SELECT MAP_FILE_ID, rtrim(FILENAME) AS FILENAME, REPORT_SPECIES_ID, {_STAMP} FROM mapfile JOIN sst_storage USING (MAP_FILE_ID)",
    ["mapfile", "sst_storage"],
)
def _(spark, sf):
    rows = ins.map_catalogue(*_all(spark, sf, ["mapfile", "sst_storage"]))
    return rows.select("MAP_FILE_ID", "FILENAME", "REPORT_SPECIES_ID", stamp("AS_OF_TIMESTAMP"))


@query(
    "map_segments_db",
    f"SELECT MAP_FILE_ID, SEGMENT_NUMBER, START_PAGE_NUMBER, NUMBER_OF_PAGES FROM mapfile JOIN sst_storage USING (MAP_FILE_ID) "
    f"JOIN report_instance_segment USING ({_KEY3})",
    ["mapfile", "sst_storage", "report_instance_segment"],
)
def _(spark, sf):
    rows = ins.map_segments_db(*_all(spark, sf, ["mapfile", "sst_storage", "report_instance_segment"]))
    return rows.select("MAP_FILE_ID", "SEGMENT_NUMBER", "START_PAGE_NUMBER", "NUMBER_OF_PAGES")


@query(
    "with_segment_count",
    f"SELECT MAP_FILE_ID, (SELECT count(*) FROM report_instance_segment r WHERE r.DOMAIN_ID = s.DOMAIN_ID AND r.REPORT_SPECIES_ID = "
    "s.REPORT_SPECIES_ID AND r.AS_OF_TIMESTAMP = s.AS_OF_TIMESTAMP) AS segment_count FROM mapfile m JOIN sst_storage s USING (MAP_FILE_ID)",
    ["mapfile", "sst_storage", "report_instance_segment"],
)
def _(spark, sf):
    rows = ins.map_catalogue(*_all(spark, sf, ["mapfile", "sst_storage"]))
    return ins.with_segment_count(rows, view(spark, sf, "report_instance_segment")).select("MAP_FILE_ID", "segment_count")


_NAMES = """SELECT DOMAIN_ID, REPORT_SPECIES_ID,
  coalesce(max(CASE WHEN ITEM_ID = 1 THEN rtrim(NAME) END), max(CASE WHEN ITEM_ID = 0 THEN rtrim(NAME) END), 'UNKNOWN_' || CAST(REPORT_SPECIES_ID AS VARCHAR)) AS REPORT_SPECIES_NAME,
  coalesce(max(CASE WHEN ITEM_ID = 0 THEN rtrim(NAME) END), 'UNKNOWN_' || CAST(REPORT_SPECIES_ID AS VARCHAR)) AS REPORT_SPECIES_DISPLAYNAME
  FROM report_species_name GROUP BY DOMAIN_ID, REPORT_SPECIES_ID"""


@query("species_names", _NAMES, ["report_species_name"])
def _(spark, sf):
    return ins.species_names(view(spark, sf, "report_species_name"))


_LATEST = """SELECT DOMAIN_ID, REPORT_SPECIES_ID, AS_OF_TIMESTAMP, STRUCTURE_DEF_ID FROM (SELECT *, row_number() OVER (PARTITION BY DOMAIN_ID, REPORT_SPECIES_ID
  ORDER BY AS_OF_TIMESTAMP DESC, STRUCTURE_DEF_ID DESC) AS rn FROM report_instance) AS r WHERE rn = 1"""


@query(
    "indexed_fields",
    f"""SELECT l.REPORT_SPECIES_ID, coalesce(rtrim(n1.NAME), rtrim(n0.NAME)) AS REPORT_SPECIES_NAME, rtrim(n0.NAME) AS REPORT_SPECIES_DISPLAYNAME,
      l.STRUCTURE_DEF_ID, f.LINE_ID, rtrim(ln.NAME) AS LINE_NAME, f.FIELD_ID, rtrim(f.NAME) AS FIELD_NAME, f.START_COLUMN, f.END_COLUMN,
      f.END_COLUMN - f.START_COLUMN + 1 AS WIDTH
    FROM ({_LATEST}) AS l JOIN field f ON f.STRUCTURE_DEF_ID = l.STRUCTURE_DEF_ID AND f.IS_INDEXED = 1
    JOIN report_species_name n0 ON n0.DOMAIN_ID = l.DOMAIN_ID AND n0.REPORT_SPECIES_ID = l.REPORT_SPECIES_ID AND n0.ITEM_ID = 0
    LEFT JOIN report_species_name n1 ON n1.DOMAIN_ID = l.DOMAIN_ID AND n1.REPORT_SPECIES_ID = l.REPORT_SPECIES_ID AND n1.ITEM_ID = 1
    LEFT JOIN line ln ON ln.STRUCTURE_DEF_ID = f.STRUCTURE_DEF_ID AND ln.LINE_ID = f.LINE_ID""",
    ["report_instance", "field", "report_species_name", "line"],
)
def indexed_fields(spark, sf):
    return ins.indexed_fields(*_all(spark, sf, ["field", "report_instance", "report_species_name", "line"])).drop("DOMAIN_ID")


@query(
    "indexed_field_list",
    f"SELECT REPORT_SPECIES_ID, string_agg(entry, '|' ORDER BY LINE_ID, FIELD_ID, entry) AS indexed_fields FROM (SELECT l.REPORT_SPECIES_ID, f.LINE_ID, f.FIELD_ID, "
    f"rtrim(f.NAME) || '#' || CAST(f.LINE_ID AS VARCHAR) || '#' || CAST(f.FIELD_ID AS VARCHAR) AS entry FROM ({_LATEST}) AS l JOIN field f "
    "ON f.STRUCTURE_DEF_ID = l.STRUCTURE_DEF_ID AND f.IS_INDEXED = 1) AS x GROUP BY REPORT_SPECIES_ID",
    ["report_instance", "field"],
)
def _(spark, sf):
    return ins.indexed_field_list(*_all(spark, sf, ["field", "report_instance"]), with_ids=True).drop("DOMAIN_ID")


@query(
    "signature_fields",
    "SELECT s.SIGN_ID, s.MINOR_VERSION, s.REPORT_SPECIES_ID, sf.LINE_ID, sf.FIELD_ID, rtrim(sf.NAME) AS SENSITIVE_NAME, sf.SENSITIVITY, f.FIELD_NAME "
    "FROM signature s LEFT JOIN sensitive_field sf ON sf.SIGN_ID = s.SIGN_ID LEFT JOIN (SELECT DISTINCT LINE_ID, FIELD_ID, rtrim(NAME) AS FIELD_NAME "
    "FROM field) AS f ON f.LINE_ID = sf.LINE_ID AND f.FIELD_ID = sf.FIELD_ID",
    ["signature", "sensitive_field", "field"],
)
def _(spark, sf):
    return ins.signature_fields(*_all(spark, sf, ["signature", "sensitive_field", "field"]), across_versions=True).drop("DOMAIN_ID")


@query(
    "species_signatures",
    "SELECT n.REPORT_SPECIES_ID, rtrim(n.NAME) AS NAME, s.SIGN_ID, s.MINOR_VERSION, rtrim(s.DESCRIPTION) AS DESCRIPTION FROM report_species_name n "
    "LEFT JOIN signature s ON s.DOMAIN_ID = n.DOMAIN_ID AND s.REPORT_SPECIES_ID = n.REPORT_SPECIES_ID WHERE n.ITEM_ID = 0",
    ["report_species_name", "signature"],
)
def _(spark, sf):
    return ins.species_signatures(*_all(spark, sf, ["report_species_name", "signature"])).drop("DOMAIN_ID")


_STALE = (
    "SELECT * FROM signature s WHERE EXISTS (SELECT 1 FROM signature n WHERE n.DOMAIN_ID = s.DOMAIN_ID AND n.REPORT_SPECIES_ID = s.REPORT_SPECIES_ID "
    "AND n.SIGN_ID = s.SIGN_ID AND n.MINOR_VERSION > s.MINOR_VERSION)"
)


@query("stale_versions", f"SELECT SIGN_ID, REPORT_SPECIES_ID, MINOR_VERSION, DESCRIPTION FROM ({_STALE}) AS x", ["signature"])
def _(spark, sf):
    return wi.stale_versions(view(spark, sf, "signature"), rt.SIGN_KEYS).drop("DOMAIN_ID")


@query("orphans", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 350000)")
def _(spark, sf):
    child = table(spark, sf, "orders").filter("o_totalprice > 350000").select(F.col("o_custkey").alias("c_custkey"))
    return rt.orphans(table(spark, sf, "customer").select("c_custkey"), child, "c_custkey")


@query(
    "stale_children",
    f"SELECT SIGN_ID, MINOR_VERSION, LINE_NUMBER FROM lines_in_sign c WHERE EXISTS (SELECT 1 FROM ({_STALE}) AS s WHERE s.SIGN_ID = c.SIGN_ID AND s.MINOR_VERSION = c.MINOR_VERSION)",
    ["signature", "lines_in_sign"],
)
def _(spark, sf):
    stale = wi.stale_versions(view(spark, sf, "signature"), rt.SIGN_KEYS)
    return rt.stale_children(view(spark, sf, "lines_in_sign"), stale).select("SIGN_ID", "MINOR_VERSION", "LINE_NUMBER")


@query(
    "segment_names",
    "SELECT r.REPORT_SPECIES_ID, r.SEGMENT_NUMBER, CASE WHEN trim(coalesce(s.NAME, '')) <> '' THEN s.NAME WHEN r.SEGMENT_NUMBER IN (3, 4) THEN "
    "'Desk ' || CAST(r.REPORT_SPECIES_ID % 10 AS VARCHAR) ELSE 'Unknown' END AS NAME FROM (SELECT DISTINCT DOMAIN_ID, REPORT_SPECIES_ID, SEGMENT_NUMBER "
    "FROM report_instance_segment) AS r LEFT JOIN section s ON s.DOMAIN_ID = r.DOMAIN_ID AND s.REPORT_SPECIES_ID = r.REPORT_SPECIES_ID AND s.SECTION_ID = r.SEGMENT_NUMBER",
    ["report_instance_segment", "section"],
)
def _(spark, sf):
    segs = view(spark, sf, "report_instance_segment").select("DOMAIN_ID", "REPORT_SPECIES_ID", "SEGMENT_NUMBER").distinct()
    names = view(spark, sf, "section").select("DOMAIN_ID", "REPORT_SPECIES_ID", F.col("SECTION_ID").alias("SEGMENT_NUMBER"), "NAME")
    rows = segs.join(names, ["DOMAIN_ID", "REPORT_SPECIES_ID", "SEGMENT_NUMBER"], "left").withColumn(
        "MAP_FILENAME", F.concat(F.lit("M"), (F.col("REPORT_SPECIES_ID") % 10).cast("string"))
    )
    digit = F.substring("map_filename", 2, 1)
    content = F.concat(F.lit("xx( 03-Desk "), digit, F.lit("   ( 4-Desk "), digit, F.lit("    tail"))
    texts = segs.select(F.concat(F.lit("M"), (F.col("REPORT_SPECIES_ID") % 10).cast("string")).alias("map_filename")).distinct()
    found = ins.names_in_map_text(texts.withColumn("content", content))
    return ins.segment_names(rows, found).select("REPORT_SPECIES_ID", "SEGMENT_NUMBER", "NAME")


@query(
    "match_files",
    "SELECT p_partkey, count(*) AS files, min(l_linenumber) AS first_line FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY p_partkey",
)
def _(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", F.concat(F.lit("p"), F.col("p_partkey").cast("string"), F.lit(".RPT")).alias("FILENAME"))
    listing = table(spark, sf, "lineitem").select(
        F.concat(F.lit("/in/P"), F.col("l_partkey").cast("string"), F.lit(".T"), F.col("l_linenumber").cast("string")).alias("path")
    )
    hits = ins.match_files(rows, listing)
    line = F.regexp_extract("matched_path", r"\.T(\d+)$", 1).cast("int")
    return hits.groupBy("p_partkey").agg(F.count("*").alias("files"), F.min(line).alias("first_line"))


@query(
    "locate_files",
    "SELECT p_partkey, min(l_linenumber) AS found_in FROM part LEFT JOIN lineitem ON l_partkey = p_partkey AND l_quantity > 40 AND l_linenumber BETWEEN 2 AND 4 GROUP BY p_partkey",
)
def _(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", F.concat(F.lit("X\\Y\\p"), F.col("p_partkey").cast("string")).alias("FILENAME"))
    listing = table(spark, sf, "lineitem").filter("l_quantity > 40").select(
        F.concat(F.lit("/d"), F.col("l_linenumber").cast("string"), F.lit("/p"), F.col("l_partkey").cast("string")).alias("path")
    )
    found = ins.locate_files(rows, listing, ["/d2", "/d3", "/d4"])
    return found.select("p_partkey", F.regexp_extract("found_path", r"^/d(\d)/", 1).cast("int").alias("found_in"))


_CORRELATED = f"""
SELECT m.filename, m.header_valid, m.binary_segment_count, m.error, b.MAP_FILE_ID, o.DOMAIN_ID, o.REPORT_SPECIES_ID, o.MAP_FILE_ID IS NOT NULL AS has_db_entry,
  coalesce(s.n, 0) AS db_segment_count, coalesce(c.n, 0) AS section_count, m.binary_segment_count = coalesce(s.n, 0) AS segments_match
FROM (SELECT rtrim(FILENAME) AS filename, MAP_FILE_ID % 10 <> 2 AS header_valid, MAP_FILE_ID % 6 AS binary_segment_count, CASE WHEN MAP_FILE_ID % 13 = 0 THEN 'short' END AS error FROM mapfile
   UNION ALL SELECT c_name || '.MAP', false, 0, 'unknown' FROM customer) AS m
LEFT JOIN (SELECT rtrim(FILENAME) AS filename, max(MAP_FILE_ID) AS MAP_FILE_ID FROM mapfile GROUP BY 1) AS b ON b.filename = m.filename
LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY MAP_FILE_ID ORDER BY AS_OF_TIMESTAMP DESC, DOMAIN_ID DESC, REPORT_SPECIES_ID DESC) AS rn FROM sst_storage) AS z WHERE rn = 1) AS o ON o.MAP_FILE_ID = b.MAP_FILE_ID
LEFT JOIN (SELECT {_KEY3}, count(*) AS n FROM report_instance_segment GROUP BY ALL) AS s ON s.DOMAIN_ID = o.DOMAIN_ID AND s.REPORT_SPECIES_ID = o.REPORT_SPECIES_ID AND s.AS_OF_TIMESTAMP = o.AS_OF_TIMESTAMP
LEFT JOIN (SELECT DOMAIN_ID, REPORT_SPECIES_ID, count(*) AS n FROM section GROUP BY ALL) AS c ON c.DOMAIN_ID = o.DOMAIN_ID AND c.REPORT_SPECIES_ID = o.REPORT_SPECIES_ID"""
_CORRELATED_VIEWS = ["mapfile", "sst_storage", "report_instance_segment", "section"]


def _correlated(spark, sf):
    ident = F.col("MAP_FILE_ID")
    known = view(spark, sf, "mapfile").select(
        F.rtrim("FILENAME").alias("filename"), (ident % 10 != 2).alias("header_valid"), (ident % 6).alias("binary_segment_count"),
        F.when(ident % 13 == 0, "short").alias("error"),
    )
    stray = table(spark, sf, "customer").select(
        F.concat("c_name", F.lit(".MAP")).alias("filename"), F.lit(False).alias("header_valid"), F.lit(0).cast("long").alias("binary_segment_count"),
        F.lit("unknown").alias("error"),
    )
    files = known.unionByName(stray)
    return ins.correlate_maps(files, *_all(spark, sf, _CORRELATED_VIEWS))


@query(
    "correlate_maps",
    f"SELECT filename, MAP_FILE_ID, REPORT_SPECIES_ID, has_db_entry, binary_segment_count, db_segment_count, section_count, segments_match FROM ({_CORRELATED}) AS x",
    _CORRELATED_VIEWS,
)
def _(spark, sf):
    return _correlated(spark, sf).select(
        "filename", "MAP_FILE_ID", "REPORT_SPECIES_ID", "has_db_entry", "binary_segment_count", "db_segment_count", "section_count", "segments_match"
    )


@query(
    "find_field",
    "SELECT STRUCTURE_DEF_ID, LINE_ID, FIELD_ID FROM (SELECT *, row_number() OVER (PARTITION BY STRUCTURE_DEF_ID ORDER BY LINE_ID, FIELD_ID, START_COLUMN) AS rn "
    "FROM field WHERE upper(trim(NAME)) = 'FIELD_3') AS x WHERE rn = 1",
    ["field"],
)
def _(spark, sf):
    rows = ins.find_field(view(spark, sf, "field"), " field_3 ", ["LINE_ID", "FIELD_ID", "START_COLUMN"], ["STRUCTURE_DEF_ID"])
    return rows.select("STRUCTURE_DEF_ID", "LINE_ID", "FIELD_ID")


@query(
    "report_profile",
    f"""SELECT l.REPORT_SPECIES_ID, l.STRUCTURE_DEF_ID, sp.spool_file, ix.index_file, coalesce(sg.n, 0) AS segments, sg.last_end AS last_end_page, coalesce(sc.n, 0) AS sections,
      coalesce(fd.indexed, 0) AS indexed_fields, coalesce(fd.significant, 0) AS significant_fields
    FROM ({_LATEST}) AS l
    JOIN (SELECT {_KEY3}, max(rtrim(FILENAME)) AS spool_file FROM rptfile_instance JOIN rptfile USING (RPT_FILE_ID) GROUP BY ALL) AS sp USING ({_KEY3})
    JOIN (SELECT {_KEY3}, max(rtrim(FILENAME)) AS index_file FROM sst_storage JOIN mapfile USING (MAP_FILE_ID) GROUP BY ALL) AS ix USING ({_KEY3})
    LEFT JOIN (SELECT {_KEY3}, count(*) AS n, max(START_PAGE_NUMBER + NUMBER_OF_PAGES - 1) AS last_end FROM report_instance_segment GROUP BY {_KEY3}) AS sg USING ({_KEY3})
    LEFT JOIN (SELECT DOMAIN_ID, REPORT_SPECIES_ID, count(*) AS n FROM section GROUP BY ALL) AS sc USING (DOMAIN_ID, REPORT_SPECIES_ID)
    LEFT JOIN (SELECT STRUCTURE_DEF_ID, count(*) FILTER (IS_INDEXED = 1) AS indexed, count(*) FILTER (IS_SIGNIFICANT = 1) AS significant FROM field GROUP BY ALL) AS fd USING (STRUCTURE_DEF_ID)""",
    [*INSTANCE_TABLES, "field"],
)
def _(spark, sf):
    ri, rfi, rf, sst, mf, ris, section = _all(spark, sf, INSTANCE_TABLES)
    rows = ins.report_profile(ri, rfi, rf, sst, mf, ris, section, view(spark, sf, "field"))
    size = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("long").alias(c)
    last = F.array_max(F.transform("segments", lambda s: s["end_page"])).alias("last_end_page")
    return rows.select(
        "REPORT_SPECIES_ID", "STRUCTURE_DEF_ID", "spool_file", "index_file",
        F.when(F.col("segments").isNull(), 0).otherwise(F.size("segments")).cast("long").alias("segments"), last,
        F.when(F.col("sections").isNull(), 0).otherwise(F.size("sections")).cast("long").alias("sections"),
        F.when(F.col("indexed_fields").isNull(), 0).otherwise(F.size("indexed_fields")).cast("long").alias("indexed_fields"),
        F.when(F.col("significant_fields").isNull(), 0).otherwise(F.size("significant_fields")).cast("long").alias("significant_fields"),
    )


@query(
    "section_id_hits",
    "SELECT file, candidate, sections FROM (SELECT DISTINCT l_orderkey AS file, unnest([CAST(l_linenumber AS BIGINT), l_suppkey]) AS candidate FROM lineitem) AS c "
    "JOIN (SELECT CAST(SECTION_ID AS BIGINT) AS candidate, count(*) AS sections FROM section GROUP BY 1) AS s USING (candidate)",
    ["section"],
)
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("file"), F.array(F.col("l_linenumber").cast("long"), F.col("l_suppkey")).alias("candidates")
    )
    return ins.section_id_hits(rows, view(spark, sf, "section")).select("file", "candidate", "sections")


# --- aggregates --------------------------------------------------------------------------------


@query(
    "map_stats",
    f"SELECT count(*) AS total_files, count(*) FILTER (header_valid) AS valid_headers, count(*) FILTER (error IS NOT NULL) AS errors, count(*) FILTER (has_db_entry) AS with_db_entry, "
    f"count(*) FILTER (segments_match) AS segment_matches, CAST(sum(binary_segment_count) AS BIGINT) AS binary_segments, CAST(sum(db_segment_count) AS BIGINT) AS db_segments FROM ({_CORRELATED}) AS x",
    _CORRELATED_VIEWS,
)
def _(spark, sf):
    return ag.map_stats(_correlated(spark, sf))


@query(
    "map_distributions",
    f"WITH c AS ({_CORRELATED}) SELECT 'year' AS kind, substr(filename, 1, 2) AS value, count(*) AS files FROM c GROUP BY 2 UNION ALL SELECT 'domain', CAST(DOMAIN_ID AS VARCHAR), "
    "count(*) FROM c GROUP BY 2 UNION ALL SELECT 'segments', CAST(binary_segment_count AS VARCHAR), count(*) FROM c GROUP BY 2",
    _CORRELATED_VIEWS,
)
def _(spark, sf):
    return ag.map_distributions(_correlated(spark, sf))


@query(
    "column_profile",
    "SELECT min(l_partkey) AS min_value, max(l_partkey) AS max_value, count(l_partkey) AS value_count, count(DISTINCT l_partkey) AS distinct_count FROM lineitem",
)
def _(spark, sf):
    return ag.column_profile(table(spark, sf, "lineitem"), "l_partkey")


@query(
    "segment_profile",
    f"SELECT REPORT_SPECIES_ID, {_STAMP}, segments, first_segment, last_segment FROM (SELECT {_KEY3}, count(*) AS segments, min(SEGMENT_NUMBER) AS first_segment, max(SEGMENT_NUMBER) AS last_segment "
    f"FROM report_instance_segment GROUP BY {_KEY3} ORDER BY segments DESC, {_KEY3} LIMIT 20) AS x",
    ["report_instance_segment"],
)
def _(spark, sf):
    rows = ag.segment_profile(view(spark, sf, "report_instance_segment"), 20)
    return rows.select("REPORT_SPECIES_ID", stamp("AS_OF_TIMESTAMP"), "segments", "first_segment", "last_segment")


@query(
    "maps_with_sections",
    "SELECT MAP_FILE_ID, rtrim(FILENAME) AS FILENAME, REPORT_SPECIES_ID, count(*) AS section_count FROM mapfile JOIN sst_storage USING (MAP_FILE_ID) JOIN section USING (DOMAIN_ID, REPORT_SPECIES_ID) "
    "GROUP BY MAP_FILE_ID, FILENAME, DOMAIN_ID, REPORT_SPECIES_ID HAVING count(*) > 0 ORDER BY section_count DESC, MAP_FILE_ID, REPORT_SPECIES_ID LIMIT 10",
    ["mapfile", "sst_storage", "section"],
)
def _(spark, sf):
    catalogue = ins.map_catalogue(*_all(spark, sf, ["mapfile", "sst_storage"]))
    return ag.maps_with_sections(catalogue, view(spark, sf, "section"), 10).drop("DOMAIN_ID")


@query("value_counts", "SELECT p_name AS value, count(*) AS occurrences FROM part GROUP BY p_name")
def _(spark, sf):
    return ag.value_counts(table(spark, sf, "part").select(F.col("p_name").alias("value")))


@query(
    "species_summary",
    """WITH i AS (SELECT o_custkey + 1 AS s, upper('F' || CAST(o_orderkey % 700 AS VARCHAR) || '.rpt') AS f, o_orderkey % 700 % 4 <> 1 AS rpt, o_orderkey % 700 % 5 AS secs,
        CASE WHEN o_orderkey % 3 = 0 THEN 'M' || CAST(o_orderkey % 900 AS VARCHAR) END AS m, o_orderkey % 2 = 0 AS map FROM orders WHERE o_orderstatus = 'F'),
      r AS (SELECT s, f, bool_or(rpt) AS e, max(secs) AS k FROM i GROUP BY s, f)
    SELECT c_custkey + 1 AS REPORT_SPECIES_ID, c_name AS REPORT_SPECIES_NAME, (SELECT count(*) FROM i WHERE s = c_custkey + 1) AS INSTANCE_COUNT,
      coalesce(a.RPT_FILES_EXIST, 0) AS RPT_FILES_EXIST, coalesce(a.RPT_FILES_FOUND, 0) AS RPT_FILES_FOUND, coalesce(a.MAX_SECTIONS, 0) AS MAX_SECTIONS, coalesce(b.n, 0) AS MAP_FILES_FOUND
    FROM customer LEFT JOIN (SELECT s, count(*) FILTER (e) AS RPT_FILES_EXIST, count(*) FILTER (k > 0) AS RPT_FILES_FOUND, max(k) AS MAX_SECTIONS FROM r GROUP BY s) AS a ON a.s = c_custkey + 1
    LEFT JOIN (SELECT s, count(DISTINCT upper(m)) AS n FROM i WHERE m IS NOT NULL AND map GROUP BY s) AS b ON b.s = c_custkey + 1""",
)
def _(spark, sf):
    key = F.col("o_orderkey")
    segments = F.array_join(F.transform(F.slice(F.array(*[F.lit(f"{n}#1#1") for n in range(5)]), F.lit(1), (key % 700 % 5).cast("int")), lambda x: x), "|")
    rows = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(
        (F.col("o_custkey") + 1).alias("REPORT_SPECIES_ID"),
        F.concat(F.lit("x\\f"), (key % 700).cast("string"), F.lit(".rpt")).alias("FILENAME"),
        F.when(key % 700 % 4 != 1, "Y").otherwise("N").alias("RPT_FILE_EXISTS"),
        segments.alias("SEGMENTS"),
        F.when(key % 3 == 0, F.concat(F.lit("m"), (key % 900).cast("string"))).alias("MAP_FILENAME"),
        F.when(key % 2 == 0, "Y").otherwise("N").alias("MAP_FILE_EXISTS"),
    )
    species = view(spark, sf, "species").select("REPORT_SPECIES_ID", "REPORT_SPECIES_NAME")
    return ag.species_summary(species, rows)


@query(
    "exclusive_files",
    f"SELECT RPT_FILE_ID FROM rptfile_instance GROUP BY RPT_FILE_ID HAVING bool_and(AS_OF_TIMESTAMP < TIMESTAMP '1999-01-01')",
    ["rptfile_instance"],
)
def _(spark, sf):
    refs = view(spark, sf, "rptfile_instance")
    gone = view(spark, sf, "report_instance").filter("AS_OF_TIMESTAMP < timestamp_ntz'1999-01-01'")
    return ag.exclusive_files(refs, gone, "RPT_FILE_ID")


@query(
    "signature_stats",
    f"SELECT total_rows, distinct_keys, old_rows, total_rows - old_rows AS latest_rows FROM (SELECT count(*) AS total_rows, count(DISTINCT (DOMAIN_ID, REPORT_SPECIES_ID, SIGN_ID)) AS distinct_keys, "
    f"(SELECT count(*) FROM ({_STALE}) AS o) AS old_rows FROM signature) AS x",
    ["signature"],
)
def _(spark, sf):
    return ag.signature_stats(view(spark, sf, "signature"), domain=1).drop("old_percent")


@query(
    "fields_per_signature",
    "SELECT s.REPORT_SPECIES_ID, s.SIGN_ID, count(f.FIELD_ID) AS field_count FROM signature s LEFT JOIN sensitive_field f ON f.SIGN_ID = s.SIGN_ID GROUP BY s.REPORT_SPECIES_ID, s.SIGN_ID",
    ["signature", "sensitive_field"],
)
def _(spark, sf):
    return ins.fields_per_signature(*_all(spark, sf, ["signature", "sensitive_field"]))


@query(
    "segment_value_distribution",
    "SELECT 'l_linenumber' AS name, count(l_linenumber) AS value_count, count(DISTINCT l_linenumber) AS distinct_values, CAST(min(l_linenumber) AS BIGINT) AS min_value, CAST(max(l_linenumber) AS BIGINT) AS max_value FROM lineitem "
    "UNION ALL SELECT 'l_suppkey', count(l_suppkey), count(DISTINCT l_suppkey), min(l_suppkey), max(l_suppkey) FROM lineitem",
)
def _(spark, sf):
    return ag.segment_value_distribution(table(spark, sf, "lineitem"), ["l_linenumber", "l_suppkey"])


@query("outcome_counts", "SELECT event_type AS action, count(*) AS outcomes FROM events GROUP BY event_type")
def _(spark, sf):
    return st.outcome_counts(table(spark, sf, "events").withColumnRenamed("event_type", "action"))


# --- windows, top-k ----------------------------------------------------------------------------


@query(
    "latest_per_key",
    "SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) AS x WHERE rn = 1",
)
def _(spark, sf):
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate")
    return wi.latest_per_key(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    "first_per_key",
    "SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey) AS rn FROM lineitem) AS x WHERE rn = 1",
)
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey")
    return wi.first_per_key(rows, ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey"])


_CODES = "SELECT user_id, event_id, CASE WHEN event_type IN ('click', 'view') THEN 'SG' ELSE event_type END AS code FROM events"


def _codes(spark, sf):
    return table(spark, sf, "events").select(
        F.col("user_id").alias("REPORT_SPECIES_ID"), F.col("event_id").alias("ITEM_ID"),
        F.when(F.col("event_type").isin("click", "view"), "SG").otherwise(F.col("event_type")).alias("COUNTRY_CODE"),
    )


@query(
    "running_country",
    f"SELECT user_id AS REPORT_SPECIES_ID, event_id AS ITEM_ID, coalesce(first_value(CASE WHEN code <> 'SG' THEN code END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id "
    f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'SG') AS RUNNING_CODE FROM ({_CODES}) AS c",
)
def _(spark, sf):
    return wi.running_country(_codes(spark, sf)).select("REPORT_SPECIES_ID", "ITEM_ID", "RUNNING_CODE")


@query(
    "country_conflicts",
    f"SELECT user_id AS REPORT_SPECIES_ID, event_id AS ITEM_ID, was AS EXISTING_CODE, code AS FOLDER_CODE FROM (SELECT *, first_value(CASE WHEN code <> 'SG' THEN code END IGNORE NULLS) OVER "
    f"(PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS was FROM ({_CODES}) AS c) AS x WHERE was IS NOT NULL AND was <> code",
)
def _(spark, sf):
    return wi.country_conflicts(_codes(spark, sf)).select(
        "REPORT_SPECIES_ID", "ITEM_ID", "EXISTING_CODE", F.col("COUNTRY_CODE").alias("FOLDER_CODE")
    )


@query("assign_class", "SELECT o_orderkey, CAST((row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1) % 10 AS INT) AS class FROM orders")
def _(spark, sf):
    return wi.assign_class(table(spark, sf, "orders").select("o_custkey", "o_orderkey"), ["o_custkey", "o_orderkey"]).select("o_orderkey", "class")


@query(
    "head_tail",
    "SELECT o_orderkey, CASE WHEN up <= 10 THEN 'first' ELSE 'last' END AS part, total FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS up, row_number() OVER (ORDER BY o_orderkey DESC) AS down, "
    "count(*) OVER () AS total FROM orders) AS x WHERE up <= 10 OR down <= 10",
)
def _(spark, sf):
    return fl.head_tail(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 10)


@query("top_n_distinct", "SELECT DISTINCT p_brand, p_size FROM part ORDER BY p_brand, p_size LIMIT 50")
def _(spark, sf):
    return st.top_n(table(spark, sf, "part"), ["p_brand", "p_size"], 50, ["p_brand", "p_size"])


@query(
    "next_ids",
    "SELECT (SELECT max(c_custkey) FROM customer) + 1000 + i AS c_custkey, i AS position FROM (SELECT unnest(range(1, 26)) AS i) AS r",
)
def _(spark, sf):
    return st.next_ids(table(spark, sf, "customer"), "c_custkey", 25)


# --- sets --------------------------------------------------------------------------------------


@query(
    "append_rows",
    "SELECT s_suppkey AS id, s_name AS name, '' AS segment FROM supplier UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer",
)
def _(spark, sf):
    old = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    new = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return st.append_rows(old, new)


@query("new_group_ids", "SELECT DISTINCT l_suppkey AS rid FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 12)")
def _(spark, sf):
    known = table(spark, sf, "supplier").filter("s_nationkey < 12").select(F.col("s_suppkey").alias("GROUP_ID"))
    return st.new_group_ids(table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("rid")), known)


@query(
    "pick_users_and_assignments",
    "WITH u AS (SELECT USER_ID FROM scm_users WHERE trim(USERNAME) IN ('Customer#000000003', 'Customer#000000140') UNION ALL SELECT USER_ID FROM (SELECT USER_ID FROM scm_users "
    "WHERE trim(USERNAME) NOT IN ('Customer#000000003', 'Customer#000000140') ORDER BY USER_ID LIMIT 40) AS t) SELECT USER_ID, GROUP_ID FROM scm_user_group WHERE USER_ID IN (SELECT USER_ID FROM u)",
    ["scm_users", "scm_user_group"],
)
def _(spark, sf):
    users = st.pick_users(view(spark, sf, "scm_users"), ["Customer#000000003", "Customer#000000140"], 40)
    return st.filter_assignments(view(spark, sf, "scm_user_group"), users).select("USER_ID", "GROUP_ID")


@query(
    "compare_outputs",
    "WITH a AS (SELECT o_custkey AS k, o_orderstatus AS s FROM orders WHERE o_totalprice < 400000), b AS (SELECT o_custkey AS k, o_orderstatus AS s FROM orders WHERE o_totalprice >= 60000), "
    "c AS (SELECT k, s, 1 AS x, 0 AS y FROM a UNION ALL SELECT k, s, 0, 1 FROM b) SELECT k, s, CAST(sum(x) AS BIGINT) AS copies_a, CAST(sum(y) AS BIGINT) AS copies_b FROM c GROUP BY k, s HAVING sum(x) <> sum(y)",
)
def _(spark, sf):
    rows = lambda kept: table(spark, sf, "orders").filter(kept).select(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("s"))
    return st.compare_outputs(rows("o_totalprice < 400000"), rows("o_totalprice >= 60000"))


@query(
    "compare_by_key",
    "SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'only_a' WHEN a.o_orderkey IS NULL THEN 'only_b' ELSE 'mismatch' END AS status "
    "FROM (SELECT o_orderkey, o_orderstatus AS s FROM orders WHERE o_totalprice < 400000) AS a FULL JOIN (SELECT o_orderkey, CASE WHEN o_custkey % 9 = 0 THEN 'X' ELSE o_orderstatus END AS s FROM orders "
    "WHERE o_totalprice >= 60000) AS b ON a.o_orderkey = b.o_orderkey WHERE a.s IS DISTINCT FROM b.s",
)
def _(spark, sf):
    base = table(spark, sf, "orders")
    a = base.filter("o_totalprice < 400000").select("o_orderkey", F.col("o_orderstatus").alias("s"))
    b = base.filter("o_totalprice >= 60000").select("o_orderkey", F.when(F.col("o_custkey") % 9 == 0, "X").otherwise(F.col("o_orderstatus")).alias("s"))
    return st.compare_outputs(a, b, ["o_orderkey"]).select("o_orderkey", "status")


_CHANGED = "SELECT o_orderkey, o_custkey, CASE WHEN o_totalprice > 450000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders WHERE o_totalprice >= 2000"


@query(
    "compare_stored_outputs",
    "SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'only_a' ELSE 'mismatch' END AS status "
    f"FROM orders AS a LEFT JOIN ({_CHANGED}) AS b ON a.o_orderkey = b.o_orderkey WHERE a.o_orderstatus IS DISTINCT FROM b.o_orderstatus",
)
def _(spark, sf):
    base = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    status = F.when(F.col("o_totalprice") > 450000, "X").otherwise(F.col("o_orderstatus"))
    a, b = scratch_path(spark, "output-a"), scratch_path(spark, "output-b")
    ht.store_with_tree(base, a, ["o_orderkey"])
    ht.store_with_tree(base.filter("o_totalprice >= 2000").withColumn("o_orderstatus", status), b, ["o_orderkey"])
    return ht.compare_stored(spark, a, b, ["o_orderkey"]).select("o_orderkey", "status")


@query(
    "compare_by_position",
    "WITH a AS (SELECT o_orderkey AS k, row_number() OVER (ORDER BY o_orderkey) - 1 AS position FROM orders WHERE o_orderkey <> 700), b AS (SELECT o_orderkey AS k, row_number() OVER (ORDER BY o_orderkey) - 1 AS position FROM orders "
    "WHERE o_orderkey <> 900) SELECT position, CASE WHEN b.k IS NULL THEN 'only_a' WHEN a.k IS NULL THEN 'only_b' ELSE 'mismatch' END AS status FROM a FULL JOIN b USING (position) WHERE a.k IS DISTINCT FROM b.k",
)
def _(spark, sf):
    base = table(spark, sf, "orders").select("o_orderkey")
    return st.compare_by_position(base.filter("o_orderkey <> 700"), base.filter("o_orderkey <> 900"), ["o_orderkey"]).select("position", "status")


@query(
    "reconcile",
    "SELECT c_custkey, CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F' AND o_totalprice > 300000) THEN 'found' ELSE 'missing' END AS status FROM customer",
)
def _(spark, sf):
    actual = table(spark, sf, "orders").filter("o_orderstatus = 'F' AND o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return st.reconcile(table(spark, sf, "customer").select("c_custkey"), actual, "c_custkey")


@query(
    "intersect_pages",
    "SELECT l_orderkey AS file, CAST(l_linenumber AS BIGINT) AS page FROM lineitem WHERE l_quantity > 20 INTERSECT SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R'",
)
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("file"), F.col("l_linenumber").cast("long").alias("page"), "l_quantity", "l_returnflag")
    return st.intersect_pages(rows.filter("l_quantity > 20"), rows.filter("l_returnflag = 'R'"))


# --- hierarchy ---------------------------------------------------------------------------------

_TREE = """
WITH RECURSIVE tree AS (
  SELECT ITEM_ID, NAME, PARENT_ID, ITEM_TYPE, CASE WHEN upper(trim(NAME)) IN ('HK', 'MY', 'SG') THEN upper(trim(NAME)) ELSE 'SG' END AS COUNTRY_CODE
  FROM folder WHERE PARENT_ID = 0 AND ITEM_TYPE <> 3
  UNION ALL
  SELECT f.ITEM_ID, f.NAME, f.PARENT_ID, f.ITEM_TYPE, CASE WHEN upper(trim(f.NAME)) IN ('HK', 'MY', 'SG') THEN upper(trim(f.NAME)) ELSE t.COUNTRY_CODE END
  FROM folder f JOIN tree t ON f.PARENT_ID = t.ITEM_ID WHERE f.ITEM_TYPE <> 3)
SELECT * FROM tree"""


def _coded(spark, sf):
    return hi.inherit_country(view(spark, sf, "folder"))


@query("folder_hierarchy", _TREE, ["folder"])
def folder_hierarchy(spark, sf):
    return hi.folder_hierarchy(_coded(spark, sf))


@query(
    "excluded_folders",
    f"SELECT count(*) AS excluded, count(*) FILTER (ITEM_TYPE = 3) AS type_3, count(*) FILTER (ITEM_TYPE <> 3) AS other FROM folder WHERE ITEM_ID NOT IN (SELECT ITEM_ID FROM ({_TREE}) AS t)",
    ["folder"],
)
def _(spark, sf):
    folder = view(spark, sf, "folder")
    return hi.excluded_folders(folder, hi.valid_folders(folder))


@query("country_counts", f"SELECT COUNTRY_CODE, count(*) AS folders FROM ({_TREE}) AS t GROUP BY COUNTRY_CODE", ["folder"])
def _(spark, sf):
    return ag.country_counts(_coded(spark, sf))


_MAPPED = f"""SELECT t.ITEM_ID, t.NAME AS ITEM_NAME, fs.DOMAIN_ID, fs.REPORT_SPECIES_ID, t.COUNTRY_CODE AS code FROM folder_species fs JOIN ({_TREE}) AS t ON t.ITEM_ID = fs.ITEM_ID WHERE fs.REPORT_SPECIES_ID <> 0"""
_HIER_VIEWS = ["folder", "folder_species", "report_species_name"]


@query(
    "folder_report",
    f"""SELECT m.ITEM_ID, m.ITEM_NAME, m.REPORT_SPECIES_ID, coalesce(n.REPORT_SPECIES_NAME, 'UNKNOWN_' || CAST(m.REPORT_SPECIES_ID AS VARCHAR)) AS REPORT_SPECIES_NAME,
      coalesce(n.REPORT_SPECIES_DISPLAYNAME, 'UNKNOWN_' || CAST(m.REPORT_SPECIES_ID AS VARCHAR)) AS REPORT_SPECIES_DISPLAYNAME,
      coalesce(first_value(CASE WHEN code <> 'SG' THEN code END IGNORE NULLS) OVER (PARTITION BY m.REPORT_SPECIES_ID ORDER BY m.ITEM_ID ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'SG') AS COUNTRY_CODE
    FROM ({_MAPPED}) AS m LEFT JOIN ({_NAMES}) AS n ON n.DOMAIN_ID = m.DOMAIN_ID AND n.REPORT_SPECIES_ID = m.REPORT_SPECIES_ID""",
    _HIER_VIEWS,
)
def folder_report(spark, sf):
    return hi.folder_report(_coded(spark, sf), *_all(spark, sf, _HIER_VIEWS[1:]))


@query(
    "report_species",
    f"""SELECT m.REPORT_SPECIES_ID, coalesce(n.REPORT_SPECIES_NAME, 'UNKNOWN_' || CAST(m.REPORT_SPECIES_ID AS VARCHAR)) AS REPORT_SPECIES_NAME,
      coalesce(n.REPORT_SPECIES_DISPLAYNAME, 'UNKNOWN_' || CAST(m.REPORT_SPECIES_ID AS VARCHAR)) AS REPORT_SPECIES_DISPLAYNAME, m.COUNTRY_CODE, CAST(1 AS INT) AS IN_USE
    FROM (SELECT REPORT_SPECIES_ID, arg_min(DOMAIN_ID, ITEM_ID) AS DOMAIN_ID, coalesce(arg_min(code, ITEM_ID) FILTER (code <> 'SG'), 'SG') AS COUNTRY_CODE FROM ({_MAPPED}) AS x GROUP BY REPORT_SPECIES_ID) AS m
    LEFT JOIN ({_NAMES}) AS n ON n.DOMAIN_ID = m.DOMAIN_ID AND n.REPORT_SPECIES_ID = m.REPORT_SPECIES_ID""",
    _HIER_VIEWS,
)
def _(spark, sf):
    return hi.report_species(_coded(spark, sf), *_all(spark, sf, _HIER_VIEWS[1:]))


@query(
    "folder_conflicts",
    f"""SELECT REPORT_SPECIES_ID, ITEM_ID, was AS EXISTING_CODE, code AS FOLDER_CODE FROM (SELECT *, first_value(CASE WHEN code <> 'SG' THEN code END IGNORE NULLS) OVER
      (PARTITION BY REPORT_SPECIES_ID ORDER BY ITEM_ID ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS was FROM ({_MAPPED}) AS m) AS x WHERE was <> code""",
    _HIER_VIEWS[:2],
)
def _(spark, sf):
    return hi.conflicts(_coded(spark, sf), view(spark, sf, "folder_species"))


@query(
    "mark_in_use",
    "SELECT REPORT_SPECIES_ID, CASE WHEN REPORT_SPECIES_ID IN (SELECT o_custkey + 1 FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01') THEN 1 ELSE 0 END AS IN_USE FROM species",
    ["species"],
)
def _(spark, sf):
    recent = fl.year_window(view(spark, sf, "report_instance"), "AS_OF_TIMESTAMP", 2001)
    return hi.mark_in_use(view(spark, sf, "species"), recent).select("REPORT_SPECIES_ID", "IN_USE")


# --- retention ---------------------------------------------------------------------------------


def _upper(spark, sf):
    return {n.upper(): view(spark, sf, n) for n in INSTANCE_TABLES}


_GONE = f"SELECT DISTINCT {_KEY3} FROM report_instance WHERE AS_OF_TIMESTAMP >= TIMESTAMP '1996-01-01' AND AS_OF_TIMESTAMP <= TIMESTAMP '1998-12-31'"


def _semi(alias: str) -> str:
    return (
        f"EXISTS (SELECT 1 FROM ({_GONE}) AS g WHERE g.DOMAIN_ID = {alias}.DOMAIN_ID AND g.REPORT_SPECIES_ID = {alias}.REPORT_SPECIES_ID "
        f"AND g.AS_OF_TIMESTAMP = {alias}.AS_OF_TIMESTAMP)"
    )


def _exclusive(refs: str, ident: str) -> str:
    return (
        f"SELECT {ident} FROM (SELECT r.{ident}, g.DOMAIN_ID IS NOT NULL AS hit FROM {refs} r LEFT JOIN ({_GONE}) AS g USING ({_KEY3})) AS z GROUP BY {ident} HAVING bool_and(hit)"
    )


@query(
    "instance_retention_plan",
    f"""SELECT CAST(1 AS INT) AS step, 'REPORT_INSTANCE_SEGMENT' AS table_name, count(*) AS rows FROM report_instance_segment x WHERE {_semi('x')}
    UNION ALL SELECT 2, 'SST_STORAGE', count(*) FROM sst_storage x WHERE {_semi('x')}
    UNION ALL SELECT 3, 'MAPFILE', count(*) FROM mapfile WHERE MAP_FILE_ID IN ({_exclusive('sst_storage', 'MAP_FILE_ID')})
    UNION ALL SELECT 4, 'RPTFILE_INSTANCE', count(*) FROM rptfile_instance x WHERE {_semi('x')}
    UNION ALL SELECT 5, 'RPTFILE', count(*) FROM rptfile WHERE RPT_FILE_ID IN ({_exclusive('rptfile_instance', 'RPT_FILE_ID')})
    UNION ALL SELECT 6, 'REPORT_INSTANCE', count(*) FROM report_instance x WHERE {_semi('x')}""",
    INSTANCE_TABLES[:6],
)
def _(spark, sf):
    plan = rt.instance_retention(_upper(spark, sf), "1996-01-01", "1998-12-31")
    return ag.plan_counts({name: parts[0] for name, parts in plan.items()})


@query(
    "instance_retention_kept_files",
    f"SELECT RPT_FILE_ID, FILENAME FROM rptfile WHERE RPT_FILE_ID NOT IN ({_exclusive('rptfile_instance', 'RPT_FILE_ID')})",
    ["report_instance", "rptfile", "rptfile_instance"],
)
def _(spark, sf):
    return rt.instance_retention(_upper(spark, sf), "1996-01-01", "1998-12-31")["RPTFILE"][1].select("RPT_FILE_ID", "FILENAME")


@query(
    "retention_candidates",
    "SELECT (SELECT count(*) FROM report_instance WHERE AS_OF_TIMESTAMP >= TIMESTAMP '1996-01-01' AND AS_OF_TIMESTAMP <= TIMESTAMP '1998-12-31') AS instances, "
    "(SELECT count(*) FROM report_instance r LEFT JOIN report_species_name n ON n.DOMAIN_ID = r.DOMAIN_ID AND n.REPORT_SPECIES_ID = r.REPORT_SPECIES_ID "
    "WHERE AS_OF_TIMESTAMP >= TIMESTAMP '1996-01-01' AND AS_OF_TIMESTAMP <= TIMESTAMP '1998-12-31') AS listed_rows",
    ["report_instance", "report_species_name"],
)
def _(spark, sf):
    return rt.candidate_counts(view(spark, sf, "report_instance"), view(spark, sf, "report_species_name"), "1996-01-01", "1998-12-31")


@query(
    "signature_retention_collateral",
    f"SELECT SIGN_ID, MINOR_VERSION, REPORT_SPECIES_ID, DESCRIPTION FROM signature s WHERE MINOR_VERSION = (SELECT max(MINOR_VERSION) FROM signature n WHERE n.DOMAIN_ID = s.DOMAIN_ID AND "
    f"n.REPORT_SPECIES_ID = s.REPORT_SPECIES_ID AND n.SIGN_ID = s.SIGN_ID) AND EXISTS (SELECT 1 FROM ({_STALE}) AS o WHERE o.SIGN_ID = s.SIGN_ID AND o.MINOR_VERSION = s.MINOR_VERSION)",
    ["signature"],
)
def _(spark, sf):
    plan = rt.signature_retention(*_all(spark, sf, ["signature", "sensitive_field", "lines_in_sign"]))
    return plan["collateral"][0].drop("DOMAIN_ID")


@query(
    "signature_retention_exact",
    f"SELECT s.SIGN_ID, s.MINOR_VERSION, s.REPORT_SPECIES_ID FROM ({_STALE}) AS s",
    ["signature"],
)
def _(spark, sf):
    """With ``exact``, stale signatures only."""
    plan = rt.signature_retention(*_all(spark, sf, ["signature", "sensitive_field", "lines_in_sign"]), exact=True)
    return plan["SIGNATURE"][0].select("SIGN_ID", "MINOR_VERSION", "REPORT_SPECIES_ID")


@query(
    "signature_fields_of_version",
    "SELECT s.SIGN_ID, s.MINOR_VERSION, s.REPORT_SPECIES_ID, sf.LINE_ID, sf.FIELD_ID, rtrim(sf.NAME) AS SENSITIVE_NAME, sf.SENSITIVITY, f.FIELD_NAME "
    "FROM signature s LEFT JOIN sensitive_field sf ON sf.SIGN_ID = s.SIGN_ID AND sf.MINOR_VERSION = s.MINOR_VERSION LEFT JOIN (SELECT DISTINCT LINE_ID, FIELD_ID, rtrim(NAME) AS FIELD_NAME "
    "FROM field) AS f ON f.LINE_ID = sf.LINE_ID AND f.FIELD_ID = sf.FIELD_ID",
    ["signature", "sensitive_field", "field"],
)
def _(spark, sf):
    return ins.signature_fields(*_all(spark, sf, ["signature", "sensitive_field", "field"])).drop("DOMAIN_ID")


@query(
    "signature_retention_plan",
    f"WITH k AS (SELECT DISTINCT SIGN_ID, MINOR_VERSION FROM ({_STALE}) AS o) SELECT CAST(1 AS INT) AS step, 'LINES_IN_SIGN' AS table_name, count(*) AS rows FROM lines_in_sign JOIN k USING (SIGN_ID, MINOR_VERSION) "
    "UNION ALL SELECT 2, 'SENSITIVE_FIELD', count(*) FROM sensitive_field JOIN k USING (SIGN_ID, MINOR_VERSION) UNION ALL SELECT 3, 'SIGNATURE', count(*) FROM signature JOIN k USING (SIGN_ID, MINOR_VERSION)",
    ["signature", "sensitive_field", "lines_in_sign"],
)
def _(spark, sf):
    plan = rt.signature_retention(*_all(spark, sf, ["signature", "sensitive_field", "lines_in_sign"]))
    return ag.plan_counts({name: parts[0] for name, parts in plan.items() if name != "collateral"})


@query(
    "file_retention",
    "SELECT 'RPTFILE' AS table_name, RPT_FILE_ID AS file_id FROM rptfile WHERE RPT_FILE_ID NOT IN (SELECT RPT_FILE_ID FROM rptfile_instance) UNION ALL "
    "SELECT 'MAPFILE', MAP_FILE_ID FROM mapfile WHERE MAP_FILE_ID NOT IN (SELECT MAP_FILE_ID FROM sst_storage)",
    ["rptfile", "rptfile_instance", "mapfile", "sst_storage"],
)
def _(spark, sf):
    plan = rt.file_retention(*_all(spark, sf, ["rptfile", "rptfile_instance", "mapfile", "sst_storage"]))
    one = lambda name, ident: plan[name][0].select(F.lit(name).alias("table_name"), F.col(ident).alias("file_id"))
    return one("RPTFILE", "RPT_FILE_ID").unionByName(one("MAPFILE", "MAP_FILE_ID"))


@query(
    "relationship_report",
    "WITH p AS (SELECT DISTINCT SIGN_ID, MINOR_VERSION FROM signature) SELECT 'SENSITIVE_FIELD' AS child, true AS shares_keys, count(*) AS rows, count(*) FILTER (p.SIGN_ID IS NULL) AS orphan_rows FROM sensitive_field c LEFT JOIN p USING (SIGN_ID, MINOR_VERSION) "
    "UNION ALL SELECT 'LINES_IN_SIGN', true, count(*), count(*) FILTER (p.SIGN_ID IS NULL) FROM lines_in_sign c LEFT JOIN p USING (SIGN_ID, MINOR_VERSION) UNION ALL SELECT 'SECTION', false, count(*), NULL FROM section",
    ["signature", "sensitive_field", "lines_in_sign", "section"],
)
def _(spark, sf):
    children = {n.upper(): view(spark, sf, n) for n in ("sensitive_field", "lines_in_sign", "section")}
    return rt.relationship_report(view(spark, sf, "signature"), children, rt.VERSION_KEYS)

"""Catalogue operators: hierarchy edge cases, running codes, retention, resources, sources, streaming."""

import random

import pytest
from pyspark.sql import functions as F

from foliant.functions import text as tx
from foliant.operators import aggregates as ag
from foliant.operators import generators as gen
from foliant.operators import hierarchy as hi
from foliant.operators import instances as ins
from foliant.operators import resources as rs
from foliant.operators import retention as rt
from foliant.operators import sets as st
from foliant.operators import windows as wi
from foliant.sources import catalogue as cat
from foliant.sources import files as fs
from foliant.streaming import ingest


def values(df, col):
    return sorted(r[col] for r in df.collect())


# --- hierarchy

FOLDERS = [
    (1, "Root", 0, 1), (2, " hk ", 1, 1), (3, "deep", 2, 1), (4, "sg", 3, 1), (5, "x", 4, 1),
    (10, "typed", 1, 3), (11, "below typed", 10, 1), (20, "orphan", 99, 1), (21, "below orphan", 20, 1),
    (30, "c1", 31, 1), (31, "c2", 30, 1), (32, "self", 32, 1), (33, "on cycle", 30, 1), (40, "US", 0, 1), (41, "QQ", 40, 1), (50, "t", 0, 3),
]


@pytest.fixture(scope="module")
def folders(spark):
    return spark.createDataFrame(FOLDERS, "ITEM_ID int, NAME string, PARENT_ID int, ITEM_TYPE int")


def test_forest_keeps_only_what_reaches_a_root(folders):
    coded = hi.inherit_country(folders)
    assert {r["ITEM_ID"]: r["COUNTRY_CODE"] for r in coded.collect()} == {1: "SG", 2: "HK", 3: "HK", 4: "SG", 5: "SG", 40: "US", 41: "US"}
    assert tuple(hi.excluded_folders(folders, hi.valid_folders(folders)).first()) == (9, 2, 7)
    assert {r["COUNTRY_CODE"] for r in hi.inherit_country(folders, "JP").collect()} == {"JP"}


def test_forest_of_a_long_chain_needs_few_rounds(spark):
    chain = spark.range(1, 301).select(
        F.col("id").alias("ITEM_ID"), F.when(F.col("id") == 1, "MY").otherwise("n").alias("NAME"), (F.col("id") - 1).alias("PARENT_ID"), F.lit(1).alias("ITEM_TYPE")
    )
    coded = hi.inherit_country(chain)
    assert coded.count() == 300 and coded.filter("COUNTRY_CODE = 'MY'").count() == 300


def test_species_tables_keep_running_and_final_codes(spark, folders):
    links = spark.createDataFrame([(1, 1, 7), (2, 1, 7), (4, 1, 7), (40, 1, 7), (2, 1, 0), (3, 1, -5), (20, 1, 8), (5, 1, 9)],
                                  "ITEM_ID int, DOMAIN_ID int, REPORT_SPECIES_ID int")
    names = spark.createDataFrame([(1, 7, 0, "Display  "), (1, 7, 1, ""), (1, 9, 1, "only one")], "DOMAIN_ID int, REPORT_SPECIES_ID int, ITEM_ID int, NAME string")
    coded = hi.inherit_country(folders)
    report = {(r["REPORT_SPECIES_ID"], r["ITEM_ID"]): r for r in hi.folder_report(coded, links, names).collect()}
    assert [report[7, i]["COUNTRY_CODE"] for i in (1, 2, 4, 40)] == ["SG", "HK", "HK", "HK"]
    assert (report[7, 1]["REPORT_SPECIES_NAME"], report[7, 1]["REPORT_SPECIES_DISPLAYNAME"]) == ("", "Display")
    assert (report[9, 5]["REPORT_SPECIES_NAME"], report[9, 5]["REPORT_SPECIES_DISPLAYNAME"]) == ("only one", "UNKNOWN_9")
    assert (-5, 3) in report and not any(k[0] in (0, 8) for k in report)
    species = {r["REPORT_SPECIES_ID"]: r["COUNTRY_CODE"] for r in hi.report_species(coded, links, names).collect()}
    assert species == {7: "HK", 9: "SG"}
    found = {(r["ITEM_ID"], r["EXISTING_CODE"], r["FOLDER_CODE"]) for r in hi.conflicts(coded, links).collect()}
    assert found == {(4, "HK", "SG"), (40, "HK", "US")}


def test_running_code_equals_the_fold_on_random_data(spark):
    rnd = random.Random(9)
    rows = [(rnd.choice([1, 1, 1, 2, 3]), i, rnd.choice(["SG", "SG", "HK", "MY"])) for i in range(300)]
    state, running, conflicts = {}, {}, set()
    for key, i, code in rows:
        old = state.get(key)
        if old is None or old == "SG":
            state[key] = code
        elif code != old:
            conflicts.add(i)
        running[i] = state[key]
    df = spark.createDataFrame(rows, "REPORT_SPECIES_ID int, ITEM_ID int, COUNTRY_CODE string")
    assert {r["ITEM_ID"]: r["RUNNING_CODE"] for r in wi.running_country(df).collect()} == running
    assert {r["ITEM_ID"] for r in wi.country_conflicts(df).collect()} == conflicts
    assert {r["REPORT_SPECIES_ID"]: r["FINAL_CODE"] for r in wi.final_country(df).collect()} == state


# --- names, dates, resources


def test_dates_years_and_names(spark):
    df = spark.createDataFrame([("A\\b/24366x.rpt",), ("23366",), ("24x12",), ("2401",), ("24000",)], "p string")
    stem = tx.strip_ext(tx.base_name(F.col("p")))
    assert [r[0] for r in df.select(tx.julian_date(stem)).collect()] == ["2024-12-31", "2024-01-01", "", "", "2023-12-31"]
    years = spark.createDataFrame([(" 2024 ",), ("x 2023 y",), ("20235",), ("12345 abc",), ("",), (None,)], "y string")
    assert [r[0] for r in years.select(tx.clean_year(F.col("y"))).collect()] == ["2024", "2023", "20235", "UNKNOWN", "UNKNOWN", "UNKNOWN"]
    ts = spark.sql("SELECT timestamp_ntz'2024-07-01 06:30:00.5' t UNION ALL SELECT timestamp_ntz'2024-01-01 06:30:00'")
    assert values(ts.select(tx.to_utc(F.col("t"), "Europe/London").alias("u")), "u") == ["2024-01-01 06:30:00", "2024-07-01 05:30:00"]
    assert spark.sql("SELECT 1").select(tx.to_utc(F.lit(None).cast("timestamp_ntz"), "UTC")).first()[0] == ""


def test_resource_types(spark):
    names = ["C0ARL05B.RCS", "c1x", "F1ABR10.RFD", "zz.rpd", "README.txt", ".RCS", "noext"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    got = [r[0] for r in df.orderBy("i").select(tx.resource_type(F.col("n"))).collect()]
    assert got == ["CharSet_Raster", "CharSet_Outline", "Formdef", "PageDef", "Unknown", "Unknown", "Unknown"]


def test_version_dedup_equals_the_fold_on_random_data(spark):
    rnd = random.Random(4)
    rows = [("N", f"f{k}", f"20{20 + i // 24:02d}_{i % 12 + 1:02d}_01_{i % 24:02d}", rnd.choice([None, 1, 2, 3])) for k in range(6) for i in range(48)]
    want = set()
    for k in range(6):
        mine = sorted((r for r in rows if r[1] == f"f{k}"), key=lambda r: r[2], reverse=True)
        kept = [mine[0]]
        for r in mine[1:]:
            if r[3] != kept[-1][3] and r[3] != mine[0][3]:
                kept.append(r)
        want |= set(kept)
    df = spark.createDataFrame(rows, "namespace string, filename string, version string, crc long")
    assert {tuple(r) for r in wi.dedupe_versions(df).collect()} == want


def test_version_tree_on_disk(spark, tmp_path):
    for ns, version, name, body in [("HK", "2024_01_02_03", "C0A.RCS", "a"), ("HK", "2023_01_02_03", "C0A.RCS", "a"), ("MY", "2024_01_02_03", "C0A.RCS", "b"),
                                    ("MY", "2024_01_02_03", "x.txt", "b"), ("MY", "notes", "C0B.RCS", "b")]:
        folder = tmp_path / ns / version
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(body)
    rows = fs.scan_versions(spark, str(tmp_path), with_crc=True)
    assert {(r["namespace"], r["version"], r["filename"]) for r in rows.collect()} == {
        ("HK", "2024_01_02_03", "C0A.RCS"), ("HK", "2023_01_02_03", "C0A.RCS"), ("MY", "2024_01_02_03", "C0A.RCS")}
    inventory, kept = rs.resource_inventory(rows.drop("path"))
    assert {r["namespace"]: r["versions"] for r in inventory.collect()} == {"HK": ["2024_01_02_03"], "MY": ["2024_01_02_03"]}
    stats = ag.resource_stats(rows, kept).first()
    assert (stats["unique_resources"], stats["max_versions"], stats["removed"]) == (2, 2, 1)
    merged, _ = rs.resource_inventory(rows.drop("path"), merged=True)
    assert merged.first()["versions"] == ["MY\\2024_01_02_03", "HK\\2024_01_02_03"]
    wide = wi.version_matrix(kept, wide=True, columns=2)
    assert {(r["V1"], r["V2"]) for r in wide.collect()} == {("2024_01_02_03", "")}
    # one version folder at the root makes the tree flat
    (tmp_path / "2022_01_01_01").mkdir()
    (tmp_path / "2022_01_01_01" / "P1X").write_text("p")
    assert [(r["namespace"], r["version"]) for r in fs.scan_versions(spark, str(tmp_path), "D").collect()] == [("D", "2022_01_01_01")]
    assert fs.scan_versions(spark, str(tmp_path), from_year=2023).count() == 0


def test_archive_manifest_simulation_and_reports(spark):
    rows = spark.createDataFrame([(1, "S", "a.rpt", "2024"), (1, "S", "b.RPT", "x"), (1, "S", " ", "2024")], "SPECIES_ID int, SPECIES_NAME string, FILENAME string, YEAR string")
    none = spark.createDataFrame([], "path string")
    listing = spark.createDataFrame([("/in/a.TXT",), ("/in/a.PDF",)], "path string")
    got = {r["FILENAME"]: (r["STATUS"], r["COMPRESSED_FILENAME"], r["FILE_COUNT"]) for r in rs.archive_manifest(rows, listing, none).collect()}
    assert got == {"a.rpt": ("PLANNED", "\\2024\\a.zip", 2), "b.RPT": ("NO_FILES_FOUND", "", 0)}
    assert values(rs.missing_files(rs.archive_manifest(rows, listing, none)), "FILENAME") == ["b.RPT"]
    assert values(rs.archive_manifest(rows, listing, none, simulate=True), "COMPRESSED_FILENAME") == ["\\SIMULATE\\2024\\a.zip", "\\SIMULATE\\UNKNOWN\\b.zip"]
    species = spark.createDataFrame([(1,), (2,)], "SPECIES_ID int")
    assert values(rs.missing_species(species, rows), "SPECIES_ID") == [2]


# --- instances and retention

KEY = "1 DOMAIN_ID, 5 REPORT_SPECIES_ID, timestamp_ntz'{}' AS_OF_TIMESTAMP, 0 REPROCESS_IN_PROGRESS"


def test_instance_without_segments_and_both_year_boundaries(spark):
    at = lambda *ts: spark.sql(" UNION ALL ".join("SELECT " + KEY.format(t) for t in ts))
    ri = at("2023-12-31 23:59:59", "2024-01-01 00:00:00", "2024-12-31 23:59:59", "2025-01-01 00:00:00")
    empty = lambda ddl: spark.createDataFrame([], ddl)
    key = "DOMAIN_ID int, REPORT_SPECIES_ID int, AS_OF_TIMESTAMP timestamp_ntz, REPROCESS_IN_PROGRESS int"
    rows = ins.instances_with_segments(
        ri, empty(key + ", RPT_FILE_ID int"), empty("RPT_FILE_ID int, FILENAME string"),
        empty(key + ", SEGMENT_NUMBER int, START_PAGE_NUMBER int, NUMBER_OF_PAGES int"),
        empty("DOMAIN_ID int, REPORT_SPECIES_ID int, SECTION_ID int, NAME string"), empty(key + ", MAP_FILE_ID int"),
        empty("MAP_FILE_ID int, FILENAME string"), 2024, 2024,
    ).collect()
    assert sorted(str(r["AS_OF_TIMESTAMP"]) for r in rows) == ["2024-01-01 00:00:00", "2024-12-31 23:59:59"]
    assert {r["segments"] for r in rows} == {"##0#"}


def test_shared_file_stays_and_last_day_rule(spark):
    at = lambda ts, extra="": f"SELECT {KEY.format(ts)}{extra}"
    ri = spark.sql(" UNION ALL ".join(at(t) for t in ("2020-01-01 00:00:00", "2020-01-31 00:00:00", "2020-01-31 08:00:00")))
    link = spark.sql(" UNION ALL ".join([at("2020-01-01 00:00:00", ", 1 RPT_FILE_ID"), at("2020-01-31 08:00:00", ", 1 RPT_FILE_ID"), at("2020-01-31 00:00:00", ", 2 RPT_FILE_ID")]))
    tables = {
        "REPORT_INSTANCE": ri, "RPTFILE_INSTANCE": link, "RPTFILE": spark.createDataFrame([(1,), (2,), (3,)], "RPT_FILE_ID int"),
        "SST_STORAGE": link.withColumnRenamed("RPT_FILE_ID", "MAP_FILE_ID"), "MAPFILE": spark.createDataFrame([(1,)], "MAP_FILE_ID int"),
        "REPORT_INSTANCE_SEGMENT": ri,
    }
    plan = rt.instance_retention(tables, "2020-01-01", "2020-01-31")
    assert (plan["REPORT_INSTANCE"][0].count(), values(plan["RPTFILE"][0], "RPT_FILE_ID"), values(plan["RPTFILE"][1], "RPT_FILE_ID")) == (2, [2], [1, 3])
    assert list(plan) == ["REPORT_INSTANCE_SEGMENT", "SST_STORAGE", "MAPFILE", "RPTFILE_INSTANCE", "RPTFILE", "REPORT_INSTANCE"]
    whole = rt.instance_retention(tables, "2020-01-01", "2020-01-31", end_of_day=True)
    assert values(whole["RPTFILE"][0], "RPT_FILE_ID") == [1, 2]
    assert rt.instance_retention(tables, check_files=False)["RPTFILE"][0].count() == 0


def test_wide_signature_delete_lists_its_collateral(spark):
    sig = spark.createDataFrame([(1, 1, 1, 10), (1, 2, 1, 10), (1, 1, 1, 11), (2, 1, 1, 10)], "SIGN_ID int, MINOR_VERSION int, DOMAIN_ID int, REPORT_SPECIES_ID int")
    child = spark.createDataFrame([(1, 1), (1, 2), (9, 9)], "SIGN_ID int, MINOR_VERSION int")
    plan = rt.signature_retention(sig, child, child)
    assert [tuple(r) for r in plan["collateral"][0].select("SIGN_ID", "MINOR_VERSION", "REPORT_SPECIES_ID").collect()] == [(1, 1, 11)]
    assert (plan["SIGNATURE"][0].count(), plan["SENSITIVE_FIELD"][0].count()) == (2, 1)
    exact = rt.signature_retention(sig, child, child, exact=True)
    assert (exact["SIGNATURE"][0].count(), exact["SIGNATURE"][1].count(), exact["LINES_IN_SIGN"][0].count()) == (1, 3, 0)
    stats = ag.signature_stats(sig).first()
    assert (stats["total_rows"], stats["distinct_keys"], stats["old_rows"], stats["old_percent"]) == (4, 3, 1, 25.0)


def test_segment_names_fall_back_only_when_asked(spark):
    segs = spark.createDataFrame([("M", 4, "", 1), ("M", 7, None, 1), ("M", 9, "own", 1)], "MAP_FILENAME string, SEGMENT_NUMBER int, NAME string, x int")
    texts = spark.createDataFrame([("M", "junk( 04-Ann Lee   ( 7-Old  ( 07-New   ")], "map_filename string, content string")
    names = ins.names_in_map_text(texts)
    assert {(r["segment_key"], r["segment_name"]) for r in names.collect()} >= {("4", "Ann Lee"), ("04", "Ann Lee"), ("7", "New"), ("07", "New")}
    assert {r["SEGMENT_NUMBER"]: r["NAME"] for r in ins.segment_names(segs, names).collect()} == {4: "Ann Lee", 7: "New", 9: "own"}
    assert ins.segment_names(segs, None).filter("SEGMENT_NUMBER = 4").first()["NAME"] == ""


# --- sets, sources, generators, streaming


def test_compare_counts_copies_and_nulls(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k int, v string")
    b = spark.createDataFrame([(1, None), (2, "y")], "k int, v string")
    got = {(r["k"], r["v"]): (r["copies_a"], r["copies_b"]) for r in st.compare_outputs(a, b).collect()}
    assert got == {(1, None): (2, 1), (2, "x"): (1, 0), (2, "y"): (0, 1)}
    assert st.verdict(st.compare_outputs(a, a)).first()["verdict"] == "PASS"


def test_rids_sort_by_number_with_text_last(spark):
    df = spark.createDataFrame([("10|9| x ||9",), (None,)], "RID string")
    assert [r["rid"] for r in st.unique_rids([df]).orderBy(*st.by_number()).collect()] == ["9", "10", "x"]


def test_csv_check_and_quoting(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c'), (2, None)], "REPORT_SPECIES_ID int, NAME string")
    path = str(tmp_path / "t")
    cat.write_csv(df, path, ["NAME", "REPORT_SPECIES_ID"], ["REPORT_SPECIES_ID"])
    back = cat.read_csv_checked(spark, path, ["report_species_id"])
    assert back.columns == ["NAME", "REPORT_SPECIES_ID"]
    assert 'a "b", c' in [r["NAME"] for r in back.collect()]
    with pytest.raises(ValueError, match="country"):
        cat.read_csv_checked(spark, path, ["NAME", "COUNTRY"])


def test_table_lookup_and_schema(spark, tmp_path):
    with pytest.raises(ValueError, match="nowhere"):
        cat.require_tables(spark, ["nowhere"])
    assert cat.first_existing(spark, ["nowhere"]) is None
    spark.createDataFrame([(1, 1, 5, "ab   ")], "SECURITYDOMAIN_ID int, USER_ID int, FLAGS int, USERNAME string").write.parquet(str(tmp_path / "SCM_USERS.parquet"))
    row = cat.load_table(spark, str(tmp_path), "SCM_USERS").first()
    assert row["USERNAME"] == "ab" and "PASSWORD" not in row.asDict()


def test_assignments_are_distinct_and_repeatable(spark):
    users = spark.range(1, 200).select(F.col("id").alias("USER_ID"))
    for n in (1, 2, 3, 50):
        groups = spark.range(n).select((F.col("id") * 7).alias("GROUP_ID"))
        rows = [tuple(r) for r in gen.gen_assignments(users, groups, 1, 3, seed=1).select("USER_ID", "GROUP_ID").collect()]
        assert len(rows) == len(set(rows)) and {u for u, _ in rows} == set(range(1, 200))
        assert {g for _, g in rows} <= {7 * i for i in range(n)}
        again = [tuple(r) for r in gen.gen_assignments(users, groups, 1, 3, seed=1).select("USER_ID", "GROUP_ID").collect()]
        assert sorted(rows) == sorted(again)


def test_stream_resumes_and_logs(spark, tmp_path):
    src, target, state, log = (str(tmp_path / n) for n in ("in", "out", "state", "log"))
    write = lambda lo, hi: spark.range(lo, hi).select(F.col("id").alias("SPECIES_ID"), F.lit("f").alias("FILENAME"), F.lit("PLANNED").alias("Status")).coalesce(1).write.mode("append").parquet(src)
    write(0, 10)
    schema = spark.read.parquet(src).schema
    run = lambda: ingest.ingest_incremental(spark, src, schema, target, state, log=log)
    run()
    run()
    assert spark.read.parquet(target).count() == 10
    write(10, 15)
    run()
    assert spark.read.parquet(target).count() == 15
    rows = spark.read.parquet(log)
    assert rows.count() == 15 and {r["STATUS"] for r in rows.collect()} == {"PLANNED"}
    done = spark.read.parquet(target)
    assert ingest.pending_rows(spark.range(20).withColumnRenamed("id", "SPECIES_ID"), done, ["SPECIES_ID"]).count() == 5


def test_a_repeated_batch_is_logged_once(spark, tmp_path, monkeypatch):
    """A batch that fails after its rows were written runs again and replaces rows and log of its own."""
    src, out, log, state = (str(tmp_path / n) for n in ("in", "out", "log", "state"))
    spark.range(30).selectExpr("id AS species_id", "concat('f', id) AS filename", "'ok' AS status", "id AS extra").repartition(3).write.parquet(src)
    schema = spark.read.parquet(src).schema
    run = lambda: ingest.ingest_incremental(spark, src, schema, out, state, files_per_batch=1, log=log)
    real, calls = ingest.append_log, []

    def fails_once(df, path, number):
        calls.append(number)
        if calls == [0, 1]:
            raise RuntimeError("lost")
        real(df, path, number)

    monkeypatch.setattr(ingest, "append_log", fails_once)
    with pytest.raises(Exception, match="lost"):
        run()
    assert ingest.read_log(spark, log).select("batch").distinct().count() == 1
    run()
    run()
    assert calls == [0, 1, 1, 2]
    rows = ingest.read_log(spark, log)
    assert sorted(int(r["SPECIES_ID"]) for r in rows.collect()) == list(range(30))
    assert rows.where("LOGGED_AT IS NULL OR FILENAME <> concat('f', SPECIES_ID)").count() == 0
    assert spark.read.parquet(out).count() == 30


def test_signatures_of_a_hot_species_meet_its_names_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(ins, "SIGNATURES_PER_BLOCK", 50, raising=False)
    names = [(1, 1, 0, "hot  "), (1, 1, 0, "hot again"), (1, 2, 0, "cold "), (1, 3, 0, "none"), (1, 2, 1, "other item"), (None, 1, 0, "no domain"), (1, None, 0, None), (1, 3, 0, "none")]
    signs = [(1, 1, n, n % 3, f"d{n} ") for n in range(2000)] + [(1, 1, 7, 1, "d7 ")] * 2 + [(1, 2, 5, 1, None), (1, 9, 6, 1, "unnamed"), (None, 1, 8, 1, "x"), (1, None, 8, 1, "x"), (1, 1, None, None, None)]
    rsn = spark.createDataFrame(names, "DOMAIN_ID int, REPORT_SPECIES_ID long, ITEM_ID int, NAME string")
    sig = spark.createDataFrame(signs, "DOMAIN_ID int, REPORT_SPECIES_ID long, SIGN_ID long, MINOR_VERSION int, DESCRIPTION string")
    strip = lambda text: text and text.rstrip(" ")
    want = []
    for d, s, item, name in names:
        if item == 0:
            some = [x for x in signs if None not in (d, s) and x[:2] == (d, s)]
            want += [(d, s, strip(name), *x[2:4], strip(x[4])) for x in some] or [(d, s, strip(name), None, None, None)]
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        found = ins.species_signatures(rsn, sig)
        assert found.columns == ["DOMAIN_ID", "REPORT_SPECIES_ID", "NAME", "SIGN_ID", "MINOR_VERSION", "DESCRIPTION"]
        assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)
        most = found.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
        assert most < len(want) / 3
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)

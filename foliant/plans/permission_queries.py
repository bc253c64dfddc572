"""Queries over access-control blobs, principals, grants, RID mapping and test principals."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliant.functions import acl
from foliant.functions import text as tx
from foliant.functions.binary import u32_hex
from foliant.operators import generators as gen
from foliant.operators import grants as gr
from foliant.operators import sets as st
from foliant.plans.registry import query, spread, table, view

# every event as a blob: a user, a group (sometimes the same number as a user, sometimes a number that is neither), a repeated user, and by type Everyone or a builtin group
_USER = "user_id + 1000"
_GROUP = "CASE WHEN event_id % 9 = 0 THEN 900000 + event_id % 50 ELSE event_id % 260 + 1040 END"


def _sid(rid):
    return acl.sid_hex([F.lit(21).cast("long"), F.lit(1), F.lit(2), F.lit(3), rid])


def blobs(spark, sf):
    """(event_id, user_id, event_type, VALUE): self-relative descriptor bytes with one access list."""
    mask = F.lit("FF011F00")
    ace = lambda sid: F.concat(F.lit("00000000"), mask, sid)
    user, group = F.col("user_id") + 1000, F.expr(_GROUP)
    everyone = acl.sid_hex([F.lit(0).cast("long")], authority=1)
    builtin = acl.sid_hex([F.lit(32).cast("long"), F.lit(544).cast("long")])
    extra = F.when(F.col("event_type") == "click", ace(everyone)).when(F.col("event_type") == "error", ace(builtin)).otherwise(F.lit(""))
    body = F.concat(F.lit("0x0200"), F.lit("02004C00"), ace(_sid(user)), ace(_sid(group)), ace(_sid(user)), extra)
    value = F.when(~((F.col("event_type") == "signup") & (F.col("event_id") % 7 == 0)), acl.blob_of_hex(body))
    events = spread(table(spark, sf, "events").select("event_id", "user_id", "event_type"), "event_id")
    return events.select("event_id", "user_id", "event_type", value.alias("VALUE"))


_BLOB_ROWS = f"SELECT event_id, user_id, event_type, {_USER} AS u, {_GROUP} AS g FROM events WHERE NOT (event_type = 'signup' AND event_id % 7 = 0)"
_RIDS = f"SELECT event_id, user_id, event_type, unnest(CASE WHEN u = g THEN [u] ELSE [u, g] END) AS rid, unnest(CASE WHEN u = g THEN [0] ELSE [0, 1] END) AS pos FROM ({_BLOB_ROWS}) AS b"


@query(
    "acl_sids",
    f"SELECT event_id, CAST(CASE WHEN event_type IN ('click', 'error') THEN 4 ELSE 3 END AS INT) AS sids, u AS first_rid, CAST(2032127 AS BIGINT) AS first_mask FROM ({_BLOB_ROWS}) AS b",
)
def acl_sids(spark, sf):
    # the scan tests every offset, so random numbers can look like an identifier now and then: count the written ones
    rows = blobs(spark, sf).filter("VALUE IS NOT NULL").select("event_id", acl.acl_sids("VALUE").alias("s"))
    written = lambda s: s["sid"].startswith("S-1-5-") | (s["sid"] == acl.EVERYONE)
    rows = rows.select("event_id", F.filter("s", written).alias("s"))
    return rows.select("event_id", F.size("s").alias("sids"), F.col("s")[0]["rid"].alias("first_rid"), F.col("s")[0]["mask"].alias("first_mask"))


@query(
    "acl_grants",
    f"SELECT event_id, CASE WHEN u = g THEN CAST(u AS VARCHAR) ELSE CAST(u AS VARCHAR) || '|' || CAST(g AS VARCHAR) END AS rids, CAST(CASE event_type WHEN 'click' THEN 1 ELSE 0 END AS INT) AS everyone FROM ({_BLOB_ROWS}) AS b",
)
def _(spark, sf):
    rows = gr.decode_grants(blobs(spark, sf), ["event_id"])
    return rows.select("event_id", F.array_join(F.transform("rids", lambda r: r.cast("string")), "|").alias("rids"), "everyone")


@query(
    "grants_with_principals",
    f"SELECT event_id, rid, CASE WHEN rid IN (SELECT USER_ID FROM scm_users) THEN rid END AS user_id, CASE WHEN rid IN (SELECT GROUP_ID FROM scm_groups) THEN rid END AS group_id, "
    f"rid NOT IN (SELECT USER_ID FROM scm_users) AND rid NOT IN (SELECT GROUP_ID FROM scm_groups) AS unmapped FROM ({_RIDS}) AS r",
    ["scm_users", "scm_groups"],
)
def _(spark, sf):
    grants = gr.decode_grants(blobs(spark, sf), ["event_id"])
    return gr.grants_with_principals(grants, view(spark, sf, "scm_users"), view(spark, sf, "scm_groups"), ["event_id"]).drop("position")


_ACCESS = f"""SELECT event_id, coalesce(string_agg(CASE WHEN rid IN (SELECT GROUP_ID FROM scm_groups) THEN CAST(rid AS VARCHAR) END, '|' ORDER BY pos), '') AS "Group",
   coalesce(string_agg(CASE WHEN rid IN (SELECT USER_ID FROM scm_users) THEN CAST(rid AS VARCHAR) END, '|' ORDER BY pos), '') AS "User", string_agg(CAST(rid AS VARCHAR), '|' ORDER BY pos) AS RID,
   CAST(max(CASE event_type WHEN 'click' THEN 1 ELSE 0 END) AS INT) AS Everyone FROM ({_RIDS}) AS r GROUP BY event_id"""


def _folder_access(spark, sf):
    rows = blobs(spark, sf).withColumnRenamed("event_id", "FOLDER_ID")
    return gr.folder_access(rows, view(spark, sf, "scm_users"), view(spark, sf, "scm_groups"))


@query("folder_access", f"SELECT event_id AS FOLDER_ID, \"Group\", \"User\", RID, Everyone FROM ({_ACCESS}) AS a", ["scm_users", "scm_groups"])
def folder_access(spark, sf):
    return _folder_access(spark, sf)


@query("section_access", f"SELECT event_id % 1000 AS REPORT_SPECIES_ID, event_id AS SECTION_ID, \"Group\", \"User\", RID, Everyone FROM ({_ACCESS}) AS a", ["scm_users", "scm_groups"])
def _(spark, sf):
    rows = blobs(spark, sf).select((F.col("event_id") % 1000).alias("REPORT_SPECIES_ID"), F.col("event_id").alias("SECTION_ID"), "VALUE")
    return gr.section_access(rows, view(spark, sf, "scm_users"), view(spark, sf, "scm_groups"))


@query("species_access", f"SELECT event_id AS REPORT_SPECIES_ID, \"Group\", \"User\", RID, Everyone FROM ({_ACCESS}) AS a", ["scm_users", "scm_groups"])
def _(spark, sf):
    rows = blobs(spark, sf).select(F.col("event_id").alias("REPORT_SPECIES_ID"), "VALUE")
    return gr.species_access(rows, view(spark, sf, "scm_users"), view(spark, sf, "scm_groups"))


@query(
    "unmapped_rids",
    f"SELECT DISTINCT rid FROM ({_RIDS}) AS r WHERE rid NOT IN (SELECT USER_ID FROM scm_users) AND rid NOT IN (SELECT GROUP_ID FROM scm_groups)",
    ["scm_users", "scm_groups"],
)
def _(spark, sf):
    grants = gr.decode_grants(blobs(spark, sf), ["event_id"])
    return gr.unmapped_rids(gr.grants_with_principals(grants, view(spark, sf, "scm_users"), view(spark, sf, "scm_groups"), ["event_id"]))


@query(
    "permission_rows",
    f"""SELECT event_id AS RESOURCE_ID, 'S-1-5-21-1-2-3-' || CAST(rid AS VARCHAR) AS PRINCIPAL_SID, 'USER' AS PRINCIPAL_TYPE FROM ({_RIDS}) AS r
    UNION ALL SELECT event_id, 'S-1-5-32-544', 'BUILTIN_GROUP' FROM ({_BLOB_ROWS}) AS b WHERE event_type = 'error'""",
)
def _(spark, sf):
    rows = gr.permission_rows(blobs(spark, sf), "event_id").filter(F.col("PRINCIPAL_SID").startswith("S-1-5-"))
    return rows.select("RESOURCE_ID", "PRINCIPAL_SID", "PRINCIPAL_TYPE")


@query(
    "sid_format_and_rid",
    "SELECT event_id, 'S-1-5-21-1-2-3-' || CAST(user_id + 1000 AS VARCHAR) AS sid, user_id + 1000 AS rid, user_id + 1000 AS rid_of_text, "
    "'Domain User/Group (RID: ' || CAST(user_id + 1000 AS VARCHAR) || ')' AS sid_name FROM events",
)
def _(spark, sf):
    rows = table(spark, sf, "events").select("event_id", F.unhex(_sid(F.col("user_id") + 1000)).alias("b"))
    sid = acl.format_sid(F.col("b"))
    return rows.select("event_id", sid.alias("sid"), acl.rid_of_sid_bytes(F.col("b")).alias("rid"), acl.rid_of_sid(sid).alias("rid_of_text"), acl.sid_name(sid).alias("sid_name"))


@query(
    "mask_rights",
    "SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'FULL_CONTROL (All Rights)' WHEN 1 THEN 'READ & EXECUTE' WHEN 2 THEN 'MODIFY' WHEN 3 THEN 'DELETE|FILE_READ_DATA/LIST_DIRECTORY' ELSE 'Custom: 0x' || lpad(printf('%X', CAST((user_id + 1) * 512 % 65536 AS INT)), 8, '0') END AS rights FROM events",
)
def _(spark, sf):
    key = F.col("event_id") % 5
    mask = (
        F.when(key == 0, 0x1F01FF).when(key == 1, 7).when(key == 2, 6).when(key == 3, 0x10001).otherwise((F.col("user_id") + 1) * 512 % 65536)
    )
    return table(spark, sf, "events").select("event_id", F.array_join(acl.mask_rights(mask), "|").alias("rights"))


@query(
    "descriptor_aces",
    "SELECT event_id, 'DACL' AS acl, CASE i WHEN 0 THEN 'ACCESS_ALLOWED_ACE_TYPE' ELSE 'ACCESS_DENIED_ACE_TYPE' END AS ace_type, CASE i WHEN 0 THEN 'FULL_CONTROL (All Rights)' ELSE 'READ & EXECUTE' END AS rights, "
    "CASE i WHEN 0 THEN 'Everyone' ELSE 'Domain User/Group (RID: ' || CAST(user_id + 1000 AS VARCHAR) || ')' END AS sid_name, 'S-1-1-0' AS owner_sid, 'SE_DACL_PRESENT|SE_SELF_RELATIVE' AS flags FROM events, (VALUES (0), (1)) AS v(i)",
)
def _(spark, sf):
    everyone = acl.sid_hex([F.lit(0).cast("long")], authority=1)
    domain = _sid(F.col("user_id") + 1000)
    aces = F.concat(F.lit("00001400FF011F00"), everyone, F.lit("0100240007000000"), domain)
    header = F.concat(F.lit("01000480"), *[u32_hex(F.lit(n)) for n in (20, 0, 0, 32)])
    blob = F.unhex(F.concat(header, everyone, F.lit("0200480002000000"), aces))
    rows = gr.descriptor_aces(table(spark, sf, "events").select("event_id", blob.alias("VALUE")))
    return rows.select(
        "event_id", "acl", "ace_type", F.array_join("rights", "|").alias("rights"), "sid_name", "owner_sid",
        F.array_join(acl.control_flags(F.col("control")), "|").alias("flags"),
    )


@query(
    "unique_section_access",
    f"""WITH n AS (SELECT rtrim(s.NAME) AS SECTION_NAME, r.rid, r.event_type FROM ({_RIDS}) AS r JOIN section s ON s.REPORT_SPECIES_ID = r.user_id + 1 AND s.SECTION_ID = r.event_id % 3 + 1)
    SELECT SECTION_NAME, coalesce(string_agg(DISTINCT CAST(rid AS VARCHAR), '|' ORDER BY CAST(rid AS VARCHAR)) FILTER (rid IN (SELECT GROUP_ID FROM scm_groups)), '') AS "Group",
      coalesce(string_agg(DISTINCT CAST(rid AS VARCHAR), '|' ORDER BY CAST(rid AS VARCHAR)) FILTER (rid IN (SELECT USER_ID FROM scm_users)), '') AS "User",
      string_agg(DISTINCT CAST(rid AS VARCHAR), '|' ORDER BY CAST(rid AS VARCHAR)) AS RID, CAST(max(CASE event_type WHEN 'click' THEN 1 ELSE 0 END) AS INT) AS Everyone FROM n GROUP BY SECTION_NAME""",
    ["section", "scm_users", "scm_groups"],
)
def unique_section_access(spark, sf):
    rows = blobs(spark, sf).select((F.col("user_id") + 1).alias("REPORT_SPECIES_ID"), (F.col("event_id") % 3 + 1).cast("int").alias("SECTION_ID"), "VALUE")
    return gr.unique_section_access(rows, view(spark, sf, "section"), view(spark, sf, "scm_users"), view(spark, sf, "scm_groups"))


@query(
    "unique_rids",
    "SELECT DISTINCT rid, TRY_CAST(rid AS BIGINT) AS rid_number FROM (SELECT CAST(l_suppkey AS VARCHAR) AS rid FROM lineitem UNION ALL SELECT CAST(l_partkey AS VARCHAR) FROM lineitem UNION ALL SELECT p_type FROM part) AS r",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.concat_ws("|", F.col("l_suppkey").cast("string"), F.lit(" "), F.concat(F.lit(" "), F.col("l_partkey").cast("string"))).alias("RID"))
    return st.unique_rids([lines, table(spark, sf, "part").select(F.col("p_type").alias("RID"))])


@query(
    "extract_principals",
    "SELECT USER_ID AS id, trim(USERNAME) AS name, coalesce(trim(DESCRIPTION), '') AS description FROM scm_users UNION ALL SELECT GROUP_ID, trim(GROUPNAME), coalesce(trim(DESCRIPTION), '') FROM scm_groups",
    ["scm_users", "scm_groups"],
)
def _(spark, sf):
    out = gr.extract_principals({"SCM_USERS": view(spark, sf, "scm_users"), "SCM_GROUPS": view(spark, sf, "scm_groups")})
    one = lambda t, i, n: out[t].select(F.col(i).alias("id"), F.col(n).alias("name"), F.col("DESCRIPTION").alias("description"))
    return one("SCM_USERS", "USER_ID", "USERNAME").unionByName(one("SCM_GROUPS", "GROUP_ID", "GROUPNAME"))


_RESOLVED = """SELECT a.USER_ID, a.GROUP_ID, CASE WHEN u.USER_ID IS NULL THEN 'USER_ID ' || CAST(a.USER_ID AS VARCHAR) || ' not found' WHEN g.GROUP_ID IS NULL THEN 'GROUP_ID ' || CAST(a.GROUP_ID AS VARCHAR) || ' not found' END AS error
  FROM scm_user_group a LEFT JOIN scm_users u ON u.USER_ID = a.USER_ID LEFT JOIN scm_groups g ON g.GROUP_ID = a.GROUP_ID"""
_ASSIGN_VIEWS = ["scm_user_group", "scm_users", "scm_groups"]


@query("resolve_assignments", f"SELECT USER_ID, GROUP_ID, error, CASE WHEN error IS NULL THEN 'resolved' ELSE 'error' END AS action FROM ({_RESOLVED}) AS r", _ASSIGN_VIEWS)
def _(spark, sf):
    return gr.resolve_assignments(*[view(spark, sf, n) for n in _ASSIGN_VIEWS]).select("USER_ID", "GROUP_ID", "error", "action")


@query(
    "provisioning_plan",
    f"SELECT action, count(*) AS outcomes FROM (SELECT CASE WHEN error IS NOT NULL THEN 'would_error' WHEN (USER_ID + GROUP_ID) % 4 = 0 THEN 'would_skip' ELSE 'would_create' END AS action FROM ({_RESOLVED}) AS r) AS p GROUP BY action",
    _ASSIGN_VIEWS,
)
def _(spark, sf):
    wanted = gr.resolve_assignments(*[view(spark, sf, n) for n in _ASSIGN_VIEWS]).withColumn("dn", F.concat_ws("/", F.col("USER_ID").cast("string"), F.col("GROUP_ID").cast("string")))
    existing = wanted.filter((F.col("USER_ID") + F.col("GROUP_ID")) % 4 == 0).select("dn")
    return st.outcome_counts(gr.provisioning_plan(wanted, existing, dry_run=True, error="error"))


# a directory export: users by employee id, groups by the tag in their description; some without an identifier
_EXPORT = """SELECT CAST(USER_ID AS VARCHAR) AS Original_ID, 'user' AS Object_Type, trim(USERNAME) AS Name, CASE WHEN USER_ID % 13 = 0 THEN NULL WHEN USER_ID % 17 = 0 THEN 'S-1-bad' ELSE 'S-1-5-21-1-2-3-' || CAST(USER_ID + 70000 AS VARCHAR) END AS AD_SID FROM scm_users
  UNION ALL SELECT CASE WHEN DESCRIPTION LIKE 'x %' THEN CAST(GROUP_ID AS VARCHAR) END, 'group', GROUPNAME, 'S-1-5-21-1-2-3-' || CAST(GROUP_ID + 90000 AS VARCHAR) FROM scm_groups"""
_MAPPING = f"SELECT *, TRY_CAST(regexp_extract(AD_SID, '([^-]*)$', 1) AS BIGINT) AS AD_RID FROM ({_EXPORT}) AS e WHERE Original_ID IS NOT NULL AND AD_SID IS NOT NULL"


def _mapping(spark, sf):
    sid = lambda rid: F.concat(F.lit("S-1-5-21-1-2-3-"), rid.cast("string"))
    user_id = F.col("USER_ID")
    users = view(spark, sf, "scm_users").select(
        F.lit("user").alias("object_type"), F.btrim("USERNAME").alias("name"), user_id.alias("employee_id"), F.lit(None).cast("string").alias("description"),
        F.when(user_id % 13 == 0, None).when(user_id % 17 == 0, "S-1-bad").otherwise(sid(user_id + 70000)).alias("sid"),
    )
    groups = view(spark, sf, "scm_groups").select(
        F.lit("group").alias("object_type"), F.col("GROUPNAME").alias("name"), F.lit(None).cast("long").alias("employee_id"), F.col("DESCRIPTION").alias("description"),
        sid(F.col("GROUP_ID") + 90000).alias("sid"),
    )
    return gr.rid_mapping(users.unionByName(groups))


@query("rid_mapping", _MAPPING, ["scm_users", "scm_groups"])
def _(spark, sf):
    return _mapping(spark, sf)




@query(
    "translate_rids",
    f"""WITH f AS (SELECT Original_ID, CAST(AD_RID AS VARCHAR) AS new FROM (SELECT *, row_number() OVER (PARTITION BY Original_ID ORDER BY CASE Object_Type WHEN 'user' THEN 0 ELSE 1 END, Name) AS rn FROM ({_MAPPING}) AS m) AS x WHERE rn = 1)
    SELECT r.event_id AS FOLDER_ID, string_agg(coalesce(f.new, CAST(r.rid AS VARCHAR)), '|' ORDER BY r.pos) AS RID,
      count(f.new) + count(CASE WHEN r.rid IN (SELECT GROUP_ID FROM scm_groups) THEN f.new END) AS translated FROM ({_RIDS}) AS r LEFT JOIN f ON f.Original_ID = CAST(r.rid AS VARCHAR) GROUP BY r.event_id""",
    ["scm_users", "scm_groups"],
)
def translate_rids(spark, sf):
    done = gr.translate_all({"folders": _folder_access(spark, sf)}, _mapping(spark, sf))["folders"]
    return done.select("FOLDER_ID", "RID", "translated")


@query(
    "prepare_groups",
    "SELECT GROUP_ID, CASE WHEN GROUPNAME LIKE 'Team%' THEN GROUPNAME ELSE 'IST_' || CAST(GROUP_ID AS VARCHAR) END AS GROUPNAME, CASE WHEN GROUPNAME LIKE 'Team%' THEN DESCRIPTION ELSE 'IST_' || CAST(GROUP_ID AS VARCHAR) || ' ' END AS DESCRIPTION FROM scm_groups",
    ["scm_groups"],
)
def _(spark, sf):
    return gr.prepare_groups(view(spark, sf, "scm_groups")).select("GROUP_ID", "GROUPNAME", "DESCRIPTION")


@query(
    "directory_entries",
    """SELECT 'cn=' || trim(USERNAME) || ',OU=U' AS dn, '{"cn":"' || trim(USERNAME) || '","sAMAccountName":"' || trim(USERNAME) || '","userPrincipalName":"' || trim(USERNAME) || '@example.org","displayName":"' || CASE WHEN FULLNAME = '' THEN trim(USERNAME) ELSE FULLNAME END
      || '","description":"' || coalesce(DESCRIPTION, 'User ' || trim(USERNAME)) || '","employeeID":"' || CAST(USER_ID AS VARCHAR) || '","userAccountControl":514,"c":"SG","co":"SG"}' AS attributes FROM scm_users""",
    ["scm_users"],
)
def _(spark, sf):
    users = view(spark, sf, "scm_users").withColumn("USERNAME", F.btrim("USERNAME"))
    return gr.directory_entries(users, "OU=U", "SG").select("dn", "attributes")


@query(
    "tag_original_id",
    "SELECT GROUP_ID, CASE WHEN DESCRIPTION LIKE 'x %' THEN DESCRIPTION ELSE coalesce(DESCRIPTION, GROUPNAME) || ' [OriginalID:' || CAST(GROUP_ID AS VARCHAR) || ']' END AS description, CAST(GROUP_ID AS VARCHAR) AS original FROM scm_groups",
    ["scm_groups"],
)
def _(spark, sf):
    tagged = tx.tag_original_id(F.col("DESCRIPTION"), F.col("GROUPNAME"), F.col("GROUP_ID"))
    return view(spark, sf, "scm_groups").select("GROUP_ID", tagged.alias("description"), tx.original_id(tagged).alias("original"))


@query(
    "gen_groups",
    f"SELECT rid AS GROUP_ID, CAST(rid AS VARCHAR) AS GROUPNAME, 'TEST-' || CAST(rid AS VARCHAR) || ' [OriginalID:' || CAST(rid AS VARCHAR) || ']' AS DESCRIPTION FROM (SELECT DISTINCT rid FROM ({_RIDS}) AS r WHERE rid NOT IN (SELECT USER_ID FROM scm_users) AND rid NOT IN (SELECT GROUP_ID FROM scm_groups)) AS u",
    ["scm_users", "scm_groups"],
)
def _(spark, sf):
    users, groups = view(spark, sf, "scm_users"), view(spark, sf, "scm_groups")
    mapped = gr.grants_with_principals(gr.decode_grants(blobs(spark, sf), ["event_id"]), users, groups, ["event_id"])
    return gr.gen_groups(gr.unmapped_rids(mapped), groups).select("GROUP_ID", "GROUPNAME", "DESCRIPTION")


@query(
    "refresh_grants",
    f"""SELECT event_id AS FOLDER_ID, coalesce(string_agg(CASE WHEN rid IN (SELECT GROUP_ID FROM scm_groups) OR rid NOT IN (SELECT USER_ID FROM scm_users) THEN CAST(rid AS VARCHAR) END, '|' ORDER BY pos), '') AS "Group" FROM ({_RIDS}) AS r GROUP BY event_id""",
    ["scm_users", "scm_groups"],
)
def _(spark, sf):
    rows = blobs(spark, sf).withColumnRenamed("event_id", "FOLDER_ID")
    done, _groups = gr.refresh_grants(rows, view(spark, sf, "scm_users"), view(spark, sf, "scm_groups"), ["FOLDER_ID"])
    return done.select("FOLDER_ID", "Group")


@query(
    "gen_users",
    "SELECT (SELECT max(USER_ID) FROM scm_users) + 1000 + i AS USER_ID, 'testuser' || lpad(CAST(i AS VARCHAR), 5, '0') AS USERNAME, 'Test User ' || CAST(i AS VARCHAR) AS FULLNAME FROM (SELECT unnest(range(1, 501)) AS i) AS r",
    ["scm_users"],
)
def _(spark, sf):
    return gen.gen_users(view(spark, sf, "scm_users"), 500).select("USER_ID", "USERNAME", "FULLNAME")


@query("gen_assignments_check", "SELECT count(*) AS users, 0::BIGINT AS broken FROM scm_users", ["scm_users"])
def _(spark, sf):
    groups = view(spark, sf, "scm_groups")
    rows = gen.gen_assignments(view(spark, sf, "scm_users"), groups, seed=7, special_group=5)
    per_user = rows.groupBy("USER_ID").agg(
        F.count("*").alias("n"), F.count_distinct("GROUP_ID").alias("d"), F.count_if(F.col("GROUP_ID") == 5).alias("special")
    )
    broken = F.count_if((F.col("n") != F.col("d")) | (F.col("special") != 1) | ~F.col("n").between(2, 4))
    return per_user.agg(F.count("*").alias("users"), broken.alias("broken"))

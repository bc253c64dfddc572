"""Permissions: principals, grant tables, roll-ups, RID mapping and translation, provisioning plans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions.acl import acl_aces, acl_sids, ace_type_name, grants_of_sids, mask_rights, principal_type, rid_of_sid, sid_name
from foliant.functions.text import is_system_group, original_id, strip, tag_original_id
from foliant.operators.sets import append_rows, new_group_ids
from foliant.scale import small_side
from foliant.sources.catalogue import export_clean, order_output


def extract_principals(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Users, groups, domains, sections and memberships: trimmed, ordered by id, no passwords."""
    order = {
        "SCM_USERS": ["USER_ID"],
        "SCM_GROUPS": ["GROUP_ID"],
        "SCM_SECURITYDOMAIN": ["SECURITYDOMAIN_ID"],
        "SCM_USER_GROUP": ["USER_ID", "GROUP_ID"],
        "SECTION": ["DOMAIN_ID", "REPORT_SPECIES_ID", "SECTION_ID"],
    }
    out = {}
    for name, keys in order.items():
        if name in tables:
            df = tables[name]
            df = df.drop(*[c for c in df.columns if c.upper() == "PASSWORD"])
            out[name] = order_output(export_clean(df), keys)
    return out


def decode_grants(df: DataFrame, keys: Sequence[str], value: str = "VALUE") -> DataFrame:
    """Keys, distinct RIDs in first-seen order and the Everyone flag; rows without a blob are dropped."""
    rows = df.filter(F.col(value).isNotNull()).select(*keys, acl_sids(F.col(value)).alias("_sids"))
    return rows.select(*keys, grants_of_sids(F.col("_sids")).alias("g")).select(*keys, "g.rids", "g.everyone")


def _with_principals(rows: DataFrame, users: DataFrame, groups: DataFrame) -> DataFrame:
    """Flags ``_u`` / ``_g``: the row's ``rid`` is a user / a group.

    One look-up table of all principals, sent to the tasks if it was counted and is small; else its join has a
    shuffle of its own on both sides, so a RID that stands in every blob can be split.
    """
    none = F.lit(None).cast("boolean")
    u = users.select(F.col("USER_ID").cast("long").alias("rid"), F.lit(True).alias("_u"), none.alias("_g"))
    g = groups.select(F.col("GROUP_ID").cast("long").alias("rid"), none.alias("_u"), F.lit(True).alias("_g"))
    lookup = u.unionByName(g).where("rid IS NOT NULL").groupBy("rid").agg(F.max("_u").alias("_u"), F.max("_g").alias("_g"))
    return rows.join(small_side(lookup, max_rows=2_000_000), "rid", "left")


def grants_with_principals(grants: DataFrame, users: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per (key, RID): its position, user id and group id where they exist.

    ``unmapped`` marks RIDs that are neither.
    """
    rows = grants.select(*keys, F.posexplode("rids").alias("position", "rid"))
    out = _with_principals(rows, users, groups)
    return out.select(
        *keys,
        "position",
        "rid",
        F.when(F.col("_u"), F.col("rid")).alias("user_id"),
        F.when(F.col("_g"), F.col("rid")).alias("group_id"),
        (F.col("_u").isNull() & F.col("_g").isNull()).alias("unmapped"),
    )


def _pipe(value: Column) -> Column:
    ordered = F.sort_array(F.collect_list(F.when(value.isNotNull(), F.struct("position", value.cast("string").alias("v")))))
    return F.array_join(F.transform(ordered, lambda r: r["v"]), "|")


def access_table(df: DataFrame, users: DataFrame, groups: DataFrame, keys: Sequence[str], value: str = "VALUE") -> DataFrame:
    """Grant table: keys, Group, User, RID as pipe lists, Everyone 0/1.

    Keys identify one blob, so a list never holds more ids than its blob.
    """
    grants = decode_grants(df, keys, value)
    rows = grants.select(*keys, "everyone", F.posexplode_outer("rids").alias("position", "rid"))
    mapped = _with_principals(rows, users, groups)
    return mapped.groupBy(*keys).agg(
        _pipe(F.when(F.col("_g"), F.col("rid"))).alias("Group"),
        _pipe(F.when(F.col("_u"), F.col("rid"))).alias("User"),
        _pipe(F.col("rid")).alias("RID"),
        F.max("everyone").alias("Everyone"),
    )


def folder_access(df: DataFrame, users: DataFrame, groups: DataFrame) -> DataFrame:
    return access_table(df, users, groups, ["FOLDER_ID"])


def species_access(df: DataFrame, users: DataFrame, groups: DataFrame) -> DataFrame:
    return access_table(df, users, groups, ["REPORT_SPECIES_ID"])


def section_access(df: DataFrame, users: DataFrame, groups: DataFrame) -> DataFrame:
    return access_table(df, users, groups, ["REPORT_SPECIES_ID", "SECTION_ID"])


def unmapped_rids(mapped: DataFrame) -> DataFrame:
    return mapped.filter("unmapped").select("rid").distinct()


def permission_rows(df: DataFrame, ident: str = "SECTION_ID", value: str = "VALUE") -> DataFrame:
    """One row per distinct identifier of a section's blob, with its principal type."""
    found = df.filter(F.octet_length(value) > 0).select(ident, acl_sids(F.col(value)).alias("_sids"))
    rows = found.select(ident, F.explode(F.array_distinct(F.transform("_sids", lambda s: s["sid"]))).alias("sid"))
    sid = F.col("sid")
    return rows.filter(F.length(sid) > 10).select(
        F.lit("SECTION").alias("RESOURCE_TYPE"),
        F.col(ident).alias("RESOURCE_ID"),
        sid.alias("PRINCIPAL_SID"),
        principal_type(sid, rid_of_sid(sid)).alias("PRINCIPAL_TYPE"),
        F.lit("UNKNOWN").alias("ACCESS_MASK"),
    )


def descriptor_aces(df: DataFrame, col: str = "VALUE") -> DataFrame:
    """Access-entry audit table: one row per entry of both lists with owner, group, type, mask and rights."""
    keep = [c for c in df.columns if c != col]
    rows = df.select(*keep, acl_aces(F.col(col)).alias("d")).select(
        *keep, "d.revision", "d.control", "d.owner_sid", "d.group_sid", F.explode("d.aces").alias("a")
    )
    return rows.select(
        *keep, "revision", "control", "owner_sid", "group_sid", F.col("a.acl").alias("acl"),
        ace_type_name(F.col("a.ace_type")).alias("ace_type"), F.col("a.ace_flags").alias("ace_flags"),
        F.col("a.mask").alias("mask"), mask_rights(F.col("a.mask")).alias("rights"),
        F.col("a.sid").alias("sid"), sid_name(F.col("a.sid")).alias("sid_name"),
    )


def unique_section_access(stype_section: DataFrame, section: DataFrame, users: DataFrame, groups: DataFrame) -> DataFrame:
    """Access per section name: union of all grants, ids sorted by number, Everyone if any grants it.

    The ids are made distinct per name before lists are built, so a name shared by very many
    sections sends its distinct ids only.
    """
    key = ["REPORT_SPECIES_ID", "SECTION_ID"]
    named = stype_section.filter(F.col("VALUE").isNotNull()).join(section.select(*key, F.rtrim("NAME").alias("SECTION_NAME")), key)
    grants = decode_grants(named, ["SECTION_NAME"])
    ids = (
        grants.select("SECTION_NAME", "everyone", F.explode_outer("rids").alias("rid"))
        .groupBy("SECTION_NAME", "rid")
        .agg(F.max("everyone").alias("everyone"))
    )
    tagged = _with_principals(ids, users, groups)
    sorted_list = lambda c: F.array_join(F.transform(F.sort_array(F.collect_list(c)), lambda x: x.cast("string")), "|")
    return tagged.groupBy("SECTION_NAME").agg(
        sorted_list(F.when(F.col("_g"), F.col("rid"))).alias("Group"),
        sorted_list(F.when(F.col("_u"), F.col("rid"))).alias("User"),
        sorted_list(F.col("rid")).alias("RID"),
        F.max("everyone").alias("Everyone"),
    )


def resolve_assignments(assign: DataFrame, users: DataFrame, groups: DataFrame) -> DataFrame:
    """Names for (USER_ID, GROUP_ID); an unknown user, then an unknown group, is an error row, not a drop."""
    u = users.groupBy("USER_ID").agg(F.max("USERNAME").alias("USERNAME"))
    g = groups.groupBy("GROUP_ID").agg(F.max("GROUPNAME").alias("GROUPNAME"))
    missing = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    error = F.when(missing("USERNAME"), F.concat(F.lit("USER_ID "), F.col("USER_ID").cast("string"), F.lit(" not found"))).when(
        missing("GROUPNAME"), F.concat(F.lit("GROUP_ID "), F.col("GROUP_ID").cast("string"), F.lit(" not found"))
    )
    return (
        assign.join(u, "USER_ID", "left")
        .join(g, "GROUP_ID", "left")
        .withColumn("error", error)
        .withColumn("action", F.when(F.col("error").isNotNull(), "error").otherwise("resolved"))
    )


def rid_mapping(entries: DataFrame) -> DataFrame:
    """(Original_ID, Object_Type, Name, AD_SID, AD_RID) from a directory export; rows without
    an original id or an identifier are dropped.

    ``entries``: (object_type, name, employee_id, description, sid). Users carry their id in
    ``employee_id``, groups in the description tag.
    """
    ident = F.when(F.col("object_type") == "user", F.col("employee_id").cast("string")).otherwise(original_id(F.col("description")))
    return (
        entries.select(
            ident.alias("Original_ID"), F.col("object_type").alias("Object_Type"), F.col("name").alias("Name"), F.col("sid").alias("AD_SID"),
        )
        .filter((F.coalesce("Original_ID", F.lit("")) != "") & F.col("AD_SID").isNotNull())
        .withColumn("AD_RID", rid_of_sid(F.col("AD_SID")))
    )


def bad_sids(mapping: DataFrame) -> DataFrame:
    return mapping.agg(F.count_if(F.col("AD_RID").isNull()).alias("bad_sids"))


def translate_rids(
    df: DataFrame,
    mapping: DataFrame,
    cols: Sequence[str],
    keys: Sequence[str],
    original: str = "Original_ID",
    target: str = "AD_RID",
    order: Sequence[str] = ("Object_Type", "Name"),
) -> DataFrame:
    """Replace ids in pipe lists by their mapped id; unmapped ids stay.

    Adds ``translated`` and ``unmapped`` (numeric, not mapped) per row. Of several mappings for
    one id the first in ``order`` counts. All lists go through one join; ``keys`` must
    identify a row, so a list is rebuilt from its own members only.
    """
    first = mapping.groupBy(F.col(original).cast("string").alias("_id")).agg(
        F.min_by(F.col(target).cast("string"), F.struct(*order)).alias("_new")
    )
    lists = F.array(
        *[
            F.struct(F.lit(c).alias("_col"), F.transform(F.split(F.coalesce(F.col(c), F.lit("")), r"\|"), strip).alias("_parts"))
            for c in cols
        ]
    )
    rest = [c for c in df.columns if c not in cols and c not in keys]
    carried = F.struct(F.lit(1).alias("_one"), *rest).alias("_rest")
    parts = (
        df.select(*keys, carried, F.explode(lists).alias("l"))
        .select(*keys, "_rest", F.col("l._col").alias("_col"), F.posexplode("l._parts").alias("_pos", "_id"))
        .join(small_side(first.where("_id <> ''"), max_rows=2_000_000), "_id", "left")
    )
    mapped = F.col("_new").isNotNull() & (F.col("_id") != "")
    rebuilt = parts.groupBy(*keys).agg(
        *[
            F.array_join(
                F.transform(
                    F.sort_array(
                        F.collect_list(
                            F.when(F.col("_col") == c, F.struct("_pos", F.coalesce(F.when(mapped, F.col("_new")), "_id").alias("_v")))
                        )
                    ),
                    lambda r: r["_v"],
                ),
                "|",
            ).alias(c)
            for c in cols
        ],
        F.count_if(mapped).alias("translated"),
        F.count_if(~mapped & F.col("_id").rlike(r"^\d+$")).alias("unmapped"),
        F.any_value("_rest").alias("_rest"),
    )
    return rebuilt.select(*keys, *cols, *[F.col(f"_rest.{c}").alias(c) for c in rest], "translated", "unmapped").select(
        *df.columns, "translated", "unmapped"
    )


TRANSLATED_COLUMNS = {
    "section_names": (["Group", "User", "RID"], ["SECTION_NAME"]),
    "sections": (["Group", "RID"], ["REPORT_SPECIES_ID", "SECTION_ID"]),
    "species": (["Group", "RID"], ["REPORT_SPECIES_ID"]),
    "folders": (["Group", "RID"], ["FOLDER_ID"]),
}


def translate_all(tables: Mapping[str, DataFrame], mapping: DataFrame, by_type: bool = False) -> dict[str, DataFrame]:
    """Translate the grant tables; only the section roll-up has its User column translated.

    Users and groups share one key space and the user comes first. ``by_type`` keeps them
    apart: Group lists use group mappings, User lists user mappings, RID lists both.
    """
    users_first = mapping.withColumn("_rank", F.when(F.col("Object_Type") == "user", 0).otherwise(1))
    out = {}
    for name, df in tables.items():
        cols, keys = TRANSLATED_COLUMNS[name]
        if not by_type:
            out[name] = translate_rids(df, users_first, cols, keys, order=["_rank", "Name"])
            continue
        done = df
        for c in cols:
            kind = {"Group": "group", "User": "user"}.get(c)
            part = users_first if kind is None else users_first.filter(F.col("Object_Type") == kind)
            done = translate_rids(done.select(*df.columns), part, [c], keys, order=["_rank", "Name"])
        out[name] = done.select(*df.columns)
    return out


def prepare_groups(groups: DataFrame, prefix: str = "IST_") -> DataFrame:
    """Numeric group names become ``IST_<id>`` with a matching description; system groups stay."""
    numeric = ~is_system_group(F.col("GROUPNAME"))
    name = F.concat(F.lit(prefix), F.col("GROUP_ID").cast("string"))
    return groups.withColumn("DESCRIPTION", F.when(numeric, F.concat(name, F.lit(" "))).otherwise(F.col("DESCRIPTION"))).withColumn(
        "GROUPNAME", F.when(numeric, name).otherwise(F.col("GROUPNAME"))
    )


def directory_entries(
    df: DataFrame, ou: str, country: str | None = None, upn_suffix: str = "example.org", enabled: bool = False
) -> DataFrame:
    """Directory entries of users or groups (by their columns): dn and attributes as JSON. No passwords."""
    if "USERNAME" in df.columns:
        name = F.col("USERNAME")
        text = lambda c, default: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col(c)).otherwise(default)
        attributes = F.struct(
            name.alias("cn"),
            name.alias("sAMAccountName"),
            F.concat(name, F.lit("@" + upn_suffix)).alias("userPrincipalName"),
            text("FULLNAME", name).alias("displayName"),
            text("DESCRIPTION", F.concat(F.lit("User "), name)).alias("description"),
            F.col("USER_ID").cast("string").alias("employeeID"),
            F.lit(512 if enabled else 514).alias("userAccountControl"),
            *([F.lit(country).alias("c"), F.lit(country).alias("co")] if country else []),
        )
    else:
        name = F.col("GROUPNAME")
        info = F.when(name.startswith("IST_"), F.lit(country)) if country else F.lit(None).cast("string")
        attributes = F.struct(
            name.alias("cn"),
            name.alias("sAMAccountName"),
            tag_original_id(F.col("DESCRIPTION"), name, F.col("GROUP_ID")).alias("description"),
            F.lit(-2147483646).alias("groupType"),
            info.alias("info"),
        )
    return df.select(F.concat(F.lit("cn="), name, F.lit("," + ou)).alias("dn"), name.alias("name"), F.to_json(attributes).alias("attributes"))


def provisioning_plan(wanted: DataFrame, existing: DataFrame, key: str = "dn", dry_run: bool = False, error: str | None = None) -> DataFrame:
    """``create`` / ``skip`` per wanted entry, ``error`` where the named column is set; a dry run says ``would_...``."""
    have = existing.select(F.col(key), F.lit(True).alias("_have")).distinct()
    action = F.when(F.col("_have"), "skip").otherwise("create")
    if error is not None:
        action = F.when(F.col(error).isNotNull(), "error").otherwise(action)
    if dry_run:
        action = F.concat(F.lit("would_"), action)
    return wanted.join(have, key, "left").withColumn("action", action).drop("_have")


def gen_groups(unmapped: DataFrame, groups: DataFrame, domain: int = 1) -> DataFrame:
    """New groups for RIDs that are neither users nor groups: name = id, description with the id tag."""
    ident = F.col("rid").cast("string")
    return new_group_ids(unmapped, groups).select(
        F.lit(domain).alias("SECURITYDOMAIN_ID"),
        F.col("rid").alias("GROUP_ID"),
        F.lit(0).alias("FLAGS"),
        ident.alias("GROUPNAME"),
        F.concat(F.lit("TEST-"), ident, F.lit(" [OriginalID:"), ident, F.lit("]")).alias("DESCRIPTION"),
    )


def refresh_grants(
    df: DataFrame, users: DataFrame, groups: DataFrame, keys: Sequence[str], domain: int = 1
) -> tuple[DataFrame, DataFrame]:
    """Grant table after the groups missing for its RIDs were added, and the extended groups."""
    mapped = grants_with_principals(decode_grants(df, keys), users, groups, keys)
    extended = append_rows(groups, gen_groups(unmapped_rids(mapped), groups, domain))
    return access_table(df, users, extended, keys), extended

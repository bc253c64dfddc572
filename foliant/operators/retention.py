"""Retention plans: what to delete and what stays, as tables. Nothing is changed in place."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.operators.aggregates import exclusive_files
from foliant.operators.filters import date_window
from foliant.operators.windows import latest_versions, stale_versions
from foliant.sources.schemas import INSTANCE_KEY

KEY3 = INSTANCE_KEY[:3]
SIGN_KEYS = ["DOMAIN_ID", "REPORT_SPECIES_ID", "SIGN_ID"]
VERSION_KEYS = ["SIGN_ID", "MINOR_VERSION"]

Plan = dict[str, tuple[DataFrame, DataFrame]]


def orphans(parent: DataFrame, child: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Parent rows that no child refers to. The child side shrinks to its distinct keys first."""
    keys = [key] if isinstance(key, str) else list(key)
    return parent.join(child.select(*keys).distinct(), keys, "left_anti")


def stale_children(child: DataFrame, stale: DataFrame, keys: Sequence[str] = tuple(VERSION_KEYS)) -> DataFrame:
    """Child rows of stale versions."""
    return child.join(stale.select(*keys).distinct(), list(keys), "left_semi")


def _split(df: DataFrame, gone: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    return df.join(gone, list(keys), "left_semi"), df.join(gone, list(keys), "left_anti")


def instance_retention(
    tables: Mapping[str, DataFrame],
    lo: str | None = None,
    hi: str | None = None,
    end_of_day: bool = False,
    check_files: bool = True,
) -> Plan:
    """(delete, keep) per table, children first, for the instances of a date window.

    Keyed on three columns, without the reprocess flag. A file goes only when every
    reference to it goes; without ``check_files`` file tables stay untouched.
    """
    gone = date_window(tables["REPORT_INSTANCE"], "AS_OF_TIMESTAMP", lo, hi, end_of_day).select(*KEY3).distinct()
    plan: Plan = {
        "REPORT_INSTANCE_SEGMENT": _split(tables["REPORT_INSTANCE_SEGMENT"], gone, KEY3),
        "SST_STORAGE": _split(tables["SST_STORAGE"], gone, KEY3),
    }
    for link, files, ident in (("SST_STORAGE", "MAPFILE", "MAP_FILE_ID"), ("RPTFILE_INSTANCE", "RPTFILE", "RPT_FILE_ID")):
        if link not in plan:
            plan[link] = _split(tables[link], gone, KEY3)
        if check_files:
            plan[files] = _split(tables[files], exclusive_files(tables[link], gone, ident), [ident])
        else:
            plan[files] = (tables[files].limit(0), tables[files])
    plan["REPORT_INSTANCE"] = _split(tables["REPORT_INSTANCE"], gone, KEY3)
    return plan


def candidate_counts(ri: DataFrame, rsn: DataFrame, lo: str | None, hi: str | None) -> DataFrame:
    """Instances in the window: counted once, and counted per name row (a species with two
    names counts twice in a list that joins the names without a slot filter)."""
    window = date_window(ri, "AS_OF_TIMESTAMP", lo, hi)
    names = rsn.groupBy("DOMAIN_ID", "REPORT_SPECIES_ID").agg(F.count("*").alias("_names"))
    return window.join(names, ["DOMAIN_ID", "REPORT_SPECIES_ID"], "left").agg(
        F.count("*").alias("instances"),
        F.coalesce(F.sum(F.coalesce("_names", F.lit(1))), F.lit(0)).alias("listed_rows"),
    )


def signature_retention(sig: DataFrame, sf: DataFrame, lis: DataFrame, domain: int | None = None, exact: bool = False) -> Plan:
    """(delete, keep) for signatures and their children, plus ``collateral``.

    Deletes match on (SIGN_ID, MINOR_VERSION) only, which is wider than the "stale" test:
    ``collateral`` lists latest rows that such a delete also hits. ``exact`` deletes stale
    rows only, and children only when no kept signature still uses their version.
    """
    rows = sig if domain is None else sig.filter(F.col("DOMAIN_ID") == domain)
    stale = stale_versions(rows, SIGN_KEYS)
    keys = stale.select(*VERSION_KEYS).distinct()
    latest = latest_versions(rows, SIGN_KEYS)
    collateral = latest.join(keys, VERSION_KEYS, "left_semi")
    if exact:
        keys = keys.join(latest.select(*VERSION_KEYS).distinct(), VERSION_KEYS, "left_anti")
        kept = latest if domain is None else latest.unionByName(sig.filter(F.col("DOMAIN_ID") != domain))
        own = (stale, kept)
    else:
        own = _split(sig, keys, VERSION_KEYS)
    nothing = collateral.limit(0)
    return {
        "LINES_IN_SIGN": _split(lis, keys, VERSION_KEYS),
        "SENSITIVE_FIELD": _split(sf, keys, VERSION_KEYS),
        "SIGNATURE": own,
        "collateral": (nothing if exact else collateral, nothing),
    }


def file_retention(rptfile: DataFrame, rfi: DataFrame, mapfile: DataFrame, sst: DataFrame) -> Plan:
    """(delete, keep) of report and index files without any reference."""
    plan: Plan = {}
    for name, files, refs, ident in (
        ("RPTFILE", rptfile, rfi, "RPT_FILE_ID"),
        ("MAPFILE", mapfile, sst, "MAP_FILE_ID"),
    ):
        used = refs.select(ident).distinct()
        plan[name] = (files.join(used, ident, "left_anti"), files.join(used, ident, "left_semi"))
    return plan


def relationship_report(parent: DataFrame, children: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Per child table: does it carry the keys, its rows, and rows whose parent is missing."""
    parts = []
    parents = parent.select(*keys).distinct()
    for name, child in children.items():
        shares = set(keys) <= set(child.columns)
        if shares:
            # one row per key on both sides; the copies of a hot key are counted before the join
            per_key = child.groupBy(*keys).agg(F.count("*").alias("_n"))
            marked = per_key.join(parents.withColumn("_p", F.lit(True)), list(keys), "left")
            counts = marked.agg(
                F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
                F.coalesce(F.sum(F.when(F.col("_p").isNull(), F.col("_n"))), F.lit(0)).alias("orphan_rows"),
            )
        else:
            counts = child.agg(F.count("*").alias("rows")).withColumn("orphan_rows", F.lit(None).cast("long"))
        parts.append(counts.select(F.lit(name).alias("child"), F.lit(shares).alias("shares_keys"), "rows", "orphan_rows"))
    return reduce(DataFrame.unionByName, parts)

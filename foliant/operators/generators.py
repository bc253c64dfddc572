"""Test principals, assignments and file plans, generated on the executors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.operators.sets import next_ids
from foliant.operators.windows import assign_class
from foliant.scale import global_index


def gen_users(users: DataFrame, n: int, domain: int = 1) -> DataFrame:
    """``n`` test users with ids after max + 1000."""
    number = F.col("position").cast("string")
    return next_ids(users, "USER_ID", n).select(
        F.lit(domain).alias("SECURITYDOMAIN_ID"),
        "USER_ID",
        F.concat(F.lit("testuser"), F.when(F.length(number) < 5, F.lpad(number, 5, "0")).otherwise(number)).alias("USERNAME"),
        F.lit(0).alias("FLAGS"),
        F.concat(F.lit("Test User "), number).alias("FULLNAME"),
        F.concat(F.lit("Generated test user "), number).alias("DESCRIPTION"),
    )


def gen_assignments(
    users: DataFrame, groups: DataFrame, lo: int = 1, hi: int = 3, seed: int = 0, special_group: int | None = None, domain: int = 1
) -> DataFrame:
    """``lo`` to ``hi`` distinct groups per user, chosen by a seeded hash, plus the special group.

    A user's picks are positions in the group list, spaced by a step that cannot wrap onto
    itself, so they are distinct; the groups come in by an equi-join on the position
    instead of carrying the whole group list in every row.
    """
    listed = global_index(groups.select("GROUP_ID").distinct(), ["GROUP_ID"], "_slot")
    n = groups.select("GROUP_ID").distinct().agg(F.count("*")).scalar()
    rolled = lambda salt: F.xxhash64(F.col("USER_ID"), F.lit(seed), F.lit(salt))
    rows = users.select("USER_ID").distinct().withColumn("_n", n)
    count = F.least(F.lit(lo) + F.pmod(rolled(1), F.lit(hi - lo + 1)), F.col("_n"))
    step = F.pmod(rolled(2), F.greatest(F.floor(F.col("_n") / hi), F.lit(1))) + 1
    picks = F.transform(F.sequence(F.lit(0), F.lit(hi - 1)), lambda i: F.pmod(rolled(3) % F.col("_n") + i * step, F.col("_n")))
    chosen = (
        rows.filter(F.col("_n") > 0)
        .select("USER_ID", F.explode(F.slice(picks, F.lit(1), count.cast("int"))).alias("_slot"))
        .join(listed, "_slot")
        .select("USER_ID", "GROUP_ID")
    )
    if special_group is not None:
        chosen = chosen.unionByName(users.select("USER_ID").distinct().withColumn("GROUP_ID", F.lit(special_group).cast("long")))
    return chosen.select(F.lit(domain).alias("SECURITYDOMAIN_ID"), "USER_ID", "GROUP_ID", F.lit(0).alias("FLAGS"))


def file_plan(instances: DataFrame, order: Sequence[str], templates: Sequence[str], seed: int = 0) -> DataFrame:
    """Files per instance by round-robin class: 0 gives TXT and AFP, 1-2 TXT and PDF, 3-9 TXT only
    from one of the text ``templates``."""
    rows = assign_class(instances, order)
    pick = F.element_at(
        F.array(*[F.lit(t) for t in templates]),
        (F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in order]), F.lit(len(templates))) + 1).cast("int"),
    )
    file = lambda kind, source: F.struct(F.lit(kind).alias("file_type"), source.alias("source"))
    text = file("TXT", F.lit("test.txt"))
    files = (
        F.when(F.col("class") == 0, F.array(text, file("AFP", F.lit("test.afp"))))
        .when(F.col("class") <= 2, F.array(text, file("PDF", F.lit("test.pdf"))))
        .otherwise(F.array(file("TXT", pick)))
    )
    stem = F.regexp_replace(F.col("FILENAME"), r"\.[^.]*$", "")
    return (
        rows.withColumn("_f", F.explode(files))
        .withColumn("file_type", F.col("_f.file_type"))
        .withColumn("source", F.col("_f.source"))
        .withColumn("target", F.concat(stem, F.lit("."), F.col("file_type")))
        .drop("_f")
    )



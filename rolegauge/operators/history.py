"""Questions over stored reports: access, newest reports, previous scores, dashboards.

A user, or the group of anonymous reports, may own a large part of the table. Ranks are therefore limited before
the shuffle, and the previous score is found per user and part first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rolegauge.functions.text import strip
from rolegauge.operators.numbering import number_rows
from rolegauge.operators.validation import username_reason
from rolegauge.session import shuffle_partitions
from rolegauge.storage import materialize

ADMIN = "admin"
NEWEST, TREND = 20, 8


def key_users(users: DataFrame) -> DataFrame:
    """One row: the admin's id and the id of the primary user (lowest id that is not the admin, else the admin)."""
    named = F.col("username") == ADMIN
    return users.agg(
        F.min(F.when(named, F.col("id"))).alias("admin_id"), F.min(F.when(~named, F.col("id"))).alias("other_id")
    ).select("admin_id", F.coalesce("other_id", "admin_id").alias("primary_id"))


def access_pairs(users: DataFrame) -> DataFrame:
    """``viewer_id, owner_id``: everybody sees the own reports, the primary user also those of the admin."""
    own = users.select(F.col("id").alias("viewer_id"), F.col("id").alias("owner_id"))
    extra = key_users(users).filter(
        F.col("primary_id").isNotNull() & F.col("admin_id").isNotNull() & (F.col("primary_id") != F.col("admin_id"))
    )
    return own.unionByName(extra.select(F.col("primary_id").alias("viewer_id"), F.col("admin_id").alias("owner_id")))


def accessible(reports: DataFrame, access: DataFrame, viewer: int | None = None) -> DataFrame:
    """Reports with each ``viewer_id`` that may see them, or those of one viewer."""
    allowed = access if viewer is None else access.filter(F.col("viewer_id") == viewer)
    return reports.join(allowed, reports["user_id"] == allowed["owner_id"]).drop("owner_id")


def looked_up(requests: DataFrame, reports: DataFrame, access: DataFrame) -> DataFrame:
    """Answer ``report_id, viewer_id`` requests: the report, when it exists and the viewer may see it."""
    found = requests.join(reports, requests["report_id"] == reports["id"])
    return found.join(
        access, (found["viewer_id"] == access["viewer_id"]) & (found["user_id"] == access["owner_id"]), "left_semi"
    )


def newest(reports: DataFrame, access: DataFrame, count: int = NEWEST) -> DataFrame:
    """The newest reports every viewer may see, with ``place`` 1 for the newest.

    The rank is limited per owner first, inside every input partition, so only a few rows per owner are shuffled
    and joined with the viewers.
    """
    by_owner = Window.partitionBy("user_id").orderBy(F.desc("uploaded_at"), F.desc("id"))
    recent = (
        reports.filter(F.col("user_id").isNotNull())
        .withColumn("place", F.row_number().over(by_owner))
        .filter(F.col("place") <= count)
        .drop("place")
    )
    by_viewer = Window.partitionBy("viewer_id").orderBy(F.desc("uploaded_at"), F.desc("id"))
    return (
        recent.join(access, recent["user_id"] == access["owner_id"])
        .drop("owner_id")
        .withColumn("place", F.row_number().over(by_viewer))
        .filter(F.col("place") <= count)
    )


def dashboard(recent: DataFrame) -> DataFrame:
    """Totals of the newest reports of each viewer."""
    return recent.groupBy("viewer_id").agg(
        F.count("*").alias("total_scans"),
        F.coalesce(F.rint(F.avg("score")), F.lit(0.0)).cast("int").alias("average_score"),
        F.coalesce(F.max("score"), F.lit(0)).alias("best_score"),
    )


def trend(recent: DataFrame, count: int = TREND) -> DataFrame:
    """The newest scores of each viewer, oldest first, with the labels ``Scan 1..n``."""
    by_viewer = Window.partitionBy("viewer_id").orderBy("place")
    scored = (
        recent.filter(F.col("score").isNotNull())
        .withColumn("newest", F.row_number().over(by_viewer))
        .filter(F.col("newest") <= count)
    )
    rising = F.row_number().over(Window.partitionBy("viewer_id").orderBy(F.desc("newest")))
    return scored.withColumn("scan_no", rising).select(
        "viewer_id", "scan_no", F.concat(F.lit("Scan "), F.col("scan_no").cast("string")).alias("label"), "score"
    )


def latest_score(reports: DataFrame) -> DataFrame:
    """The score of the newest report of each user; anonymous reports form one group."""
    newest_first = F.struct("uploaded_at", "id")
    return reports.groupBy("user_id").agg(F.max_by(F.struct("score"), newest_first).alias("last")).select(
        "user_id", F.col("last.score").alias("score")
    )


def score_progress(reports: DataFrame) -> DataFrame:
    """Each report with the score of the report before it by the same user, and whether it is at least as good.

    The narrow rows are range-partitioned by (user, time), which cuts a user with many reports into parts of equal size, however
    they lie in time. The order is followed inside (user, part); the first report of a part takes the last score of the user's part
    before it, from a table with one row per user and part. The parts are written to the shared folder, so they stay the same.
    """
    owner = F.coalesce(F.col("user_id").cast("string"), F.lit(""))
    narrow = reports.select("id", "user_id", "uploaded_at", "score", owner.alias("owner"))
    parted = narrow.repartitionByRange(shuffle_partitions(reports.sparkSession), "owner", "uploaded_at", "id")
    placed = materialize(parted.withColumn("period", F.spark_partition_id()), "score-parts")
    inside = Window.partitionBy("owner", "period").orderBy("uploaded_at", "id")
    last = (
        placed.groupBy("owner", "period")
        .agg(F.max_by(F.struct("score"), F.struct("uploaded_at", "id")).alias("last"))
        .withColumn("carried", F.lag("last").over(Window.partitionBy("owner").orderBy("period")))
        .select("owner", "period", "carried")
    )
    before = F.lag(F.struct("score")).over(inside)
    return (
        placed.withColumn("before", before)
        .join(last, ["owner", "period"])
        .withColumn("previous_score", F.coalesce("before", "carried")["score"])
        .select(
            "id", "user_id", "score", "previous_score",
            F.when(F.col("previous_score").isNotNull(), F.col("score") >= F.col("previous_score")).alias("not_worse"),
        )
    )


def previous_at_scan(new: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """``key, previous_score``: for each new report the score of its owner's newest stored report at that time, NULL without one.

    An as-of lookup in one range partitioning of both tables by (owner, time), as in ``score_progress``: an owner with many reports is cut
    into parts; what stands before a part is taken from a table with one row per owner and part. A stored report of the same time counts
    as earlier; anonymous reports have one owner. Stored reports without a score are the newest all the same.
    """
    owner = F.coalesce(F.col("user_id").cast("string"), F.lit(""))
    at = F.col("uploaded_at").cast("timestamp").alias("at")
    none = F.lit(None).cast(dict(new.dtypes)[key])
    known = stored.select(owner.alias("owner"), at, F.lit(0).alias("kind"), F.col("id").alias("no"), F.struct("score").alias("own"), none.alias("key"))
    asked = new.select(
        owner.alias("owner"), at, F.lit(1).alias("kind"), F.lit(None).cast(known.schema["no"].dataType).alias("no"),
        F.lit(None).cast(known.schema["own"].dataType).alias("own"), F.col(key).alias("key"),
    )
    order = ["at", "kind", "no"]
    parted = known.unionByName(asked).repartitionByRange(shuffle_partitions(new.sparkSession), "owner", *order, "key")
    placed = materialize(parted.withColumn("period", F.spark_partition_id()), "as-of-parts")
    inside = Window.partitionBy("owner", "period").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ends = placed.groupBy("owner", "period").agg(F.max_by(F.when(F.col("kind") == 0, F.col("own")), F.when(F.col("kind") == 0, F.struct("at", "no"))).alias("end"))
    before = Window.partitionBy("owner").orderBy("period").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("owner", "period", F.last("end", ignorenulls=True).over(before).alias("carried"))
    found = placed.withColumn("before", F.last("own", ignorenulls=True).over(inside)).filter(F.col("kind") == 1)
    return found.join(carried, ["owner", "period"]).select(F.col("key").alias(key), F.coalesce("before", "carried")["score"].alias("previous_score"))


def recent_contacts(contacts: DataFrame, users: DataFrame, count: int = NEWEST) -> DataFrame:
    """The newest contact messages with the sender's username. Only the users of these messages are joined."""
    order = [F.desc("created_at"), F.desc("id")]
    top = contacts.orderBy(*order).limit(count)
    senders = top.select(F.col("user_id").alias("id")).distinct()
    known = users.join(F.broadcast(senders), "id", "left_semi").select(F.col("id").alias("user_id"), "username")
    return top.join(F.broadcast(known), "user_id", "left")


def counts(reports: DataFrame, users: DataFrame, catalog: DataFrame) -> DataFrame:
    """One row with the sizes of the three tables."""
    sizes = {"report_count": reports, "user_count": users, "role_count": catalog}
    one = reports.sparkSession.range(1)
    return one.select(*[table.agg(F.count("*")).scalar().alias(name) for name, table in sizes.items()])


def new_users(candidates: DataFrame, users: DataFrame, order: str) -> DataFrame:
    """Candidates with a valid, stripped username that is not taken, the first of each username by ``order``."""
    valid = candidates.withColumn("username", strip("username")).filter(username_reason(F.col("username"), F.lit(False)).isNull())
    firsts = valid.groupBy("username").agg(F.min_by(F.struct(*candidates.columns), order).alias("row")).select("row.*")
    return firsts.join(users.select("username"), "username", "left_anti").select(*candidates.columns)


def insert_users(candidates: DataFrame, users: DataFrame, order: str, created_at: Column) -> DataFrame:
    """The users followed by the new ones, with ids after the last one in the order of ``order``."""
    next_id = users.agg(F.coalesce(F.max("id"), F.lit(0)) + 1).scalar()
    placed = number_rows(new_users(candidates, users, order).select(order, "username"), "offset", order=order)
    added = placed.select((next_id + F.col("offset")).alias("id"), "username", created_at.cast("timestamp").alias("created_at"))
    return users.select("id", "username", "created_at").unionByName(added)

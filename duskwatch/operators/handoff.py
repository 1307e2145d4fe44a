"""Hand-off between stages: alerts, flagged users, investigations, responses."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from duskwatch.functions.clock import AsOf, wall_clock
from duskwatch.operators.evidence import USER
from duskwatch.operators.relational import with_surrogate_ids
from duskwatch.sources import schemas
from duskwatch.sources.tables import append, read_path

DISABLE = "Disable User"
MANUAL_RULE = "Manual request"

_DETECTIONS = "rule_name string, entity string, entity_type string, score double, details map<string,string>"


def as_detections(
    found: DataFrame,
    rule_name: str,
    entity_column: str,
    entity_type: str = "user",
    score_column: str | None = None,
) -> DataFrame:
    """A rule's result in the common shape; its other columns become the details map."""
    details = [c for c in found.columns if c != entity_column]
    entries = [part for c in details for part in (F.lit(c), F.col(c).cast("string"))]
    score = F.col(score_column).cast("double") if score_column else F.lit(None).cast("double")
    return found.select(
        F.lit(rule_name).alias("rule_name"),
        F.col(entity_column).cast("string").alias("entity"),
        F.lit(entity_type).alias("entity_type"),
        score.alias("score"),
        F.create_map(*entries).cast("map<string,string>").alias("details"),
    ).where("entity IS NOT NULL")


def manual_detections(spark: SparkSession, users: Iterable[str]) -> DataFrame:
    """Users named by an analyst, in the same shape as a rule's result."""
    rows = [(MANUAL_RULE, user, "user", None, {}) for user in users if user]
    return spark.createDataFrame(rows, _DETECTIONS)


def all_detections(*detections: DataFrame) -> DataFrame:
    """Every detection of every rule; none shadows another."""
    return reduce(lambda one, other: one.unionByName(other), detections)


def strongest(detections: DataFrame, n: int = 1) -> DataFrame:
    """The ``n`` detections with the highest score, in an order that does not depend on luck."""
    return detections.orderBy(F.desc_nulls_last("score"), "entity", "rule_name").limit(n)


def resolve_users(detections: DataFrame, identity: DataFrame | None = None) -> DataFrame:
    """Add ``user`` and ``resolved``.

    User entities stand for themselves.  E-mail entities are looked up in
    ``identity(user, email)``; one that is not found keeps its address as the user and is
    marked unresolved, so it is investigated rather than lost.
    """
    is_user = F.col("entity_type") == "user"
    if identity is None:
        return detections.withColumn(USER, F.col("entity")).withColumn("resolved", is_user)
    owners = identity.groupBy(F.col("email").alias("owner_email")).agg(F.min(USER).alias("owner"))
    # The type is a condition of the join, not part of its key: a key that is null for every
    # other entity would send all of those to one task.
    is_owner = (F.col("entity") == F.col("owner_email")) & (F.col("entity_type") == "email")
    looked_up = detections.join(owners, is_owner, "left")
    return (
        looked_up.withColumn(USER, F.coalesce("owner", "entity"))
        .withColumn("resolved", is_user | F.col("owner").isNotNull())
        .drop("owner", "owner_email")
    )


def flagged_users(resolved: DataFrame) -> DataFrame:
    """One row per user to investigate, naming the rules that fired."""
    # The set is bounded by the number of rules, not by the number of alerts.
    rules = F.array_join(F.sort_array(F.collect_set("rule_name")), ", ")
    return resolved.groupBy(USER).agg(
        rules.alias("trigger_event"), F.bool_or("resolved").alias("resolved")
    )


def _at(as_of: AsOf) -> Column:
    return wall_clock(as_of).cast("timestamp").alias("date")


def _conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def alert_rows(detections: DataFrame, as_of: AsOf = None, first_id: int = 1) -> DataFrame:
    """Detections in the alert table's schema; what no rule tells (category, tags) is null."""
    described = detections.select(
        _at(as_of),
        F.col("rule_name").alias("alert_name"),
        F.concat_ws(": ", "rule_name", "entity").alias("alert_desc"),
        F.lit("Open").alias("alert_status"),
        F.lit("System").alias("alert_source"),
        F.lit(None).alias("alert_category"),
        F.lit(None).alias("alert_subcategory"),
        F.lit(None).alias("tags"),
        F.col("entity").alias("entity_id"),
        "entity_type",
        F.col("details").alias("alert_details"),
    )
    numbered = with_surrogate_ids(described, "ID", "alert_name", "entity_id", start=first_id)
    return _conform(numbered, schemas.ALERT)


def investigation_rows(findings: DataFrame, as_of: AsOf = None, first_id: int = 1) -> DataFrame:
    """Findings in the investigation table's schema, the evidence as a map."""
    evidence = [c for c in findings.columns if c != USER]
    entries = [F.lit("entity"), F.col(USER), F.lit("entity_type"), F.lit("username")]
    entries += [part for c in evidence for part in (F.lit(c), F.col(c).cast("string"))]
    described = findings.select(
        USER,
        _at(as_of),
        F.lit("Suspicious user").alias("investigation_name"),
        F.lit("complete").alias("status"),
        F.concat_ws(": ", "severity", "recommendation").alias("status_message"),
        F.create_map(*entries).alias("data"),
    )
    return _conform(
        with_surrogate_ids(described, "id", USER, start=first_id), schemas.INVESTIGATION
    )


def needing_response(findings: DataFrame) -> DataFrame:
    """Only high severity is acted on without an analyst."""
    return findings.where(F.col("severity") == "high")


def response_actions(findings: DataFrame, users: DataFrame) -> DataFrame:
    """Accounts to disable, with their directory id; null where the directory has no such user."""
    directory = users.groupBy(F.col("Username").cast("string").alias(USER)).agg(F.min("ID").alias("directory_id"))
    return (
        needing_response(findings)
        .select(USER, "trigger_event")
        .join(directory, USER, "left")
        .withColumn("response_action", F.lit(DISABLE))
    )


def executable(actions: DataFrame) -> DataFrame:
    return actions.where(F.col("directory_id").isNotNull())


def rejected(actions: DataFrame) -> DataFrame:
    """Actions for users the directory does not know; an error for someone to look at."""
    return actions.where(F.col("directory_id").isNull())


def response_rows(
    actions: DataFrame, identity: DataFrame | None = None, first_id: int = 1
) -> DataFrame:
    """Executable actions in the response table's schema."""
    ready = executable(actions)
    if identity is None:
        ready = ready.withColumn("UserEmail", F.lit(None).cast("string"))
    else:
        emails = identity.groupBy(USER).agg(F.min("email").alias("UserEmail"))
        ready = ready.join(emails, USER, "left")
    named = ready.withColumnsRenamed(
        {USER: "UserName", "trigger_event": "TriggerEvent", "response_action": "ResponseAction"}
    )
    return _conform(with_surrogate_ids(named, "ID", "UserName", start=first_id), schemas.RESPONSE)


# --- writing a hand-off once ------------------------------------------------------------------

CONTENT_KEY = "content_key"


def content_key(df: DataFrame, ignoring: Iterable[str] = ()) -> Column:
    """A hash that rows of equal content share, whatever the order of columns and map entries.

    ``ignoring`` names columns that say nothing about the content, such as an id.
    """
    left_out = {name.lower() for name in ignoring}
    parts = []
    for field in sorted(df.schema, key=lambda f: f.name):
        if field.name.lower() in left_out:
            continue
        value = F.col(field.name)
        if isinstance(field.dataType, T.MapType):
            value = F.array_sort(F.map_entries(value))
        parts.append(value.alias(field.name))
    return F.sha2(F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}), 256)


def append_once(df: DataFrame, path: str, *, day_column: str, ignoring: Iterable[str] = ()) -> None:
    """Append the rows of ``df`` that the table at ``path`` does not hold yet.

    Rows are told apart by their content (``content_key``, kept as a column); rows that repeat
    within ``df`` are written once.  The table is divided by ``day_column``, and only folders of
    days that occur in ``df`` are read, so running a chain again, after a failure or by mistake,
    adds nothing and costs a day.  One writer at a time.
    """
    spark = df.sparkSession
    keyed = df.withColumn(CONTENT_KEY, content_key(df, ignoring)).dropDuplicates([CONTENT_KEY])
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        schema = T.StructType([f for f in keyed.schema if f.name != day_column] + [keyed.schema[day_column]])
        held = read_path(spark, path, schema=schema)
        days = df.select(day_column).distinct()
        known = held.join(days, day_column, "left_semi").select(CONTENT_KEY)
        keyed = keyed.join(known, CONTENT_KEY, "left_anti")
    append(keyed, path, partition_by=[day_column])

"""The queue of addresses for a paid geocoder: merge, flat groups, batches, inference.

The queue is a table; each step takes a snapshot and returns the next one.  ``sinks.write_version`` puts
snapshots side by side, so none is overwritten while it is read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import keys as K
from ..sources.sinks import exists
from .lookups import flag_ambiguous
from .relational import first_per_key, union_all

SPENT = ["done", "failed", "inferred"]
BOOKS = {"attempts": "int", "last_attempt_date": "date", "flat_group": "string", "flat_rep_key": "string", "flat_check": "string", "flat_group_n": "int"}
MIN_GROUP, MONTHLY_CAP, CHUNK = 3, 5000, 100


def new_rows(unmatched: DataFrame, ambiguity: DataFrame | None = None) -> DataFrame:
    """Unmatched titles as queue rows: key, reason, status, priority."""
    rows = unmatched.withColumn("queue_key", F.concat_ws("||", F.col("`Title Number`"), "AddressLine"))
    rows = first_per_key(rows, ["queue_key"], F.col("PostalCode").asc_nulls_last(), F.col("District").asc_nulls_last())
    rows = rows.withColumn("queue_reason", K.geocodability("AddressLine", "PostalCode"))
    rows = rows.withColumn("status", F.when(F.col("queue_reason") == "ok", "pending").otherwise("not_geocodable"))
    if ambiguity is not None:
        rows = flag_ambiguous(rows, ambiguity).withColumn("queue_priority", F.col("ambiguous").cast("int")).drop("ambiguous")
    else:
        rows = rows.withColumn("queue_priority", F.lit(0))
    books = {c: F.lit(0 if c == "attempts" else None).cast(t) for c, t in BOOKS.items()}
    return rows.withColumns(books)


def merge(existing: DataFrame | None, rows: DataFrame) -> DataFrame:
    """The next queue: rows that were sent stay as they are, unsent ones that are gone drop out, the others are
    taken anew but for their books, and new ones are added."""
    if existing is None:
        return rows
    existing = existing.withColumns({c: F.lit(None).cast(t) for c, t in BOOKS.items() if c not in existing.columns})
    spent = existing.filter(F.col("status").isin(SPENT))
    unsent = existing.filter(~F.col("status").isin(SPENT)).select("queue_key", *[F.col(c).alias(f"__{c}") for c in BOOKS], F.lit(True).alias("__kept"))
    fresh = rows.join(spent.select("queue_key"), "queue_key", "left_anti").join(unsent, "queue_key", "left")
    fresh = fresh.withColumns({c: F.when(F.col("__kept"), F.col(f"__{c}")).otherwise(F.col(c)) for c in BOOKS})
    return union_all(spent, fresh.drop("__kept", *[f"__{c}" for c in BOOKS]))


def assign_flats(queue: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """Flats of one building wait for one representative; groups that failed a check are left alone."""
    place = F.coalesce(F.nullif(F.col("PostalCode"), F.lit("")), F.concat(F.lit("D:"), F.coalesce("District", F.lit("NA"))))
    group = F.concat_ws("||", F.col("`Title Number`"), F.col("__base"), place)
    q = queue.withColumn("__base", K.flat_base("AddressLine"))
    q = q.withColumn("__g", F.when(F.col("__base").isNotNull(), group))
    # Figures of a group come from aggregates joined back, not from a window: a group may be of any size.
    first_number = F.expr("try_cast(regexp_substr(AddressLine, '[0-9]+') AS bigint)")
    live = F.col("status").isin("pending", "deferred_flat", "done", "failed", "inferred")
    unsent = F.col("status").isin("pending", "deferred_flat")
    order = F.struct(F.coalesce(first_number, F.lit(2**62)).alias("n"), F.col("queue_key").alias("k"))
    stats = q.filter("__g is not null").groupBy("__g").agg(
        F.max(F.col("flat_check").eqNullSafe("failed")).alias("__failed"), F.count_if(live).alias("__n"),
        F.min(F.when(F.col("status") == "done", F.col("queue_key"))).alias("__done"), F.min(F.when(unsent, order)).alias("__first"))
    q = q.join(stats, "__g", "left")
    grouped = F.coalesce(live & ~F.col("__failed") & (F.col("__n") >= min_group), F.lit(False))
    rep = F.coalesce("__done", "__first.k")
    mine = F.col("queue_key") == rep
    keep = F.col("flat_check").eqNullSafe("failed")
    status = (
        F.when(grouped & rep.isNotNull() & mine & (F.col("status") == "deferred_flat"), "pending")
        .when(grouped & rep.isNotNull() & ~mine & (F.col("status") == "pending"), "deferred_flat")
        .when(~grouped & (F.col("status") == "deferred_flat"), "pending").otherwise(F.col("status"))
    )
    old = lambda c, new: F.when(grouped, new).when(keep, F.col(c)).otherwise(F.lit(None))
    return q.withColumns({
        "flat_group": old("flat_group", F.col("__g")), "flat_group_n": old("flat_group_n", F.col("__n").cast("int")),
        "flat_rep_key": F.when(grouped, F.coalesce(rep, F.col("flat_rep_key"))).when(keep, F.col("flat_rep_key")), "status": status,
    }).drop("__g", "__base", "__failed", "__n", "__done", "__first")


def build_queue(unmatched: DataFrame, existing: DataFrame | None = None, ambiguity: DataFrame | None = None) -> DataFrame:
    return assign_flats(merge(existing, new_rows(unmatched, ambiguity)))


def next_batch(queue: DataFrame, n: int) -> DataFrame:
    """The n pending rows to send first: with a postcode before without, by priority, then by key."""
    has_code = F.coalesce(F.col("PostalCode") != "", F.lit(False))
    return queue.filter("status = 'pending'").orderBy(has_code.desc(), "queue_priority", "queue_key").limit(n)


def usage_this_month(log: DataFrame, today: dt.date) -> int:
    month = F.date_trunc("month", F.col("timestamp")) == F.lit(today.replace(day=1)).cast("timestamp")
    return log.filter(month).agg(F.coalesce(F.sum("n_calls"), F.lit(0)).alias("n")).first()["n"]


RESULT = "queue_key string, addressLine string, adminDistrict string, formattedAddress string, latitude double, longitude double, confidence string, entityType string, matchCodes string"


class GeocoderError(Exception):
    """What a geocoder raises when a call has no answer."""


def run_batch(queue: DataFrame, geocoder: Callable[[pd.DataFrame], pd.DataFrame], n: int, store: str, batch: str, confirm: bool = False,
              used: int = 0, cap: int = MONTHLY_CAP, today: dt.date | None = None, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """(next queue, results) after sending up to n rows; ``geocoder`` maps chunks of queue rows to result rows.

    Nothing is sent without ``confirm`` or beyond the month's cap, which bounds the rows that reach the
    driver.  Calls cost money, so the driver makes them, once a chunk: no task of Spark's can repeat one.
    The rows that go out and each chunk's answers are written below ``store``, under the batch's name, and both
    results are read from there; the same batch run again calls only for chunks without answers.  A row without a
    result has failed, as has a whole chunk whose call raises ``GeocoderError`` or ``OSError``; other errors are the
    program's own and end the run.
    """
    if not confirm:
        raise PermissionError("geocoding costs money: pass confirm=True")
    if used + n > cap:
        raise PermissionError(f"{used} calls were made this month, {n} more exceed the cap of {cap}")
    spark, root = queue.sparkSession, f"{store.rstrip('/')}/batch={batch}"
    names = [c.split()[0] for c in RESULT.split(", ")]
    if not exists(spark, f"{root}/sent/_SUCCESS"):
        rows = next_batch(queue, n).select("queue_key", "AddressLine", "PostalCode", "District")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{root}/sent")
    sent = spark.read.parquet(f"{root}/sent")
    rows = sent.toPandas()
    for at in range(0, max(len(rows), 1), chunk):
        path = f"{root}/answers/chunk={at // chunk:05d}"
        if exists(spark, f"{path}/_SUCCESS"):
            continue
        try:
            found = geocoder(rows.iloc[at : at + chunk])[names].values.tolist() if len(rows) else []
        except (GeocoderError, OSError):
            found = []
        spark.createDataFrame(found, RESULT).coalesce(1).write.mode("overwrite").parquet(path)
    results = spark.read.schema(RESULT).parquet(f"{root}/answers").select(*names)
    return apply_results(queue, sent, results, today or dt.date.today()), results


def apply_results(queue: DataFrame, sent: DataFrame, results: DataFrame, today: dt.date) -> DataFrame:
    """The queue after a batch: what was sent is done if it has a place, else failed."""
    hit = results.filter("latitude is not null").select("queue_key").distinct().withColumn("__hit", F.lit(True))
    q = queue.join(sent.select("queue_key").withColumn("__sent", F.lit(True)), "queue_key", "left").join(hit, "queue_key", "left")
    return q.withColumns({
        "status": F.when(F.col("__sent"), F.when(F.col("__hit"), "done").otherwise("failed")).otherwise(F.col("status")),
        "attempts": F.when(F.col("__sent"), F.coalesce("attempts", F.lit(0)) + 1).otherwise(F.col("attempts")),
        "last_attempt_date": F.when(F.col("__sent"), F.lit(today)).otherwise(F.col("last_attempt_date")),
    }).drop("__sent", "__hit")


def infer_flats(queue: DataFrame, results: DataFrame, uprns: DataFrame, tolerance: float = 50.0) -> tuple[DataFrame, DataFrame]:
    """(next queue, new results): a group's place is its representative's if enough properties stand on one point there.

    ``results``: queue_key, latitude, x, y and more.  A failed representative hands over to the next flat;
    a group whose check fails is sent one by one.
    """
    deferred = queue.filter("status = 'deferred_flat' and flat_group is not null")
    groups = deferred.groupBy("flat_group").agg(F.min("flat_rep_key").alias("rep"), F.min("queue_key").alias("next"))
    status = queue.select(F.col("queue_key").alias("rep"), F.col("status").alias("rep_status"), F.col("flat_group_n").alias("need"))
    groups = groups.join(status, "rep", "left")
    latest = results.filter("latitude is not null").groupBy("queue_key").agg(F.max(F.struct(*[c for c in results.columns if c != "queue_key"])).alias("r"))
    ready = groups.filter("rep_status = 'done'").join(latest.withColumnRenamed("queue_key", "rep"), "rep")
    # The box around a point lies within the cells around it.
    from ..functions.geo import cell
    from .spatial import _around

    at = ready.select("flat_group", "need", F.col("r.x").alias("px"), F.col("r.y").alias("py")).withColumn("c", _around(F.col("px"), F.col("py"), tolerance)).select("*", "c.cx", "c.cy")
    u = uprns.select("x", "y", cell(F.col("x"), tolerance).alias("cx"), cell(F.col("y"), tolerance).alias("cy"))
    near = at.join(u, ["cx", "cy"]).filter((F.abs(F.col("x") - F.col("px")) <= tolerance) & (F.abs(F.col("y") - F.col("py")) <= tolerance))
    stacks = near.groupBy("flat_group", "x", "y").agg(F.count("*").alias("k")).groupBy("flat_group").agg(F.max("k").alias("stack"))
    verdict = ready.join(stacks, "flat_group", "left").withColumn("stack", F.coalesce("stack", F.lit(0))).withColumn("pass", F.col("stack") >= F.col("need"))
    g = verdict.select("flat_group", "pass", F.col("rep").alias("__rep"), "stack", "r")
    failed = groups.filter("rep_status = 'failed'").select("flat_group", F.col("next").alias("__next"))
    q = queue.join(g.select("flat_group", "pass"), "flat_group", "left").join(failed, "flat_group", "left")
    waiting = F.col("status") == "deferred_flat"
    out = q.withColumns({
        "status": F.when(waiting & F.col("pass"), "inferred").when(waiting & (F.col("pass") == F.lit(False)), "pending")
        .when(waiting & (F.col("queue_key") == F.col("__next")), "pending").otherwise(F.col("status")),
        "flat_check": F.when(F.col("pass"), "passed").when(F.col("pass") == F.lit(False), "failed").otherwise(F.col("flat_check")),
        "flat_rep_key": F.coalesce("__next", "flat_rep_key"),
    }).drop("pass", "__next")
    new = deferred.select("queue_key", "flat_group").join(g.filter("pass"), "flat_group")
    new = new.select("queue_key", "r.*", F.col("__rep").alias("inferred_from"), F.col("stack").cast("int").alias("flat_uprn_stack"))
    return out, new


def latest_state(log: DataFrame, key: str = "queue_key", at: str = "ts") -> DataFrame:
    """The last row of a status log per key."""
    return first_per_key(log, [key], F.col(at).desc(), *[F.col(c) for c in log.columns if c not in (key, at)])

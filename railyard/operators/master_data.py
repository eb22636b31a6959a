"""Batch jobs on master data: append with checks, update by key, soft delete."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import messages as msg
from ..functions.exprs import instant, password_hash
from ..functions.ids import next_id, number_rows
from ..functions.lookups import split_authorised
from ..plans.checkpoints import cut
from ..plans.tables import Tables
from ..schemas import AS_OF, TABLES, Table
from .claims import first_by_key
from .notices import first_failure, reject
from .timelines import refused_changes

MIN_PASSWORD = 8
_TAKEN = {"Email": msg.EMAIL_EXISTS, "PhoneNumber": msg.PHONE_EXISTS}


def _with_defaults(rows: DataFrame, spec: Table, as_of) -> DataFrame:
    """Every column of the table but its key, cast, with defaults for what is not given.
    A given NULL is kept, as an explicit NULL is on insert."""
    for c in spec.cols[1:]:
        if c.name in rows.columns:
            value = F.col(c.name)
        elif c.default == AS_OF:
            value = instant(as_of)
        else:
            value = F.lit(c.default)
        rows = rows.withColumn(c.name, value.cast(c.type))
    return rows


def row_faults(spec: Table) -> list[tuple[Column, str]]:
    """Checks of one row against the declared columns, key aside. NULL passes a domain."""
    checks: list[tuple[Column, str]] = []
    for c in spec.cols[1:]:
        if c.required:
            checks.append((F.col(c.name).isNull(), f"{c.name} is missing"))
        if c.max_len:
            checks.append((F.length(c.name) > c.max_len, f"{c.name} is too long"))
        if c.domain:
            checks.append((~F.col(c.name).isin(*c.domain), f"{c.name} is not an allowed value"))
    if spec.name == "Routes":
        same = F.col("DepartureStationID") == F.col("ArrivalStationID")
        checks.insert(0, (same, msg.SAME_STATION))
    if spec.name == "Schedules":
        checks.append(
            (F.col("ArrivalTime") <= F.col("DepartureTime"), "arrival is not after departure")
        )
    return checks


def _held(t: Tables, table: str, columns) -> DataFrame:
    """Rows of a table whose unique columns are all given; NULL collides with nothing."""
    return t[table].dropna(subset=list(columns))


def _unique_keys(spec: Table) -> list[Column]:
    """One text per unique rule, NULL where a column of it is."""
    return [
        F.when(
            F.concat(*[F.col(c).cast("string") for c in columns]).isNotNull(),
            F.concat_ws("\x1f", F.lit(i), *[F.col(c).cast("string") for c in columns]),
        )
        for i, columns in enumerate(spec.unique)
    ]


def append_rows(t: Tables, table: str, rows: DataFrame, as_of) -> dict[str, DataFrame]:
    """Adds rows (request_id, optionally admin_id, columns) that pass every check.

    Checked are rights, the declared columns, foreign keys and unique keys. Of rows of the
    batch that share a unique value the first that is not refused for another reason
    wins. Users give a ``password`` instead of a hash; one without an administrator is a
    sign-up and needs eight characters. New schedules get the seats of their train.
    """
    spec = TABLES[table]
    allowed, unauthorised = (
        split_authorised(t, rows) if "admin_id" in rows.columns else (rows, None)
    )
    checks = row_faults(spec)
    if "password" in rows.columns:
        allowed = allowed.withColumn("PasswordHash", password_hash(F.col("password")))
        short = F.length(F.rtrim("password")) < MIN_PASSWORD
        if "admin_id" in rows.columns:
            short = F.col("admin_id").isNull() & short
        checks.append((short, msg.PASSWORD_TOO_SHORT))
    if table == "Schedules":
        seats = (
            t["Coaches"].groupBy("TrainID").agg(F.sum("TotalSeats").cast("int").alias("_seats"))
        )
        allowed = (
            allowed.join(t.hint(seats, "Coaches"), "TrainID", "left")
            .withColumn("AvailableSeats", F.col("_seats"))
            .drop("_seats")
        )
    full = _with_defaults(allowed, spec, as_of)
    for column, (parent, key) in spec.foreign.items():
        known = t.hint(
            t[parent].select(F.col(key).alias(column), F.lit(True).alias(f"_{column}")), parent
        )
        full = full.join(known, column, "left")
        missing = F.col(column).isNotNull() & F.col(f"_{column}").isNull()
        checks.append((missing, f"unknown {column}"))
    for columns in spec.unique:
        flag = "_" + "_".join(columns)
        held = _held(t, table, columns).select(*columns, F.lit(True).alias(flag)).distinct()
        full = full.join(held, list(columns), "left")
        text = _TAKEN.get(columns[0], f"{', '.join(columns)} exists already")
        # existing keys are told before faults of the row itself
        checks.insert(0, (F.col(flag).isNotNull(), text))
    checks = checks[: len(spec.unique)][::-1] + checks[len(spec.unique) :]
    code, reason = first_failure(*checks)
    names = [c.name for c in spec.cols[1:]]
    judged = cut(
        full.select("request_id", *names, code.alias("code"), reason.alias("reason"))
    )
    sound = judged.filter(F.col("reason").isNull()).select("request_id", *names)
    refused = judged.filter("reason is not null").select("request_id", "code", "reason")
    if unauthorised is not None:
        refused = refused.unionByName(reject(unauthorised, msg.NO_RIGHTS))

    if spec.unique:
        claims = sound.select(
            "request_id", F.explode(F.array_compact(F.array(*_unique_keys(spec)))).alias("item")
        )
        winners = first_by_key(claims, len(spec.unique))
        lost = claims.select("request_id").distinct().join(winners, "request_id", "left_anti")
        refused = refused.unionByName(reject(lost, "an earlier row of the batch has this key"))
        sound = sound.join(lost, "request_id", "left_anti")
    start = next_id(t[table], spec.key) - 1
    new = number_rows(sound, "request_id").withColumn(spec.key, F.col("_n") + F.lit(start))
    return {
        "rows": new.select(spec.key, *names),
        "ids": new.select("request_id", spec.key),
        "rejects": refused,
    }


def update_rows(t: Tables, table: str, changes: DataFrame) -> dict[str, DataFrame]:
    """Overwrites columns by key. ``changes`` has request_id, the key, optionally
    admin_id, and the columns to set, NULLs included; the last change of a key counts that
    is not refused.

    Changes apply in the order of request_id. One is refused if it breaks a rule of the declared
    columns, names an unknown foreign key, or takes a unique value that another row has at that
    time: from the start, or by an earlier change. A value that an earlier change has freed can
    be taken; a refused change affects no row and blocks no other. Returns
    the whole new table, its changed rows, the rows affected per request, and the rejects.
    """
    spec = TABLES[table]
    unauthorised = None
    allowed = changes
    if "admin_id" in changes.columns:
        allowed, unauthorised = split_authorised(t, changes)
    columns = [c for c in changes.columns if c not in ("request_id", "admin_id", spec.key)]
    # the row as it would be: given columns from the change, the others from the table
    kept = [c.name for c in spec.cols[1:] if c.name not in columns]
    before = t[table].select(spec.key, F.lit(True).alias("_known"), *kept)
    full = allowed.select("request_id", spec.key, *columns).join(before, spec.key, "left")
    checks = row_faults(spec)
    for column, (parent, key) in spec.foreign.items():
        if column in columns:
            known = t.hint(
                t[parent].select(F.col(key).alias(column), F.lit(True).alias(f"_{column}")), parent
            )
            full = full.join(known, column, "left")
            missing = F.col(column).isNotNull() & F.col(f"_{column}").isNull()
            checks.append((missing, f"unknown {column}"))
    touched = [u for u in spec.unique if set(u) & set(columns)]
    # an unknown key changes nothing, so it breaks no rule
    checks = [(F.col("_known").isNotNull() & fault, why) for fault, why in checks]
    code, reason = first_failure(*checks)
    judged = full.select(
        "request_id", spec.key, "_known", *columns, *kept, code.alias("code"), reason.alias("reason")
    )
    judged = cut(judged)
    sound = judged.filter(F.col("reason").isNull() & F.col("_known").isNotNull())
    late = sound.select("request_id", F.lit(None).cast("int").alias("code"), F.lit(None).cast("string").alias("reason")).limit(0)
    if touched:
        held = F.array(*[k for k, u in zip(_unique_keys(spec), spec.unique) if u in touched])
        asked = sound.select("request_id", F.col(spec.key).alias("key"), held.alias("items"))
        at_start = t[table].select(F.col(spec.key).alias("key"), held.alias("items"))
        rule = F.substring_index("item", "\x1f", 1)
        texts = [_TAKEN.get(u[0], f"{', '.join(u)} exists already") for u in spec.unique]
        why = F.lit("an earlier change of the batch has this key")
        for i, text in enumerate(texts):
            why = F.when(F.col("at_start") & (rule == str(i)), F.lit(text)).otherwise(why)
        late = cut(
            refused_changes(asked, at_start).select(
                "request_id", F.lit(None).cast("int").alias("code"), why.alias("reason")
            )
        )
    sound = sound.join(late, "request_id", "left_anti")
    # a max over structs aggregates map-side, so a key changed very often is no hot spot
    last = sound.groupBy(spec.key).agg(
        F.max(F.struct("request_id", F.struct(*columns).alias("new"))).alias("_last")
    )
    hit = F.col("_last").isNotNull()
    table_columns = [
        F.when(hit, F.col(f"_last.new.{c.name}").cast(c.type)).otherwise(F.col(c.name)).alias(c.name)
        if c.name in columns
        else F.col(c.name)
        for c in spec.cols
    ]
    refused = judged.filter("reason is not null").select("request_id", "code", "reason").unionByName(late)
    none = refused.select("request_id", F.lit(0).alias("_none"))
    count = F.coalesce("_none", F.when(F.col("_known"), 1).otherwise(0))
    affected = judged.join(none, "request_id", "left").select(
        "request_id", count.alias("RowsAffected")
    )
    if unauthorised is not None:
        refused = refused.unionByName(reject(unauthorised, msg.NO_RIGHTS))
    updated = t[table].join(last, spec.key, "left").select(*table_columns)
    changed = t[table].join(last, spec.key).select(*table_columns)
    return {"rows": updated, "changed": changed, "affected": affected, "rejects": refused}


def soft_delete(t: Tables, table: str, commands: DataFrame, as_of) -> dict[str, DataFrame]:
    """Sets IsActive to false by (request_id, id, admin_id) unless the row is in use:
    users with Active bookings, stations on a route, trains with upcoming schedules.

    Only users may be deleted without an administrator (NULL), and then without a guard.
    Unknown ids change nothing. Returns changed rows and rejects.
    """
    spec = TABLES[table]
    if table == "Users":
        used = t["Bookings"].filter(F.col("BookingStatus") == "Active").select(
            F.col("UserID").alias("id")
        )
        why = msg.USER_HAS_BOOKINGS
    elif table == "Stations":
        ends = F.explode(F.array("DepartureStationID", "ArrivalStationID"))
        used, why = t["Routes"].select(ends.alias("id")), msg.STATION_IN_ROUTES
    elif table == "Trains":
        upcoming = (F.col("Status") == "Scheduled") & (F.col("DepartureTime") > instant(as_of))
        used = t["Schedules"].filter(upcoming).select(F.col("TrainID").alias("id"))
        why = msg.TRAIN_HAS_SCHEDULES
    else:
        raise ValueError(f"{table} has no soft delete")
    # distinct first: a user with very many bookings becomes one row per task
    used = used.distinct().withColumn("_used", F.lit(True))
    by_admin, by_others = split_authorised(t, commands)
    commands = by_admin.withColumn("_admin", F.lit(True)).unionByName(
        by_others.withColumn("_admin", F.lit(False))
    )
    plain = F.col("admin_id").isNull() if table == "Users" else F.lit(False)
    is_admin = F.col("admin_id").isNotNull() & F.col("_admin")
    _, reason = first_failure(
        (~plain & ~is_admin, msg.NO_RIGHTS), (~plain & F.col("_used").isNotNull(), why)
    )
    judged = (
        commands.join(used, "id", "left")
        .select("request_id", "id", reason.alias("reason"))
    )
    ok = judged.filter(F.col("reason").isNull()).select(F.col("id").alias(spec.key))
    changed = (
        t[table].join(ok, spec.key, "left_semi").withColumn("IsActive", F.lit(False))
    )
    refused = judged.filter("reason is not null").select(
        "request_id", F.lit(None).cast("int").alias("code"), "reason"
    )
    return {"rows": changed.select(*t[table].columns), "rejects": refused}

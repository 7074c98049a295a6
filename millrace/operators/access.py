"""Who may see what: request parameters, user attributes, row filters, and statistics of a result."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from urllib.parse import parse_qsl

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.values import permission_values
from millrace.operators.tables import value_stats

MAX_ROWS = 30_000
ALLOWED = {"q", "rows", "shards.tolerant", "facet.field", "facet", "wt"}


class Refused(ValueError):
    pass


def parse_params(query_string: str) -> list[tuple[str, str]]:
    """Decoded parameters; blank values are dropped, values may hold `=`."""
    return [(k, v) for k, v in parse_qsl(query_string, keep_blank_values=False) if v.strip()]


def check_params(params: list[tuple[str, str]]) -> dict[str, list[str]]:
    """The parameters by name, or Refused: only those allowed, wt=json, fewer than MAX_ROWS rows."""
    out: dict[str, list[str]] = {}
    for key, value in params:
        if key not in ALLOWED:
            raise Refused(f"parameter {key} is not allowed")
        out.setdefault(key, []).append(value)
    if out.get("wt") != ["json"]:
        raise Refused("wt=json is required")
    for rows in out.get("rows", []):
        if not rows.isdigit() or int(rows) >= MAX_ROWS:
            raise Refused(f"rows must be below {MAX_ROWS}")
    return out


@dataclass(frozen=True)
class Rule:
    """How a user attribute restricts a multivalued field: deny_all, require_one or require_all of its values."""

    attribute: str
    field: str
    kind: str


@dataclass
class User:
    name: str
    attributes: dict[str, list[str]] = field(default_factory=dict)


def users(table: DataFrame) -> DataFrame:
    """user, attr, values: trimmed, upper case, sorted, each once."""
    cleaned = table.select("user", "attr", F.explode(permission_values(F.col("values"))).alias("v")).filter("v <> ''")
    return cleaned.groupBy("user", "attr").agg(F.array_sort(F.collect_set("v")).alias("values"))


def load_user(table: DataFrame, name: str) -> User:
    """The one user of that name; Refused if there is none, or, where the table tells entries of a directory apart by a
    column `entry`, more than one."""
    own = table.filter(F.col("user") == name)
    if "entry" in table.columns and own.select("entry").distinct().limit(2).count() > 1:
        raise Refused(f"more than one user {name}")
    rows = users(own).collect()
    if not rows:
        raise Refused(f"no user {name}")
    return User(name, {r["attr"]: r["values"] for r in rows})


def restriction(held: Column, kind: str, values: list[str]) -> Column | None:
    """Whether a row's values of a field satisfy a rule; None if the user has no values, so nothing is restricted.
    A null field has no values."""
    if not values:
        return None
    wanted = F.array(*[F.lit(v) for v in values])
    own = F.coalesce(held, F.array().cast("array<string>"))
    if kind == "deny_all":
        return ~F.arrays_overlap(own, wanted)
    if kind == "require_one":
        return F.arrays_overlap(own, wanted)
    if kind == "require_all":
        return F.size(F.array_except(wanted, own)) == 0
    raise ValueError(f"no rule {kind}")


def visible(records: DataFrame, user: User, rules: list[Rule]) -> DataFrame:
    """The records that every rule lets the user see."""
    for rule in rules:
        allowed = restriction(F.col(rule.field), rule.kind, user.attributes.get(rule.attribute, []))
        if allowed is not None:
            records = records.filter(F.coalesce(allowed, F.lit(False)))
    return records


def within_time(spark: SparkSession, seconds: float, run: Callable[[], object]) -> object:
    """What run gives; its jobs are cancelled and Refused is raised if it takes longer."""
    tag = f"limit-{uuid.uuid4().hex}"
    late = threading.Event()

    def stop() -> None:
        late.set()
        spark.sparkContext.cancelJobsWithTag(tag)

    timer = threading.Timer(seconds, stop)
    spark.addTag(tag)
    spark.sparkContext.addJobTag(tag)
    timer.start()
    try:
        return run()
    except Exception as error:
        if late.is_set():
            raise Refused(f"took longer than {seconds:g} s") from error
        raise
    finally:
        timer.cancel()
        spark.removeTag(tag)
        spark.sparkContext.removeJobTag(tag)


def response_log(found: DataFrame, returned: DataFrame, user: str, query: str, fields: list[str], started: float) -> DataFrame:
    """One row for the log of queries: user, query, how many records were found and returned, milliseconds since it
    started, and the counts of the fields' values among those returned."""
    counts = value_stats(returned, fields).agg(F.array_sort(F.collect_list(F.struct("field", "value", "n"))).alias("stats"))
    totals = found.agg(F.count("*").alias("found")).join(F.broadcast(returned.agg(F.count("*").alias("returned")))).join(F.broadcast(counts))
    return totals.select(F.lit(user).alias("user"), F.lit(query).alias("query"), "found", "returned", (F.unix_millis(F.now()) - int(started * 1000)).alias("millis"), "stats")

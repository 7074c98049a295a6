"""Checks tied to the attributes and labels of typed objects, and the lookups that some of them need.

A rule is a function of a Column that gives struct<value, error>; rules hold for a type and all below it. Lookups
(countries, airports) are joins to a dimension that the caller supplies.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import values as v
from millrace.operators.fuzzy import best_match
from millrace.operators.ontology import REGISTRY, Registry, clean_values

Rule = Callable[[Column], Column]


def any_text(value: Column) -> Column:
    return v.checked(F.nullif(F.trim(value), F.lit("")), F.lit(True), "")


def instant_text(value: Column) -> Column:
    """Instants in the form they are indexed in; days and day-first dates are the instants that they begin with."""
    day = F.coalesce(F.try_to_timestamp(value, F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")), F.try_to_timestamp(value, F.lit("yyyy-MM-dd")), v.day_first_date(value))
    text = F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return F.struct(text.alias("value"), F.when(value.isNotNull() & day.isNull(), "not a date").alias("error"))


def point_text(value: Column) -> Column:
    point = v.geoloc(value)
    return F.struct(F.when(point["error"].isNull() & value.isNotNull(), F.concat_ws(",", point["value"]["lat"].cast("string"), point["value"]["lon"].cast("string"))).alias("value"), point["error"].alias("error"))


def country_code(value: Column) -> Column:
    upper = F.upper(F.trim(value))
    return v.checked(upper, upper.rlike("^[A-Z]{2}$"), "not a country code")


#: Rules of labels by type, and of attributes by name.
LABELS: dict[str, Rule] = {"Email": v.email, "ITUE164": v.phone_e164}
ATTRIBUTES: dict[str, Rule] = {
    "dob": instant_text, "timestamp": instant_text, "issued": instant_text, "expiry": instant_text, "start_dt": instant_text, "end_dt": instant_text,
    "gender": v.gender, "geoloc": point_text, "country": country_code,
}


def _label_checks(labels: dict[str, Rule], registry: Registry) -> Column:
    """The check of the nearest type above that has a rule."""
    out = None
    for name in registry.objects:
        rule = next((labels[t] for t in registry.ancestors(name) if t in labels), any_text)
        if rule is not any_text:
            hit = F.col("type") == name
            out = F.when(hit, rule(F.col("label"))) if out is None else out.when(hit, rule(F.col("label")))
    return any_text(F.col("label")) if out is None else out.otherwise(any_text(F.col("label")))


def validated(nodes: DataFrame, labels: dict[str, Rule] = LABELS, attributes: dict[str, Rule] = ATTRIBUTES, registry: Registry = REGISTRY) -> DataFrame:
    """The nodes with the checked values of label and attributes, and errors: an array of (field, value, error).

    Attributes that the type doesn't have are an error and left out. Values are kept as a set; null and blank ones are
    left out without an error, values that break their rule with one. A node without a label that holds is an error. A
    node stays one row: nothing is shuffled.
    """
    allowed = F.create_map(*[x for t in registry.objects for x in (F.lit(t), F.array(*[F.lit(a) for a in registry.attributes(t)]).cast("array<string>"))])
    mine = F.coalesce(F.try_element_at(allowed, F.col("type")), F.array().cast("array<string>"))
    result = "array<struct<value:string,error:string>>"

    def checks(name: Column, value: Column) -> Column:
        out = F.struct(value.alias("value"), F.lit(None).cast("string").alias("error"))
        for attr, rule in attributes.items():
            out = F.when(name == attr, rule(value)).otherwise(out)
        return out

    entries = F.transform(
        F.array_sort(F.map_entries(F.coalesce("attrs", F.create_map().cast("map<string,array<string>>")))),
        lambda e: F.struct(e["key"].alias("key"), F.array_contains(mine, e["key"]).alias("known"), clean_values(e["value"]).alias("given"), F.transform(clean_values(e["value"]), lambda x: checks(e["key"], x)).cast(result).alias("checked")),
    )
    checked = nodes.withColumn("_label", _label_checks(labels, registry)).withColumn("_entries", entries)
    kept = F.filter(F.transform(F.filter("_entries", lambda e: e["known"]), lambda e: F.struct(e["key"].alias("key"), F.array_sort(F.array_distinct(F.filter(F.transform(e["checked"], lambda c: c["value"]), lambda x: x.isNotNull()))).alias("value"))), lambda e: F.size(e["value"]) > 0)
    one = lambda field, value, error: F.struct(field.alias("field"), value.alias("value"), error.alias("error"))
    unknown = F.transform(F.filter("_entries", lambda e: ~e["known"]), lambda e: one(e["key"], F.lit(None).cast("string"), F.lit("no such attribute")))
    wrong = F.flatten(F.transform(F.filter("_entries", lambda e: e["known"]), lambda e: F.filter(F.zip_with(e["given"], e["checked"], lambda g, c: one(e["key"], g, c["error"])), lambda x: x["error"].isNotNull())))
    label_error = F.coalesce(F.col("_label")["error"], F.when(F.col("_label")["value"].isNull(), "no label"))
    label = F.when(label_error.isNotNull(), F.array(one(F.lit("label"), F.col("label"), label_error))).otherwise(F.array().cast("array<struct<field:string,value:string,error:string>>"))
    rest = [c for c in nodes.columns if c not in ("label", "attrs")]
    return checked.select(*rest, F.col("_label")["value"].alias("label"), F.map_from_entries(kept).alias("attrs"), F.concat(label, unknown, wrong).alias("errors"))


# Countries: a dimension with code (alpha-2), alpha3, name, and aliases (array of further and former names).


def country_names(countries: DataFrame) -> DataFrame:
    """name (folded), code, rank: every name, code and alias of a country; what is current comes before what is former."""
    folded = lambda c: F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))
    own = F.array(F.struct(folded(F.col("name")).alias("name"), F.lit(0).alias("rank")), F.struct(F.lower("code").alias("name"), F.lit(1).alias("rank")), F.struct(F.lower("alpha3").alias("name"), F.lit(1).alias("rank")))
    more = F.transform(F.coalesce("aliases", F.array().cast("array<string>")), lambda a: F.struct(folded(a).alias("name"), F.lit(2).alias("rank")))
    rows = countries.select("code", F.explode(F.concat(own, more)).alias("n")).select("n.name", "code", "n.rank").filter("name is not null and name <> ''")
    return rows.groupBy("name").agg(F.min_by("code", F.struct("rank", "code")).alias("code"), F.min("rank").alias("rank"))


def country_of(records: DataFrame, column: str, countries: DataFrame, overrides: dict[str, str] | None = None, fuzzy: bool = True) -> DataFrame:
    """records with country_code and country_error: by override, then name or code as it is, then the most similar name.

    Distinct values are looked up once each. Null and blank values have neither code nor error; a value that is like no
    name is an error.
    """
    folded = F.nullif(F.lower(F.trim(F.regexp_replace(column, r"\s+", " "))), F.lit(""))
    asked = records.select(folded.alias("_asked")).filter("_asked is not null").distinct()
    names = country_names(countries)
    given = F.create_map(*[x for k, c in sorted((overrides or {}).items()) for x in (F.lit(k.lower()), F.lit(c))]) if overrides else F.create_map().cast("map<string,string>")
    exact = asked.join(names, asked["_asked"] == names["name"], "left").select("_asked", F.coalesce(F.try_element_at(given, F.col("_asked")), F.col("code")).alias("_code"))
    if fuzzy:
        unknown = exact.filter("_code is null").select(F.col("_asked").alias("query"))
        near = best_match(unknown, names.filter("rank <> 1").select("name", F.col("name").alias("output"))).join(names.select(F.col("name").alias("output"), F.col("code").alias("_near")), "output")
        exact = exact.join(near.select(F.col("query").alias("_asked"), "_near"), "_asked", "left").select("_asked", F.coalesce("_code", "_near").alias("_code"))
    out = records.withColumn("_asked", folded).join(exact, "_asked", "left")
    return out.withColumns({"country_code": F.col("_code"), "country_error": F.when(F.col("_asked").isNotNull() & F.col("_code").isNull(), "not a country")}).drop("_asked", "_code")


def enrich_countries(nodes: DataFrame, countries: DataFrame, overrides: dict[str, str] | None = None) -> DataFrame:
    """Country nodes with the code of their label as attribute country; other nodes as they are."""
    looked = country_of(nodes.withColumn("_name", F.when(F.col("type") == "Country", F.col("label"))), "_name", countries, overrides)
    own = F.create_map(F.lit("country"), F.array("country_code"))
    rest = F.map_filter("attrs", lambda k, _: k != "country")
    return looked.withColumn("attrs", F.when(F.col("country_code").isNotNull(), F.map_concat(rest, own)).otherwise(F.col("attrs"))).select(*nodes.columns, "country_error")


def enrich_addresses(nodes: DataFrame, states: dict[str, str] | None = None) -> DataFrame:
    """Address nodes with postcode and state where a label ends with them ("..., STATE 1234" or "..., STATE, 1234"); the
    label keeps the rest in upper case. Without such an ending the label is only put in upper case."""
    end = F.regexp_extract(F.upper("label"), r"[,\s]([A-Z]{2,3})[,\s]+([0-9]{4,6})\s*$", 0)
    state, code = (F.nullif(F.regexp_extract(F.upper("label"), r"[,\s]([A-Z]{2,3})[,\s]+([0-9]{4,6})\s*$", n), F.lit("")) for n in (1, 2))
    if states:
        names = F.create_map(*[x for k, name in sorted(states.items()) for x in (F.lit(k), F.lit(name))])
        state = F.coalesce(F.try_element_at(names, state), state)
    bare = F.regexp_replace(F.expr("substring(upper(label), 1, length(label) - length(_end))"), r"[,\s]+$", "")
    is_address = (F.col("type") == "Address") & F.col("label").isNotNull()
    found = nodes.withColumns({"_end": end, "_state": state, "_code": code})
    more = F.map_from_entries(F.filter(F.array(F.struct(F.lit("state").alias("key"), F.array("_state").alias("value")), F.struct(F.lit("postcode").alias("key"), F.array("_code").alias("value"))), lambda e: e["value"][0].isNotNull()))
    kept = F.map_filter("attrs", lambda k, _: ~F.map_contains_key(more, k))
    return found.withColumns({"attrs": F.when(is_address, F.map_concat(kept, more)).otherwise(F.col("attrs")), "label": F.when(is_address, bare).otherwise(F.col("label"))}).select(*nodes.columns)

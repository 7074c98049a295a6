"""Typed objects and links: registry, legality, flattening into search documents.

Graphs are two tables: nodes (doc_id, node_id, type, label, attrs map<string,array<string>>) and edges (doc_id, src,
link_type, reversed, attrs, dst). The registry is small and resolved once on the driver into join tables.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ObjectType:
    name: str
    parent: str | None = None
    attributes: tuple[str, ...] = ()
    links: tuple[str, ...] = ()


@dataclass(frozen=True)
class LinkType:
    name: str
    directional: bool = True
    targets: tuple[str, ...] = ()
    attributes: tuple[str, ...] = ("timestamp",)


#: The object types with parent, own attributes and outgoing links.
OBJECT_TYPES = [
    ObjectType("Account", None, (), ("AssociatedWith",)),
    ObjectType("PhoneNumber", "Account"),
    ObjectType("Email", "Account"),
    ObjectType("ITUE164", "PhoneNumber", ("country",)),
    ObjectType("OnlineAccount", "Account", ("platform",)),
    ObjectType("IssuedDocument", None, ("issued", "expiry", "country"), ("AssociatedWith", "Travelled")),
    ObjectType("Passport", "IssuedDocument", ("type",)),
    ObjectType("Visa", "IssuedDocument", ("class", "application")),
    ObjectType("Unknown"),
    ObjectType("Entity", None, (), ("MemberOf", "Holds", "AssociatedWith", "Located", "Travelled")),
    ObjectType("Organisation", "Entity"),
    ObjectType("Group", "Entity", ("type",)),
    ObjectType("Person", "Entity", ("dob", "pob", "gender", "surname", "givennames")),
    ObjectType("Event", None, ("timestamp",)),
    ObjectType("MultiDayEvent", None, ("start_dt", "end_dt")),
    ObjectType("Flight", "Event", ("route", "departure_time", "departure_port", "arrival_time", "arrival_port"), ("Arrived", "Departed")),
    ObjectType("Location", None, ("geoloc",), ("Located", "AssociatedWith")),
    ObjectType("Country", "Location", ("country",)),
    ObjectType("Address", "Location", ("state", "state_district", "postcode", "country")),
    ObjectType("Port", "Location"),
    ObjectType("Airport", "Port", ("city", "country")),
    ObjectType("Object", None, (), ("Located",)),
]
#: The link types with the object types that they lead to.
LINK_TYPES = [
    LinkType("AssociatedWith", False, ("Account", "IssuedDocument", "Location")),
    LinkType("Travelled", True, ("Flight",)),
    LinkType("MemberOf", True, ("Organisation", "Group")),
    LinkType("Holds", True, ("IssuedDocument",)),
    LinkType("Departed", True, ("Location",)),
    LinkType("Located", True, ("Location",)),
    LinkType("Arrived", True, ("Location",)),
    LinkType("IssuedTo"),
    LinkType("IssuedBy"),
]


class Registry:
    def __init__(self, objects: list[ObjectType] = OBJECT_TYPES, links: list[LinkType] = LINK_TYPES) -> None:
        self.objects, self.links = {o.name: o for o in objects}, {x.name: x for x in links}

    def ancestors(self, name: str) -> list[str]:
        """The type and all above it, the nearest first."""
        out = []
        while name:
            out.append(name)
            name = self.objects[name].parent
        return out

    def attributes(self, name: str) -> list[str]:
        return list(dict.fromkeys(a for t in self.ancestors(name) for a in self.objects[t].attributes))

    def outgoing(self, name: str) -> set[str]:
        return {x for t in self.ancestors(name) for x in self.objects[t].links}

    def _is(self, name: str, targets: tuple[str, ...]) -> bool:
        return bool(set(self.ancestors(name)) & set(targets))

    def legal(self) -> list[tuple[str, str, bool, str]]:
        """(source type, link type, reversed, target type) of every link that may be made. Links without direction hold
        both ways; a directional one that is reversed leads from its target back to a source."""
        out = []
        for source in self.objects:
            for link in self.links.values():
                for target in self.objects:
                    ahead = link.name in self.outgoing(source) and self._is(target, link.targets)
                    back = link.name in self.outgoing(target) and self._is(source, link.targets)
                    if ahead or back and not link.directional:
                        out.append((source, link.name, False, target))
                    if back and link.directional:
                        out.append((source, link.name, True, target))
        return out

    def shared_attributes(self) -> set[str]:
        """Attribute names that more than one object type, or an object and a link type, have of their own."""
        owners: dict[str, int] = {}
        for t in self.objects.values():
            for a in set(t.attributes):
                owners[a] = owners.get(a, 0) + 1
        for x in self.links.values():
            for a in set(x.attributes):
                owners[a] = owners.get(a, 0) + 1
        return {a for a, n in owners.items() if n > 1}

    # The registry as tables.

    def ancestor_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(t, a) for t in self.objects for a in self.ancestors(t)], "type string, ancestor string")

    def attribute_table(self, spark: SparkSession) -> DataFrame:
        shared = self.shared_attributes()
        return spark.createDataFrame([(t, a, a in shared) for t in self.objects for a in self.attributes(t)], "type string, attr string, shared boolean")

    def legal_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.legal(), "src_type string, link_type string, reversed boolean, dst_type string")

    def markdown(self) -> str:
        lines = ["| type | parent | attributes | links |", "|---|---|---|---|"]
        for t in self.objects.values():
            lines.append(f"| {t.name} | {t.parent or ''} | {', '.join(self.attributes(t.name))} | {', '.join(sorted(self.outgoing(t.name)))} |")
        return "\n".join(lines)


REGISTRY = Registry()


def attribute_errors(nodes: DataFrame, registry: Registry = REGISTRY) -> DataFrame:
    """doc_id, node_id, attr of attributes that a node's type doesn't have."""
    held = nodes.select("doc_id", "node_id", "type", F.explode(F.map_keys("attrs")).alias("attr"))
    return held.join(F.broadcast(registry.attribute_table(nodes.sparkSession)), ["type", "attr"], "left_anti").select("doc_id", "node_id", "attr")


def link_errors(nodes: DataFrame, edges: DataFrame, registry: Registry = REGISTRY) -> DataFrame:
    """Edges that may not be made between their types, or lead to no node."""
    types = nodes.select("doc_id", "node_id", "type")
    typed = edges.join(types.select("doc_id", F.col("node_id").alias("src"), F.col("type").alias("src_type")), ["doc_id", "src"], "left")
    typed = typed.join(types.select("doc_id", F.col("node_id").alias("dst"), F.col("type").alias("dst_type")), ["doc_id", "dst"], "left")
    legal = F.broadcast(registry.legal_table(nodes.sparkSession))
    return typed.join(legal, ["src_type", "link_type", "reversed", "dst_type"], "left_anti").select(*edges.columns)


def clean_values(values: Column) -> Column:
    """An attribute's values as a set, without blanks."""
    return F.array_sort(F.array_distinct(F.filter(values, lambda v: v.isNotNull() & (F.trim(v) != ""))))


def field_values(nodes: DataFrame, edges: DataFrame, registry: Registry = REGISTRY) -> DataFrame:
    """doc_id, field, value (distinct) of the flattened graphs.

    A node gives its label under its type and every type above it; an attribute its values under its bare name and, if
    its name is shared, under Type.name for the type and those above; links their name under link_types, their
    attributes like those of nodes.
    """
    spark = nodes.sparkSession
    ancestors = F.broadcast(registry.ancestor_table(spark))
    shared = sorted(registry.shared_attributes())
    labels = nodes.join(ancestors, "type").select("doc_id", F.col("ancestor").alias("field"), F.col("label").alias("value"))
    attrs = nodes.select("doc_id", "type", F.explode("attrs").alias("attr", "values")).withColumn("value", F.explode("values")).drop("values")
    bare = attrs.select("doc_id", F.col("attr").alias("field"), "value")
    qualified = attrs.filter(F.col("attr").isin(shared)).join(ancestors, "type").select("doc_id", F.concat_ws(".", "ancestor", "attr").alias("field"), "value")
    links = edges.select("doc_id", F.lit("link_types").alias("field"), F.col("link_type").alias("value"))
    link_attrs = edges.select("doc_id", "link_type", F.explode("attrs").alias("attr", "values")).withColumn("value", F.explode("values")).drop("values")
    link_bare = link_attrs.select("doc_id", F.col("attr").alias("field"), "value")
    link_qualified = link_attrs.filter(F.col("attr").isin(shared)).select("doc_id", F.concat_ws(".", "link_type", "attr").alias("field"), "value")
    parts = [labels, bare, qualified, links, link_bare, link_qualified]
    return functools.reduce(DataFrame.unionByName, parts).filter("value is not null and value <> ''").distinct()


_INSTANT = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ$"


def flatten(nodes: DataFrame, edges: DataFrame, registry: Registry = REGISTRY) -> DataFrame:
    """doc_id, object_types, link_types, attr_types and fields (map of suffixed name to sorted values).

    Instants are suffixed _dts, other text _ss, coordinates nothing. Values are brought together per document and field
    first, so the last aggregation moves one row a field.
    """
    values = field_values(nodes, edges, registry)
    geo = F.col("field").endswith("geoloc")
    suffix = F.when(geo, "").when(F.col("value").rlike(_INSTANT), "_dts").otherwise("_ss")
    kind = F.when(F.col("field") == "link_types", "link").when(F.col("field").rlike("^[A-Z][^.]*$"), "object").otherwise("attr")
    named = values.withColumns({"kind": kind, "name": F.when(kind == "link", "link_types").otherwise(F.concat("field", suffix))})
    per_field = named.groupBy("doc_id", "kind", "name").agg(F.array_sort(F.collect_set("value")).alias("values"), F.first("field").alias("field"))
    of = lambda k: F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.when(F.col("kind") == k, F.array("field") if k != "link" else F.col("values"))))))
    entries = F.collect_list(F.when(F.col("kind") != "link", F.struct("name", "values")))
    return per_field.groupBy("doc_id").agg(of("object").alias("object_types"), of("link").alias("link_types"), of("attr").alias("attr_types"), F.map_from_entries(F.array_sort(entries)).alias("fields"))


def flatten_rows(graphs: DataFrame, registry: Registry = REGISTRY) -> DataFrame:
    """What flatten gives, of graphs that lie in one row each (graph_rows): doc_id, n (nodes), e (edges). The fields are
    made within the row; rows of one doc_id are brought together by the only shuffle there is."""
    shared = sorted(registry.shared_attributes())
    known = F.create_map(*[x for t in registry.objects for x in (F.lit(t), F.array(*[F.lit(a) for a in registry.ancestors(t)]))])
    entry = lambda kind, field, value: F.struct(F.lit(kind).alias("kind"), field.alias("field"), value.alias("value"))
    above = lambda n: F.coalesce(F.try_element_at(known, n["type"]), F.array().cast("array<string>"))
    pairs = lambda attrs: F.flatten(F.transform(F.map_entries(attrs), lambda a: F.transform(a["value"], lambda v: F.struct(a["key"].alias("k"), v.alias("v")))))
    is_shared = lambda p: p["k"].isin(shared)

    labels = F.flatten(F.transform("n", lambda n: F.transform(above(n), lambda a: entry("object", a, n["label"]))))
    bare = F.flatten(F.transform("n", lambda n: F.transform(pairs(n["attrs"]), lambda p: entry("attr", p["k"], p["v"]))))
    typed = F.flatten(F.transform("n", lambda n: F.flatten(F.transform(F.filter(pairs(n["attrs"]), is_shared), lambda p: F.transform(above(n), lambda a: entry("attr", F.concat_ws(".", a, p["k"]), p["v"]))))))
    links = F.transform("e", lambda e: entry("link", F.lit("link_types"), e["link_type"]))
    link_bare = F.flatten(F.transform("e", lambda e: F.transform(pairs(e["attrs"]), lambda p: entry("attr", p["k"], p["v"]))))
    link_typed = F.flatten(F.transform("e", lambda e: F.transform(F.filter(pairs(e["attrs"]), is_shared), lambda p: entry("attr", F.concat_ws(".", e["link_type"], p["k"]), p["v"]))))
    entries = F.array_distinct(F.filter(F.concat(labels, bare, typed, links, link_bare, link_typed), lambda x: x["value"].isNotNull() & (x["value"] != "")))
    # One document's fields are few enough for one row, as they are in what comes out.
    whole = graphs.select("doc_id", entries.alias("x")).groupBy("doc_id").agg(F.array_distinct(F.flatten(F.collect_list("x"))).alias("x"))
    suffix = lambda x: F.when(x["field"].endswith("geoloc"), "").when(x["value"].rlike(_INSTANT), "_dts").otherwise("_ss")
    named = F.transform(F.filter("x", lambda x: x["kind"] != "link"), lambda x: F.struct(F.concat(x["field"], suffix(x)).alias("name"), x["value"].alias("value")))
    whole = whole.withColumn("named", named)
    fields = F.transform(F.array_sort(F.array_distinct(F.transform("named", lambda x: x["name"]))), lambda name: F.struct(name.alias("name"), F.array_sort(F.array_distinct(F.transform(F.filter("named", lambda x: x["name"] == name), lambda x: x["value"]))).alias("values")))
    of = lambda kind, part: F.array_sort(F.array_distinct(F.transform(F.filter("x", lambda x: x["kind"] == kind), lambda x: x[part])))
    return whole.filter(F.size("x") > 0).select("doc_id", of("object", "field").alias("object_types"), of("link", "value").alias("link_types"), of("attr", "field").alias("attr_types"), F.map_from_entries(fields).alias("fields"))


def document_id(cid: Column, record_ids: Column) -> Column:
    """SHA-256 over the dataset's number and the sorted record ids, one after the other."""
    return F.sha2(F.concat(cid.cast("string"), F.array_join(F.array_sort(record_ids), "")), 256)


def raw_json(columns: list[str]) -> Column:
    """The record as compact JSON with sorted keys, without nulls."""
    return F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]), {"ignoreNullFields": "true"})


def instant(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def acyclic(edges: DataFrame) -> bool:
    """Whether no document's links run in a circle: ends that nothing leads to are taken away until none is left, or no
    more can be; each round is a pass over what is left, so it ends for chains of any length."""
    from millrace.session import cut_lineage

    left = edges.select("doc_id", "src", "dst").distinct()
    count = left.count()
    while count:
        reached = left.select("doc_id", F.col("dst").alias("src")).distinct()
        left = cut_lineage(left.join(reached, ["doc_id", "src"], "left_semi"), "edges")
        now = left.count()
        if now == count:
            return False
        count = now
    return True


# Building graphs from records: a declarative mapping, row by row, without a shuffle.


def node(node_id: int, kind: str, label: Column, **attrs: Column) -> Column:
    """A node of a record's graph; null where its label is. Attributes may be scalars or arrays."""
    pairs = [x for name, value in attrs.items() for x in (F.lit(name), value)]
    held = F.map_filter(F.create_map(*pairs), lambda _, v: F.size(v) > 0) if pairs else F.create_map().cast("map<string,array<string>>")
    return F.when(label.isNotNull(), F.struct(F.lit(node_id).alias("node_id"), F.lit(kind).alias("type"), label.alias("label"), held.alias("attrs")))


def one(value: Column) -> Column:
    return F.filter(F.array(value.cast("string")), lambda v: v.isNotNull())


def link(src: int, kind: str, dst: int, reversed: bool = False, **attrs: Column) -> Column:
    pairs = [x for name, value in attrs.items() for x in (F.lit(name), value)]
    held = F.map_filter(F.create_map(*pairs), lambda _, v: F.size(v) > 0) if pairs else F.create_map().cast("map<string,array<string>>")
    return F.struct(F.lit(src).alias("src"), F.lit(kind).alias("link_type"), F.lit(reversed).alias("reversed"), held.alias("attrs"), F.lit(dst).alias("dst"))


def graph_rows(records: DataFrame, doc_id: Column, nodes: list[Column], links: list[Column]) -> DataFrame:
    """doc_id, n, e: the nodes and edges of every record in its row; links whose ends aren't both there are left out."""
    made = F.filter(F.array(*nodes), lambda n: n.isNotNull())
    edges = F.array(*links) if links else F.array().cast("array<struct<src:int,link_type:string,reversed:boolean,attrs:map<string,array<string>>,dst:int>>")
    built = records.select(doc_id.alias("doc_id"), made.alias("n"), edges.alias("e"))
    ids = F.transform("n", lambda n: n["node_id"])
    return built.withColumn("e", F.filter("e", lambda e: F.array_contains(ids, e["src"]) & F.array_contains(ids, e["dst"])))


def build_graphs(records: DataFrame, doc_id: Column, nodes: list[Column], links: list[Column]) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of every record; links whose ends aren't both there are left out."""
    rows = graph_rows(records, doc_id, nodes, links)
    return rows.select("doc_id", F.explode("n").alias("n")).select("doc_id", "n.*"), rows.select("doc_id", F.explode("e").alias("e")).select("doc_id", "e.*")


def airports(records: DataFrame, dimension: DataFrame, column: str, prefix: str) -> DataFrame:
    """The airport of a code column: label "Name (CODE)", city, country and geoloc, under a prefix, and <prefix>_error
    for codes that aren't three letters or aren't known; nulls where unknown."""
    known = dimension.select(
        F.upper("code").alias(f"{prefix}_code"), F.concat(F.col("name"), F.lit(" ("), F.upper("code"), F.lit(")")).alias(f"{prefix}_label"), F.col("city").alias(f"{prefix}_city"), F.col("country").alias(f"{prefix}_country"),
        F.concat_ws(",", F.col("lat").cast("string"), F.col("lon").cast("string")).alias(f"{prefix}_geoloc"),
    )
    joined = records.join(known, F.upper(F.trim(column)) == F.col(f"{prefix}_code"), "left")
    wrong = F.when(~F.trim(column).rlike("^[A-Za-z]{3}$"), "not an airport code").when(F.col(f"{prefix}_code").isNull() & F.col(column).isNotNull(), "unknown airport")
    return joined.withColumn(f"{prefix}_error", wrong).drop(f"{prefix}_code")


def flight_graphs(records: DataFrame, dimension: DataFrame, doc_id: Column) -> tuple[DataFrame, DataFrame]:
    """Person – Holds – Passport – Travelled – Flight – Departed / Arrived – Airport, of flight records with dob
    (dd/mm/yyyy), name, passport_no, passport_country, departure_port, departure_time, arrival_port, arrival_time."""
    from millrace.functions.values import day_first_date, surname

    joined = airports(airports(records, dimension, "departure_port", "dep"), dimension, "arrival_port", "arr")
    route = F.concat_ws("-", F.upper("departure_port"), F.upper("arrival_port"))
    nodes = [
        node(1, "Person", F.nullif(surname(F.col("name")), F.lit("")), dob=one(instant(day_first_date(F.col("dob"))))),
        node(2, "Passport", F.col("passport_no"), country=one(F.col("passport_country"))),
        node(3, "Flight", route, route=one(route), departure_time=one(F.col("departure_time")), arrival_time=one(F.col("arrival_time")), departure_port=one(F.col("departure_port")), arrival_port=one(F.col("arrival_port"))),
        node(4, "Airport", F.col("dep_label"), city=one(F.col("dep_city")), country=one(F.col("dep_country")), geoloc=one(F.col("dep_geoloc"))),
        node(5, "Airport", F.col("arr_label"), city=one(F.col("arr_city")), country=one(F.col("arr_country")), geoloc=one(F.col("arr_geoloc"))),
    ]
    links = [link(1, "Holds", 2), link(2, "Travelled", 3), link(3, "Departed", 4, timestamp=one(F.col("departure_time"))), link(3, "Arrived", 5, timestamp=one(F.col("arrival_time")))]
    return build_graphs(joined, doc_id, nodes, links)

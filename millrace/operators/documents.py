"""From records to search documents: metadata fields, catalogue markings, and the pipeline over them."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.values import short_marking, surname
from millrace.operators import ontology
from millrace.session import cut_lineage


@dataclass(frozen=True)
class MetadataField:
    """A field of provenance. kind is string or int; marking makes it out of a catalogue marking's column."""

    name: str
    kind: str = "string"
    multivalued: bool = False
    required_at_load: bool = False
    required_at_index: bool = False
    stats: bool = False
    marking: Callable[[], Column] | None = None
    example: object = None


FIELDS = [
    MetadataField("src_file_rec", multivalued=True, required_at_load=True, example=["10/test_data.csv:10"]),
    MetadataField("src_file_cid", "int", stats=True, example=10),
    MetadataField("src_file_src", stats=True, marking=lambda: short_marking(F.col("owner_external"))["value"], example="Department"),
]


@dataclass
class MetadataRegistry:
    fields: list[MetadataField] = field(default_factory=lambda: list(FIELDS))

    def schema(self) -> T.StructType:
        """The fields as columns; what a field is for goes into its metadata."""
        kinds = {"string": T.StringType(), "int": T.LongType()}
        out = []
        for f in self.fields:
            kind = T.ArrayType(kinds[f.kind]) if f.multivalued else kinds[f.kind]
            out.append(T.StructField(f.name, kind, not (f.required_at_load or f.required_at_index), {"stats": f.stats, "multivalued": f.multivalued}))
        return T.StructType(out)

    def example(self) -> dict:
        return {f.name: f.example for f in self.fields}

    def validated(self, df: DataFrame) -> DataFrame:
        """df with metadata_error: the first field whose value breaks its rule. Scalars become lists of one where a field
        has several values, and lists of one scalars where it has one."""
        kinds = dict(df.dtypes)
        errors = []
        for f in self.fields:
            if f.name not in kinds:
                errors.append(F.when(F.lit(f.required_at_load or f.required_at_index), F.lit(f"{f.name} is missing")))
                continue
            value, listed = F.col(f.name), kinds[f.name].startswith("array")
            if f.multivalued and not listed:
                df, value = df.withColumn(f.name, F.when(value.isNotNull(), F.array(value))), F.col(f.name)
            elif listed and not f.multivalued:
                several = f"_several_{f.name}"
                df = df.withColumns({several: F.size(value) > 1, f.name: F.try_element_at(value, F.lit(1))})
                errors.append(F.when(F.col(several), f"{f.name} has more than one value"))
            blank = (lambda v: v.isNull() | (F.trim(v.cast("string")) == "")) if f.kind == "string" else (lambda v: v.isNull())
            empty = value.isNull() | F.exists(value, blank) | (F.size(value) == 0) if f.multivalued else blank(value)
            if f.required_at_load or f.required_at_index:
                errors.append(F.when(F.coalesce(empty, F.lit(True)), f"{f.name} is missing"))
            elif f.kind == "string" and not f.multivalued:
                errors.append(F.when(value.isNotNull() & blank(value), f"{f.name} is empty"))
        out = df.withColumn("metadata_error", F.coalesce(*errors, F.lit(None).cast("string")))
        return out.drop(*[c for c in out.columns if c.startswith("_several_")])

    def with_markings(self, df: DataFrame, markings: DataFrame, cid: str = "src_file_cid") -> DataFrame:
        """df with the fields made from its dataset's markings; these come before what a record says itself. Markings
        are one row a dataset, joined by number (Spark broadcasts them while they are small)."""
        made = markings.select(F.col("cid").alias("_cid"), *[f.marking().alias(f"_m_{f.name}") for f in self.fields if f.marking])
        out = df.join(made, df[cid] == F.col("_cid"), "left").drop("_cid")
        for f in self.fields:
            if f.marking:
                own = F.col(f.name) if f.name in df.columns else F.lit(None).cast("string")
                out = out.withColumn(f.name, F.coalesce(F.col(f"_m_{f.name}"), own)).drop(f"_m_{f.name}")
        return out


def failed_lines_as_unknown(records: DataFrame) -> DataFrame:
    """raw_line of failed rows, read as UTF-8 with what doesn't fit replaced; null for valid ones."""
    return records.withColumn("raw_line", F.when(F.col("_load_error").isNotNull(), F.decode(F.unbase64("_line_b64encoded"), "utf-8")))


def search_documents(records: DataFrame, build: Callable[[DataFrame, Column], tuple[DataFrame, DataFrame]], registry: MetadataRegistry | None = None) -> DataFrame:
    """id, raw, the metadata fields, types and flattened fields of every record.

    records has src_file_rec, src_file_cid and the record's own columns; build makes (nodes, edges) of them for a
    document id. Records that build nothing for become an Unknown of their id.
    """
    registry = registry or MetadataRegistry()
    checked = registry.validated(records)
    own = [c for c in records.columns if c not in {f.name for f in registry.fields}]
    identified = checked.withColumns({"id": ontology.document_id(F.col("src_file_cid"), F.col("src_file_rec")), "raw": ontology.raw_json(own) if own else F.lit("{}")})
    nodes, edges = build(identified, F.col("id"))
    lone = identified.select(F.col("id").alias("doc_id")).distinct().join(nodes.select("doc_id").distinct(), "doc_id", "left_anti")
    unknown = lone.select("doc_id", F.lit(1).alias("node_id"), F.lit("Unknown").alias("type"), F.col("doc_id").alias("label"), F.create_map().cast("map<string,array<string>>").alias("attrs"))
    flat = ontology.flatten(nodes.select("doc_id", "node_id", "type", "label", "attrs").unionByName(unknown), edges).withColumnRenamed("doc_id", "id")
    meta = [f.name for f in registry.fields if f.name in checked.columns]
    return identified.select("id", "raw", *meta, "metadata_error").dropDuplicates(["id"]).join(flat, "id")


def compact_graph(nodes: DataFrame, edges: DataFrame, root: int = 1) -> DataFrame:
    """doc_id, data: each graph as compact JSON from its root: [type, label, [[attribute, value]...], [[link, attributes,
    object]...]], a reversed link marked by `-`. Links are followed as deep as they go, the deepest first; a document whose
    links run in a circle has no such form and is an error."""
    if not ontology.acyclic(edges):
        raise ValueError("links run in a circle")
    values = F.flatten(F.transform(F.array_sort(F.map_entries("attrs")), lambda e: F.transform(F.array_sort(e["value"]), lambda v: F.to_json(F.array(e["key"], v)))))
    text = lambda c: F.substring(F.to_json(F.array(c)), F.lit(2), F.length(F.to_json(F.array(c))) - 2)
    own = nodes.select("doc_id", "node_id", text(F.col("type")).alias("t"), text(F.col("label")).alias("l"), F.concat(F.lit("["), F.array_join(values, ","), F.lit("]")).alias("a"))
    out = own.select("doc_id", "node_id", F.concat_ws(",", "t", "l", "a").alias("head"), F.lit("[]").alias("links"))
    link_name = text(F.concat(F.when(F.col("reversed"), F.lit("-")).otherwise(F.lit("")), F.col("link_type")))
    joined = edges.select("doc_id", "src", "dst", link_name.alias("n"), F.concat(F.lit("["), F.array_join(values, ","), F.lit("]")).alias("la"))
    depth, level = 0, edges.select("doc_id", F.col("src").alias("node_id")).distinct()
    while not level.isEmpty():  # as many rounds as the longest chain has links
        depth += 1
        level = cut_lineage(edges.select("doc_id", F.col("dst").alias("node_id"), F.col("src").alias("at")).join(level, ["doc_id", "node_id"], "left_semi").select("doc_id", F.col("at").alias("node_id")).distinct(), "level")
    for _ in range(depth):
        whole = out.select("doc_id", F.col("node_id").alias("dst"), F.concat(F.lit("["), "head", F.lit(","), "links", F.lit("]")).alias("object"))
        under = joined.join(whole, ["doc_id", "dst"]).groupBy("doc_id", F.col("src").alias("node_id")).agg(F.array_join(F.array_sort(F.collect_list(F.concat(F.lit("["), "n", F.lit(","), "la", F.lit(","), "object", F.lit("]")))), ",").alias("inner"))
        out = out.drop("links").join(under, ["doc_id", "node_id"], "left").select("doc_id", "node_id", "head", F.concat(F.lit("["), F.coalesce("inner", F.lit("")), F.lit("]")).alias("links"))
    return out.filter(F.col("node_id") == root).select("doc_id", F.concat(F.lit("["), "head", F.lit(","), "links", F.lit("]")).alias("data"))


def load_dataset(spark: SparkSession, paths: list[str], loader: Callable[[SparkSession, list[str]], DataFrame] | None = None, preprocess: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The records of a dataset: by its own loader, or else JSON lines with a column for every field in any of them; then
    what its own preprocessing makes of them."""
    records = loader(spark, paths) if loader else spark.read.json(paths)
    return records.transform(preprocess) if preprocess else records


def built_by(records: DataFrame, builder: Callable[[dict], dict | None], schema: str, debug: bool = False) -> DataFrame:
    """What a Python function makes of each record, for builders that Columns can't express: rows of the schema and
    build_error. Records that it gives None for are left out. An exception stops the job with the record in its message;
    with debug the record comes out with nothing but the error, so that errors can be counted."""
    out = f"{schema}, build_error string"
    names = [f.name for f in T._parse_datatype_string(out).fields]

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = []
            for record in batch.to_dict("records"):
                try:
                    if (one := builder(record)) is not None:
                        made.append({**one, "build_error": None})
                except Exception as error:
                    if not debug:
                        raise ValueError(f"{type(error).__name__}: {error}, in {record}") from error
                    made.append({"build_error": f"{type(error).__name__}: {error}"})
            yield pd.DataFrame(made, columns=names)

    return records.mapInPandas(build, out)


def name_graphs(records: DataFrame, doc_id: Column, name: Column) -> tuple[DataFrame, DataFrame]:
    """A Person under its name for every record; an Entity UNKNOWN where there is none (count them by that label)."""
    label = F.nullif(surname(name), F.lit(""))
    return ontology.build_graphs(records, doc_id, [ontology.node(1, "Person", label), ontology.node(2, "Entity", F.when(label.isNull(), "UNKNOWN"))], [])

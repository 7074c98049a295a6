"""Queries over typed objects and links built from register rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.values import surname
from millrace.operators import ontology as o
from millrace.operators import validation
from millrace.operators.documents import search_documents
from millrace.session import table


def _register(spark: SparkSession, sf_dir: str, build):
    rows = table(spark, sf_dir, "testdata").dropDuplicates(["src_file_rec", "name", "region", "telephone_number"])
    person = F.coalesce(F.nullif(surname(F.col("name")), F.lit("")), F.lit("UNKNOWN"))
    nodes = [
        o.node(1, "Person", person, surname=o.one(F.lower(person))),
        o.node(2, "PhoneNumber", F.nullif(F.regexp_replace("telephone_number", "[^0-9]", ""), F.lit(""))),
        o.node(3, "Address", F.nullif(F.upper(F.trim("region")), F.lit("")), state=o.one(F.nullif(F.trim("region"), F.lit("")))),
    ]
    links = [o.link(1, "AssociatedWith", 2), o.link(1, "Located", 3, timestamp=o.one(o.instant(F.col("seen_at"))))]
    return build(rows, F.col("src_file_rec"), nodes, links)


def register_graphs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A person for every register row, with its number and the place it is in; rows that share a src_file_rec are one."""
    return _register(spark, sf_dir, o.build_graphs)


def ontology_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, edges = register_graphs(spark, sf_dir)
    return o.field_values(nodes, edges).groupBy("field").agg(F.count("*").alias("n"), F.countDistinct("value").alias("distinct_values"))


def ontology_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flattened search documents."""
    flat = o.flatten_rows(_register(spark, sf_dir, o.graph_rows))
    joined = [F.array_join(c, ",").alias(c) for c in ("object_types", "link_types", "attr_types")]
    return flat.select("doc_id", *joined, F.array_join(F.try_element_at("fields", F.lit("Entity_ss")), "|").alias("entity"), F.array_join(F.try_element_at("fields", F.lit("Location_ss")), "|").alias("location"))


def ontology_ancestors(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, _ = register_graphs(spark, sf_dir)
    return nodes.join(F.broadcast(o.REGISTRY.ancestor_table(spark)), "type").groupBy("ancestor").agg(F.count("*").alias("n"))


def ontology_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links that may not be made, if the places are taken for accounts: all of them lead the wrong way."""
    nodes, edges = register_graphs(spark, sf_dir)
    wrong = nodes.withColumn("type", F.when(F.col("type") == "Address", "PhoneNumber").otherwise(F.col("type")))
    return o.link_errors(wrong, edges).groupBy("link_type").agg(F.count("*").alias("n"))


def ontology_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Register rows as addresses of mail with a place and a gender made of them, checked by the rules of their types."""
    rows = table(spark, sf_dir, "testdata")
    attrs = F.create_map(F.lit("gender"), F.array(F.left("name", F.lit(1))), F.lit("dob"), F.array(F.date_format("seen_at", "yyyy-MM-dd"), F.lit(" ")), F.lit("platform"), F.array("region"))
    kind = F.when(F.col("cid") % 2 == 0, "Person").otherwise("Email")
    label = F.when(F.col("cid") % 2 == 0, F.col("name")).otherwise(F.concat(F.lower("name"), F.lit("@example.com")))
    nodes = rows.select("src_file_rec", F.lit(1).alias("node_id"), kind.alias("type"), label.alias("label"), attrs.alias("attrs"))
    checked = validation.validated(nodes)
    held = F.array_join(F.array_sort(F.map_keys("attrs")), ",")
    return checked.select("src_file_rec", "label", held.alias("held"), F.array_join(F.transform("errors", lambda e: F.concat_ws(": ", e["field"], e["error"])), "; ").alias("errors"))


def flight_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A flight record as a search document, under the id that its dataset and record give."""
    flight = ("17/04/1979", "bart simpson", "P1234567", "AU", "SYD", "2016-04-02T10:00:00Z", "AKL", "2016-04-02T15:00:00Z", ["10/test_data.csv:10"], 10)
    schema = "dob string, name string, passport_no string, passport_country string, departure_port string, departure_time string, arrival_port string, arrival_time string, src_file_rec array<string>, src_file_cid int"
    ports = [("SYD", "Sydney Intl", "Sydney", "AU", -33.946111, 151.177222), ("AKL", "Auckland Intl", "Auckland", "NZ", -37.008056, 174.791667)]
    dimension = spark.createDataFrame(ports, "code string, name string, city string, country string, lat double, lon double")
    built = search_documents(spark.createDataFrame([flight], schema), lambda records, doc_id: o.flight_graphs(records, dimension, doc_id))
    first = lambda name: F.array_join(F.try_element_at("fields", F.lit(name)), "|")
    return built.select("id", F.array_join("object_types", ",").alias("object_types"), F.array_join("link_types", ",").alias("link_types"), first("Person_ss").alias("person"), first("dob_dts").alias("dob"), first("Airport.country_ss").alias("countries"))


QUERIES = {f.__name__: f for f in [ontology_fields, ontology_documents, ontology_ancestors, ontology_errors, ontology_validate, flight_documents]}

from millrace.plans.value_queries import _EMAIL  # noqa: E402

_ROWS = r"""
    rows AS (SELECT DISTINCT ON (src_file_rec, name, region, telephone_number) src_file_rec AS doc, coalesce(nullif(upper(trim(regexp_replace(name, '[^\p{L}\p{N}_]+', ' ', 'g'))), ''), 'UNKNOWN') AS person,
        nullif(regexp_replace(telephone_number, '[^0-9]', '', 'g'), '') AS phone, nullif(upper(trim(region)), '') AS place, nullif(trim(region), '') AS state, strftime(seen_at, '%Y-%m-%dT%H:%M:%SZ') AS seen FROM testdata)"""
SQL = {
    "flight_documents": """
        SELECT sha256('10' || '10/test_data.csv:10') AS id, 'Airport,Entity,Event,Flight,IssuedDocument,Location,Passport,Person,Port' AS object_types, 'Arrived,Departed,Holds,Travelled' AS link_types,
            'BART SIMPSON' AS person, '1979-04-17T00:00:00Z' AS dob, 'AU|NZ' AS countries""",
    "ontology_validate": rf"""
        WITH r AS (SELECT src_file_rec, cid % 2 = 0 AS p, name, CASE WHEN cid % 2 = 0 THEN nullif(trim(name), '') ELSE lower(name) || '@example.com' END AS given, nullif(trim(left(name, 1)), '') AS g, seen_at IS NOT NULL AS seen, nullif(trim(region), '') IS NOT NULL AS has_region FROM testdata),
        c AS (SELECT *, NOT p AND given IS NOT NULL AND NOT regexp_matches(trim(given), '{_EMAIL}') AS no_email, given IS NULL AS no_label, g IS NOT NULL AND upper(g) NOT IN ('M', 'F') AS no_gender FROM r)
        SELECT src_file_rec, CASE WHEN NOT no_email THEN given END AS label,
            CASE WHEN p THEN concat_ws(',', CASE WHEN seen THEN 'dob' END, CASE WHEN g IS NOT NULL AND NOT no_gender THEN 'gender' END) ELSE '' END AS held,
            concat_ws('; ', CASE WHEN no_email THEN 'label: not an email address' WHEN no_label THEN 'label: no label' END,
                CASE WHEN NOT p THEN 'dob: no such attribute' END, CASE WHEN NOT p THEN 'gender: no such attribute' END, 'platform: no such attribute', CASE WHEN p AND no_gender THEN 'gender: not a gender' END) AS errors
        FROM c""",
    "ontology_fields": f"""
        WITH {_ROWS}, f AS (
            SELECT doc, unnest(['Person', 'Entity']) AS field, person AS value FROM rows
            UNION SELECT doc, 'surname', lower(person) FROM rows
            UNION SELECT doc, unnest(['PhoneNumber', 'Account']), phone FROM rows WHERE phone IS NOT NULL
            UNION SELECT doc, unnest(['Address', 'Location']), place FROM rows WHERE place IS NOT NULL
            UNION SELECT doc, 'state', state FROM rows WHERE state IS NOT NULL
            UNION SELECT doc, 'link_types', 'AssociatedWith' FROM rows WHERE phone IS NOT NULL
            UNION SELECT doc, 'link_types', 'Located' FROM rows WHERE place IS NOT NULL
            UNION SELECT doc, unnest(['timestamp', 'Located.timestamp']), seen FROM rows WHERE place IS NOT NULL)
        SELECT field, count(*) AS n, count(DISTINCT value) AS distinct_values FROM f GROUP BY field""",
    "ontology_ancestors": f"""
        WITH {_ROWS}
        SELECT ancestor, count(*) AS n FROM (
            SELECT unnest(['Person', 'Entity']) AS ancestor FROM rows UNION ALL SELECT unnest(['PhoneNumber', 'Account']) FROM rows WHERE phone IS NOT NULL
            UNION ALL SELECT unnest(['Address', 'Location']) FROM rows WHERE place IS NOT NULL) GROUP BY 1""",
    "ontology_errors": f"WITH {_ROWS} SELECT 'Located' AS link_type, count(*) AS n FROM rows WHERE place IS NOT NULL HAVING count(*) > 0",
}
SQL["ontology_documents"] = f"""
    WITH {_ROWS}, d AS (SELECT doc, list_sort(list(DISTINCT person)) AS persons, list_sort(list(DISTINCT place) FILTER (WHERE place IS NOT NULL)) AS places, count(phone) > 0 AS phoned, count(place) > 0 AS placed FROM rows GROUP BY doc)
    SELECT doc AS doc_id,
        array_to_string(list_sort(list_concat(['Person', 'Entity'], CASE WHEN phoned THEN ['PhoneNumber', 'Account'] ELSE [] END, CASE WHEN placed THEN ['Address', 'Location'] ELSE [] END)), ',') AS object_types,
        array_to_string(list_sort(list_concat(CASE WHEN phoned THEN ['AssociatedWith'] ELSE [] END, CASE WHEN placed THEN ['Located'] ELSE [] END)), ',') AS link_types,
        array_to_string(list_sort(list_concat(['surname'], CASE WHEN placed THEN ['state', 'timestamp', 'Located.timestamp'] ELSE [] END)), ',') AS attr_types,
        array_to_string(persons, '|') AS entity, CASE WHEN placed THEN array_to_string(places, '|') END AS location
    FROM d"""

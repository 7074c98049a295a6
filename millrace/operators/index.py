"""A persistent text index, and scores of whole queries.

Postings (term, id, places) lie in files by a hash of the term, sorted by term, so a query reads its own terms' files and
within them its terms' row groups. Building is one shuffle; a search moves only the postings of its words.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import search_parser as sp
from millrace.functions.analyzers import text_general
from millrace.operators.search import Schema, _words, predicate
from millrace.session import shared_path

K1, B = 1.2, 0.75


def leaves(query: sp.Query, factor: float = 1.0) -> Iterable[tuple[object, float]]:
    """The terms, phrases and ranges of a query that aren't excluded, with the product of their boosts."""
    for occur, node in query.clauses:
        if occur == sp.MUST_NOT or isinstance(node, sp.All):
            continue
        if isinstance(node, sp.Query):
            yield from leaves(node, factor * node.boost)
        else:
            yield node, factor * node.boost


def check_query(text: str) -> sp.Query:
    """The parsed query; an error for one that can't be answered from what it asks for: one of exclusions only, or one
    that asks for any value of a field."""
    query = sp.parse(text)
    if not any(occur != sp.MUST_NOT for occur, _ in query.clauses):
        raise sp.QueryError("nothing is asked for")
    if any(isinstance(n, sp.Term) and n.field and n.wildcard and set(n.text) == {"*"} for n, _ in leaves(query)):
        raise sp.QueryError("any value of a field is asked for")
    return query


class TextIndex:
    """An index over one text column of a table, in a folder."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        head = spark.read.parquet(f"{path}/stats").first()
        self.documents, self.mean, self.buckets = head["documents"], head["mean"] or 1.0, head["buckets"]

    @staticmethod
    def build(records: DataFrame, id_col: str, text: Column, path: str | None = None, buckets: int = 64) -> TextIndex:
        """Rows without an id are left out, rows of one id are taken together; null texts have no words."""
        spark = records.sparkSession
        path = path or shared_path(spark, "index")
        words = text_general(F.coalesce(text, F.lit("")))
        rows = records.select(F.col(id_col).alias("id"), words.alias("words")).filter("id is not null")
        lengths = rows.groupBy("id").agg(F.sum(F.size("words")).alias("length"))
        lengths.write.parquet(f"{path}/documents")
        lengths = spark.read.parquet(f"{path}/documents")
        lengths.agg(F.count("*").alias("documents"), F.avg("length").alias("mean"), F.lit(buckets).alias("buckets")).write.parquet(f"{path}/stats")
        held = rows.select("id", F.posexplode("words").alias("place", "term")).groupBy("id", "term").agg(F.array_sort(F.collect_list("place")).alias("places"))
        postings = held.join(lengths, "id").withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int"))
        # A frequent word's postings go to several tasks; each writes its file of the bucket.
        spread = F.pmod(F.xxhash64("id"), F.lit(8))
        postings.repartition("bucket", spread).sortWithinPartitions("bucket", "term").write.partitionBy("bucket").parquet(f"{path}/postings")
        return TextIndex(spark, path)

    def postings(self, words: Iterable[str], patterns: Iterable[str] = ()) -> DataFrame:
        """term, id, places, length of the words, and of all terms that match a pattern whole."""
        words, patterns = sorted(set(words)), sorted(set(patterns))
        read = self.spark.read.schema("term string, id bigint, places array<int>, length bigint, bucket int").parquet(f"{self.path}/postings")
        wanted = F.col("term").isin(words)
        if patterns:
            for p in patterns:
                wanted = wanted | F.col("term").rlike(f"^(?:{p})$")
            return read.filter(wanted).drop("bucket")
        places = [r[0] for r in self.spark.createDataFrame([(w,) for w in words] or [("",)], "w string").select(F.pmod(F.xxhash64("w"), F.lit(self.buckets)).cast("int")).distinct().collect()]
        return read.filter(F.col("bucket").isin(places) & wanted).drop("bucket")

    def search(self, text: str) -> DataFrame:
        """id, score of every document that matches a query over the text, by the postings alone.

        The score is the sum over words and phrases of boost times BM25; a phrase counts as a word that occurs as often
        as it does, and as rare as its rarest word; a pattern or fuzzy word scores by all terms it stands for as one.
        Excluded clauses only exclude.
        """
        query = check_query(text)
        every = list(_all_leaves(query))
        if any(node.field for node in every) or any(isinstance(node, sp.Range) for node in every):
            raise sp.QueryError("the index holds one text, not fields")
        words, patterns, near = set(), set(), []
        for node in every:
            if isinstance(node, sp.Term) and node.wildcard:
                patterns.add(sp.wildcard_regex(node.text.lower()))
            elif isinstance(node, sp.Term) and node.fuzzy is not None:
                near.append(node)
            else:
                words.update(_words(node.text))
        found = self.postings(words, [*patterns, *[".+" for _ in near[:1]]])
        for node in near:  # of a whole dictionary only what is near is kept
            found = found.filter(F.col("term").isin(sorted(words)) | (F.levenshtein("term", F.lit(node.text.lower()), node.fuzzy) >= 0) | _matching(patterns)) if len(near) == 1 else found
        counts = {r["term"]: r["n"] for r in found.filter(F.col("term").isin(sorted(words))).groupBy("term").agg(F.count("*").alias("n")).collect()} if words else {}
        per_document = found.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("term", "places"))).alias("t"), F.first("length").alias("length"))
        hit, score = self._clauses(query, 1.0, counts)
        if any(isinstance(node, sp.All) for _, node in query.clauses):
            whole = self.spark.read.parquet(f"{self.path}/documents").select("id", F.col("length").alias("size"))
            per_document = whole.join(per_document, "id", "left").select("id", F.coalesce("t", F.create_map().cast("map<string,array<int>>")).alias("t"), F.coalesce("length", "size").alias("length"))
        return per_document.filter(hit).select("id", score.alias("score"))

    def _bm25(self, times: Column, holders: int) -> Column:
        idf = math.log(1 + (self.documents - holders + 0.5) / (holders + 0.5))
        return F.lit(idf) * times * (K1 + 1) / (times + K1 * (1 - B + B * F.col("length") / F.lit(float(self.mean))))

    def _leaf(self, node, factor: float, counts: dict[str, int]) -> tuple[Column, Column]:
        """(matches, score) of one word, phrase or pattern over the map t of term to places."""
        if isinstance(node, sp.Term) and (node.wildcard or node.fuzzy is not None):
            if node.wildcard:
                regex = f"^(?:{sp.wildcard_regex(node.text.lower())})$"
                kept = F.map_filter("t", lambda k, _: k.rlike(regex))
            else:
                kept = F.map_filter("t", lambda k, _: F.levenshtein(k, F.lit(node.text.lower()), node.fuzzy) >= 0)
            times = F.aggregate(F.map_values(kept), F.lit(0), lambda n, p: n + F.size(p))
            return times > 0, factor * self._bm25(times, 0)
        words = _words(node.text)
        if not words:
            return F.lit(False), F.lit(0.0)
        places = lambda w: F.coalesce(F.try_element_at(F.col("t"), F.lit(w)), F.array().cast("array<int>"))
        if len(words) == 1:
            times = F.size(places(words[0]))
        elif getattr(node, "slop", 0):
            away = lambda w, goal: F.coalesce(F.array_min(F.transform(places(w), lambda q: F.abs(q - goal))), F.lit(1 << 20))
            times = F.size(F.filter(places(words[0]), lambda p: sum((away(w, p + n) for n, w in enumerate(words[1:], 1)), F.lit(0)) <= node.slop))
        else:
            def follows(p: Column) -> Column:
                out = F.lit(True)
                for n, w in enumerate(words[1:], 1):
                    out = out & F.array_contains(places(w), (p + n).cast("int"))
                return out

            times = F.size(F.filter(places(words[0]), follows))
        return times > 0, factor * self._bm25(times, min(counts.get(w, 0) for w in words))

    def _clauses(self, query: sp.Query, factor: float, counts: dict[str, int]) -> tuple[Column, Column]:
        must, should, score, excluded = F.lit(True), None, F.lit(0.0), F.lit(False)
        required = False
        for occur, node in query.clauses:
            if isinstance(node, sp.Query):
                hit, points = self._clauses(node, factor * node.boost, counts)
            elif isinstance(node, sp.All):
                hit, points = F.lit(True), F.lit(factor * node.boost)
            else:
                hit, points = self._leaf(node, factor * node.boost, counts)
            if occur == sp.MUST_NOT:
                excluded = excluded | hit
                continue
            score = score + F.when(hit, points).otherwise(0.0)
            if occur == sp.MUST:
                must, required = must & hit, True
            else:
                should = hit if should is None else should | hit
        some = must if required else (should if should is not None else F.lit(False))
        return some & ~excluded, score


def _all_leaves(query: sp.Query) -> Iterable[object]:
    for _, node in query.clauses:
        if isinstance(node, sp.Query):
            yield from _all_leaves(node)
        elif not isinstance(node, sp.All):
            yield node


def _matching(patterns: set[str]) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | F.col("term").rlike(f"^(?:{p})$")
    return out


def scored_fields(records: DataFrame, query: str, schema: Schema) -> DataFrame:
    """The records that match, with a score of boosts alone: the sum over the clauses that match of their boosts. For
    queries over fields, which have no words to weigh."""
    parsed = check_query(query)
    points = F.lit(0.0)
    for node, factor in leaves(parsed):
        points = points + F.when(predicate(sp.Query(((sp.SHOULD, node),)), schema, top=False), F.lit(factor)).otherwise(0.0)
    return records.filter(predicate(parsed, schema)).withColumn("score", points)


def within_distance(records: DataFrame, point: Column, lat: float, lon: float, km: float) -> DataFrame:
    """Records whose point (struct lat, lon) lies within so many km, with the distance, the nearest first to be sorted by.

    A box of degrees spares most rows the distance; it wraps around at the date line and is all the way round at a pole.
    Null points are nowhere.
    """
    from millrace.functions.values import distance_km

    up = math.degrees(km / 6371.0087714)
    box = point["lat"].between(lat - up, lat + up)
    if abs(lat) + up < 90:
        side = math.degrees(math.asin(min(1.0, math.sin(math.radians(min(up, 90))) / math.cos(math.radians(lat)))))
        off = F.abs(F.pmod(point["lon"] - F.lit(lon) + 180, F.lit(360.0)) - 180)
        box = box & (off <= side + 1e-9)
    away = distance_km(F.lit(lat), F.lit(lon), point["lat"], point["lon"])
    return records.filter(box).withColumn("distance_km", away).filter(F.col("distance_km") <= km)


# Synonyms and pinned results, as their usual files have them.


def read_synonyms(lines: Iterable[str]) -> dict[str, list[str]]:
    """Word to what else it is taken for: `a, b, c` are one another's, of `a, b => c, d` a and b stand for c and d (and
    for themselves only if they are among these). `#` begins a comment."""
    out: dict[str, list[str]] = {}
    for line in lines:
        left, arrow, right = line.partition("#")[0].strip().partition("=>")
        words = [w.strip().lower() for w in left.split(",") if w.strip()]
        others = [w.strip().lower() for w in right.split(",") if w.strip()] if arrow else words
        for word in words:
            known = out.setdefault(word, [])
            known += [o for o in others if o != word and o not in known]
    return out


def read_elevation(xml: str) -> dict[str, tuple[list[str], list[str]]]:
    """Query text (in lower case) to the ids that come first and those that don't come at all."""
    from xml.etree import ElementTree

    out = {}
    for query in ElementTree.fromstring(xml).iter("query"):
        docs = list(query.iter("doc"))
        gone = [d.get("id") for d in docs if d.get("exclude") == "true"]
        out[query.get("text", "").strip().lower()] = ([d.get("id") for d in docs if d.get("id") not in gone], gone)
    return out

"""Names matched to the most similar known one, and spelling correction, as joins on n-grams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.analyzers import char_ngrams


def _squeezed(name: Column) -> Column:
    return F.regexp_replace(F.lower(name), r"\s+", "")


def ngram_index(names: DataFrame, low: int = 2, high: int = 3) -> DataFrame:
    """gram, name, output, times, postings: each gram of each alias, how often it holds it, and how many places of all
    aliases do. names has name (the alias) and output (what it stands for)."""
    grams = names.select("name", "output", F.explode(char_ngrams(_squeezed(F.col("name")), low, high)).alias("gram"))
    held = grams.groupBy("gram", "name", "output").agg(F.count("*").alias("times"))
    return held.join(held.groupBy("gram").agg(F.sum("times").alias("postings")), "gram")


def best_match(queries: DataFrame, names: DataFrame, low: int = 2, high: int = 3) -> DataFrame:
    """query, output, score: the known name that scores best for each query; queries that share no gram give no row.

    A gram of n letters adds n over its number of postings, for each of its places in the query and each in the alias;
    all over the edit distance (1 at least) between the squeezed query and what the alias stands for. Scores are summed
    by what aliases stand for; the better of equals is the lesser.
    """
    wanted = queries.select("query").filter("query is not null").distinct()
    own = wanted.select("query", F.explode(char_ngrams(_squeezed(F.col("query")), low, high)).alias("gram")).groupBy("query", "gram").agg(F.count("*").alias("asked"))
    shared = own.join(ngram_index(names, low, high), "gram").groupBy("query", "output").agg(F.sum(F.col("asked") * F.col("times") * F.length("gram") / F.col("postings")).alias("weight"))
    distance = F.greatest(F.lit(1), F.levenshtein(_squeezed(F.col("query")), _squeezed(F.col("output"))))
    scored = shared.withColumn("score", F.round(F.col("weight") / distance, 9))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "output"))
    return scored.withColumn("rank", rank).filter("rank = 1").select("query", "output", "score")


def vocabulary(texts: DataFrame, words: Column) -> DataFrame:
    """word, n over all texts."""
    return texts.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def _shorter(word: Column) -> Column:
    """What is left of a word without one letter."""
    size = F.length(word)
    return F.transform(F.sequence(F.lit(1), F.greatest(size, F.lit(1))), lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, size)))


def _deletions(word: Column, letters: int = 1) -> Column:
    """The word and what is left of it without so many letters or fewer."""
    out = F.array(word)
    for _ in range(letters):
        out = F.array_distinct(F.concat(out, F.flatten(F.transform(out, _shorter))))
    return out


def _swaps(word: Column) -> Column:
    """The word with two letters next to each other swapped, in each place."""
    size = F.length(word)
    swapped = F.transform(
        F.sequence(F.lit(1), F.greatest(size - 1, F.lit(1))), lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.lit(1)), F.substring(word, i, F.lit(1)), F.substring(word, i + 2, size))
    )
    return F.when(size > 1, swapped).otherwise(F.array().cast("array<string>"))


def spelling(words: DataFrame, known: DataFrame) -> DataFrame:
    """word, correction: the most frequent known word within one edit (a letter more, less, changed, or two neighbours
    swapped), else within two, the lesser of equals; null for words that are known themselves or have none.

    Candidates meet under what both become without one letter, or two, so no word is compared with all others.
    """
    asked = words.select("word").filter("word is not null").distinct()
    word, candidate = F.col("word"), F.col("candidate")
    within_one = (F.levenshtein(word, candidate) <= 1) | F.array_contains(_swaps(word), candidate)
    # Two edits, either of which may be a swap; a swap made undoes itself, so the last one is looked at from the other end.
    within_two = (
        (F.levenshtein(word, candidate) <= 2)
        | F.exists(_swaps(word), lambda w: F.levenshtein(w, candidate) <= 1)
        | F.exists(_swaps(candidate), lambda c: F.levenshtein(word, c) <= 1)
        | F.arrays_overlap(_swaps(word), _swaps(candidate))
    )

    def best(asked: DataFrame, letters: int, near: Column) -> DataFrame:
        mine = asked.select("word", F.explode(_deletions(word, letters)).alias("key"))
        theirs = known.select(F.col("word").alias("candidate"), "n", F.explode(_deletions(word, letters)).alias("key"))
        met = mine.join(theirs, "key").select("word", "candidate", "n").distinct().filter(near)
        rank = F.row_number().over(Window.partitionBy("word").orderBy((candidate == word).desc(), F.desc("n"), "candidate"))
        return met.withColumn("rank", rank).filter("rank = 1").select("word", F.when(candidate != word, candidate).alias("correction"))

    first = best(asked, 1, within_one)
    second = best(asked.join(first, "word", "left_anti"), 2, within_two)
    return asked.join(first.unionByName(second), "word", "left")

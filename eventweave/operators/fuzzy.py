"""Candidates for misspelt names (A10, A17, A18): a q-gram index with length and count filter.

Two strings within ``k`` edits share all but ``k * q`` of their padded q-grams.  So, with the grams in one global order,
rarest first, they share one of their first ``k * q + 1``: these are the index, and an equi-join on
(place, gram) finds every pair that can be close.  Rare grams keep the join small, a gram that half of the names
hold is seldom among a string's rarest.  Pairs then pass the length filter, the count filter (shared grams) and an edit
distance that stops at ``k``.  Strings too short to be bound to share a gram carry one common entry
instead, joined by strings of their length and ``k`` more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import is_blank

PAD = "\u0001"
SHORT = "\u0002"


def q_grams(text: Column, q: int) -> Column:
    """All padded q-grams of ``text``, each with the number of its occurrence, so that repeats count."""
    padded = F.concat(F.lit(PAD * (q - 1)), text, F.lit(PAD * (q - 1)))
    grams = F.transform(F.sequence(F.lit(1), F.length(text) + q - 1), lambda i: F.substr(padded, i, F.lit(q)))
    number = lambda g, i: F.size(F.filter(F.slice(grams, F.lit(1), i + 1), lambda x: x == g))
    return F.transform(grams, lambda g, i: F.concat(g, number(g, i).cast("string")))


def _index(strings: DataFrame, rank: DataFrame, places: list[str], k: int, q: int) -> DataFrame:
    """(places, text, grams, gram): the rarest grams of each string, and the common entry of short ones."""
    each = strings.select(*places, "text", F.explode("grams").alias("gram")).join(rank, "gram", "left")
    rarest = F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")))  # a string's own grams
    picked = each.groupBy(*places, "text").agg(F.slice(rarest, 1, k * q + 1).alias("rarest"))
    short = F.when(F.length("text") <= (k - 1) * q + 1 + k, F.array(F.lit(SHORT))).otherwise(F.array().cast("array<string>"))
    entries = F.concat(F.transform("rarest", lambda x: x["gram"]), short)
    return picked.select(*places, "text", F.explode(entries).alias("gram"))


def candidates(
    rows: DataFrame, names: DataFrame, places: list[str], text: str, name: str, k: int = 2, q: int = 2, top: int | None = None
) -> DataFrame:
    """Names of the same place within ``k`` edits of a text, ranked: places, text, name, distance, rank.

    ``rows`` and ``names`` share the columns ``places``; blanks and rows without a place are left out, repeats count once.
    Rank 1 is the nearest, ties in order of the name; ``top`` keeps the first ranks only.  No pair within
    ``k`` edits is missed, whatever its length."""
    if k < 1 or q < 2:
        raise ValueError("k must be at least 1, q at least 2")

    def strings(df: DataFrame, col: str) -> DataFrame:
        placed = df.filter(~is_blank(col)).dropna(subset=places).select(*places, F.col(col).alias("text")).distinct()
        return placed.withColumn("grams", q_grams(F.col("text"), q))

    left, right = strings(rows, text), strings(names, name)
    rank = right.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    a = _index(left, rank, places, k, q)
    b = _index(right, rank, places, k, q).withColumnRenamed("text", "name")
    pairs = a.join(b, [*places, "gram"])
    close = F.abs(F.length("text") - F.length("name")) <= k
    pairs = pairs.filter(close).select(*places, "text", "name").distinct()
    counted = pairs.withColumn("a", q_grams(F.col("text"), q)).withColumn("b", q_grams(F.col("name"), q))
    shared = F.size(F.array_intersect("a", "b")) >= F.greatest(F.size("a"), F.size("b")) - k * q
    found = counted.filter(shared).withColumn("distance", F.levenshtein("text", "name", k)).filter("distance >= 0")
    # a text has few names within k edits: this window holds those alone
    nearest = Window.partitionBy(*places, "text").orderBy("distance", "name")
    out = found.withColumn("rank", F.row_number().over(nearest))
    if top is not None:
        out = out.filter(F.col("rank") <= top)
    return out.select(*places, F.col("text").alias(text), F.col("name").alias(name), "distance", "rank")


def mend(rows: DataFrame, found: DataFrame, places: list[str], text: str, name: str, out: str = "mended") -> DataFrame:
    """``rows`` with ``out``: the candidate of rank 1 where it is alone at its distance, else NULL.  Two equally near
    names are a question for a person, as are texts without a candidate."""
    best = found.groupBy(*places, text).agg(F.min(F.struct("distance", F.col(name))).alias("b"), F.collect_list("distance").alias("d"))
    alone = F.size(F.filter("d", lambda x: x == F.col("b.distance"))) == 1
    sure = best.filter(alone).select(*places, text, F.col(f"b.{name}").alias(out))
    return rows.join(sure, [*places, text], "left")

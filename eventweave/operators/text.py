"""Text rules and location parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import regex_trim
from ..functions.rules import Rule, apply_rules
from .ordered import join_null_safe


def rewrite(df: DataFrame, col: str, rules: list[Rule], out: str | None = None, distinct_first: bool = False) -> DataFrame:
    """A10: ordered regex rewrite, each rule on the previous output.

    ``distinct_first`` folds the rules over the distinct values of ``col`` and
    joins the result back: for a column with few distinct values (state names,
    hazard labels) the regex work then scales with the values, not the rows.
    """
    out = out or col
    if not distinct_first:
        return df.withColumn(out, apply_rules(F.col(col), rules))
    mapping = df.select(col).distinct().select(F.col(col), apply_rules(F.col(col), rules).alias("__rewritten"))
    res = join_null_safe(df, mapping, [col], "left")
    return res.withColumn(out, F.col("__rewritten")).drop("__rewritten")


def token_rules(
    words: list[str],
    plurals: dict[str, str] | None = None,
    whole_word: bool = True,
    and_to_comma: bool = True,
) -> list[Rule]:
    """Rules for A11: fold plurals, remove ``words``, ``and`` -> comma, tidy spaces.

    ``whole_word=False`` removes the words anywhere (inside ``eastland`` too),
    which is what a plain substring removal does."""
    rules: list[Rule] = []
    for plural, singular in (plurals or {}).items():
        rules.append(Rule(plural, singular, literal=True, whole_word=whole_word))
    if words:
        alt = "|".join(sorted(words, key=len, reverse=True))
        rules.append(Rule(f"(?:{alt})", "", whole_word=whole_word))
    if and_to_comma:
        rules.append(Rule(" and ", ", ", literal=True))
    rules.append(Rule(r"\s{2,}", " "))
    rules.append(Rule(r"\s+,", ","))
    rules.append(Rule(r"^\s+|\s+$", ""))
    return rules


def strip_tokens(
    df: DataFrame,
    col: str,
    words: list[str],
    plurals: dict[str, str] | None = None,
    whole_word: bool = True,
    out: str | None = None,
) -> DataFrame:
    """Remove directional / administrative words from a text column."""
    return df.withColumn(out or col, apply_rules(F.col(col), token_rules(words, plurals, whole_word)))


PATCH_SCHEMA = "key STRING, seq INT, column STRING, op STRING, pattern STRING, value STRING, when_match STRING"


def apply_patches(df: DataFrame, key: str, patches: DataFrame, column: str, literal_values: bool = True) -> DataFrame:
    """Keyed override patches applied in ``seq`` order; the last ``set`` wins.

    ``patches``: key, seq, column, op (``set``, ``replace_first``,
    ``replace_all``), pattern, value, when_match (optional regex the current
    value must match for the patch to apply).  Patches for one key are gathered
    into one ordered array — patch lists are curated, a handful per key — and
    folded with ``aggregate`` after a left join, so unpatched rows pass through.
    """
    p = patches.filter(F.col("column") == column)
    value = F.col("value")
    if literal_values:
        value = F.regexp_replace(value, r"([\\$])", r"\\$1")
    p = p.select(
        F.col("key").alias("__pkey"),
        F.struct(
            F.col("seq").alias("seq"),
            F.col("op").alias("op"),
            F.col("pattern").alias("pattern"),
            F.col("value").alias("value"),
            value.alias("repl"),
            F.col("when_match").alias("when_match"),
        ).alias("__p"),
    )
    grouped = p.groupBy("__pkey").agg(F.array_sort(F.collect_list("__p")).alias("__patches"))
    j = df.join(grouped, df[key].cast("string") == grouped["__pkey"], "left")

    def step(acc, q):
        applies = q["when_match"].isNull() | F.regexp_like(acc, q["when_match"])
        first = F.regexp_replace(acc, F.concat(F.lit("(?s)^(.*?)(?:"), q["pattern"], F.lit(")")), F.concat(F.lit("$1"), q["repl"]))
        changed = (
            F.when(q["op"] == "set", q["value"])
            .when(q["op"] == "replace_first", first)
            .when(q["op"] == "replace_all", F.regexp_replace(acc, q["pattern"], q["repl"]))
            .otherwise(acc)
        )
        return F.when(applies, changed).otherwise(acc)

    patched = F.when(
        F.col("__patches").isNull(), F.col(column)
    ).otherwise(F.aggregate("__patches", F.col(column).cast("string"), step))
    return j.withColumn(column, patched).drop("__pkey", "__patches")


def apply_date_patches(df: DataFrame, key: str, patches: DataFrame, begin: str = "begin_date", end: str = "end_date") -> DataFrame:
    """Replace span dates for listed events (``key, begin_date, end_date``;
    a NULL in the patch keeps the current value).  A key listed twice uses its
    smallest (begin, end) patch, so the result never depends on row order."""
    p = patches.groupBy(F.col("key").alias("__pkey")).agg(
        F.min(F.struct(F.col("begin_date").alias("b"), F.col("end_date").alias("e"))).alias("__p")
    )
    p = p.select("__pkey", F.col("__p.b").alias("__pb"), F.col("__p.e").alias("__pe"))
    j = df.join(p, df[key].cast("string") == p["__pkey"], "left")
    return (
        j.withColumn(begin, F.coalesce("__pb", begin))
        .withColumn(end, F.coalesce("__pe", end))
        .drop("__pkey", "__pb", "__pe")
    )


LOWER = r"\p{Ll}"  # ICU [:lower:]; a Java bracket [:lower:] would mean the letters ':lower'


def flag_unparsed(df: DataFrame, col: str, out: str = "inProgress") -> DataFrame:
    """Rows whose text still holds lower-case letters need more work."""
    return df.withColumn(out, F.coalesce(F.col(col).rlike(LOWER), F.lit(False)))


CODE = r"\b([A-Z]{2})\b"  # a state code: two capitals standing alone


def parse_locations(df: DataFrame, key: str, col: str = "Location") -> DataFrame:
    """Multi-level explode of free-text locations.

    ``"harris [houston], dallas [plano] (TX), dade, broward (FL)"`` ->
    1. pieces split at ``),`` / ``);`` (position kept);
    2. a piece without lower-case letters is a list of states: ``State`` is its text and there
       is no region.  Otherwise ``State`` = its two-capital codes joined by ``, `` and the text
       without them holds the regions;
    3. the regions are split at ``),``, ``],`` and ``]``; of each part the text before the first
       ``(`` or ``[`` names regions and the text up to the next one their county, so every
       part has its own county;
    4. the region names are split at ``,``.
    Blank regions and counties are NULL (a part that holds only the emptied code brackets
    stays as a state-only row).  NULL text yields one row of NULLs.  Output columns:
    key, piece_no, region_no, State, Region, County, inProgress.
    """
    pieces = df.select(F.col(key), F.posexplode_outer(F.split(F.col(col), r"\),|\);")).alias("piece_no", "piece"))
    pieces = flag_unparsed(pieces, "piece")
    codes = F.array_join(F.regexp_extract_all(F.col("piece"), F.lit(CODE), 1), ", ")
    pieces = pieces.withColumn("State", F.when(F.col("inProgress"), codes).otherwise(regex_trim("piece")))
    text = F.when(F.col("inProgress"), F.regexp_replace("piece", CODE, ""))
    blank = lambda c: F.nullif(regex_trim(c), F.lit(""))

    def names(part):
        county = blank(F.regexp_replace(F.regexp_extract(part, r"^[^(\[]*[(\[]([^(\[]*)", 1), r"[),]", ""))
        return F.transform(F.split(F.regexp_extract(part, r"^([^(\[]*)", 1), ","), lambda r: F.struct(blank(r).alias("Region"), county.alias("County")))

    regions = F.flatten(F.transform(F.split(text, r"\),|\],|\]"), names))
    out = pieces.select(key, "piece_no", "State", "inProgress", F.posexplode_outer(regions).alias("region_no", "r"))
    return out.select(key, "piece_no", "region_no", "State", F.col("r.Region").alias("Region"), F.col("r.County").alias("County"), "inProgress")


def state_codes(df: DataFrame, state: str = "State") -> DataFrame:
    """One row for each state code of a piece (a piece without a code keeps one row, NULL)."""
    return df.withColumn(state, F.explode_outer(F.regexp_extract_all(F.col(state), F.lit(CODE), 1)))

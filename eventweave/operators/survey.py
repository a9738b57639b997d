"""Survey panel: site parsing, recodes, crosstabs and weighted tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import regex_trim
from ..session import materialize
from .ordered import join_null_safe, number_within


def parse_site(df: DataFrame, col: str = "sitename") -> DataFrame:
    """``City, State (XX)`` -> city, state, abb; city lower-cased without
    ``borough of `` and `` county``.  Missing parts become NULL."""
    city = F.get(F.split(F.col(col), ","), 0)
    rest = F.get(F.split(F.col(col), ","), 1)
    state = F.get(F.split(rest, r"\("), 0)
    abb = F.regexp_replace(F.get(F.split(rest, r"\("), 1), r"\)", "")
    clean_city = F.regexp_replace(F.regexp_replace(F.lower(city), "borough of ", ""), " county", "")
    return df.withColumn("city", clean_city).withColumn("state", regex_trim(state)).withColumn("abb", abb)


def recode_binary(df: DataFrame, cols: list[str], suffix: str = "_0") -> DataFrame:
    """Code each answer by its sorted level (1, 2, ...) and write ``2 - code``
    (yes=1/no=2 becomes 1/0).

    One pass stacks the distinct (column, level) rows of all columns; a level's code is
    its row number within its column (numbers in numeric order).  The written code
    table is then joined once per column, by level."""
    stacked = F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("level")) for c in cols])
    levels = df.select(F.explode(stacked).alias("s")).select("s.col", "s.level").filter("level is not null").distinct()
    levels = levels.withColumn("number", F.expr("try_cast(level AS DOUBLE)"))
    codes = materialize(number_within(levels, ["col"], ["number asc nulls last", "level"], "code"), "level_codes")
    out = df
    for c in cols:
        mine = codes.filter(F.col("col") == c).select(F.col("level").alias("__level"), F.col("code").alias("__code"))
        out = out.join(mine, F.col(c).cast("string") == F.col("__level"), "left")
        out = out.withColumn(c + suffix, (F.lit(2) - F.col("__code")).cast("int")).drop("__level", "__code")
    return out


def crosstab_pct(df: DataFrame, row: str, col: str, levels: list[str], digits: int = 2) -> DataFrame:
    """Row-percent crosstab whose cells read ``45.00% (9)``; a missing
    answer is its own ``NA`` column, as in a tabulation with NA kept, and answers
    outside ``levels`` share the column ``other``, so a row's cells add up to 100 %."""
    answer = F.coalesce(F.col(col).cast("string"), F.lit("NA"))
    t = df.withColumn("__col", F.when(answer.isin(*levels), answer).otherwise("other"))
    levels = [*levels, "other"]
    counts = t.groupBy(row, "__col").agg(F.count(F.lit(1)).alias("__n"))
    totals = counts.groupBy(row).agg(F.sum("__n").alias("__tot"))
    cells = counts.join(totals, on=row, how="inner").withColumn(
        "__cell",
        F.format_string(
            f"%.{digits}f%% (%d)", F.round(F.col("__n") * 100.0 / F.col("__tot"), digits), F.col("__n")
        ),
    )
    wide = cells.groupBy(row).pivot("__col", levels).agg(F.first("__cell"))
    return wide.na.fill({c: f"{0:.{digits}f}% (0)" for c in levels})


def psu_per_stratum(df: DataFrame, stratum: str = "stratum", psu: str = "PSU") -> DataFrame:
    """Number of distinct PSUs per stratum (PSU ids nested in strata)."""
    return df.select(stratum, psu).distinct().groupBy(stratum).agg(F.count(F.lit(1)).cast("long").alias("n_psu"))


def weighted_table(df: DataFrame, cols: list[str], weight: str = "weight") -> DataFrame:
    """Weighted one- or two-way table (point totals)."""
    return df.groupBy(*cols).agg(F.sum(weight).alias("weighted_n"), F.count(F.lit(1)).cast("long").alias("n"))


def map_district(df: DataFrame, mapping: DataFrame, district: str = "district") -> DataFrame:
    """District -> county through a small mapping table, columns reordered
    with the mapped county first."""
    j = df.join(mapping, on=district, how="left")
    rest = [c for c in j.columns if c not in ("state", "county", district)]
    return j.select("state", "county", district, *rest)


def select_typed(df: DataFrame, spec: list[tuple[str, str, str]]) -> DataFrame:
    """Pick, rename and cast: ``spec`` = [(source expr, name, type)]."""
    return df.select(*[F.expr(src).cast(typ).alias(name) for src, name, typ in spec])


def design_estimates(
    df: DataFrame, by: list[str], y: str, weight: str = "weight", stratum: str = "stratum", psu: str = "PSU"
) -> DataFrame:
    """Weighted mean and total of ``y`` per domain ``by`` with design-based standard errors: by..., n, total,
    se_total, mean, se_mean.

    Linearised (Taylor) variance of a stratified sample of PSUs (ids nested in strata, drawn with replacement): with
    u the PSU totals of the linearised values, sum over strata of n/(n-1) times the squared distances from
    the stratum's mean.  All PSUs of the design count, also those without rows of the domain.  The only
    PSU of a stratum is measured from the mean over all PSUs (the ``adjust`` rule).  Rows without
    stratum, PSU or weight are no part of the design; rows without ``y`` are, but not of the estimates.

    One aggregation to (domain, PSU) combines before its shuffle; all that follows has a row per PSU or stratum."""
    design = df.filter(F.col(stratum).isNotNull() & F.col(psu).isNotNull() & F.col(weight).isNotNull())
    sizes = design.select(stratum, psu).distinct().groupBy(stratum).agg(F.count(F.lit(1)).alias("__n_h"))
    whole = sizes.agg(F.sum("__n_h").alias("__m"), F.count_if(F.col("__n_h") == 1).alias("__lonely"))  # one row
    w, value = F.col(weight).cast("double"), F.col(y).cast("double")
    per_psu = design.filter(F.col(y).isNotNull()).groupBy(*by, stratum, psu).agg(
        F.sum(w).alias("__w"), F.sum(w * value).alias("__wy"), F.count(F.lit(1)).alias("__rows")
    )
    per_psu = materialize(per_psu, "psu_totals")
    domains = per_psu.groupBy(*by).agg(F.sum("__w").alias("__all_w"), F.sum("__wy").alias("__all_wy"), F.sum("__rows").cast("long").alias("n"))
    u = join_null_safe(per_psu, domains, by) if by else per_psu.crossJoin(domains)  # one row a domain
    u = u.withColumn("__um", (F.col("__wy") - F.col("__all_wy") / F.col("__all_w") * F.col("__w")) / F.col("__all_w")).withColumn("__ut", F.col("__wy"))
    parts = [a for k in ("m", "t") for a in (F.sum(f"__u{k}").alias(f"__s{k}"), F.sum(F.col(f"__u{k}") ** 2).alias(f"__q{k}"))]
    strata = u.groupBy(*by, stratum).agg(*parts).join(sizes, stratum).crossJoin(whole)
    lonely = F.col("__n_h") == 1
    sums = []
    for k in ("m", "t"):
        s, q, n = F.col(f"__s{k}"), F.col(f"__q{k}"), F.col("__n_h")
        sums += [
            F.sum(F.when(~lonely, n / (n - 1) * (q - s * s / n))).alias(f"__v{k}"),
            F.sum(s).alias(f"__all{k}"),
            F.sum(F.when(lonely, s)).alias(f"__l{k}"),
            F.sum(F.when(lonely, q)).alias(f"__lq{k}"),
        ]
    got = strata.groupBy(*by).agg(*sums, F.max("__m").alias("__m"), F.max("__lonely").alias("__lonely"))
    none = F.lit(0.0)

    def variance(k: str) -> Column:
        # the squared distances of all lonely PSUs from the mean over PSUs; those without rows of the domain are at 0
        mean = F.col(f"__all{k}") / F.col("__m")
        far = F.coalesce(f"__lq{k}", none) - 2 * mean * F.coalesce(f"__l{k}", none) + F.col("__lonely") * mean * mean
        return F.sqrt(F.greatest(F.coalesce(f"__v{k}", none) + far, none))

    got = got.select(*by, variance("t").alias("se_total"), variance("m").alias("se_mean"))
    out = join_null_safe(domains, got, by) if by else domains.crossJoin(got)
    return out.select(*by, "n", F.col("__all_wy").alias("total"), "se_total", (F.col("__all_wy") / F.col("__all_w")).alias("mean"), "se_mean")

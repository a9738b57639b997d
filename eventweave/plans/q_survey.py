"""Survey-panel statistics (A56-A62) on documents joined to labels.

Mapping: one document = one respondent; site name composed from source and
language; stratum = lang, PSU = source, weight = n_chars / 100, year from the
id, answers q26 = quality + 1 and q27 = toxic + 1 (1 = yes, 2 = no; NULL when
the document is unlabeled)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import survey as sv
from .base import register, tbl, with_ctes

PANEL_SQL = """panel AS (
  SELECT d.doc_id AS record,
         'Borough of ' || d.source || ' County, State ' || upper(d.lang) || ' (' || upper(d.lang) || ')' AS sitename,
         2000 + d.doc_id % 4 AS year, cast(d.n_chars AS DOUBLE) / 100.0 AS weight, d.lang AS stratum, d.source AS PSU,
         12 + d.doc_id % 7 AS age, 1 + d.doc_id % 2 AS sex, l.quality + 1 AS q26, l.toxic + 1 AS q27
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

# District -> (state, county) map, built by rule for the 20 sources.
DISTRICTS = [(f"src{i}", f"S{i % 5}", f"county{i % 7}") for i in range(20)]


def panel(spark, sf):
    d = tbl(spark, sf, "documents").select("doc_id", "source", "lang", "n_chars")
    lab = tbl(spark, sf, "labels").select("doc_id", "quality", "toxic")
    j = d.join(lab, on="doc_id", how="left")
    return j.select(
        F.col("doc_id").alias("record"),
        F.expr("'Borough of ' || source || ' County, State ' || upper(lang) || ' (' || upper(lang) || ')'").alias("sitename"),
        F.expr("2000 + doc_id % 4").alias("year"),
        (F.col("n_chars") / 100.0).alias("weight"),
        F.col("lang").alias("stratum"),
        F.col("source").alias("PSU"),
        F.expr("12 + doc_id % 7").alias("age"),
        F.expr("1 + doc_id % 2").alias("sex"),
        (F.col("quality") + 1).alias("q26"),
        (F.col("toxic") + 1).alias("q27"),
    )


@register(
    "parse_site",
    with_ctes(
        [],
        """SELECT record,
       replace(replace(lower(split_part(sitename, ',', 1)), 'borough of ', ''), ' county', '') AS city,
       regexp_replace(split_part(split_part(sitename, ',', 2), '(', 1), '^\\s+|\\s+$', '', 'g') AS state,
       replace(split_part(split_part(sitename, ',', 2), '(', 2), ')', '') AS abb
FROM panel""",
        [PANEL_SQL],
    ),
    "A56",
)
def q_parse_site(spark, sf):
    return sv.parse_site(panel(spark, sf)).select("record", "city", "state", "abb")


@register(
    "recode_binary",
    with_ctes(
        [],
        """SELECT p.record, cast(p.q26 AS DOUBLE) AS q26, cast(p.q27 AS DOUBLE) AS q27,
       cast(2 - a.code AS DOUBLE) AS q26_0, cast(2 - b.code AS DOUBLE) AS q27_0
FROM panel p
LEFT JOIN (SELECT q26, dense_rank() OVER (ORDER BY q26) AS code FROM (SELECT DISTINCT q26 FROM panel WHERE q26 IS NOT NULL) x) a ON p.q26 = a.q26
LEFT JOIN (SELECT q27, dense_rank() OVER (ORDER BY q27) AS code FROM (SELECT DISTINCT q27 FROM panel WHERE q27 IS NOT NULL) y) b ON p.q27 = b.q27""",
        [PANEL_SQL],
    ),
    "A57",
)
def q_recode_binary(spark, sf):
    out = sv.recode_binary(panel(spark, sf), ["q26", "q27"])
    return out.select("record", *[F.col(c).cast("double").alias(c) for c in ("q26", "q27", "q26_0", "q27_0")])


LEVELS = ["1", "2", "NA"]


@register(
    "crosstab_pct",
    with_ctes(
        [],
        "SELECT year, "
        + ", ".join(
            f"""coalesce(max(CASE WHEN a = '{lv}' THEN printf('%.2f%% (%d)', round(n * 100.0 / tot, 2), n) END), '0.00% (0)') AS "{lv}\""""
            for lv in [*LEVELS, "other"]
        )
        + f"""
FROM (SELECT year, a, n, sum(n) OVER (PARTITION BY year) AS tot
      FROM (SELECT year, CASE WHEN coalesce(cast(q26 AS VARCHAR), 'NA') IN ({", ".join(f"'{lv}'" for lv in LEVELS)})
                              THEN coalesce(cast(q26 AS VARCHAR), 'NA') ELSE 'other' END AS a, count(*) AS n FROM panel GROUP BY 1, 2) c) t
GROUP BY year""",
        [PANEL_SQL],
    ),
    "A58",
)
def q_crosstab_pct(spark, sf):
    return sv.crosstab_pct(panel(spark, sf), "year", "q26", LEVELS)


@register(
    "psu_per_stratum",
    with_ctes([], "SELECT stratum, count(DISTINCT PSU) AS n_psu FROM panel GROUP BY stratum", [PANEL_SQL]),
    "A59",
)
def q_psu_per_stratum(spark, sf):
    return sv.psu_per_stratum(panel(spark, sf))


@register(
    "weighted_table",
    with_ctes(
        [], "SELECT year, cast(q26 AS DOUBLE) AS q26, round(sum(weight), 6) AS weighted_n, count(*) AS n FROM panel GROUP BY year, q26", [PANEL_SQL]
    ),
    "A60",
)
def q_weighted_table(spark, sf):
    out = sv.weighted_table(panel(spark, sf), ["year", "q26"]).withColumn("weighted_n", F.round("weighted_n", 6))
    return out.withColumn("q26", F.col("q26").cast("double"))


_DISTRICT_VALUES = ", ".join(f"('{d}', '{s}', '{c}')" for d, s, c in DISTRICTS)


@register(
    "map_district",
    with_ctes(
        [],
        f"""SELECT m.state, m.county, p.PSU AS district, p.record, p.year
FROM (SELECT PSU, record, year FROM panel) p
LEFT JOIN (VALUES {_DISTRICT_VALUES}) m(district, state, county) ON p.PSU = m.district""",
        [PANEL_SQL],
    ),
    "A61",
)
def q_map_district(spark, sf):
    mapping = spark.createDataFrame(DISTRICTS, "district STRING, state STRING, county STRING")
    p = panel(spark, sf).select(F.col("PSU").alias("district"), "record", "year")
    return sv.map_district(p, F.broadcast(mapping))


SPEC = [
    ("record", "record", "string"),
    ("year", "year", "int"),
    ("2 - sex", "is_female", "string"),
    ("weight", "weight", "double"),
    ("q26", "q26", "double"),
]


@register(
    "select_typed",
    with_ctes(
        [],
        "SELECT cast(record AS VARCHAR) AS record, year, cast(2 - sex AS VARCHAR) AS is_female, weight, cast(q26 AS DOUBLE) AS q26 FROM panel",
        [PANEL_SQL],
    ),
    "A62",
)
def q_select_typed(spark, sf):
    return sv.select_typed(panel(spark, sf), SPEC)


@register(
    "design_errors",
    with_ctes(
        [],
        """SELECT g.year, g.n, round(all_wy, 6) AS total, round(sqrt(vt + far_t), 6) AS se_total, round(all_wy / all_w, 9) AS mean, round(sqrt(vm + far_m), 9) AS se_mean
FROM g JOIN (
  SELECT year, sum(CASE WHEN n_h > 1 THEN n_h / (n_h - 1.0) * (qt - st * st / n_h) ELSE 0 END) AS vt,
         sum(CASE WHEN n_h > 1 THEN n_h / (n_h - 1.0) * (qm - sm * sm / n_h) ELSE 0 END) AS vm,
         sum(CASE WHEN n_h = 1 THEN (st - mt) * (st - mt) ELSE 0 END) AS far_t, sum(CASE WHEN n_h = 1 THEN (sm - mm) * (sm - mm) ELSE 0 END) AS far_m
  FROM (SELECT *, sum(st) OVER (PARTITION BY year) / sum(n_h) OVER (PARTITION BY year) AS mt,
               sum(sm) OVER (PARTITION BY year) / sum(n_h) OVER (PARTITION BY year) AS mm
        FROM (SELECT year, stratum, count(*) AS n_h, sum(ut) AS st, sum(ut * ut) AS qt, sum(um) AS sm, sum(um * um) AS qm
              FROM u GROUP BY year, stratum) a) b
  GROUP BY year) v ON g.year = v.year""",
        [
            PANEL_SQL,
            "p AS (SELECT year, CASE WHEN year = 2003 AND stratum = 'de' THEN 'de2003' ELSE stratum END AS stratum, "
            "CASE WHEN stratum = 'fr' THEN 'all of fr' ELSE PSU END AS PSU, weight, cast(q26 = 1 AS INTEGER) AS y FROM panel)",
            "g AS (SELECT year, count(*) AS n, sum(weight * y) AS all_wy, sum(weight) AS all_w FROM p WHERE y IS NOT NULL GROUP BY year)",
            # every PSU of the design for every domain, with zeros where it has no rows
            """u AS (
  SELECT g.year, d.stratum, coalesce(wy, 0) AS ut, coalesce((wy - all_wy / all_w * w) / all_w, 0) AS um
  FROM g CROSS JOIN (SELECT DISTINCT stratum, PSU FROM p WHERE stratum IS NOT NULL AND PSU IS NOT NULL AND weight IS NOT NULL) d
  LEFT JOIN (SELECT year, stratum, PSU, sum(weight) AS w, sum(weight * y) AS wy FROM p WHERE y IS NOT NULL GROUP BY year, stratum, PSU) x
    ON x.year = g.year AND x.stratum = d.stratum AND x.PSU = d.PSU)""",
        ],
    ),
    "A59,A60",
)
def q_design_errors(spark, sf):
    """Share of q26 = 1 by year; one stratum lies in one year alone, one has a single PSU."""
    p = panel(spark, sf).select(
        "year", "weight",
        F.expr("CASE WHEN year = 2003 AND stratum = 'de' THEN 'de2003' ELSE stratum END").alias("stratum"),
        F.expr("CASE WHEN stratum = 'fr' THEN 'all of fr' ELSE PSU END").alias("PSU"),
        F.expr("cast(q26 = 1 AS INT)").alias("y"),
    )
    out = sv.design_estimates(p, ["year"], "y")
    return out.select("year", "n", F.round("total", 6).alias("total"), F.round("se_total", 6).alias("se_total"), F.round("mean", 9).alias("mean"), F.round("se_mean", 9).alias("se_mean"))

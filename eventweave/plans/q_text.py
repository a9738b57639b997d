"""Text rules, patches and location parsing (A08, A10-A20) on the driver tables."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..functions.rules import Rule
from ..operators import fuzzy, geo
from ..operators import text as tx
from ..operators.cleaning import drop_listed
from .base import CTE, CTE_DEPS, register, states, tbl, with_ctes
from .q_spans import ship_spans

# Our own rule lists.
DOC_RULES = [
    Rule("$", " USD", literal=True),
    Rule(r"(^|\s)and(\s|$)", "$1&$2"),
    Rule("the", "thee"),
    Rule("theee", "thee"),  # repairs what the previous rule over-applied
    Rule(r"\s+\|\s+", " / "),
]
NAME_RULES = [
    Rule("^small ", "tiny "),
    Rule("^tiny (ring|rod)$", "tiny $1s"),
    Rule("old", "aged"),
]
STRIP_WORDS = ["small", "large", "hot", "cold"]
STRIP_PLURALS = {"parts": "part"}
UNBOUNDED_WORDS = ["old", "new"]


def duck_rules(col: str, rules: list[Rule]) -> str:
    """The same rule fold in DuckDB syntax (RE2; ``\\1`` group references)."""
    out = col
    for r in rules:
        pat = r.regex().replace("'", "''")
        if r.literal:
            rep = r.replacement.replace("\\", "\\\\")
        else:
            rep = re.sub(r"\$(\d)", r"\\\1", r.replacement)
        rep = rep.replace("'", "''")
        flag = "" if r.first_only else ", 'g'"
        out = f"regexp_replace({out}, '{pat}', '{rep}'{flag})"
    return out


@register(
    "rewrite_rules",
    f"SELECT doc_id, md5(t) AS text_md5, length(t) AS n_chars FROM (SELECT doc_id, {duck_rules('text', DOC_RULES)} AS t FROM documents) x",
    "A10",
)
def q_rewrite_rules(spark, sf):
    d = tx.rewrite(tbl(spark, sf, "documents").select("doc_id", "text"), "text", DOC_RULES)
    return d.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").alias("n_chars"))


@register(
    "rewrite_names",
    f"SELECT p_partkey, {duck_rules('p_name', NAME_RULES)} AS p_name FROM part",
    "A10",
)
def q_rewrite_names(spark, sf):
    p = tbl(spark, sf, "part").select("p_partkey", "p_name")
    return tx.rewrite(p, "p_name", NAME_RULES, distinct_first=True).select("p_partkey", "p_name")


_STRIP_TEXT = "p_name || ' and ' || lower(p_brand) || ' parts'"


@register(
    "strip_tokens",
    f"SELECT p_partkey, {duck_rules(_STRIP_TEXT, tx.token_rules(STRIP_WORDS, STRIP_PLURALS, True))} AS stripped FROM part",
    "A11",
)
def q_strip_tokens(spark, sf):
    p = tbl(spark, sf, "part").select("p_partkey", F.expr(_STRIP_TEXT).alias("stripped"))
    return tx.strip_tokens(p, "stripped", STRIP_WORDS, STRIP_PLURALS, whole_word=True)


_UNB_TEXT = "p_name || ' golden ' || lower(p_brand)"


@register(
    "strip_tokens_unbounded",
    f"SELECT p_partkey, {duck_rules(_UNB_TEXT, tx.token_rules(UNBOUNDED_WORDS, None, False))} AS stripped FROM part",
    "A11",
)
def q_strip_tokens_unbounded(spark, sf):
    p = tbl(spark, sf, "part").select("p_partkey", F.expr(_UNB_TEXT).alias("stripped"))
    return tx.strip_tokens(p, "stripped", UNBOUNDED_WORDS, None, whole_word=False)


def part_patches(spark, sf):
    """Patch rows derived from the data: every part gets 0-2 ordered patches."""
    p = tbl(spark, sf, "part")
    k = F.col("p_partkey").cast("string").alias("key")
    col = F.lit("p_name").alias("column")
    none = F.lit(None).cast("string")
    a = p.filter(F.col("p_size") % 10 == 0).select(
        k, F.lit(1).alias("seq"), col, F.lit("replace_first").alias("op"), F.lit("[aeiou]").alias("pattern"),
        F.lit("*").alias("value"), none.alias("when_match"))
    b = p.filter(F.col("p_size") % 10 == 1).select(
        k, F.lit(1).alias("seq"), col, F.lit("set").alias("op"), none.alias("pattern"),
        F.concat(F.col("p_brand"), F.lit("$x")).alias("value"), none.alias("when_match"))
    c1 = p.filter(F.col("p_size") % 10 == 2).select(
        k, F.lit(1).alias("seq"), col, F.lit("replace_all").alias("op"), F.lit("o").alias("pattern"),
        F.lit("0").alias("value"), none.alias("when_match"))
    c2 = p.filter(F.col("p_size") % 10 == 2).select(
        k, F.lit(2).alias("seq"), col, F.lit("set").alias("op"), none.alias("pattern"),
        F.upper("p_name").alias("value"), none.alias("when_match"))
    d = p.filter(F.col("p_size") % 10 == 3).select(
        k, F.lit(1).alias("seq"), col, F.lit("replace_all").alias("op"), F.lit("e").alias("pattern"),
        F.lit("E").alias("value"), F.lit("ring$").alias("when_match"))
    return a.unionByName(b).unionByName(c1).unionByName(c2).unionByName(d)


@register(
    "apply_patches",
    """SELECT p_partkey, CASE p_size % 10
    WHEN 0 THEN regexp_replace(p_name, '[aeiou]', '*')
    WHEN 1 THEN p_brand || '$x'
    WHEN 2 THEN upper(p_name)
    WHEN 3 THEN CASE WHEN regexp_matches(p_name, 'ring$') THEN regexp_replace(p_name, 'e', 'E', 'g') ELSE p_name END
    ELSE p_name END AS p_name
FROM part""",
    "A12",
)
def q_apply_patches(spark, sf):
    p = tbl(spark, sf, "part").select("p_partkey", "p_name")
    return tx.apply_patches(p, "p_partkey", part_patches(spark, sf), "p_name").select("p_partkey", "p_name")


@register(
    "date_patches",
    with_ctes(
        ["ship_spans"],
        """SELECT s.rowkey, cast(coalesce(p.b, s.begin_date) AS VARCHAR) AS begin_date,
       cast(coalesce(p.e, s.end_raw) AS VARCHAR) AS end_date,
       coalesce(coalesce(p.e, s.end_raw) < coalesce(p.b, s.begin_date), false) AS is_reversed
FROM ship_spans s LEFT JOIN (
  SELECT k, b, e FROM (
    SELECT cast(rowkey AS VARCHAR) AS k, end_raw AS b, begin_date AS e,
           row_number() OVER (PARTITION BY rowkey ORDER BY end_raw, begin_date) AS rn
    FROM ship_spans WHERE end_raw < begin_date AND rowkey % 8 = 1) q WHERE rn = 1) p ON cast(s.rowkey AS VARCHAR) = p.k""",
    ),
    "A13",
)
def q_date_patches(spark, sf):
    s = ship_spans(spark, sf)
    patches = s.filter((F.col("end_raw") < F.col("begin_date")) & (F.col("rowkey") % 8 == 1)).select(
        F.col("rowkey").cast("string").alias("key"), F.col("end_raw").alias("begin_date"), F.col("begin_date").alias("end_date")
    )
    spans = s.select("rowkey", "begin_date", F.col("end_raw").alias("end_date"))
    out = tx.apply_date_patches(spans, "rowkey", patches)
    return out.withColumn("is_reversed", F.coalesce(F.col("end_date") < F.col("begin_date"), F.lit(False)))


@register(
    "drop_listed",
    """SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem
WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)""",
    "A08",
)
def q_drop_listed(spark, sf):
    li = tbl(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    block = tbl(spark, sf, "supplier").filter(F.col("s_acctbal") < 0).select(F.col("s_suppkey").alias("l_suppkey"))
    return drop_listed(li, block, "l_suppkey")


# --------------------------------------------------------- location parsing
def part_locations(spark, sf):
    p = tbl(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    s1 = states(spark, sf).select(F.col("n_nationkey").alias("k1"), F.col("abbr").alias("code1"))
    s2 = states(spark, sf).select(F.col("n_nationkey").alias("k2"), F.col("abbr").alias("code2"))
    j = p.join(s1, (p["p_partkey"] % 25) == s1["k1"]).join(s2, ((p["p_partkey"] + 7) % 25) == s2["k2"])
    return j.select("p_partkey", F.expr(LOCATION_EXPR).alias("Location"))


LOCATION_EXPR = """CASE WHEN p_size % 9 = 0 THEN NULL
  WHEN p_size % 9 = 1 THEN
    split_part(CASE WHEN p_size % 4 = 0 THEN upper(p_name) ELSE p_name END, ' ', 1) || ', ' ||
    split_part(CASE WHEN p_size % 4 = 0 THEN upper(p_name) ELSE p_name END, ' ', 2) || ' (' || code1 || '), '
  ELSE
    split_part(CASE WHEN p_size % 4 = 0 THEN upper(p_name) ELSE p_name END, ' ', 1) || ', ' ||
    split_part(CASE WHEN p_size % 4 = 0 THEN upper(p_name) ELSE p_name END, ' ', 2) || ' (' || code1 || ', ' || code2 ||
    '), ' || p_brand || ' [' || lower(p_type) || '] (' || code2 || ')'
  END"""

CTE["part_locations"] = f"""part_locations AS (
  SELECT p_partkey, {LOCATION_EXPR} AS Location
  FROM part JOIN (SELECT n_nationkey AS k1, abbr AS code1 FROM states) s1 ON p_partkey % 25 = s1.k1
  JOIN (SELECT n_nationkey AS k2, abbr AS code2 FROM states) s2 ON (p_partkey + 7) % 25 = s2.k2)"""
CTE_DEPS["part_locations"] = ["states"]
CTE["pieces"] = r"""pieces AS (
  SELECT p_partkey, i - 1 AS piece_no, arr[i] AS piece
  FROM (SELECT p_partkey, string_split_regex(Location, '\),|\);') AS arr FROM part_locations WHERE Location IS NOT NULL) x,
       range(1, len(arr) + 1) t(i)
  UNION ALL SELECT p_partkey, NULL, NULL FROM part_locations WHERE Location IS NULL)"""
CTE_DEPS["pieces"] = ["part_locations"]
CTE["pieces2"] = r"""pieces2 AS (
  SELECT p_partkey, piece_no, inProgress,
         CASE WHEN inProgress THEN array_to_string(regexp_extract_all(piece, '\b([A-Z]{2})\b', 1), ', ')
              ELSE regexp_replace(piece, '^\s+|\s+$', '', 'g') END AS State,
         CASE WHEN inProgress THEN string_split_regex(regexp_replace(piece, '\b[A-Z]{2}\b', '', 'g'), '\),|\],|\]') END AS parts
  FROM (SELECT *, coalesce(regexp_matches(piece, '\p{Ll}'), false) AS inProgress FROM pieces) x)"""
CTE_DEPS["pieces2"] = ["pieces"]
CTE["parsed"] = r"""parts AS (
  SELECT p_partkey, piece_no, State, inProgress, j AS part_no, string_split_regex(parts[j], '\(|\[') AS sides
  FROM pieces2, range(1, len(parts) + 1) t(j) WHERE parts IS NOT NULL),
names AS (
  SELECT p_partkey, piece_no, State, inProgress, part_no, m AS name_no, string_split(sides[1], ',')[m] AS name,
         nullif(regexp_replace(regexp_replace(sides[2], '[),]', '', 'g'), '^\s+|\s+$', '', 'g'), '') AS County
  FROM parts, range(1, len(string_split(sides[1], ',')) + 1) t(m)),
parsed AS (
  SELECT p_partkey, piece_no, row_number() OVER (PARTITION BY p_partkey, piece_no ORDER BY part_no, name_no) - 1 AS region_no,
         State, nullif(regexp_replace(name, '^\s+|\s+$', '', 'g'), '') AS Region, County, inProgress FROM names
  UNION ALL
  SELECT p_partkey, piece_no, NULL, State, NULL, NULL, inProgress FROM pieces2 WHERE parts IS NULL)"""
CTE_DEPS["parsed"] = ["pieces2"]


def parsed_locations(spark, sf):
    return tx.parse_locations(part_locations(spark, sf), "p_partkey", "Location")


@register(
    "parse_locations",
    with_ctes(
        ["parsed"],
        """SELECT p_partkey, cast(piece_no AS DOUBLE) AS piece_no, cast(region_no AS DOUBLE) AS region_no,
       State, Region, County, inProgress FROM parsed""",
    ),
    "A14",
)
def q_parse_locations(spark, sf):
    p = parsed_locations(spark, sf)
    return p.withColumn("piece_no", F.col("piece_no").cast("double")).withColumn("region_no", F.col("region_no").cast("double"))


@register(
    "flag_unparsed",
    with_ctes(["pieces2"], "SELECT inProgress, count(*) AS n FROM pieces2 GROUP BY inProgress"),
    "A15",
)
def q_flag_unparsed(spark, sf):
    p = part_locations(spark, sf).select("p_partkey", F.posexplode_outer(F.split("Location", r"\),|\);")).alias("piece_no", "piece"))
    return tx.flag_unparsed(p, "piece").groupBy("inProgress").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------- gazetteer
def part_gazetteer(spark, sf):
    p = tbl(spark, sf, "part").filter(F.col("p_size") % 3 == 0).select("p_partkey", "p_name")
    s = states(spark, sf)
    j = p.join(s, (p["p_partkey"] % 25) == s["n_nationkey"])
    return j.select(
        F.col("abbr").alias("state_id"),
        F.expr("split_part(p_name, ' ', 2)").alias("city"),
        F.expr("split_part(p_name, ' ', 2)").alias("city_ascii"),
        F.expr("split_part(p_name, ' ', 1)").alias("county_name"),
    )


CTE["gaz"] = """gaz AS (
  SELECT s.abbr AS state_id, split_part(p_name, ' ', 2) AS city, split_part(p_name, ' ', 1) AS county_name
  FROM part JOIN states s ON p_partkey % 25 = s.n_nationkey WHERE p_size % 3 = 0)"""
CTE_DEPS["gaz"] = ["states"]
CTE["regions"] = r"""region_rows AS (
  SELECT concat_ws('_', cast(p_partkey AS VARCHAR), cast(piece_no AS VARCHAR), cast(region_no AS VARCHAR)) AS region_id,
         regexp_extract_all(State, '\b([A-Z]{2})\b', 1) AS codes, Region, County,
         CASE WHEN Region IS NOT NULL AND County IS NOT NULL THEN 'both' WHEN Region IS NOT NULL THEN 'region_only'
              WHEN County IS NOT NULL THEN 'county_only' ELSE 'none' END AS presence
  FROM parsed),
regions AS (
  SELECT region_id, unnest(codes) AS State, Region, County, presence FROM region_rows
  UNION ALL SELECT region_id, NULL, Region, County, presence FROM region_rows WHERE coalesce(len(codes), 0) = 0)"""
CTE_DEPS["regions"] = ["parsed"]
CTE["matched"] = """matched AS (
  SELECT b.region_id, b.State, b.Region, c.county_name AS county, 'county' AS level
  FROM (SELECT * FROM regions WHERE presence = 'region_only') b
  JOIN (SELECT DISTINCT state_id, county_name FROM gaz) c ON b.State = c.state_id AND b.Region = c.county_name
  UNION ALL
  SELECT r.region_id, r.State, r.Region, c.county_name AS county, 'city' AS level
  FROM (SELECT * FROM regions b WHERE presence = 'region_only'
        AND NOT EXISTS (SELECT 1 FROM gaz g WHERE g.state_id = b.State AND g.county_name = b.Region)) r
  JOIN (SELECT DISTINCT state_id, city, county_name FROM gaz) c ON r.State = c.state_id AND r.Region = c.city)"""
CTE_DEPS["matched"] = ["regions", "gaz"]
CTE["leftovers"] = """leftovers AS (
  SELECT r.region_id, r.State, r.Region FROM regions r WHERE presence = 'region_only' AND NOT EXISTS (
    SELECT 1 FROM matched m WHERE m.region_id = r.region_id AND m.State = r.State AND m.Region = r.Region))"""
CTE_DEPS["leftovers"] = ["matched"]


def regions_frame(spark, sf):
    """Every parsed region once for each state code of its piece, with its presence label."""
    p = geo.partition_by_presence(parsed_locations(spark, sf))
    p = p.select(
        F.concat_ws("_", F.col("p_partkey").cast("string"), F.col("piece_no").cast("string"), F.col("region_no").cast("string")).alias("region_id"),
        "State", "Region", "County", "presence",
    )
    return tx.state_codes(p)


def gazetteer_result(spark, sf):
    return geo.match_gazetteer(regions_frame(spark, sf), part_gazetteer(spark, sf))


@register(
    "gazetteer_match",
    with_ctes(["matched"], "SELECT region_id, State, Region, county, level FROM matched"),
    "A17",
)
def q_gazetteer_match(spark, sf):
    matched, _ = gazetteer_result(spark, sf)
    return matched.select("region_id", "State", "Region", "county", "level")


@register(
    "gazetteer_leftovers",
    with_ctes(["leftovers"], "SELECT region_id, State, Region FROM leftovers"),
    "A17",
)
def q_gazetteer_leftovers(spark, sf):
    _, left = gazetteer_result(spark, sf)
    return left.select("region_id", "State", "Region")


CTE["assignments"] = """assignments AS (
  SELECT cast(p_partkey AS VARCHAR) || '_0_0' AS region_id, lower(p_brand) || ', ' || lower(p_type) AS counties
  FROM part WHERE p_size % 4 = 1)"""
CTE["places"] = r"""places AS (
  SELECT region_id, State, Region, county, level FROM matched
  UNION ALL
  SELECT region_id, State, Region, County, 'known' FROM regions WHERE presence IN ('both', 'county_only')
  UNION ALL
  SELECT l.region_id, l.State, l.Region, regexp_replace(unnest(string_split(a.counties, ',')), '^\s+|\s+$', '', 'g') AS county,
         'manual' AS level
  FROM leftovers l
  JOIN assignments a ON l.region_id = a.region_id)"""
CTE_DEPS["places"] = ["leftovers", "assignments"]


def assignments(spark, sf):
    p = tbl(spark, sf, "part").filter(F.col("p_size") % 4 == 1)
    return p.select(
        F.concat(F.col("p_partkey").cast("string"), F.lit("_0_0")).alias("region_id"),
        F.concat(F.lower("p_brand"), F.lit(", "), F.lower("p_type")).alias("counties"),
    )


def places_frame(spark, sf):
    return geo.clean_places(regions_frame(spark, sf), part_gazetteer(spark, sf), assignments(spark, sf)).select(
        "region_id", "State", "Region", "county", "level"
    )


@register("assign_leftovers", with_ctes(["places"], "SELECT region_id, State, Region, county, level FROM places"), "A18")
def q_assign_leftovers(spark, sf):
    return places_frame(spark, sf)


@register(
    "match_coverage",
    with_ctes(
        ["regions", "gaz"],
        """SELECT count(CASE WHEN hit THEN 1 END) AS n_matched, count(CASE WHEN hit IS NULL THEN 1 END) AS n_unmatched
FROM regions r LEFT JOIN (SELECT DISTINCT state_id, county_name, true AS hit FROM gaz) g
  ON r.State = g.state_id AND r.Region = g.county_name""",
    ),
    "A19",
)
def q_match_coverage(spark, sf):
    dim = part_gazetteer(spark, sf).select(F.col("state_id").alias("State"), F.col("county_name").alias("Region"))
    return geo.match_coverage(regions_frame(spark, sf), dim, ["State", "Region"])


@register(
    "attach_places",
    with_ctes(
        ["places"],
        """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.State, p.county
FROM lineitem l LEFT JOIN (SELECT DISTINCT cast(split_part(region_id, '_', 1) AS BIGINT) AS l_partkey, State, county FROM places) p
  ON l.l_partkey = p.l_partkey""",
    ),
    "A20",
)
def q_attach_places(spark, sf):
    pl = places_frame(spark, sf).select(
        F.substring_index("region_id", "_", 1).cast("bigint").alias("l_partkey"), "State", "county"
    ).distinct()
    ev = tbl(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return geo.attach_places(ev, pl, "l_partkey").select("l_orderkey", "l_linenumber", "l_partkey", "State", "county")


@register(
    "presence_partition",
    with_ctes(
        ["parsed"],
        """SELECT presence, count(*) AS n FROM (
  SELECT CASE WHEN NOT (Region IS NULL OR Region = '') AND NOT (County IS NULL OR County = '') THEN 'both'
              WHEN NOT (Region IS NULL OR Region = '') THEN 'region_only'
              WHEN NOT (County IS NULL OR County = '') THEN 'county_only' ELSE 'none' END AS presence
  FROM parsed) x GROUP BY presence""",
    ),
    "A16",
)
def q_presence_partition(spark, sf):
    p = geo.partition_by_presence(parsed_locations(spark, sf))
    return p.groupBy("presence").agg(F.count(F.lit(1)).alias("n"))


CTE["misspelt"] = """misspelt AS (
  SELECT state_id AS State, city, overlay_name AS Region FROM (
    SELECT DISTINCT s.abbr AS state_id, split_part(p_name, ' ', 2) AS city,
      CASE p_partkey % 4 WHEN 0 THEN split_part(p_name, ' ', 2) || 'e' WHEN 1 THEN substr(split_part(p_name, ' ', 2), 2)
        WHEN 2 THEN replace(replace(split_part(p_name, ' ', 2), 'e', 'i'), 'l', 'r') ELSE 'x' || split_part(p_name, ' ', 1) END AS overlay_name
    FROM part JOIN states s ON p_partkey % 25 = s.n_nationkey) x)"""
CTE_DEPS["misspelt"] = ["states"]


def misspelt_regions(spark, sf):
    """Region names as a careless clerk would write them, by state."""
    p = tbl(spark, sf, "part").select("p_partkey", "p_name")
    s = states(spark, sf)
    j = p.join(s, (p["p_partkey"] % 25) == s["n_nationkey"])
    spelt = F.expr(
        "CASE p_partkey % 4 WHEN 0 THEN split_part(p_name, ' ', 2) || 'e' WHEN 1 THEN substr(split_part(p_name, ' ', 2), 2) "
        "WHEN 2 THEN replace(replace(split_part(p_name, ' ', 2), 'e', 'i'), 'l', 'r') ELSE 'x' || split_part(p_name, ' ', 1) END"
    )
    return j.select(F.col("abbr").alias("State"), spelt.alias("Region"))


def place_names(spark, sf):
    """County and city names of the gazetteer, by state."""
    g = part_gazetteer(spark, sf)
    names = g.select(F.col("state_id").alias("State"), F.col("city").alias("place"))
    return names.unionByName(g.select(F.col("state_id").alias("State"), F.col("county_name").alias("place")))


@register(
    "place_candidates",
    with_ctes(
        ["misspelt", "gaz"],
        """SELECT State, Region, place, distance, row_number() OVER (PARTITION BY State, Region ORDER BY distance, place) AS rank
FROM (SELECT l.State, l.Region, n.place, levenshtein(l.Region, n.place) AS distance
      FROM (SELECT DISTINCT State, Region FROM misspelt WHERE Region <> '') l
      JOIN (SELECT state_id, city AS place FROM gaz UNION SELECT state_id, county_name FROM gaz) n ON n.state_id = l.State) x
WHERE distance <= 2""",
    ),
    "A10,A17,A18",
)
def q_place_candidates(spark, sf):
    return fuzzy.candidates(misspelt_regions(spark, sf), place_names(spark, sf), ["State"], "Region", "place")

"""Searches on the published layout."""

from __future__ import annotations

from . import published as pb
from .base import REGISTRY, register, star_casualties, star_dates, star_locations, star_types, stage, tbl
from .q_analytics import SEARCH

#: the fewest buckets; larger tables get more, so that a bucket does not grow with the input
BUCKETS = 8


@stage
def published_star(spark, sf):
    """The star tables of the driver tables, written in the published layout."""
    tables = {
        "disastTypes": star_types(spark, sf),
        "disastDates": star_dates(spark, sf),
        "disastCasualties": star_casualties(spark, sf),
        "disastLocations": star_locations(spark, sf),
    }
    return pb.publish(tables, pb.new_folder(spark), star_buckets(spark, sf))


def star_buckets(spark, sf) -> int:
    """Buckets for the places, the largest table: at most one for each line and each order (counts come from file footers)."""
    return pb.buckets_for_rows(tbl(spark, sf, "lineitem").count() + tbl(spark, sf, "orders").count(), BUCKETS)


@register("event_search_published", REGISTRY["event_search"].sql, "A38-A43,A46")
def q_event_search_published(spark, sf):
    found = pb.search_published(published_star(spark, sf), **SEARCH)
    return found.select("eventKey", "incident_type", "hazard_type", "hazard_cluster", "eventStart", "eventEnd", "nKilled", "nWounded", "state", "county", "Year")


@register("units_affected_published", REGISTRY["units_affected_per_year"].sql, "A38-A43,A47")
def q_units_affected_published(spark, sf):
    return pb.units_published(published_star(spark, sf), ["state", "county"], "URGENT")

"""The event spine and the activity tables built from it, dimensions, and the ready-made questions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placemetrics.functions.casts import month, rate, safe_divide
from placemetrics.operators.cells import AREA
from placemetrics.operators.ranks import ranked
from placemetrics.sources.zones import stored

SPINE = ["dataset", "row_key", "category", "event_date", "place"]


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def spine(parts: list[DataFrame]) -> DataFrame:
    """Dated events of all datasets; rows without a month go here and only here, categories default last."""
    rows = union_all([p.select(*SPINE) for p in parts]).withColumn("event_month", month(F.col("event_date")))
    return rows.filter("event_month is not null").withColumn("category", F.coalesce("category", F.lit("Unknown"))).drop("event_date")


def counts(events: DataFrame, place: str = "place") -> DataFrame:
    """Events by place, dataset, category and month; rows without a place are left out."""
    return events.filter(F.col(place).isNotNull()).groupBy(place, "dataset", "category", "event_month").agg(F.count("*").alias("event_count"))


def population_by_boundary(cells: DataFrame, bridge: DataFrame, boundary_set: str) -> DataFrame:
    """People and housing units of the cells that a boundary owns, with the number of such cells that have any."""
    own = bridge.filter((F.col("boundary_set") == boundary_set) & F.col("is_primary")).select("boundary_id", "resolution", "h3_cell")
    owned = cells.join(own, ["resolution", "h3_cell"]).groupBy("boundary_id")
    return owned.agg(F.sum("population").alias("population"), F.sum("housing_units").alias("housing_units"), F.count("*").alias("cell_count"))


def dimension(boundaries: DataFrame, population: DataFrame, businesses: DataFrame) -> DataFrame:
    """One row a boundary: area, whole people and housing units (zero without cells), active businesses, densities."""
    out = boundaries.join(population, "boundary_id", "left").join(businesses, "boundary_id", "left")
    whole = {c: F.coalesce(F.round(c).cast("long"), F.lit(0).cast("long")) for c in ("population", "housing_units", "cell_count", "businesses")}
    out = out.withColumns(whole)
    return out.withColumns({"population_density": safe_divide(F.col("population"), F.col("area_sq_km")), "business_density": safe_divide(F.col("businesses"), F.col("area_sq_km"))})


def with_integer_key(dim: DataFrame, text: str = "boundary_id") -> DataFrame:
    """Adds the integer of ids such as '11.0'; the text stays."""
    return dim.withColumn("boundary_number", F.col(text).try_cast("double").try_cast("bigint"))


def by_neighborhood(count: DataFrame, dim: DataFrame) -> DataFrame:
    n = F.col("event_count")
    return count.join(dim, count["place"] == dim["boundary_id"]).select(
        "place", "dataset", "category", "event_month", "event_count", "population", "housing_units", "businesses", "area_sq_km",
        rate(n, F.col("population")).alias("per_1000_residents"), rate(n, F.col("housing_units")).alias("per_1000_housing_units"),
        rate(n, F.col("businesses")).alias("per_1000_businesses"), safe_divide(n, F.col("area_sq_km")).alias("per_sq_km"),
    )


def by_cell(count: DataFrame, measures: DataFrame, labels: dict[str, DataFrame], resolution: int = 8) -> DataFrame:
    """Counts by cell with the cell's people and housing units, and for each name in ``labels`` the primary boundary (h3_cell,
    boundary_id) as an approximate label; one area for all cells."""
    n = F.col("event_count")
    joined = count.withColumnRenamed("place", "h3_cell").join(measures, "h3_cell", "left")
    for name, label in labels.items():
        joined = joined.join(label.select("h3_cell", F.col("boundary_id").alias(name)), "h3_cell", "left")
    return joined.withColumns(
        {
            "resolution": F.lit(resolution),
            "per_1000_residents": rate(n, F.col("population")),
            "per_1000_housing_units": rate(n, F.col("housing_units")),
            "per_sq_km": n / F.lit(AREA[resolution]),
        }
    )


def locations(rows: DataFrame, labels: DataFrame, title: str, place: str) -> DataFrame:
    """One row a location with its primary boundary, and on every row how many locations and places its title has."""
    own = rows.join(labels.select("h3_cell", F.col("boundary_id").alias(place)), "h3_cell", "left")
    return with_group_totals(own, title, place, title)


def with_group_totals(df: DataFrame, group: str, distinct: str, name: str) -> DataFrame:
    """Totals of a non-unique attribute on every row."""
    totals = df.groupBy(group).agg(F.count("*").alias(f"{name}_rows"), F.count_distinct(distinct).alias(f"{name}_values"))
    return df.join(totals, group, "left")


def top(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def rates(mart: DataFrame, by: list[str], denominator: str) -> DataFrame:
    """Sum of counts over the largest denominator, NULL where there is none."""
    sums = mart.groupBy(*by).agg(F.sum("event_count").alias("events"), F.max(denominator).alias("denominator"))
    return sums.withColumn("rate", rate(F.col("events"), F.col("denominator")))


def lowest_with_exclusions(mart: DataFrame, by: str, denominator: str, n: int) -> DataFrame:
    """Lowest rates among places that have one, with the number of places left out beside them. The mart is read once."""
    all_ = stored(rates(mart, [by], denominator), "rates")
    left_out = all_.agg(F.count_if(F.col("rate").isNull()).alias("excluded_places"), F.count("*").alias("all_places"))
    return top(all_.filter("rate is not null"), [F.col("rate").asc(), F.col(by).asc()], n).join(F.broadcast(left_out))


def complete_months(events: DataFrame, column: str = "event_month") -> DataFrame:
    """Events without the newest month, which is partial."""
    newest = events.agg(F.max(column).alias("__newest"))
    return events.join(F.broadcast(newest)).filter(F.col(column) < F.col("__newest")).drop("__newest")


def three_ranks(cells: DataFrame) -> DataFrame:
    """Places ranked by count, density and rate; density at one resolution ranks as count does."""
    out = cells
    for name, column in {"count_rank": "events", "density_rank": "density", "rate_rank": "rate"}.items():
        out = ranked(out, column, name)
    return out

"""Dashboard plan: cleaned star tables to the reported series, maps and forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardspark.operators import forecast, report


def historical(disasters: DataFrame, impacts: DataFrame, locations: DataFrame) -> dict[str, DataFrame]:
    """Series and tables of the historical section."""
    clean = report.clean_disasters(disasters)
    places = report.clean_locations(locations)
    return {
        "monthly": report.monthly_occurrences(clean),
        "yearly": report.occurrences(clean, "year", "type"),
        "fatalities": report.fatalities_by_district(report.with_impacts(clean, impacts, places)),
        "map": report.mapped(clean, places),
    }


def recent(news_events: DataFrame) -> dict[str, DataFrame]:
    """Series and tables of the news section."""
    clean = report.clean_occurrences(news_events)
    by_district = report.occurrences(clean, "district", "type").where(F.col("district") != "")
    return {
        "monthly": report.monthly_occurrences(clean),
        "by_district": by_district,
        "district_order": report.ranked_totals(by_district, "district", "ocorrencias"),
    }


def outlook(monthly: DataFrame, news_events: DataFrame, year: int) -> dict[str, DataFrame]:
    """Monthly forecast of one year and its spread over districts."""
    ahead = forecast.fit_forecast(monthly, year)
    return {
        "forecast": ahead,
        "districts": forecast.allocate(ahead, report.clean_occurrences(news_events)),
    }

"""The published report of a sample run, rebuilt from as many rows."""

from pyspark.sql import functions as F

from wirelake.plans import reports


def sample(spark):
    used = ["first"] * 136 + ["second"] * 41 + ["third"] * 4 + [None] * 15
    rows = [(f"u{i}", u, None if u else "All Scrapers Failed", 0.73) for i, u in enumerate(used)]
    return spark.createDataFrame(rows, "url string, scraper_used string, error_type string, processing_time_s double")


def test_summary(spark):
    row = reports.scrape_summary(sample(spark), F.lit(6), F.lit(135.13)).first()
    assert (row.total_urls, row.filtered_pct, row.attempted, row.successful, row.failed) == (202, 3.0, 196, 181, 15)
    assert (row.success_rate, row.failed_rate, row.success_rate_total, row.mean_time_s) == (92.3, 7.7, 89.6, 0.73)
    assert round(row.articles_per_s, 2) == 1.45


def test_shares(spark):
    assert [tuple(r) for r in reports.scraper_report(sample(spark)).collect()] == [("first", 136, 75.1), ("second", 41, 22.7), ("third", 4, 2.2)]
    assert [tuple(r) for r in reports.error_report(sample(spark)).collect()] == [("All Scrapers Failed", 15, 100.0)]


def test_empty_log(spark):
    row = reports.scrape_summary(sample(spark).limit(0), F.lit(0)).first()
    assert row.attempted == 0 and row.success_rate is None

"""Data tables behind the 32 charts, one per chart, from the four cleaned tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.functions.cleaning import ordinal
from tabula.operators import freq, stats, timeline
from tabula.plans.reports import PATCH_DAYS, SEVERITY, ransomware_known, response_window


def _positive_points(pulses: DataFrame) -> DataFrame:
    points = pulses.where((F.col("Indicators_Count") > 0) & (F.col("Subscribers") > 0))
    return points.select("Indicators_Count", "Subscribers")


def _yearly(vulnerabilities: DataFrame) -> DataFrame:
    return freq.counts_with_flag(ransomware_known(vulnerabilities), "CVE_Year", "cveID",
                                 F.col("knownRansomwareCampaignUse"))


def _response_histogram(vulnerabilities: DataFrame) -> DataFrame:
    """Bins with the median and the mandated window as constant columns for the marker lines."""
    days = response_window(vulnerabilities)
    middle = stats.median(days, "days").scalar()
    return stats.histogram(days, "days", 30).select(
        "*", middle.alias("median"), F.lit(PATCH_DAYS).alias("mark"))


def _reputation_histogram(ips: DataFrame) -> DataFrame:
    middle = stats.median(ips, "Reputation_Score").scalar()
    return stats.histogram(ips, "Reputation_Score", 30).select("*", middle.alias("median"))


def _severity_points(df: DataFrame, reputation: str) -> DataFrame:
    return df.select(reputation, "Malicious_Votes",
                     ordinal(F.col("Threat_Severity"), SEVERITY).alias("severity"))


def _text(df: DataFrame, column: str) -> DataFrame:
    """A boolean as the text true/false, for level names."""
    return df.withColumn(column, F.col(column).cast("string"))


def _bools_by_severity(domains: DataFrame, column: str) -> DataFrame:
    return freq.crosstab_percent(_text(domains, column), "Threat_Severity", column, ["true", "false"],
                                 prefix=f"{column}_")


def _top(column: str, k: int) -> Callable[[DataFrame], DataFrame]:
    return lambda df: freq.top_values(df, column, k)


def _top_list(column: str, k: int) -> Callable[[DataFrame], DataFrame]:
    return lambda df: freq.top_elements(df, column, k)


def _severity(df: DataFrame) -> DataFrame:
    return freq.ordered_share(df, "Threat_Severity", SEVERITY)


# name -> (cleaned table, chart data)
CHARTS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "chart_01_monthly_pulses": ("pulses", lambda d: timeline.monthly_counts(d, "Created")),
    "chart_02_tlp": ("pulses", lambda d: freq.value_counts(d, "TLP")),
    "chart_03_families": ("pulses", _top_list("Malware_Families_Clean", 15)),
    "chart_04_techniques": ("pulses", _top_list("Attack_IDs_Clean", 20)),
    "chart_05_industries": ("pulses", _top_list("Industries_Clean", 15)),
    "chart_06_countries": ("pulses", _top_list("Countries_Clean", 15)),
    "chart_07_indicators_subscribers": ("pulses", _positive_points),
    "chart_08_tags": ("pulses", _top_list("Tags_Clean", 25)),
    "chart_09_years_ransomware": ("vulnerabilities", lambda d: _yearly(d).drop("flagged_pct")),
    "chart_10_vendors": ("vulnerabilities", _top("vendorProject", 15)),
    "chart_11_response_days": ("vulnerabilities", _response_histogram),
    "chart_12_weaknesses": ("vulnerabilities", _top_list("cwes_list", 15)),
    "chart_13_ransomware_share": ("vulnerabilities", lambda d: freq.share_by(
        _text(ransomware_known(d), "knownRansomwareCampaignUse"), "knownRansomwareCampaignUse")),
    "chart_13_ransomware_by_year": ("vulnerabilities", _yearly),
    "chart_14_monthly_vulnerabilities": (
        "vulnerabilities", lambda d: timeline.monthly_counts(d, "dateAdded")),
    "chart_15_products": ("vulnerabilities", _top("product", 15)),
    "chart_16_domain_severity": ("domains", _severity),
    "chart_17_tlds": ("domains", _top("TLD", 12)),
    "chart_18_length_by_severity": ("domains", lambda d: stats.histogram_by(
        d.where(F.col("Threat_Severity").isin(SEVERITY)), "Threat_Severity", "Domain_Length", 20)),
    "chart_19_numbers_by_severity": ("domains", lambda d: _bools_by_severity(d, "Has_Numbers")),
    "chart_19_hyphen_by_severity": ("domains", lambda d: _bools_by_severity(d, "Has_Hyphen")),
    "chart_20_domain_reputation_votes": ("domains", lambda d: _severity_points(d, "Reputation")),
    "chart_21_registrars": ("domains", _top("Registrar", 10)),
    "chart_22_ip_severity": ("ips", _severity),
    "chart_23_ip_countries": ("ips", _top("Country", 15)),
    "chart_24_continents": ("ips", lambda d: freq.share_by(d, "Continent")),
    "chart_25_reputation": ("ips", _reputation_histogram),
    "chart_26_labels": ("ips", _top("Threat_Label", 15)),
    "chart_27_categories": ("ips", _top("Threat_Category", 15)),
    "chart_28_tor_share": ("ips", lambda d: freq.share_by(_text(d, "TOR_Node"), "TOR_Node")),
    "chart_28_tor_by_severity": ("ips", lambda d: freq.crosstab(
        _text(d, "TOR_Node"), "Threat_Severity", "TOR_Node", ["true", "false"], prefix="tor_")),
    "chart_29_ip_reputation_votes": ("ips", lambda d: _severity_points(d, "Reputation_Score")),
    "chart_30_owners": ("ips", _top("Owner", 10)),
    "chart_31_years": ("vulnerabilities", lambda d: _yearly(d).select("CVE_Year", "total")),
    "chart_31_domain_severity": ("domains", lambda d: freq.share_by(d, "Threat_Severity")),
    "chart_31_ip_severity": ("ips", lambda d: freq.share_by(d, "Threat_Severity")),
    "chart_32_domain_correlation": ("domains", lambda d: stats.correlation_matrix(
        d, [c for c in stats.numeric_columns(d) if "Date" not in c])),
    "chart_32_ip_correlation": ("ips", lambda d: stats.correlation_matrix(
        d, [c for c in stats.numeric_columns(d) if "Date" not in c])),
}

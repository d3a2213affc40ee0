"""Report pages over the four cleaned tables.

A page is a set of named sections. ``as_long`` stacks them into (section, item, value). Sections read
a cleaned table many times, so pages expect it written once
(:func:`tabula.operators.sizing.stored`); every section then scans
only its own columns.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabula.functions.numeric import percent, whole_days
from tabula.operators import freq, stats, timeline

# Severity order, the mandated patch window in days, the longest window shown.
SEVERITY = ["Low", "Medium", "High", "Critical"]
PATCH_DAYS = 14
WINDOW_DAYS = 60


def _section(df: DataFrame, item: str | Column, value: str | Column) -> DataFrame:
    item = F.col(item) if isinstance(item, str) else item
    value = F.col(value) if isinstance(value, str) else value
    return df.select(item.cast("string").alias("item"), value.cast("double").alias("value"))


def _wide(row: DataFrame) -> DataFrame:
    """A one-row table as (item, value) rows."""
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("item"), F.col(c).cast("double").alias("value")) for c in row.columns])))


def as_long(sections: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        df.select(F.lit(name).alias("section"), "item", "value") for name, df in sections.items()])


def severity_or_unknown(df: DataFrame) -> DataFrame:
    return df.fillna({"Threat_Severity": "Unknown"})


def ransomware_known(vulnerabilities: DataFrame) -> DataFrame:
    """A missing mark counts as not known."""
    return vulnerabilities.fillna({"knownRansomwareCampaignUse": False})


def response_days(vulnerabilities: DataFrame) -> DataFrame:
    return vulnerabilities.select(whole_days(F.col("dateAdded"), F.col("dueDate")).alias("days"))


def response_window(vulnerabilities: DataFrame) -> DataFrame:
    """Whole days from added to due, within the window shown."""
    days = F.col("days")
    return response_days(vulnerabilities).where(days.isNotNull() & (days >= 0) & (days < WINDOW_DAYS))


def top_items(df: DataFrame, column: str, k: int) -> DataFrame:
    return _section(freq.top_values(df, column, k), "value", "n")


def top_list_items(df: DataFrame, column: str, k: int) -> DataFrame:
    return _section(freq.top_elements(df, column, k), "value", "n")


def overview(pulses: DataFrame, vulnerabilities: DataFrame, domains: DataFrame, ips: DataFrame
             ) -> dict[str, DataFrame]:
    rows, high = F.count(F.lit(1)), F.count_if(F.col("Threat_Severity") == "High")
    compared = freq.compare_levels({"domains": domains, "ips": ips}, "Threat_Severity", SEVERITY[:3])
    return {
        "pulses": _wide(pulses.agg(rows.alias("rows"))),
        "vulnerabilities": _wide(vulnerabilities.agg(rows.alias("rows"), F.max("CVE_Year").alias("latest year"))),
        "domains": _wide(domains.agg(rows.alias("rows"), high.alias("high"))),
        "ips": _wide(ips.agg(rows.alias("rows"), high.alias("high"))),
        "shares": _section(freq.table_shares({
            "pulses": pulses, "vulnerabilities": vulnerabilities, "domains": domains, "ips": ips}),
            "table", "share"),
        "severity domains": _section(compared, "level", "domains"),
        "severity ips": _section(compared, "level", "ips"),
        "monthly pulses": _section(timeline.monthly_counts(pulses, "Created"), "period", "n"),
        "monthly vulnerabilities": _section(
            timeline.monthly_counts(vulnerabilities, "dateAdded"), "period", "n"),
    }


def pulse_page(pulses: DataFrame) -> dict[str, DataFrame]:
    return {
        "families": top_list_items(pulses, "Malware_Families_Clean", 10),
        "techniques": top_list_items(pulses, "Attack_IDs_Clean", 10),
        "tlp": _section(freq.value_counts(pulses, "TLP"), "value", "n"),
        "industries": top_list_items(pulses, "Industries_Clean", 10),
        "countries": top_list_items(pulses, "Countries_Clean", 10),
        "daily": _section(timeline.daily_counts(pulses, "Created"), "period", "n"),
        "burst days": _section(timeline.burst_days(pulses, "Created"), "day", "n"),
    }


def vulnerability_page(vulnerabilities: DataFrame) -> dict[str, DataFrame]:
    known = ransomware_known(vulnerabilities)
    mark = F.col("knownRansomwareCampaignUse")
    yearly = freq.counts_with_flag(known, "CVE_Year", "cveID", mark)
    marks = freq.share_by(known.select(
        F.when(mark, "known").otherwise("not known").alias("mark")), "mark")
    days = response_window(vulnerabilities)
    late = F.count_if(F.col("days") > PATCH_DAYS)
    return {
        "per year": _section(yearly, "CVE_Year", "total"),
        "ransomware per year": _section(yearly, "CVE_Year", "flagged"),
        "ransomware share": _section(marks, "value", "share"),
        "vendors": top_items(vulnerabilities, "vendorProject", 12),
        "weaknesses": top_list_items(vulnerabilities, "cwes_list", 12),
        "response histogram": _section(stats.histogram(days, "days", 25), "bin", "n"),
        "response summary": _wide(stats.describe(days, "days")),
        "overdue": _wide(days.agg(late.alias("rows"), percent(late, F.count(F.lit(1))).alias("share"))),
    }


def domain_page(domains: DataFrame) -> dict[str, DataFrame]:
    known = severity_or_unknown(domains)
    return {
        "indicators": _wide(known.agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(F.col("Threat_Severity") == "High").alias("high"),
            F.count_distinct("TLD").alias("tlds"))),
        "severity": _section(freq.share_by(known, "Threat_Severity"), "value", "share"),
        "tlds": top_items(domains, "TLD", 10),
        "numbers": _section(freq.share_by(domains, "Has_Numbers"), "value", "share"),
        "hyphen": _section(freq.share_by(domains, "Has_Hyphen"), "value", "share"),
    }


def ip_page(ips: DataFrame) -> dict[str, DataFrame]:
    return {
        "indicators": _wide(ips.agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(F.col("Threat_Severity") == "High").alias("high"),
            F.count_if("TOR_Node").alias("tor"), F.count_distinct("Country").alias("countries"))),
        "continents": _section(freq.share_by(ips, "Continent"), "value", "share"),
        "countries": top_items(ips, "Country", 10),
        "categories": top_items(ips, "Threat_Category", 10),
        "reputation histogram": _section(stats.histogram(ips, "Reputation_Score", 20), "bin", "n"),
        "reputation": _wide(stats.median(ips, "Reputation_Score")),
    }


def high_severity(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.where(F.col("Threat_Severity") == "High").select(*columns)


# Columns of the two listings.
DOMAIN_LISTING = ["Domain", "TLD", "Registrar", "Malicious_Votes", "Suspicious_Votes"]
IP_LISTING = ["IP", "Country", "Owner", "Threat_Label", "Reputation_Score", "TOR_Node"]


def kpi_matrix(pulses: DataFrame, vulnerabilities: DataFrame, domains: DataFrame, ips: DataFrame,
               model_scores: DataFrame | None = None) -> DataFrame:
    """(kpi, value) as text, every value computed from the tables.

    ``model_scores`` (model, f1_macro) adds the best ransomware model.
    """
    rows = F.count(F.lit(1))
    tables = [pulses, vulnerabilities, domains, ips]
    sizes = reduce(DataFrame.unionByName, [d.agg(rows.alias("n")) for d in tables])

    def kpi(name: str, row: DataFrame, value: Column) -> DataFrame:
        return row.select(F.lit(name).alias("kpi"), value.cast("string").alias("value"))

    def top(name: str, column: str) -> DataFrame:
        first = freq.top_elements(pulses, column, 1)
        return kpi(name, first, F.concat("value", F.lit(" ("), F.col("n").cast("string"), F.lit(" pulses)")))

    known = vulnerabilities.agg(F.count_if("knownRansomwareCampaignUse").alias("n"), rows.alias("all"))
    share = F.format_string("%.1f", percent(F.col("n"), F.col("all")))
    severe = F.count_if(F.col("Threat_Severity").isin("High", "Critical")).alias("n")
    parts = [
        kpi("rows_total", sizes.agg(F.sum("n").alias("n")), F.col("n")),
        kpi("ransomware_known", known,
            F.concat(F.col("n").cast("string"), F.lit(" ("), share, F.lit("%)"))),
        top("first_family", "Malware_Families_Clean"),
        top("first_technique", "Attack_IDs_Clean"),
        top("first_industry", "Industries_Clean"),
        kpi("days_to_fix_median", stats.median(response_days(vulnerabilities), "days"),
            F.concat(F.format_string("%.0f", "median"), F.lit(" days"))),
        kpi("domains_severe", domains.agg(severe), F.col("n")),
        kpi("ips_severe", ips.agg(severe), F.col("n")),
        kpi("ips_tor", ips.agg(F.count_if("TOR_Node").alias("n")), F.col("n")),
    ]
    if model_scores is not None:
        best = model_scores.orderBy(F.col("f1_macro").desc_nulls_last(), "model").limit(1)
        parts.append(kpi("ransomware_model_f1", best, F.concat(
            F.format_string("%.2f", "f1_macro"), F.lit(" ("), "model", F.lit(")"))))
    return reduce(DataFrame.unionByName, parts)

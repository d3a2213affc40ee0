"""The cleaned tables and every chart's data table."""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tabula.catalog.registry import Tables, query, r6
from tabula.plans.charts import CHARTS
from tabula.plans.cleaning import DOMAIN_NUMBERS, IP_NUMBERS


# ---- cleaned tables: rows, with arrays as text

@query("clean_pulses", """
SELECT Pulse_ID, seq, Title, Created, Modified, Indicators_Count, Subscribers, TLP, array_to_string(Attack_IDs_Clean, '|') AS attacks,
  array_to_string(Industries_Clean, '|') AS industries, array_to_string(Countries_Clean, '|') AS countries,
  array_to_string(Malware_Families_Clean, '|') AS families, array_to_string(Tags_Clean, '|') AS tags FROM pulses
""")
def clean_pulses(t: Tables):
    return t.pulses().select(
        "Pulse_ID", "seq", "Title", F.col("Created").cast("timestamp_ntz").alias("Created"),
        F.col("Modified").cast("timestamp_ntz").alias("Modified"), "Indicators_Count",
        "Subscribers", "TLP", F.array_join("Attack_IDs_Clean", "|").alias("attacks"),
        F.array_join("Industries_Clean", "|").alias("industries"),
        F.array_join("Countries_Clean", "|").alias("countries"),
        F.array_join("Malware_Families_Clean", "|").alias("families"), F.array_join("Tags_Clean", "|").alias("tags"))


@query("clean_vulnerabilities", """
SELECT cveID, seq, vendorProject, product, vulnerabilityName, shortDescription, dateAdded, dueDate, knownRansomwareCampaignUse::INTEGER AS ransomware,
  array_to_string(cwes_list, '|') AS cwes, CVE_Year FROM vulnerabilities
""")
def clean_vulnerabilities(t: Tables):
    return t.vulnerabilities().select(
        "cveID", "seq", "vendorProject", "product", "vulnerabilityName", "shortDescription",
        F.col("dateAdded").cast("timestamp_ntz").alias("dateAdded"),
        F.col("dueDate").cast("timestamp_ntz").alias("dueDate"),
        F.col("knownRansomwareCampaignUse").cast("int").alias("ransomware"),
        F.array_join("cwes_list", "|").alias("cwes"), "CVE_Year")


@query("clean_domains", """
SELECT seq, Domain, TLD, Registrar, Creation_Date, Last_Update_Date, Last_Analysis_Date, Popularity_Rank, Domain_Length,
  Malicious_Votes, Suspicious_Votes, Harmless_Votes, Undetected_Votes, Total_Engines, Reputation,
  Has_Numbers::INTEGER AS numbers, Has_Hyphen::INTEGER AS hyphen, Threat_Severity FROM domains
""")
def clean_domains(t: Tables):
    return t.domains().select(
        "seq", "Domain", "TLD", "Registrar", *DOMAIN_NUMBERS,
        F.col("Has_Numbers").cast("int").alias("numbers"), F.col("Has_Hyphen").cast("int").alias("hyphen"),
        "Threat_Severity")


@query("clean_ips", """
SELECT seq, IP, ASN, Country, Continent, Owner, Malicious_Votes, Suspicious_Votes, Harmless_Votes, Undetected_Votes,
  Total_Reports, Reputation_Score, Times_Submitted, Last_Analysis_Date, TOR_Node::INTEGER AS tor, Threat_Label, Threat_Category,
  Threat_Severity FROM ips
""")
def clean_ips(t: Tables):
    return t.ips().select(
        "seq", "IP", "ASN", "Country", "Continent", "Owner", *IP_NUMBERS, F.col("TOR_Node").cast("int").alias("tor"),
        "Threat_Label", "Threat_Category", "Threat_Severity")


# ---- chart data

def _monthly(table: str, moment: str) -> str:
    return f"""
WITH months AS (SELECT date_trunc('month', {moment})::DATE AS m, count(*) AS n FROM {table} WHERE {moment} IS NOT NULL GROUP BY 1)
SELECT last_day(g::DATE) AS period, coalesce(n, 0) AS n
FROM (SELECT unnest(generate_series((SELECT min(m) FROM months)::TIMESTAMP, (SELECT max(m) FROM months)::TIMESTAMP,
  INTERVAL 1 MONTH)) AS g) LEFT JOIN months ON m = g::DATE"""


def _top(table: str, column: str, k: int) -> str:
    return f"""SELECT {column} AS value, count(*) AS n FROM {table} WHERE {column} IS NOT NULL
GROUP BY 1 ORDER BY n DESC, value LIMIT {k}"""


def _top_list(table: str, column: str, k: int) -> str:
    return _top(f"(SELECT unnest({column}) AS item FROM {table})", "item", k)


def _share(table: str, column: str) -> str:
    return f"""SELECT {column} AS value, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS share
FROM {table} WHERE {column} IS NOT NULL GROUP BY 1"""


_SEVERITY = "(VALUES ('Low', 0), ('Medium', 1), ('High', 2), ('Critical', 3)) AS levels(name, level)"


def _ordered(table: str) -> str:
    return f"""SELECT name AS value, count(*) AS n, level, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS share
FROM {table} JOIN {_SEVERITY} ON name = Threat_Severity GROUP BY name, level"""


def _points(table: str, reputation: str) -> str:
    return f"""SELECT {reputation}, Malicious_Votes, level AS severity FROM {table}
LEFT JOIN {_SEVERITY} ON name = Threat_Severity"""


def _bools(column: str) -> str:
    return f"""SELECT Threat_Severity, round(avg(CASE WHEN {column} THEN 100.0 ELSE 0.0 END), 6) AS "{column}_true",
  round(avg(CASE WHEN {column} THEN 0.0 ELSE 100.0 END), 6) AS "{column}_false"
FROM domains WHERE Threat_Severity IS NOT NULL AND {column} IS NOT NULL GROUP BY 1"""


def _bins(table: str, value: str, bins: int, extra: str) -> str:
    return f"""WITH limits AS (SELECT min({value})::DOUBLE AS lo, max({value})::DOUBLE AS hi FROM {table}),
grid AS (SELECT CAST(i AS INTEGER) AS bin, lo + i * ((hi - lo) / {bins}) AS a, lo + (i + 1) * ((hi - lo) / {bins}) AS b
  FROM limits, range({bins}) AS r(i))
SELECT bin, round(a, 6) AS bin_start, round(b, 6) AS bin_end,
  (SELECT count(*) FROM {table} WHERE {value} >= a AND ({value} < b OR bin = {bins - 1})) AS n,
  round((SELECT median({value}) FROM {table}), 6) AS median{extra} FROM grid"""


_WINDOW = """(SELECT CAST(date_diff('day', dateAdded, dueDate) AS INTEGER) AS days FROM vulnerabilities
  WHERE date_diff('day', dateAdded, dueDate) BETWEEN 0 AND 59)"""
_YEARS = """SELECT CVE_Year, count(*) AS total, count(*) FILTER (knownRansomwareCampaignUse) AS flagged,
  round(count(*) FILTER (knownRansomwareCampaignUse) * 100.0 / count(*), 6) AS flagged_pct
FROM vulnerabilities WHERE CVE_Year IS NOT NULL GROUP BY 1"""


def _correlations(table: str, columns: list[str]) -> str:
    return "\nUNION ALL ".join(
        f"""SELECT '{a}' AS column_a, '{b}' AS column_b,
  CASE WHEN isfinite(corr({a}, {b})) THEN round(corr({a}, {b}), 6) END AS correlation FROM {table}"""
        for a, b in product(columns, columns))


_SQL = {
    "chart_01_monthly_pulses": _monthly("pulses", "Created"),
    "chart_02_tlp": "SELECT TLP AS value, count(*) AS n FROM pulses WHERE TLP IS NOT NULL GROUP BY 1",
    "chart_03_families": _top_list("pulses", "Malware_Families_Clean", 15),
    "chart_04_techniques": _top_list("pulses", "Attack_IDs_Clean", 20),
    "chart_05_industries": _top_list("pulses", "Industries_Clean", 15),
    "chart_06_countries": _top_list("pulses", "Countries_Clean", 15),
    "chart_07_indicators_subscribers":
        "SELECT Indicators_Count, Subscribers FROM pulses WHERE Indicators_Count > 0 AND Subscribers > 0",
    "chart_08_tags": _top_list("pulses", "Tags_Clean", 25),
    "chart_09_years_ransomware": f"SELECT CVE_Year, total, flagged FROM ({_YEARS})",
    "chart_10_vendors": _top("vulnerabilities", "vendorProject", 15),
    "chart_11_response_days": _bins(_WINDOW, "days", 30, ", 14 AS mark"),
    "chart_12_weaknesses": _top_list("vulnerabilities", "cwes_list", 15),
    "chart_13_ransomware_share": _share(
        "(SELECT CASE WHEN knownRansomwareCampaignUse THEN 'true' ELSE 'false' END AS mark FROM vulnerabilities)", "mark"),
    "chart_13_ransomware_by_year": _YEARS,
    "chart_14_monthly_vulnerabilities": _monthly("vulnerabilities", "dateAdded"),
    "chart_15_products": _top("vulnerabilities", "product", 15),
    "chart_16_domain_severity": _ordered("domains"),
    "chart_17_tlds": _top("domains", "TLD", 12),
    "chart_18_length_by_severity": """
WITH limits AS (SELECT Threat_Severity AS s, min(Domain_Length) AS lo, max(Domain_Length) AS hi FROM domains
  WHERE Threat_Severity IS NOT NULL GROUP BY 1),
ranges AS (SELECT s, CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo, CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi FROM limits),
grid AS (SELECT s, CAST(i AS INTEGER) AS bin, lo + i * ((hi - lo) / 20) AS a, lo + (i + 1) * ((hi - lo) / 20) AS b
  FROM ranges, range(20) AS r(i))
SELECT s AS Threat_Severity, bin, round(a, 6) AS bin_start, round(b, 6) AS bin_end, count(Domain) AS n
FROM grid LEFT JOIN domains ON Threat_Severity = s AND Domain_Length >= a AND (Domain_Length < b OR bin = 19)
GROUP BY s, bin, a, b""",
    "chart_19_numbers_by_severity": _bools("Has_Numbers"),
    "chart_19_hyphen_by_severity": _bools("Has_Hyphen"),
    "chart_20_domain_reputation_votes": _points("domains", "Reputation"),
    "chart_21_registrars": _top("domains", "Registrar", 10),
    "chart_22_ip_severity": _ordered("ips"),
    "chart_23_ip_countries": _top("ips", "Country", 15),
    "chart_24_continents": _share("ips", "Continent"),
    "chart_25_reputation": _bins("ips", "Reputation_Score", 30, ""),
    "chart_26_labels": _top("ips", "Threat_Label", 15),
    "chart_27_categories": _top("ips", "Threat_Category", 15),
    "chart_28_tor_share": _share("(SELECT CAST(TOR_Node AS VARCHAR) AS tor FROM ips)", "tor"),
    "chart_28_tor_by_severity": """SELECT Threat_Severity, count(*) FILTER (TOR_Node) AS tor_true,
  count(*) FILTER (NOT TOR_Node) AS tor_false FROM ips WHERE Threat_Severity IS NOT NULL GROUP BY 1""",
    "chart_29_ip_reputation_votes": _points("ips", "Reputation_Score"),
    "chart_30_owners": _top("ips", "Owner", 10),
    "chart_31_years": f"SELECT CVE_Year, total FROM ({_YEARS})",
    "chart_31_domain_severity": _share("domains", "Threat_Severity"),
    "chart_31_ip_severity": _share("ips", "Threat_Severity"),
    "chart_32_domain_correlation": _correlations("domains", [
        "seq", "Popularity_Rank", "Domain_Length", "Malicious_Votes", "Suspicious_Votes", "Harmless_Votes",
        "Undetected_Votes", "Total_Engines", "Reputation"]),
    "chart_32_ip_correlation": _correlations("ips", [
        "seq", "ASN", "Malicious_Votes", "Suspicious_Votes", "Harmless_Votes", "Undetected_Votes",
        "Total_Reports", "Reputation_Score", "Times_Submitted"]),
}

_RAW_POINTS = {"chart_07_indicators_subscribers", "chart_20_domain_reputation_votes",
               "chart_29_ip_reputation_votes"}


def _register(name: str) -> None:
    table, build = CHARTS[name]

    @query(name, _SQL[name])
    def chart(t: Tables):
        out = build(getattr(t, table)())
        if name in _RAW_POINTS:
            return out
        return out.withColumns({f.name: r6(f.name) for f in out.schema.fields
                                if isinstance(f.dataType, DoubleType)})


for _name in CHARTS:
    _register(_name)

"""Report pages, listings and the indicator matrix."""

from __future__ import annotations

from tabula.catalog.charts import _WINDOW, _YEARS, _monthly
from tabula.catalog.registry import Tables, query, r6
from tabula.operators.sizing import stored
from tabula.plans import reports


# Columns that a page reads; only these are written before its sections scan them.
_OVERVIEW = {
    "pulses": ["Created"], "vulnerabilities": ["CVE_Year", "dateAdded"], "domains": ["Threat_Severity"], "ips": ["Threat_Severity"]}
_INDICATORS = {
    "pulses": ["Malware_Families_Clean", "Attack_IDs_Clean", "Industries_Clean"],
    "vulnerabilities": ["knownRansomwareCampaignUse", "dateAdded", "dueDate"],
    "domains": ["Threat_Severity"], "ips": ["Threat_Severity", "TOR_Node"]}
_VULNERABILITIES = ["cveID", "CVE_Year", "knownRansomwareCampaignUse", "vendorProject", "cwes_list", "dateAdded", "dueDate"]


def _stored_columns(t: Tables, columns: dict[str, list[str]]):
    return [stored(getattr(t, name)().select(*own), name) for name, own in columns.items()]


def _rounded(df):
    return df.withColumn("value", r6("value"))


def _part(section: str, sql: str, item: str = "value", value: str = "n") -> str:
    return f"""SELECT '{section}' AS section, CAST({item} AS VARCHAR) AS item, round(CAST({value} AS DOUBLE), 6) AS value
FROM ({sql})"""


def _one(section: str, item: str, sql: str) -> str:
    return f"SELECT '{section}' AS section, '{item}' AS item, round(CAST(({sql}) AS DOUBLE), 6) AS value"


def _top(column: str, table: str, k: int) -> str:
    return f"""SELECT {column} AS value, count(*) AS n FROM {table} WHERE {column} IS NOT NULL
GROUP BY 1 ORDER BY n DESC, 1 LIMIT {k}"""


def _top_list(column: str, table: str, k: int) -> str:
    return _top("i", f"(SELECT unnest({column}) AS i FROM {table})", k)


def _share(column: str, table: str) -> str:
    return f"""SELECT {column} AS value, count(*) * 100.0 / sum(count(*)) OVER () AS n FROM {table}
WHERE {column} IS NOT NULL GROUP BY 1"""


def _bins(table: str, value: str, bins: int) -> str:
    return f"""SELECT bin AS value, (SELECT count(*) FROM {table} WHERE {value} >= a AND ({value} < b OR bin = {bins - 1})) AS n
FROM (SELECT i AS bin, lo + i * ((hi - lo) / {bins}) AS a, lo + (i + 1) * ((hi - lo) / {bins}) AS b
  FROM (SELECT min({value})::DOUBLE AS lo, max({value})::DOUBLE AS hi FROM {table}), range({bins}) AS r(i))"""


def _daily(table: str, moment: str) -> str:
    return f"""WITH days AS (SELECT {moment}::DATE AS d, count(*) AS n FROM {table} WHERE {moment} IS NOT NULL GROUP BY 1)
SELECT g::DATE AS period, coalesce(n, 0) AS n
FROM (SELECT unnest(generate_series((SELECT min(d) FROM days)::TIMESTAMP, (SELECT max(d) FROM days)::TIMESTAMP,
  INTERVAL 1 DAY)) AS g) LEFT JOIN days ON d = g::DATE"""


def _union(*parts: str) -> str:
    return "\nUNION ALL ".join(f"SELECT * FROM ({p})" for p in parts)


_SIZES = """SELECT 'pulses' AS value, (SELECT count(*) FROM pulses) AS n UNION ALL SELECT 'vulnerabilities', (SELECT count(*) FROM vulnerabilities)
UNION ALL SELECT 'domains', (SELECT count(*) FROM domains) UNION ALL SELECT 'ips', (SELECT count(*) FROM ips)"""


def _levels(table: str) -> str:
    return f"""SELECT s AS value, (SELECT count(*) FROM {table} WHERE Threat_Severity = s) AS n
FROM (VALUES ('Low'), ('Medium'), ('High')) AS v(s)"""


@query("report_overview", _union(
    _one("pulses", "rows", "SELECT count(*) FROM pulses"),
    _one("vulnerabilities", "rows", "SELECT count(*) FROM vulnerabilities"),
    _one("vulnerabilities", "latest year", "SELECT max(CVE_Year) FROM vulnerabilities"),
    _one("domains", "rows", "SELECT count(*) FROM domains"),
    _one("domains", "high", "SELECT count(*) FROM domains WHERE Threat_Severity = 'High'"),
    _one("ips", "rows", "SELECT count(*) FROM ips"),
    _one("ips", "high", "SELECT count(*) FROM ips WHERE Threat_Severity = 'High'"),
    _part("shares", f"SELECT value, n * 100.0 / sum(n) OVER () AS n FROM ({_SIZES})"),
    _part("severity domains", _levels("domains")), _part("severity ips", _levels("ips")),
    _part("monthly pulses", _monthly("pulses", "Created"), "period"),
    _part("monthly vulnerabilities", _monthly("vulnerabilities", "dateAdded"), "period")))
def report_overview(t: Tables):
    return _rounded(reports.as_long(reports.overview(*_stored_columns(t, _OVERVIEW))))


@query("report_pulses", _union(
    _part("families", _top_list("Malware_Families_Clean", "pulses", 10)),
    _part("techniques", _top_list("Attack_IDs_Clean", "pulses", 10)),
    _part("tlp", "SELECT TLP AS value, count(*) AS n FROM pulses WHERE TLP IS NOT NULL GROUP BY 1"),
    _part("industries", _top_list("Industries_Clean", "pulses", 10)),
    _part("countries", _top_list("Countries_Clean", "pulses", 10)),
    _part("daily", _daily("pulses", "Created"), "period"),
    _part("burst days", "SELECT strftime(Created, '%Y-%m-%d') AS value, count(*) AS n FROM pulses "
          "WHERE Created IS NOT NULL GROUP BY 1 ORDER BY n DESC, value LIMIT 5")))
def report_pulses(t: Tables):
    return _rounded(reports.as_long(reports.pulse_page(stored(t.pulses(), "pulses"))))


@query("report_vulnerabilities", _union(
    _part("per year", _YEARS, "CVE_Year", "total"),
    _part("ransomware per year", _YEARS, "CVE_Year", "flagged"),
    _part("ransomware share", _share("mark", "(SELECT CASE WHEN knownRansomwareCampaignUse THEN 'known' ELSE 'not known' END AS mark FROM vulnerabilities)")),
    _part("vendors", _top("vendorProject", "vulnerabilities", 12)),
    _part("weaknesses", _top_list("cwes_list", "vulnerabilities", 12)),
    _part("response histogram", _bins(_WINDOW, "days", 25)),
    *[_one("response summary", item, f"SELECT {sql} FROM {_WINDOW}") for item, sql in [
        ("count", "count(days)"), ("mean", "avg(days)"), ("std", "stddev_samp(days)"), ("min", "min(days)"),
        ("p25", "quantile_cont(days, 0.25)"), ("p50", "quantile_cont(days, 0.5)"),
        ("p75", "quantile_cont(days, 0.75)"), ("max", "max(days)")]],
    _one("overdue", "rows", f"SELECT count(*) FROM {_WINDOW} WHERE days > 14"),
    _one("overdue", "share", f"SELECT count(*) FILTER (days > 14) * 100.0 / count(*) FROM {_WINDOW}")))
def report_vulnerabilities(t: Tables):
    table = stored(t.vulnerabilities().select(*_VULNERABILITIES), "vulnerabilities")
    return _rounded(reports.as_long(reports.vulnerability_page(table)))


@query("report_domains", _union(
    _one("indicators", "rows", "SELECT count(*) FROM domains"),
    _one("indicators", "high", "SELECT count(*) FROM domains WHERE Threat_Severity = 'High'"),
    _one("indicators", "tlds", "SELECT count(DISTINCT TLD) FROM domains"),
    _part("severity", _share("s", "(SELECT coalesce(Threat_Severity, 'Unknown') AS s FROM domains)")),
    _part("tlds", _top("TLD", "domains", 10)),
    _part("numbers", _share("Has_Numbers", "domains")), _part("hyphen", _share("Has_Hyphen", "domains"))))
def report_domains(t: Tables):
    return _rounded(reports.as_long(reports.domain_page(stored(t.domains(), "domains"))))


@query("report_ips", _union(
    _one("indicators", "rows", "SELECT count(*) FROM ips"),
    _one("indicators", "high", "SELECT count(*) FROM ips WHERE Threat_Severity = 'High'"),
    _one("indicators", "tor", "SELECT count(*) FROM ips WHERE TOR_Node"),
    _one("indicators", "countries", "SELECT count(DISTINCT Country) FROM ips"),
    _part("continents", _share("Continent", "ips")), _part("countries", _top("Country", "ips", 10)),
    _part("categories", _top("Threat_Category", "ips", 10)),
    _part("reputation histogram", _bins("ips", "Reputation_Score", 20)),
    _one("reputation", "median", "SELECT median(Reputation_Score) FROM ips")))
def report_ips(t: Tables):
    return _rounded(reports.as_long(reports.ip_page(stored(t.ips(), "ips"))))


@query("listing_domains", """
SELECT Domain, TLD, Registrar, Malicious_Votes, Suspicious_Votes FROM domains WHERE Threat_Severity = 'High'
""")
def listing_domains(t: Tables):
    return reports.high_severity(t.domains(), reports.DOMAIN_LISTING)


@query("listing_ips", """
SELECT IP, Country, Owner, Threat_Label, Reputation_Score, TOR_Node FROM ips WHERE Threat_Severity = 'High'
""")
def listing_ips(t: Tables):
    return reports.high_severity(t.ips(), reports.IP_LISTING)


def _first(column: str) -> str:
    return f"SELECT value || ' (' || n || ' pulses)' FROM ({_top_list(column, 'pulses', 1)})"


@query("kpi_matrix", f"""
SELECT 'rows_total' AS kpi, CAST((SELECT sum(n)::BIGINT FROM ({_SIZES})) AS VARCHAR) AS value
UNION ALL SELECT 'ransomware_known',
  (SELECT count(*) FILTER (knownRansomwareCampaignUse) || ' (' || format('{{:.1f}}', count(*) FILTER (knownRansomwareCampaignUse) * 100.0 / count(*)) || '%)' FROM vulnerabilities)
UNION ALL SELECT 'first_family', ({_first("Malware_Families_Clean")})
UNION ALL SELECT 'first_technique', ({_first("Attack_IDs_Clean")})
UNION ALL SELECT 'first_industry', ({_first("Industries_Clean")})
UNION ALL SELECT 'days_to_fix_median',
  (SELECT format('{{:.0f}}', median(date_diff('day', dateAdded, dueDate))) || ' days' FROM vulnerabilities)
UNION ALL SELECT 'domains_severe', CAST((SELECT count(*) FROM domains WHERE Threat_Severity IN ('High', 'Critical')) AS VARCHAR)
UNION ALL SELECT 'ips_severe', CAST((SELECT count(*) FROM ips WHERE Threat_Severity IN ('High', 'Critical')) AS VARCHAR)
UNION ALL SELECT 'ips_tor', CAST((SELECT count(*) FROM ips WHERE TOR_Node) AS VARCHAR)
""")
def kpi_matrix(t: Tables):
    return reports.kpi_matrix(*_stored_columns(t, _INDICATORS))

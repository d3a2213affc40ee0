"""Raw input tables derived from the given parquet tables.

Each text below is one projection, run as it stands by Spark and by the checking engine, so both
start from the same messy cells. ``{name}`` stands for a given table, ``EPOCH_US(x)`` for
microseconds since 1970.
"""

from __future__ import annotations

import re

RAW = {
    # messy event cells: padded and unknown tokens, bad numbers and dates, list text, mixed epochs
    "dirty_events": """
SELECT event_id AS seq,
  CASE WHEN event_id % 7 = 0 THEN ' Unknown '
       WHEN event_id % 11 = 0 THEN ''
       WHEN event_id % 13 = 0 THEN 'uNknown'
       WHEN event_id % 17 = 0 THEN 'NA'
       ELSE '  ' || event_type || ' ' END AS etype_raw,
  CASE WHEN event_id % 5 = 0 THEN '1,234'
       WHEN event_id % 9 = 0 THEN '1d'
       WHEN event_id % 10 = 3 THEN 'abc'
       ELSE CAST(value AS STRING) END AS value_raw,
  CASE WHEN event_id % 4 = 0 THEN substr(CAST(ts AS STRING), 6, 2) || '/' || substr(CAST(ts AS STRING), 9, 2)
                                  || '/' || substr(CAST(ts AS STRING), 1, 4)
       WHEN event_id % 9 = 0 THEN 'not a date'
       ELSE substr(CAST(ts AS STRING), 1, 19) END AS when_raw,
  CASE WHEN event_id % 6 = 0 THEN 'a, b,,Unknown , c'
       WHEN event_id % 6 = 1 THEN event_type || ',unknown,' || event_type || ' x'
       WHEN event_id % 6 = 2 THEN ' , ,'
       WHEN event_id % 6 = 3 THEN 'UNKNOWN'
       WHEN event_id % 6 = 4 THEN ''
       ELSE NULL END AS tags_raw,
  CASE WHEN event_id % 3 = 0 THEN 'Yes' WHEN event_id % 3 = 1 THEN 'No' ELSE 'Maybe' END AS flag_raw,
  CASE WHEN event_id % 8 = 0 THEN CAST(EPOCH_US(ts) AS DOUBLE) / 1000
       ELSE CAST(EPOCH_US(ts) AS DOUBLE) / 1000000 END AS epoch_raw
FROM {events}
""",
    # threat pulses in the shape of the first input file; exact copies of a text share their key
    "pulses_raw": """
SELECT doc_id AS seq,
  'P' || md5(text) AS Pulse_ID,
  text AS Title,
  CASE WHEN doc_id % 29 = 0 THEN 'soon'
       ELSE '20' || CAST(20 + doc_id % 4 AS STRING) || '-0' || CAST(1 + doc_id % 9 AS STRING)
            || '-1' || CAST(doc_id % 10 AS STRING) || ' 10:00:00' END AS Created,
  '2024-01-0' || CAST(1 + doc_id % 9 AS STRING) || ' 00:00:00' AS Modified,
  CASE WHEN doc_id % 19 = 0 THEN 'n/a' ELSE CAST(n_chars AS STRING) END AS Indicators_Count,
  CAST(doc_id % 50 AS STRING) AS Subscribers,
  replace(text, ' ', ', ') AS Tags,
  'T10' || CAST(10 + n_chars % 40 AS STRING) || ', T10' || CAST(10 + doc_id % 70 AS STRING) AS Attack_IDs,
  CASE WHEN doc_id % 3 = 0 THEN 'Unknown' ELSE source || ' , ' || lang END AS Industries,
  CASE WHEN doc_id % 5 = 0 THEN NULL ELSE lang || ',' || source || ',Unknown' END AS Countries,
  'fam ' || lang || ',' || source || '-kit' AS Malware_Families,
  CASE WHEN doc_id % 8 = 0 THEN 'Unknown' WHEN doc_id % 8 < 4 THEN 'white' WHEN doc_id % 8 < 6 THEN 'green'
       WHEN doc_id % 8 = 6 THEN ' amber' ELSE 'red' END AS TLP
FROM {documents}
""",
    # vulnerabilities in the shape of the second input file, one per order line
    "vulnerabilities_raw": """
SELECT l_orderkey * 1000000 + l_partkey AS seq,
  'CVE-' || substr(CAST(o_orderdate AS STRING), 1, 4) || '-' || CAST(l_orderkey AS STRING)
         || '-' || CAST(l_linenumber AS STRING) AS cveID,
  p_brand AS vendorProject,
  CASE WHEN l_partkey % 9 = 0 THEN ' Unknown ' ELSE p_type END AS product,
  p_name AS vulnerabilityName,
  l_returnflag || ' ' || l_linestatus || ' ' || o_orderpriority AS shortDescription,
  substr(CAST(o_orderdate AS STRING), 1, 10) AS dateAdded,
  CASE WHEN l_orderkey % 31 = 0 THEN 'tbd' ELSE CAST(l_shipdate AS STRING) END AS dueDate,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'Known' ELSE 'Unknown' END AS knownRansomwareCampaignUse,
  CASE WHEN l_partkey % 11 = 0 THEN ''
       ELSE '"CWE-' || CAST(p_size AS STRING) || ', CWE-' || CAST(l_linenumber AS STRING) || '"' END AS cwes
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey
""",
    # malicious domains in the shape of the third input file
    "domains_raw": """
SELECT p_partkey AS seq,
  replace(p_name, ' ', '-') || CAST(p_partkey AS STRING) AS Domain,
  p_brand AS TLD,
  CASE WHEN p_partkey % 13 = 0 THEN 'unknown' ELSE p_type END AS Registrar,
  CAST(1000000000 + p_partkey * 3600 AS STRING) AS Creation_Date,
  CAST(1100000000 + p_partkey * 7200 AS STRING) AS Last_Update_Date,
  '1700000000' AS Last_Analysis_Date,
  CASE WHEN p_partkey % 10 = 0 THEN 'Unknown' ELSE CAST(p_partkey % 977 AS STRING) END AS Popularity_Rank,
  CAST(length(p_name) + p_size AS STRING) AS Domain_Length,
  CAST(p_size AS STRING) AS Malicious_Votes,
  CAST(p_partkey % 7 AS STRING) AS Suspicious_Votes,
  CAST(90 - p_size AS STRING) AS Harmless_Votes,
  CAST(p_partkey % 17 AS STRING) AS Undetected_Votes,
  '94' AS Total_Engines,
  CAST(20 - p_size AS STRING) AS Reputation,
  CASE WHEN p_partkey % 3 = 0 THEN 'Yes' WHEN p_partkey % 3 = 1 THEN 'No' ELSE '?' END AS Has_Numbers,
  CASE WHEN p_size % 2 = 0 THEN 'Yes' ELSE 'No' END AS Has_Hyphen,
  CASE WHEN p_size <= 30 THEN 'Low' WHEN p_size <= 42 THEN ' Medium' WHEN p_size <= 48 THEN 'High'
       WHEN p_size = 49 THEN 'Critical' ELSE 'Unknown' END AS Threat_Severity
FROM {part}
""",
    # malicious addresses in the shape of the fourth input file
    "ips_raw": """
SELECT c_custkey AS seq,
  c_name AS IP,
  CASE WHEN c_custkey % 23 = 0 THEN 'AS?' ELSE CAST(64500 + c_nationkey AS STRING) END AS ASN,
  n_name AS Country,
  r_name AS Continent,
  c_mktsegment AS Owner,
  CAST(c_custkey % 21 AS STRING) AS Malicious_Votes,
  CAST(c_custkey % 5 AS STRING) AS Suspicious_Votes,
  CAST(c_custkey % 61 AS STRING) AS Harmless_Votes,
  CAST(c_custkey % 33 AS STRING) AS Undetected_Votes,
  CAST(c_custkey % 120 AS STRING) AS Total_Reports,
  CAST(c_acctbal AS STRING) AS Reputation_Score,
  CAST(c_nationkey + c_custkey % 3 AS STRING) AS Times_Submitted,
  CAST(1700000000 + c_custkey AS STRING) AS Last_Analysis_Date,
  CASE WHEN c_custkey % 33 = 0 THEN 'Yes' ELSE 'No' END AS TOR_Node,
  CASE WHEN c_custkey % 6 = 0 THEN 'Unknown' ELSE 'label-' || CAST(c_nationkey AS STRING) END AS Threat_Label,
  CASE WHEN c_custkey % 4 = 0 THEN 'botnet' WHEN c_custkey % 4 = 1 THEN 'scanner ' ELSE 'phishing' END AS Threat_Category,
  CASE WHEN c_custkey % 21 < 14 THEN 'Low' WHEN c_custkey % 21 < 18 THEN 'Medium'
       WHEN c_custkey % 21 < 20 THEN 'High' ELSE 'Unknown' END AS Threat_Severity
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
""",
    # race laps: a line is a lap, a supplier a race, the return flag a tyre compound; the odd divisors
    # keep rounded means off exact ties
    "laps": """
SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || CAST(l_extendedprice AS STRING) AS id,
  CASE WHEN l_partkey % 5 = 0 THEN 'D' || CAST(l_partkey % 40 AS STRING)
       WHEN l_partkey % 5 < 3 THEN 'ABC' ELSE 'XYZ' END AS Driver,
  'race ' || CAST(l_suppkey AS STRING) AS Race,
  CASE WHEN l_returnflag = 'A' THEN 'SOFT' WHEN l_returnflag = 'N' THEN 'MEDIUM' ELSE 'HARD' END AS Compound,
  CAST(2022 + l_orderkey % 4 AS INT) AS Year,
  CAST(l_linenumber + 7 * (l_partkey % 8) AS INT) AS LapNumber,
  CAST(1 + l_orderkey % 3 AS INT) AS Stint,
  CAST(1 + l_partkey % 20 AS INT) AS Position,
  CAST(l_linenumber - 4 AS INT) AS Position_Change,
  l_quantity AS TyreLife,
  l_extendedprice / 397 AS LapTime,
  l_quantity * l_tax / 7 - 1 AS Cumulative_Degradation,
  l_discount * 10 AS RaceProgress,
  CASE WHEN l_linestatus = 'F' AND l_quantity > 25 THEN 1 WHEN l_discount > 0.09 THEN 1 ELSE 0 END AS PitNextLap
FROM {lineitem}
""",
    # scored rows for the metrics: few distinct scores, so ties are common
    "scored": """
SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
  round(l_discount * 10, 1) AS score,
  round(l_tax * 10, 1) AS score_b,
  round((l_quantity + l_linenumber) / 60, 3) AS score_c,
  CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END AS pred,
  CASE WHEN l_returnflag = 'A' THEN 0 WHEN l_returnflag = 'N' THEN 1 ELSE 2 END AS y3,
  CASE WHEN l_quantity < 17 THEN 0 WHEN l_quantity < 34 THEN 1 ELSE 2 END AS pred3
FROM {lineitem}
""",
}

def _inputs(name: str) -> list[str]:
    """Given tables in order of appearance, the driving table first."""
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", RAW[name])))


def spark_sql(name: str) -> tuple[str, list[str]]:
    return RAW[name].replace("EPOCH_US(", "unix_micros("), _inputs(name)


def oracle_cte(name: str) -> str:
    return re.sub(r"\{(\w+)\}", r"\1", RAW[name]).replace("EPOCH_US(", "epoch_us(")


# Cleaned tables in the checking engine's own dialect, on top of the raw ones.
def _known(column: str) -> str:
    return f"CASE WHEN trim({column}) NOT IN ('Unknown', 'unknown', 'UNKNOWN', '') THEN trim({column}) END"


def _items(column: str) -> str:
    return (f"[trim(x) for x in string_split(coalesce({column}, ''), ',') "
            "if trim(x) NOT IN ('Unknown', 'unknown', 'UNKNOWN', '')]")


def _numbers(*columns: str) -> str:
    return ", ".join(f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in columns)


def _yes_no(column: str) -> str:
    return f"CASE {column} WHEN 'Yes' THEN true WHEN 'No' THEN false END AS {column}"


CLEANED: dict[str, str] = {
    "pulses": f"""
SELECT seq, Pulse_ID, Title, try_strptime(Created, '%Y-%m-%d %H:%M:%S') AS Created,
  try_strptime(Modified, '%Y-%m-%d %H:%M:%S') AS Modified,
  {_numbers("Indicators_Count", "Subscribers")}, {_items("Tags")} AS Tags_Clean,
  {_items("Attack_IDs")} AS Attack_IDs_Clean, {_items("Industries")} AS Industries_Clean,
  {_items("Countries")} AS Countries_Clean, {_items("Malware_Families")} AS Malware_Families_Clean,
  {_known("TLP")} AS TLP
FROM pulses_raw QUALIFY row_number() OVER (PARTITION BY Pulse_ID ORDER BY seq) = 1""",
    "vulnerabilities": f"""
SELECT seq, cveID, vendorProject, {_known("product")} AS product, vulnerabilityName, shortDescription,
  try_strptime(dateAdded, '%Y-%m-%d') AS dateAdded, try_strptime(dueDate, '%Y-%m-%d %H:%M:%S') AS dueDate,
  CASE WHEN knownRansomwareCampaignUse = 'Known' THEN true END AS knownRansomwareCampaignUse,
  [x for x in string_split(trim(cwes, '"'), ', ') if x <> ''] AS cwes_list,
  CAST(substr(cveID, 5, 4) AS INTEGER) AS CVE_Year
FROM vulnerabilities_raw QUALIFY row_number() OVER (PARTITION BY cveID ORDER BY seq, dueDate, vulnerabilityName) = 1""",
    "domains": f"""
SELECT DISTINCT seq, Domain, TLD, {_known("Registrar")} AS Registrar,
  {_numbers("Creation_Date", "Last_Update_Date", "Last_Analysis_Date", "Popularity_Rank", "Domain_Length", "Malicious_Votes", "Suspicious_Votes", "Harmless_Votes",
            "Undetected_Votes", "Total_Engines", "Reputation")},
  {_yes_no("Has_Numbers")}, {_yes_no("Has_Hyphen")}, {_known("Threat_Severity")} AS Threat_Severity
FROM domains_raw""",
    "ips": f"""
SELECT seq, IP, TRY_CAST(ASN AS BIGINT) AS ASN, Country, Continent, Owner,
  {_numbers("Malicious_Votes", "Suspicious_Votes", "Harmless_Votes", "Undetected_Votes", "Total_Reports",
            "Reputation_Score", "Times_Submitted", "Last_Analysis_Date")},
  {_yes_no("TOR_Node")}, {_known("Threat_Label")} AS Threat_Label,
  {_known("Threat_Category")} AS Threat_Category, {_known("Threat_Severity")} AS Threat_Severity
FROM ips_raw QUALIFY row_number() OVER (PARTITION BY IP ORDER BY seq) = 1""",
}


def with_prelude(sql: str) -> str:
    """Put the raw and cleaned tables a statement mentions in front of it as common tables."""
    needed: list[str] = []

    def need(name: str) -> None:
        if name in needed:
            return
        body = CLEANED.get(name, "")
        for other in [*RAW, *CLEANED]:
            if other != name and re.search(rf"\b{other}\b", body):
                need(other)
        needed.append(name)

    for name in [*RAW, *CLEANED]:
        if re.search(rf"\b{name}\b", sql):
            need(name)
    if not needed:
        return sql
    ctes = ", ".join(f"{n} AS ({oracle_cte(n) if n in RAW else CLEANED[n]})" for n in needed)
    if re.match(r"\s*WITH\b", sql):
        return re.sub(r"^\s*WITH\b", f"WITH {ctes},", sql, count=1)
    return f"WITH {ctes} {sql}"

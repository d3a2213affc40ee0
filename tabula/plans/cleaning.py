"""Cleaning jobs for the four input tables: raw text columns in, typed columns out.

Every job is one projection followed by one keep-first (or distinct) aggregate. Reading gives no row
order, so the caller names the columns that say which of several rows with the same key came first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tabula.functions import cleaning as c
from tabula.operators.dedup import distinct_rows, keep_first

# Column names of the input files.
PULSE_LISTS = ["Tags", "Attack_IDs", "Industries", "Countries", "Malware_Families"]
DOMAIN_NUMBERS = [
    "Creation_Date", "Last_Update_Date", "Last_Analysis_Date", "Popularity_Rank", "Domain_Length",
    "Malicious_Votes", "Suspicious_Votes", "Harmless_Votes", "Undetected_Votes", "Total_Engines",
    "Reputation",
]
IP_NUMBERS = [
    "Malicious_Votes", "Suspicious_Votes", "Harmless_Votes", "Undetected_Votes", "Total_Reports",
    "Reputation_Score", "Times_Submitted", "Last_Analysis_Date",
]
YES_NO = {"Yes": True, "No": False}
KNOWN = {"Known": True}


def clean_all(df: DataFrame) -> DataFrame:
    """Trim every text column and turn its unknown tokens into NULL.

    Two projections, so that each text is trimmed once although the token test uses it twice.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    trimmed = df.withColumns({n: c.strip(F.col(f"`{n}`")) for n in texts})
    return trimmed.withColumns({n: c.null_if(F.col(f"`{n}`"), c.UNKNOWN_TOKENS) for n in texts})


def _numbers(names: Sequence[str]) -> dict:
    return {n: c.to_number(F.col(n)) for n in names}


def clean_pulses(raw: DataFrame, order: Sequence[str]) -> DataFrame:
    typed = clean_all(raw).withColumns({
        "Created": c.to_timestamp_any(F.col("Created")),
        "Modified": c.to_timestamp_any(F.col("Modified")),
        **_numbers(["Indicators_Count", "Subscribers"]),
        **{f"{n}_Clean": c.split_list(F.col(n)) for n in PULSE_LISTS if n in raw.columns}})
    return keep_first(typed, ["Pulse_ID"], order)


def clean_vulnerabilities(raw: DataFrame, order: Sequence[str]) -> DataFrame:
    typed = clean_all(raw).withColumns({
        "dateAdded": c.to_timestamp_any(F.col("dateAdded")),
        "dueDate": c.to_timestamp_any(F.col("dueDate")),
        "cwes_list": c.split_quoted_list(F.col("cwes")),
        "CVE_Year": c.extract_whole(F.col("cveID"), r"CVE-(\d{4})"),
        "knownRansomwareCampaignUse": c.map_values(F.col("knownRansomwareCampaignUse"), KNOWN)})
    return keep_first(typed, ["cveID"], order)


def clean_domains(raw: DataFrame) -> DataFrame:
    typed = clean_all(raw).withColumns({
        **_numbers(DOMAIN_NUMBERS),
        "Has_Numbers": c.map_values(F.col("Has_Numbers"), YES_NO),
        "Has_Hyphen": c.map_values(F.col("Has_Hyphen"), YES_NO)})
    return distinct_rows(typed)


def clean_ips(raw: DataFrame, order: Sequence[str]) -> DataFrame:
    typed = clean_all(raw).withColumns({
        "ASN": c.to_whole(F.col("ASN")),
        **_numbers(IP_NUMBERS),
        "TOR_Node": c.map_values(F.col("TOR_Node"), YES_NO)})
    return keep_first(typed, ["IP"], order)

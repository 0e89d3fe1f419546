"""Write the logical sources as yearly CSV folders, the way raw exports arrive."""

from __future__ import annotations

from pyspark.sql import functions as F

from peerlight.registry.tables import Tables

# File names carry years from 2000 on, so the test years 1995-2001 move up by this much.
YEAR_SHIFT = 20


def write_raw_sources(t: Tables, root: str) -> None:
    yearly = {
        "prescribers": t.prescribers,
        "payments": t.payments,
        "prescriber_drug": t.drug,
        "recipient_profile": t.recipient,
    }
    for prefix, df in yearly.items():
        df = df.persist()
        years = [row.report_year for row in df.select("report_year").distinct().collect()]
        for year in years:
            part = df.filter(F.col("report_year") == year).drop("report_year")
            part.write.option("header", True).csv(f"{root}/{prefix}_{year + YEAR_SHIFT}.csv")
        df.unpersist()
    later = F.add_months("day", 12 * YEAR_SHIFT)
    excluded = t.last_orders.filter("c_acctbal < 0")
    excluded.select(
        F.col("c_custkey").cast("string").alias("EXCLNPI"), F.date_format(later, "yyyyMMdd").alias("EXCLDATE")
    ).coalesce(1).write.option("header", True).csv(f"{root}/leie.csv")
    t.cia.drop("signed").coalesce(1).write.option("header", True).csv(f"{root}/labels/cia.csv")
    t.doj.coalesce(1).write.option("header", True).csv(f"{root}/labels/doj.csv")

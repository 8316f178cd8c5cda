"""Deterministic dirty columns derived from the driver tables.

Each derivation is one SQL expression that runs unchanged in Spark SQL and
DuckDB, so the Spark query and its oracle start from identical input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.catalog.registry import table

K = "cast(c_custkey as varchar(20))"

CUSTOMER_DIRTY = [
    ("id", "c_custkey"),
    ("phone", f"case c_custkey % 8 when 0 then '+62 812-' || lpad({K},8,'0') when 1 then '0812' || lpad({K},8,'0') "
              f"when 2 then '(021) ' || lpad({K},7,'0') when 3 then 'N/A' when 4 then '6.28E+11' when 5 then ' 0 ' "
              f"when 6 then 'null' else '812.' || lpad({K},8,'0') end"),
    ("contact_phone", f"case c_custkey % 5 when 0 then '62' || lpad({K},9,'2') when 1 then 'n/a 0812' "
                      f"when 2 then '' when 3 then '8' || lpad({K},9,'5') else null end"),
    ("name", "case c_custkey % 6 when 0 then '  ' || lower(c_name) || '!' when 1 then 'o''brien  mc-donald' "
             "when 2 then '12345' when 3 then null when 4 then 'JOSE 2nd' else c_name end"),
    ("contact_name", "case c_custkey % 4 when 0 then upper(c_mktsegment) || ' 9' when 1 then ' ana-maria ' "
                     "when 2 then '' else lower(c_name) end"),
    ("customer_nik", f"case c_custkey % 5 when 0 then lpad({K},16,'3') when 1 then '3201 0101 ' || lpad({K},8,'0') "
                     f"when 2 then lpad({K},15,'1') when 3 then null else '3201-' || lpad({K},12,'0') end"),
    ("postal_code", f"case c_custkey % 5 when 0 then lpad({K},5,'1') when 1 then ' ' || lpad({K},5,'2') || ' ' "
                    f"when 2 then '123' when 3 then 'abcde' else null end"),
    ("latitude", "case c_custkey % 6 when 0 then '-6.25' when 1 then '91' when 2 then 'abc' when 3 then null "
                 "when 4 then '0' else '-7.5' end"),
    ("longitude", "case c_custkey % 5 when 0 then '106.75' when 1 then '0.0' when 2 then '181' when 3 then null "
                  "else '110.5' end"),
    ("flag", "case c_custkey % 8 when 0 then 'Y' when 1 then ' yes ' when 2 then 'TRUE' when 3 then '1' "
             "when 4 then 'n' when 5 then 'No' when 6 then 'maybe' else null end"),
    ("is_pkp", "case c_custkey % 5 when 0 then 'Y' when 1 then 'n' when 2 then 'X' when 3 then 'Y ' else null end"),
    ("is_bumn", "case c_custkey % 3 when 0 then 'N' when 1 then 'y' else 'maybe' end"),
    ("is_tax_free", "case c_custkey % 4 when 0 then 'Y' when 1 then null when 2 then 'N' else '' end"),
    ("city", "case c_custkey % 5 when 0 then 'jakarta 1' when 1 then ' kota-BOGOR ' when 2 then '123' "
             "when 3 then null else 'd''ili' end"),
    ("address_1", "case c_custkey % 4 when 0 then ' jalan RAYA ' when 1 then '' when 2 then null else c_mktsegment end"),
    ("address_2", "case c_custkey % 3 when 0 then 'Jalan raya' when 1 then c_mktsegment else '  ' end"),
    ("address_3", "case c_custkey % 5 when 0 then 'jalan raya' when 1 then lower(c_mktsegment) when 2 then null "
                  "else 'blok A' end"),
    ("customer_tax_address_1", "case c_custkey % 3 when 0 then lower(c_mktsegment) when 1 then null else ' x ' end"),
    ("customer_tax_address_2", "case c_custkey % 2 when 0 then c_mktsegment else 'X' end"),
    ("customer_ktp_name", "case c_custkey % 3 when 0 then c_name when 1 then 'budi  santoso' else '##' end"),
    ("customer_tax_name", "case c_custkey % 3 when 0 then 'pt. maju-jaya' when 1 then null else c_mktsegment end"),
    ("deleted", "case c_custkey % 7 when 0 then true when 1 then null else false end"),
    ("zero_text", "case c_custkey % 7 when 0 then '0' when 1 then ' 0 ' when 2 then '0.0' when 3 then '0.4' "
                  "when 4 then 'abc' when 5 then '' else null end"),
    ("c_acctbal", "c_acctbal"),
    ("c_nationkey", "c_nationkey"),
]


def dirty_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(*[f"{e} AS {n}" for n, e in CUSTOMER_DIRTY])


def dirty_customer_sql() -> str:
    cols = ",\n  ".join(f"{e} AS {n}" for n, e in CUSTOMER_DIRTY)
    return f"(SELECT\n  {cols}\nFROM customer)"

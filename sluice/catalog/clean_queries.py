"""Column cleaner queries (CL-1..CL-11, UD-1) over the dirty customer."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.catalog import sqlx as X
from sluice.catalog.dirty import dirty_customer, dirty_customer_sql
from sluice.catalog.registry import query, table
from sluice.functions import cleaners as C
from sluice.operators import numbering as N
from sluice.plans.recipes import add_phone_columns

D = dirty_customer_sql()


@query("phone_normalize", sql=f"""
    SELECT id, phone, {X.normalize_phone('phone')} AS phone_normalized,
           {X.normalize_phone('contact_phone')} AS contact_phone_normalized FROM {D}""")
def phone_normalize(spark, sf):
    d = dirty_customer(spark, sf)
    return d.select("id", "phone", C.normalize_phone("phone").alias("phone_normalized"),
                    C.normalize_phone("contact_phone").alias("contact_phone_normalized"))


@query("phone_validate", sql=f"""
    SELECT id, {X.phone_valid('phone')} AS phone_valid,
           {X.phone_valid(X.normalize_phone('phone'))} AS phone_normalized_valid,
           {X.phone_valid('contact_phone')} AS contact_phone_valid FROM {D}""")
def phone_validate(spark, sf):
    d = dirty_customer(spark, sf)
    return d.select("id", C.phone_is_valid("phone").alias("phone_valid"),
                    C.phone_is_valid(C.normalize_phone("phone")).alias("phone_normalized_valid"),
                    C.phone_is_valid("contact_phone").alias("contact_phone_valid"))


def _status_sql(c):
    return X.phone_status(X.phone_valid(c), X.phone_valid(X.normalize_phone(c)))


@query("phone_status", sql=f"""
    SELECT id, {_status_sql('phone')} AS phone_status, {_status_sql('contact_phone')} AS contact_phone_status
    FROM {D}""")
def phone_status(spark, sf):
    d = add_phone_columns(dirty_customer(spark, sf), ["phone", "contact_phone"])
    return d.select("id", "phone_status", "contact_phone_status")


_A = X.address(["address_1", "address_2", "address_3"])
_T = X.address(["customer_tax_address_1", "customer_tax_address_2"])


@query("clean_address", sql=f"""
    SELECT id, {_A[0]} AS address_1, {_A[1]} AS address_2, {_A[2]} AS address_3,
           {_T[0]} AS customer_tax_address_1, {_T[1]} AS customer_tax_address_2 FROM {D}""")
def clean_address(spark, sf):
    d = dirty_customer(spark, sf)
    a = C.clean_address(["address_1", "address_2", "address_3"])
    t = C.clean_address(["customer_tax_address_1", "customer_tax_address_2"])
    return d.select("id", *[c.alias(n) for c, n in zip(a + t, ["address_1", "address_2", "address_3",
                                                                "customer_tax_address_1", "customer_tax_address_2"])])


_NAMES = ["name", "contact_name", "customer_ktp_name", "customer_tax_name"]


@query("clean_name", sql="SELECT id, " + ", ".join(f"{X.clean_name(n)} AS {n}" for n in _NAMES) + f" FROM {D}")
def clean_name(spark, sf):
    d = dirty_customer(spark, sf)
    return d.select("id", *[C.clean_name(n).alias(n) for n in _NAMES])


@query("clean_nik", sql=f"SELECT id, {X.clean_nik('customer_nik')} AS customer_nik FROM {D}")
def clean_nik(spark, sf):
    return dirty_customer(spark, sf).select("id", C.clean_nik("customer_nik").alias("customer_nik"))


@query("clean_postal", sql=f"SELECT id, {X.clean_postal('postal_code')} AS postal_code FROM {D}")
def clean_postal(spark, sf):
    return dirty_customer(spark, sf).select("id", C.clean_postal_code("postal_code").alias("postal_code"))


_LA, _LO = X.coords("latitude", "longitude")


@query("clean_coords", sql=f"SELECT id, {_LA} AS latitude, {_LO} AS longitude FROM {D}")
def clean_coords(spark, sf):
    la, lo = C.clean_coordinates("latitude", "longitude")
    return dirty_customer(spark, sf).select("id", la.alias("latitude"), lo.alias("longitude"))


@query("clean_bool", sql=f"""
    SELECT id, {X.clean_bool('flag')} AS flag, {X.clean_bool('c_nationkey % 2')} AS nation_parity,
           {X.clean_bool('deleted')} AS deleted FROM {D}""")
def clean_bool(spark, sf):
    """CL-9 on text, on integers (0/1) and on booleans."""
    d = dirty_customer(spark, sf)
    return d.select("id", C.clean_boolean("flag").alias("flag"),
                    C.clean_boolean(F.col("c_nationkey") % 2).alias("nation_parity"),
                    C.clean_boolean("deleted").alias("deleted"))


@query("clean_padded", sql=f"""
    SELECT id, {X.padded('is_pkp', ['Y', 'N'])} AS is_pkp, {X.padded('is_bumn', ['Y', 'N'])} AS is_bumn,
           {X.padded('is_tax_free', ['Y', 'N'])} AS is_tax_free, {X.padded('is_pkp', [])} AS is_pkp_none FROM {D}""")
def clean_padded(spark, sf):
    d = dirty_customer(spark, sf)
    return d.select("id", *[C.clean_padded_char(c, ["Y", "N"]).alias(c) for c in ("is_pkp", "is_bumn", "is_tax_free")],
                    C.clean_padded_char("is_pkp", []).alias("is_pkp_none"))


@query("clean_location", sql=f"SELECT id, {X.location('city')} AS city FROM {D}")
def clean_location(spark, sf):
    return dirty_customer(spark, sf).select("id", C.clean_location("city").alias("city"))


@query("clean_supplier_names", sql=f"""
    SELECT s_suppkey, {X.clean_name('s_name')} AS s_name, {X.location('s_name')} AS s_location FROM supplier""")
def clean_supplier_names(spark, sf):
    """CL-5 and CL-11 over the supplier table's own names."""
    from sluice.catalog.registry import table

    s = table(spark, sf, "supplier")
    return s.select("s_suppkey", C.clean_name("s_name").alias("s_name"), C.clean_location("s_name").alias("s_location"))


# Numbers with and without prefixes, of several countries, too short and too long ones, from the customer's key.
_NUMBER = """CASE id % 12 WHEN 0 THEN '+62 812-' || lpad(K, 7, '0') WHEN 1 THEN '0812' || lpad(K, 8, '1') WHEN 2 THEN '(021) ' || lpad(K, 7, '5')
    WHEN 3 THEN '+65 6' || lpad(K, 7, '0') WHEN 4 THEN '0065 1800 ' || lpad(K, 7, '0') WHEN 5 THEN '+44 20 ' || lpad(K, 8, '7')
    WHEN 6 THEN '+1 212 ' || lpad(K, 6, '5') WHEN 7 THEN '812/' || lpad(K, 5, '0') WHEN 8 THEN '+62 800 ' || lpad(K, 12, '0')
    WHEN 9 THEN '+999 ' || lpad(K, 8, '0') WHEN 10 THEN 'abc' || K ELSE '0274.' || lpad(K, 6, '0') END"""
_PLAN_SQL = ", ".join(str(row) for row in N.PLAN)


@query("phone_numbering_plan", sql=f"""
    WITH plan(prefix, region, kind, code_digits, least, most) AS (VALUES {_PLAN_SQL}),
    d AS (SELECT c_custkey AS id, {_NUMBER.replace('id %', 'c_custkey %').replace('K', 'CAST(c_custkey AS VARCHAR)')} AS number FROM customer),
    s AS (SELECT id, number, replace(replace(replace(replace(replace(replace(number, ' ', ''), '(', ''), ')', ''), '.', ''), '-', ''), '/', '') AS t FROM d),
    e AS (SELECT id, number, CASE WHEN length(ltrim(t, '+')) = 0 OR length(translate(ltrim(t, '+'), '0123456789', '')) > 0 THEN NULL
                                  WHEN t[1] = '+' THEN t[2:] WHEN t[1:2] = '00' AND t[3] <> '0' THEN t[3:]
                                  WHEN t[1] = '0' THEN '62' || t[2:] WHEN t[1:2] = '62' THEN t ELSE '62' || t END AS e164 FROM s)
    SELECT e.id, e.number, e.e164 AS phone_e164, p.region AS phone_region, p.kind AS phone_kind,
           COALESCE(length(e.e164) - p.code_digits BETWEEN p.least AND p.most, false) AS phone_valid
    FROM e LEFT JOIN plan p ON starts_with(e.e164, p.prefix)
    QUALIFY row_number() OVER (PARTITION BY e.id ORDER BY length(p.prefix) DESC NULLS LAST) = 1""")
def phone_numbering_plan(spark, sf):
    """CL-2 / UD-1: each number's longest prefix in the numbering plan, its
    region and kind, and whether its length is one the plan allows."""
    text = _NUMBER.replace("id %", "c_custkey %").replace("K", "CAST(c_custkey AS STRING)")
    d = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.expr(text).alias("number"))
    return N.numbered(d, "number", N.plan(spark))

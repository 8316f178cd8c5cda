"""Per-table recipes (TP-1..TP-6) and the custom-transform registry (TR-9).

Recipes are data: each is a function of caller-named columns whose default
names are the reference's.  Every recipe is a single projection.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions import cleaners as C

# The reference's column names for each recipe.
INVOICE_ITEM_FLAGS = ("is_no_regular_discount", "is_embalace_item", "is_tax_1_applied", "is_tax_2_applied",
                      "is_tax_3_applied", "is_new_sku")
CUSTOMER_ADDRESS_GROUPS = (("address_1", "address_2", "address_3"), ("customer_tax_address_1", "customer_tax_address_2"))
CUSTOMER_PHONES = ("phone", "contact_phone")
CUSTOMER_NAMES = ("name", "contact_name", "customer_ktp_name", "customer_tax_name")
CUSTOMER_PADDED = ("is_bumn", "is_pkp", "is_tax_free")
YES_NO = ("Y", "N")
SELLING_TYPES = ("TO", "CV")
INVOICE_STATUSES = ("Done", "Process")
PRODUCT_STATUSES = ("A", "D")


def invoice_item(df: DataFrame, flags: Sequence[str] = INVOICE_ITEM_FLAGS) -> DataFrame:
    """TP-1: boolean cleaner on the six flag columns."""
    return df.withColumns({c: C.clean_boolean(c) for c in flags})


def phone_stages(column: str) -> list[dict]:
    """CL-1..3 for one phone column as three stacked projections:
    ``<c>_normalized``; then ``<c>_valid`` and ``<c>_normalized_valid``; then
    ``<c>_status`` (the reference's column order).  Each stage reads the
    previous stage's columns, so every regex runs once per row (Catalyst
    does not re-inline expensive expressions into a consumer that uses them
    more than once)."""
    norm = f"{column}_normalized"
    return [
        {norm: C.normalize_phone(column)},
        {f"{column}_valid": C.phone_is_valid(column), f"{norm}_valid": C.phone_is_valid(norm)},
        {f"{column}_status": C.phone_status(f"{column}_valid", f"{norm}_valid")},
    ]


def add_phone_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    stages = [phone_stages(c) for c in columns]
    for i in range(3):
        df = df.withColumns({k: v for st in stages for k, v in st[i].items()})
    return df


def customer(
    df: DataFrame,
    address_groups=CUSTOMER_ADDRESS_GROUPS,
    phones=CUSTOMER_PHONES,
    nik: str = "customer_nik",
    lat: str = "latitude",
    lon: str = "longitude",
    postal: str = "postal_code",
    names=CUSTOMER_NAMES,
    city: str = "city",
    padded=CUSTOMER_PADDED,
) -> DataFrame:
    """TP-2: addresses, phones, identity number, coordinates, postal code,
    names, city and padded flags, as one projection."""
    changes: dict = {}
    for group in address_groups:
        changes.update({c: C.address_part(c) for c in group})
    changes[nik] = C.clean_nik(nik)
    changes[lat], changes[lon] = C.clean_coordinates(lat, lon)
    changes[postal] = C.clean_postal_code(postal)
    for n in names:
        changes[n] = C.clean_name(n)
    changes[city] = C.clean_location(city)
    for p in padded:
        changes[p] = C.clean_padded_char(p, YES_NO)
    out = df.withColumns(changes)
    out = out.withColumns({c: e for g in address_groups for c, e in zip(g, C.drop_repeats(g))})
    return add_phone_columns(out, phones)


def invoice(df: DataFrame, selling_type: str = "selling_type", status: str = "status") -> DataFrame:
    """TP-3: selling type in {TO, CV}; status initcapped, the misspelling
    'Proccess' repaired, then kept only if Done or Process (any case)."""
    st = F.initcap(F.col(status))
    st = F.when(st == "Proccess", F.lit("Process")).otherwise(st)
    return df.withColumns({
        selling_type: C.clean_padded_char(selling_type, SELLING_TYPES),
        status: C.clean_padded_char(st, INVOICE_STATUSES),
    })


def distributor_product(df: DataFrame, status: str = "status") -> DataFrame:
    """TP-4: status NULL unless exactly 'A' or 'D'."""
    return df.withColumn(status, C.exact_values(status, PRODUCT_STATUSES))


def product(df: DataFrame, code: str = "principal_product_code") -> DataFrame:
    """TP-5: free-good and promo flags from the product code."""
    return df.withColumns({
        "is_free_good_item": C.code_flag(code, C.FREE_GOOD_MARKER),
        "is_promo_item": C.code_flag(code, C.PROMO_MARKER),
    })


def geo_tree(df: DataFrame) -> DataFrame:
    """TP-6: identity."""
    return df


CUSTOM_TRANSFORMS = {
    "invoice_item": invoice_item,
    "customer": customer,
    "invoice": invoice,
    "distributor_product": distributor_product,
    "product": product,
    "geo_tree": geo_tree,
}

"""Rule-step and recipe queries (TR-0..TR-10, PF-8, PF-9, TP-1..TP-6, UD-2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.catalog import sqlx as X
from sluice.catalog.dirty import dirty_customer, dirty_customer_sql
from sluice.catalog.registry import query, table
from sluice.plans import recipes as R
from sluice.plans.rules import apply_rules
from sluice.plans.spec import TableSpec

D = dirty_customer_sql()


def _run(df, **conf):
    return apply_rules(df, TableSpec.from_dict("t", conf))


@query("rule_one_to_zero", sql="""
    SELECT l_orderkey, CASE WHEN l_linenumber = 1 THEN 0 ELSE l_linenumber END AS l_linenumber,
           CASE WHEN l_quantity = 1 THEN 0 ELSE l_quantity END AS l_quantity FROM lineitem""")
def rule_one_to_zero(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return _run(li, transformation_order=["convert_one_to_zero"], convert_one_to_zero=["l_linenumber", "l_quantity"])


@query("rule_initcap", sql=f"""
    SELECT p_partkey, {X.initcap('p_name')} AS p_name, {X.initcap('p_type')} AS p_type FROM part""")
def rule_initcap(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_type")
    return _run(p, transformation_order=["initcap"], initcap=["p_name", "p_type"])


@query("rule_yn", sql=f"""
    SELECT id, {X.yn('is_pkp')} AS is_pkp, {X.yn('is_bumn')} AS is_bumn, {X.yn('flag')} AS flag FROM {D}""")
def rule_yn(spark, sf):
    d = dirty_customer(spark, sf).select("id", "is_pkp", "is_bumn", "flag")
    return _run(d, transformation_order=["convert_yn_to_boolean"], convert_yn_to_boolean=["is_pkp", "is_bumn", "flag"])


@query("rule_upper", sql="""
    SELECT p_partkey, upper(trim(p_name)) AS p_name, upper(trim(p_brand)) AS p_brand FROM part""")
def rule_upper(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    return _run(p, transformation_order=["upper"], upper=["p_name", "p_brand"])


@query("rule_zero_null", sql=f"""
    SELECT id, {X.zero_null_text('zero_text')} AS zero_text,
           CASE WHEN c_nationkey = 0 THEN NULL ELSE c_nationkey END AS c_nationkey FROM {D}""")
def rule_zero_null(spark, sf):
    d = dirty_customer(spark, sf).select("id", "zero_text", "c_nationkey")
    return _run(d, transformation_order=["convert_zero_to_null"], convert_zero_to_null=["zero_text", "c_nationkey"])


@query("rule_zero_null_numeric", sql="""
    SELECT l_orderkey, CASE WHEN l_discount = 0 THEN NULL ELSE l_discount END AS l_discount,
           CASE WHEN l_tax = 0 THEN NULL ELSE l_tax END AS l_tax FROM lineitem""")
def rule_zero_null_numeric(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_discount", "l_tax")
    return _run(li, transformation_order=["convert_zero_to_null"], convert_zero_to_null=["l_discount", "l_tax"])


_STRINGS = ["phone", "contact_phone", "name", "contact_name", "city", "address_1", "address_2", "zero_text"]


@query("rule_blank_null", sql="SELECT id, " + ", ".join(
    f"CASE WHEN trim({c}) = '' THEN NULL ELSE trim({c}) END AS {c}" for c in _STRINGS) + ", c_acctbal FROM " + D)
def rule_blank_null(spark, sf):
    d = dirty_customer(spark, sf).select("id", *_STRINGS, "c_acctbal")
    return _run(d, transformation_order=["convert_blank_to_null"], convert_blank_to_null=True)


@query("rule_rounding", sql=f"""
    SELECT l_orderkey, {X.round_dec('l_extendedprice', 2)} AS l_extendedprice, {X.round_dec('l_discount', 1)} AS l_discount,
           {X.round_dec('l_extendedprice * 1000', 2)} AS big_amount FROM lineitem""")
def rule_rounding(spark, sf):
    """TR-7, including values that overflow decimal(10,2) (-> NULL)."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount",
                                              (F.col("l_extendedprice") * 1000).alias("big_amount"))
    return _run(li, transformation_order=["rounding"],
                rounding={"l_extendedprice": 2, "l_discount": 1, "big_amount": 2})


@query("rule_scale", sql="""
    SELECT l_orderkey, CASE WHEN l_quantity > 5 THEN l_quantity / 100 ELSE l_quantity END AS l_quantity,
           CASE WHEN l_extendedprice > 25 THEN l_extendedprice / 1000 ELSE l_extendedprice END AS l_extendedprice
    FROM lineitem""")
def rule_scale(spark, sf):
    """DX-1: convert_scale_100 / convert_scale_1000 steps."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice")
    return _run(li, transformation_order=["convert_scale_100", "convert_scale_1000"],
                convert_scale_100=["l_quantity"], convert_scale_1000=["l_extendedprice"])


@query("keep_rename", sql="""
    SELECT p_partkey AS id, p_name AS product_name, p_retailprice AS price FROM part""")
def keep_rename(spark, sf):
    """PF-9 then PF-8: sequential renames (one chained, one missing) and kept
    columns in registry order."""
    p = table(spark, sf, "part")
    return _run(p, transformation_order=["rename_columns", "keep_columns"],
                rename_columns={"p_partkey": "id", "p_name": "name_tmp", "name_tmp": "product_name",
                                "p_retailprice": "price", "no_such_column": "x"},
                keep_columns={"id": "bigint", "product_name": "string", "price": "double"})


_SEQ_SQL = f"""
    SELECT id,
      upper(CASE WHEN trim(name) = '' THEN NULL ELSE trim(name) END) AS customer_name,
      {X.yn("CASE WHEN trim(is_pkp) = '' THEN NULL ELSE trim(is_pkp) END")} AS is_pkp,
      {X.round_dec('c_acctbal', 1)} AS c_acctbal,
      CASE WHEN c_nationkey = 1 THEN 0 ELSE c_nationkey END AS c_nationkey
    FROM {D}"""


@query("rule_sequence", sql=_SEQ_SQL)
def rule_sequence(spark, sf):
    """TR-0: several steps in listed order (blank -> rename -> upper -> y/n ->
    one-to-zero -> rounding -> keep); listed steps without settings are no-ops."""
    spec = TableSpec.from_dict("customer", {
        "transformation_order": ["convert_blank_to_null", "rename_columns", "upper", "convert_yn_to_boolean",
                                 "convert_one_to_zero", "initcap", "rounding", "keep_columns"],
        "convert_blank_to_null": True,
        "rename_columns": {"name": "customer_name"},
        "upper": ["customer_name"],
        "convert_yn_to_boolean": ["is_pkp"],
        "convert_one_to_zero": ["c_nationkey"],
        "rounding": {"c_acctbal": 1},
        "keep_columns": {"id": "bigint", "customer_name": "string", "is_pkp": "boolean",
                         "c_acctbal": "decimal(10,1)", "c_nationkey": "int"},
    })
    return apply_rules(dirty_customer(spark, sf), spec)


# Product codes derived from part so both flags and NULL codes occur.
_CODE = ("CASE p_partkey % 5 WHEN 0 THEN 'FG-' || p_brand WHEN 1 THEN 'prm-' || p_type WHEN 2 THEN 'x' || p_brand || 'PRM' "
         "WHEN 3 THEN NULL ELSE 'fg' || p_type END")


@query("rule_custom", sql=f"""
    SELECT p_partkey, code AS principal_product_code,
      CASE WHEN contains(code, 'FG') THEN 'Y' ELSE 'N' END AS is_free_good_item,
      CASE WHEN contains(code, 'PRM') THEN 'Y' ELSE 'N' END AS is_promo_item
    FROM (SELECT p_partkey, {_CODE} AS code FROM part)""")
def rule_custom(spark, sf):
    """TR-9 / UD-2: a named custom table transform run by the rule runner."""
    p = table(spark, sf, "part").selectExpr("p_partkey", f"{_CODE} AS principal_product_code")
    return _run(p, transformation_order=["custom_table_transform"], custom_table_transform="product")


_FLAG_SRC = {
    "is_no_regular_discount": "CASE l_returnflag WHEN 'R' THEN 'Y' WHEN 'A' THEN ' yes ' ELSE 'no' END",
    "is_embalace_item": "CASE l_linestatus WHEN 'O' THEN 'TRUE' ELSE '0' END",
    "is_tax_1_applied": "CASE WHEN l_tax > 0.04 THEN '1' WHEN l_tax = 0 THEN NULL ELSE 'N' END",
    "is_tax_2_applied": "CASE WHEN l_discount > 0.05 THEN 'yes' ELSE 'maybe' END",
    "is_tax_3_applied": "CASE l_linenumber % 3 WHEN 0 THEN 'false' WHEN 1 THEN 'True ' ELSE '' END",
    "is_new_sku": "CASE WHEN l_quantity > 25 THEN 'y' ELSE 'F' END",
}
_ITEMS = "(SELECT l_orderkey, l_linenumber, " + ", ".join(f"{e} AS {n}" for n, e in _FLAG_SRC.items()) + " FROM lineitem)"


@query("recipe_invoice_item", sql="SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"{X.clean_bool(n)} AS {n}" for n in _FLAG_SRC) + " FROM " + _ITEMS)
def recipe_invoice_item(spark, sf):
    li = table(spark, sf, "lineitem").selectExpr("l_orderkey", "l_linenumber",
                                                 *[f"{e} AS {n}" for n, e in _FLAG_SRC.items()])
    return R.invoice_item(li)


def _customer_sql() -> str:
    cols = ["id"]
    cols += [f"{e} AS {n}" for e, n in zip(X.address(["address_1", "address_2", "address_3"]),
                                            ["address_1", "address_2", "address_3"])]
    cols += [f"{e} AS {n}" for e, n in zip(X.address(["customer_tax_address_1", "customer_tax_address_2"]),
                                            ["customer_tax_address_1", "customer_tax_address_2"])]
    for p in ("phone", "contact_phone"):
        cols.append(f"{p}")
        cols.append(f"{X.normalize_phone(p)} AS {p}_normalized")
        cols.append(f"{X.phone_valid(p)} AS {p}_valid")
        cols.append(f"{X.phone_valid(X.normalize_phone(p))} AS {p}_normalized_valid")
        cols.append(f"{X.phone_status(X.phone_valid(p), X.phone_valid(X.normalize_phone(p)))} AS {p}_status")
    cols.append(f"{X.clean_nik('customer_nik')} AS customer_nik")
    la, lo = X.coords("latitude", "longitude")
    cols += [f"{la} AS latitude", f"{lo} AS longitude", f"{X.clean_postal('postal_code')} AS postal_code"]
    cols += [f"{X.clean_name(n)} AS {n}" for n in ("name", "contact_name", "customer_ktp_name", "customer_tax_name")]
    cols.append(f"{X.location('city')} AS city")
    cols += [f"{X.padded(n, ['Y', 'N'])} AS {n}" for n in ("is_bumn", "is_pkp", "is_tax_free")]
    return "SELECT " + ",\n  ".join(cols) + f" FROM {D}"


_CUSTOMER_OUT = ["id", "address_1", "address_2", "address_3", "customer_tax_address_1", "customer_tax_address_2",
                 "phone", "phone_normalized", "phone_valid", "phone_normalized_valid", "phone_status",
                 "contact_phone", "contact_phone_normalized", "contact_phone_valid", "contact_phone_normalized_valid",
                 "contact_phone_status", "customer_nik", "latitude", "longitude", "postal_code", "name",
                 "contact_name", "customer_ktp_name", "customer_tax_name", "city", "is_bumn", "is_pkp", "is_tax_free"]


@query("recipe_customer", sql=_customer_sql())
def recipe_customer(spark, sf):
    return R.customer(dirty_customer(spark, sf)).select(*_CUSTOMER_OUT)


_INVOICE = ("(SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'TO' WHEN 1 THEN 'cv' WHEN 2 THEN 'XX' ELSE 'TO ' END "
            "AS selling_type, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'proccess' ELSE 'PENDING' END AS status "
            "FROM orders)")


@query("recipe_invoice", sql=f"""
    SELECT o_orderkey, {X.padded('selling_type', ['TO', 'CV'])} AS selling_type,
      {X.padded(f"CASE WHEN {X.initcap('status')} = 'Proccess' THEN 'Process' ELSE {X.initcap('status')} END", ['Done', 'Process'])} AS status
    FROM {_INVOICE}""")
def recipe_invoice(spark, sf):
    o = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "CASE o_orderkey % 4 WHEN 0 THEN 'TO' WHEN 1 THEN 'cv' WHEN 2 THEN 'XX' ELSE 'TO ' END AS selling_type",
        "CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'proccess' ELSE 'PENDING' END AS status")
    return R.invoice(o)


_STATUS = "CASE p_size % 5 WHEN 0 THEN 'A' WHEN 1 THEN 'D' WHEN 2 THEN 'a' WHEN 3 THEN NULL ELSE 'A ' END"


@query("recipe_distributor_product", sql=f"""
    SELECT p_partkey, CASE WHEN s IN ('A', 'D') THEN s END AS status FROM (SELECT p_partkey, {_STATUS} AS s FROM part)""")
def recipe_distributor_product(spark, sf):
    p = table(spark, sf, "part").selectExpr("p_partkey", f"{_STATUS} AS status")
    return R.distributor_product(p)


@query("recipe_product", sql=f"""
    SELECT p_partkey, p_name, code AS principal_product_code,
      CASE WHEN contains(code, 'FG') THEN 'Y' ELSE 'N' END AS is_free_good_item,
      CASE WHEN contains(code, 'PRM') THEN 'Y' ELSE 'N' END AS is_promo_item
    FROM (SELECT p_partkey, p_name, {_CODE} AS code FROM part)""")
def recipe_product(spark, sf):
    p = table(spark, sf, "part").selectExpr("p_partkey", "p_name", f"{_CODE} AS principal_product_code")
    return R.product(p)


@query("recipe_geo", sql="""
    SELECT c.c_custkey AS geo_id, n.n_name AS nation, r.r_name AS region
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""")
def recipe_geo(spark, sf):
    """TP-6 (identity) over a geo tree: each customer's location with its
    nation and region."""
    c, n, r = table(spark, sf, "customer"), table(spark, sf, "nation"), table(spark, sf, "region")
    tree = (c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
            .select(F.col("c_custkey").alias("geo_id"), F.col("n_name").alias("nation"), F.col("r_name").alias("region")))
    return R.geo_tree(tree)

"""Phone validity by a numbering plan (CL-2, UD-1): longest-prefix match.

A plan is a table of prefixes of international numbers with the least and the
greatest number of digits behind the country code.  A number is brought to
its international digits; its prefixes are looked up in the plan longest first,
one equi-join per prefix length (a plan has a handful of lengths), and the
longest entry found decides.  The plan is broadcast after its size is
checked; a larger one is left to Spark's own choice of join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.common import text

HOME = "62"
#: Plan entries up to which the plan is broadcast.
BROADCAST_ENTRIES = 100_000
PLAN_DDL = "prefix string, region string, kind string, code_digits int, least int, most int"
# Prefix of the international number, region, kind, digits of the country code, least and
# most digits behind it (public numbering plans).
PLAN = [
    ("1", "NANP", "any", 1, 10, 10), ("7", "RU", "any", 1, 10, 10), ("20", "EG", "any", 2, 8, 10), ("27", "ZA", "any", 2, 9, 9),
    ("30", "GR", "any", 2, 10, 10), ("31", "NL", "any", 2, 9, 9), ("32", "BE", "any", 2, 8, 9), ("33", "FR", "any", 2, 9, 9),
    ("34", "ES", "any", 2, 9, 9), ("36", "HU", "any", 2, 8, 9), ("39", "IT", "any", 2, 6, 11), ("40", "RO", "any", 2, 9, 9),
    ("41", "CH", "any", 2, 9, 9), ("43", "AT", "any", 2, 4, 13), ("44", "GB", "any", 2, 7, 10), ("45", "DK", "any", 2, 8, 8),
    ("46", "SE", "any", 2, 7, 10), ("47", "NO", "any", 2, 8, 8), ("48", "PL", "any", 2, 9, 9), ("49", "DE", "any", 2, 6, 13),
    ("51", "PE", "any", 2, 8, 9), ("52", "MX", "any", 2, 10, 10), ("54", "AR", "any", 2, 10, 11), ("55", "BR", "any", 2, 10, 11),
    ("56", "CL", "any", 2, 9, 9), ("57", "CO", "any", 2, 10, 10), ("60", "MY", "any", 2, 8, 10), ("61", "AU", "any", 2, 9, 9),
    ("622", "ID", "fixed", 2, 8, 10), ("623", "ID", "fixed", 2, 8, 10), ("624", "ID", "fixed", 2, 8, 10), ("625", "ID", "fixed", 2, 8, 10),
    ("626", "ID", "fixed", 2, 8, 10), ("627", "ID", "fixed", 2, 8, 10), ("629", "ID", "fixed", 2, 8, 10), ("6221", "ID", "fixed", 2, 9, 10),
    ("6222", "ID", "fixed", 2, 9, 10), ("6224", "ID", "fixed", 2, 9, 10), ("6231", "ID", "fixed", 2, 9, 10), ("6261", "ID", "fixed", 2, 9, 10),
    ("6281", "ID", "mobile", 2, 9, 12), ("6282", "ID", "mobile", 2, 9, 12), ("6283", "ID", "mobile", 2, 9, 12), ("6285", "ID", "mobile", 2, 9, 12),
    ("6287", "ID", "mobile", 2, 9, 12), ("6288", "ID", "mobile", 2, 9, 12), ("6289", "ID", "mobile", 2, 9, 12), ("62800", "ID", "toll free", 2, 8, 14),
    ("62809", "ID", "premium", 2, 8, 13), ("63", "PH", "any", 2, 8, 10), ("64", "NZ", "any", 2, 8, 10), ("65", "SG", "any", 2, 8, 8),
    ("651800", "SG", "toll free", 2, 11, 11), ("66", "TH", "any", 2, 8, 9), ("81", "JP", "any", 2, 9, 10), ("82", "KR", "any", 2, 8, 11),
    ("84", "VN", "any", 2, 9, 10), ("86", "CN", "any", 2, 10, 11), ("90", "TR", "any", 2, 10, 10), ("91", "IN", "any", 2, 10, 10),
    ("92", "PK", "any", 2, 9, 10), ("94", "LK", "any", 2, 9, 9), ("95", "MM", "any", 2, 7, 10), ("98", "IR", "any", 2, 10, 10),
    ("670", "TL", "any", 3, 7, 8), ("673", "BN", "any", 3, 7, 7), ("852", "HK", "any", 3, 8, 8), ("853", "MO", "any", 3, 8, 8),
    ("855", "KH", "any", 3, 8, 9), ("856", "LA", "any", 3, 8, 10), ("880", "BD", "any", 3, 8, 10), ("886", "TW", "any", 3, 8, 9),
    ("965", "KW", "any", 3, 8, 8), ("966", "SA", "any", 3, 9, 9), ("968", "OM", "any", 3, 8, 8), ("971", "AE", "any", 3, 8, 9),
    ("974", "QA", "any", 3, 8, 8),
]


def plan(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PLAN, PLAN_DDL)


def international(c, home: str = HOME) -> Column:
    """Digits of the international number: ``+cc`` and ``00cc`` name their country; any other number is the home
    country's, with its code, a leading 0 or neither.  NULL for text with other than digits and separators."""
    s = F.regexp_replace(text(c), r"[\s().\-/]", "")
    plain = F.regexp_replace(s, "^00(?=[1-9])", "+")  # one mark for both
    own = F.concat(F.lit(home), F.regexp_replace(plain, f"^(0|{home})", ""))
    return F.when(plain.rlike(r"^\+[1-9][0-9]*$"), F.substring(plain, 2, 64)).when(plain.rlike(r"^[0-9]+$"), own)


def numbered(df: DataFrame, column: str, entries: DataFrame, out: str = "phone", home: str = HOME) -> DataFrame:
    """``df`` with ``<out>_e164`` (digits), ``<out>_region``, ``<out>_kind`` and ``<out>_valid`` (never NULL).

    ``entries`` has the columns of ``PLAN_DDL``, one row per prefix."""
    sizes = sorted((r[0] for r in entries.select(F.length("prefix")).distinct().collect()), reverse=True)  # a few lengths
    small = entries.limit(BROADCAST_ENTRIES + 1).count() <= BROADCAST_ENTRIES
    digits, found = f"__{out}_digits", []
    j = df.withColumn(digits, international(column, home))
    for n in sizes:
        name = f"__{out}_{n}"
        side = entries.where(F.length("prefix") == n).select(F.col("prefix").alias(f"{name}_p"), F.struct(
            "region", "kind", "code_digits", "least", "most").alias(name))
        j = j.join(F.broadcast(side) if small else side, F.substring(digits, 1, n) == F.col(f"{name}_p"), "left")
        found.append(F.col(name))
    best = F.coalesce(*found) if found else F.lit(None).cast("struct<region:string,kind:string,code_digits:int,least:int,most:int>")
    j = j.withColumn(f"__{out}_best", best)
    b, behind = F.col(f"__{out}_best"), F.length(digits) - F.col(f"__{out}_best.code_digits")
    return j.select(*df.columns, F.col(digits).alias(f"{out}_e164"), b["region"].alias(f"{out}_region"), b["kind"].alias(f"{out}_kind"),
                    F.coalesce(behind.between(b["least"], b["most"]), F.lit(False)).alias(f"{out}_valid"))

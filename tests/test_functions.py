"""Column expressions on hand-made rows."""

from pyspark.sql import functions as F

from cdrflow.functions.cleaning import normalize_technology, voice_product
from cdrflow.functions.msisdn import is_valid_msisdn

# One valid and one wrong-length example per number plan.
NUMBERS = [
    ("212612345678", True), ("21261234567", False),
    ("212712345678", True), ("212812345678", False),
    ("12025550123", True), ("1202555012", False),
    ("447911123456", True), ("44791112345", False),
    ("4915112345678", True), ("491511234567", False),
    ("61412345678", True), ("6141234567", False),
    ("8613812345678", True), ("861381234567", False),
    ("919812345678", True), ("91981234567", False),
    ("351912345678", True), ("35191234567", False),
    ("5511912345678", True), ("551191234567", False),
    ("32471234567", True), ("3247123456", False),
    ("905321234567", True), ("90532123456", False),
    ("UNK", False), ("junk", False), ("X00000012345", False),
]


def _eval(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_number_plans(spark):
    got = _eval(spark, [(n,) for n, _ in NUMBERS], "n string", is_valid_msisdn("n"))
    assert got == [ok for _, ok in NUMBERS]


def test_empty_number_compat_vs_strict_and_null(spark):
    rows = [("",), (None,)]
    assert _eval(spark, rows, "n string", is_valid_msisdn("n", "compat")) == [True, None]
    assert _eval(spark, rows, "n string", is_valid_msisdn("n", "strict")) == [False, None]


def test_technology_normalisation(spark):
    rows = [(t,) for t in ["2G", "3G", "4G", "5G", "LTE", "NR", "UMTS", None, "WIFI"]]
    got = _eval(spark, rows, "t string", normalize_technology(F.col("t")))
    assert got == ["2G", "3G", "4G", "5G", "4G", "5G", "3G", "4G", "WIFI"]


def test_voice_product(spark):
    rows = [("UNK",), ("212612345678",), ("447911123456",), ("",), ("2127",)]
    got = _eval(spark, rows, "c string", voice_product(F.col("c")))
    assert got == ["VOICE_NAT", "VOICE_NAT", "VOICE_INT", "VOICE_INT", "VOICE_NAT"]

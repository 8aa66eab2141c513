import pytest
from pyspark.sql import functions as F

from tesserae.functions import text as X

GOLDEN = [
    ("normal", "Société  Générale", "societe generale"), ("normal", "A&B/C-D", "a and b c d"), ("normal", "O'Neil \"X\" (Y), Z!", "oneil x y z"),
    ("normal", "œuvre", "œuvre"), ("normal", "ﬁn", "fin"), ("normal", "it’s", "it’s"), ("name", "Acme Corp.", "acme corp"), ("name", "A.B. Foods", "a.b foods"),
    ("core", "Acme Solutions Private Limited", "acme solutions"), ("core", "Google LLC", "google"), ("core", "SBI Co. Ltd", "sbi"),
    ("core", "Foo S.A.R.L", "foo r.l"), ("core", "AS Roma", "roma"), ("address", "12, M.G. Road, Bengaluru", "12 m.g. road bengaluru"),
    ("address", "No 5 MG Rd Apt 3", "number 5 mg road apartment 3"), ("signature", "560001 x 12 y 101", "101-560001"), ("normal", "", ""), ("core", "Ltd", ""),
]


def test_golden_rows(spark):
    kinds = {
        "normal": lambda c: X.normal(c), "name": lambda c: X.plain_name(X.normal(c)), "core": lambda c: X.core_name(X.plain_name(X.normal(c))),
        "address": lambda c: X.expand_address(X.normal(c)), "signature": lambda c: X.number_signature(c),
    }
    rows = spark.createDataFrame([(i, k, a, b) for i, (k, a, b) in enumerate(GOLDEN)], "i int, kind string, given string, wanted string")
    made = F.lit(None).cast("string")
    for k, f in kinds.items():
        made = F.when(F.col("kind") == k, f(F.col("given"))).otherwise(made)
    for r in rows.withColumn("got", made).collect():
        assert r["got"] == r["wanted"], r


def test_clean_keeps_rows_and_handles_nulls(spark):
    raw = spark.createDataFrame([("S1-1", None, None, None), ("S1-2", " A ", "1 St", "FR")], "entity_id string, business_name string, business_address string, country string")
    rows = {r["entity_id"]: r for r in X.clean(raw).collect()}
    assert rows["S1-1"]["business_name_core"] == "" and rows["S1-1"]["name_missing"] == 1 and rows["S1-2"]["business_address_norm"] == "1 street"


@pytest.mark.parametrize("text,wanted", [("१२ a 345", ["१२", "345"])])
def test_numbers_are_unicode(spark, text, wanted):
    assert spark.createDataFrame([(text,)], "t string").select(X.numbers(F.col("t"))).first()[0] == wanted

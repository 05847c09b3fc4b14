"""Golden cases of the column functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import checksum, ordered, scalar


def one(spark, column, **values):
    cols = [F.lit(v).alias(k) if v is not None else F.lit(None).cast("string").alias(k) for k, v in values.items()]
    return spark.range(1).select(*cols or ["id"]).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "first,last,want",
    [("John", "Doe", "John Doe"), ("John", None, "John"), (None, "Doe", "Doe"), (None, None, ""), ("", "Doe", "Doe")],
)
def test_full_name(spark, first, last, want):
    assert one(spark, scalar.full_name("f", "l", ""), f=first, l=last) == want


def test_full_name_default(spark):
    assert one(spark, scalar.full_name("f", "l"), f=None, l="") == "Unknown"


@pytest.mark.parametrize(
    "city,state,country,want",
    [
        ("Springfield", "IL", "USA", "Springfield, IL, USA"),
        ("Springfield", None, "USA", "Springfield, USA"),
        (None, None, None, ""),
    ],
)
def test_location(spark, city, state, country, want):
    assert one(spark, scalar.location("a", "b", "c", ""), a=city, b=state, c=country) == want


def test_casts(spark):
    assert one(spark, scalar.to_int("v"), v="123") == 123
    assert one(spark, scalar.to_float("v"), v="1500.50") == 1500.5
    assert one(spark, scalar.to_bool("v"), v="true") is True
    assert one(spark, scalar.to_bool("v"), v="no") is False
    assert one(spark, scalar.to_bool("v"), v=None) is None
    assert one(spark, scalar.to_int("v"), v="abc") is None


def test_clean_text(spark):
    assert one(spark, scalar.title_case("v"), v="bronze") == "Bronze"
    assert one(spark, scalar.clean_email("v"), v="  John@Example.COM ") == "john@example.com"


@pytest.mark.parametrize("code,want", [("c", "INSERT"), ("u", "UPDATE"), ("d", "DELETE"), ("r", "READ"), ("x", "UNKNOWN")])
def test_op_names(spark, code, want):
    assert one(spark, scalar.op_name("v"), v=code) == want
    if code == "r":
        assert one(spark, scalar.op_name("v", "SNAPSHOT"), v=code) == "SNAPSHOT"


def test_mask_email(spark):
    import hashlib

    want = "user_" + hashlib.md5(b"a@b.c").hexdigest()[:8] + "@masked.com"
    assert one(spark, scalar.mask_email("v"), v="a@b.c") == want
    assert one(spark, scalar.mask_email("v"), v=None) is None
    assert one(spark, scalar.mask_email("v"), v="") is None
    assert one(spark, scalar.mask_partial("v"), v="1234567890") == "******7890"
    assert one(spark, scalar.mask_partial("v"), v="12") == "12"


@pytest.mark.parametrize(
    "size,want",
    [(0, "0.00 B"), (1023, "1023.00 B"), (1024, "1.00 KB"), (1536, "1.50 KB"), (1024**2, "1.00 MB"), (5 * 1024**3, "5.00 GB"),
     (1024**5, "1.00 PB"), (2000 * 1024**5, "2000.00 PB"), (49792, "48.62 KB")],
)
def test_human_bytes(spark, size, want):
    assert one(spark, scalar.human_bytes("v"), v=size) == want


def test_any_timestamp(spark):
    at = dt.datetime(2024, 1, 15, 10, 30, 0, 250000)
    millis = int(at.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert one(spark, scalar.any_timestamp("v").cast("timestamp_ntz"), v=str(millis)) == at
    assert one(spark, scalar.any_timestamp("v").cast("timestamp_ntz"), v="2024-01-15T10:30:00.25") == at
    assert one(spark, scalar.any_timestamp("v"), v="soon") is None


def test_iso_text_round_trip(spark):
    text = "2024-01-15T10:30:00.000250"
    assert one(spark, scalar.iso_text(scalar.iso_timestamp("v")), v=text) == text
    assert one(spark, scalar.iso_date("v"), v="2024-02-30") is None
    assert one(spark, scalar.iso_date("v"), v="2024-02-29") == dt.date(2024, 2, 29)


TEXTS = ["", "back\\slash", "emoji 🎉", "x" * 100_000, "line\nbreak", '{"a": {"b": [1, 2]}}']


@pytest.mark.parametrize("text", TEXTS)
def test_texts_survive_json(spark, text):
    back = F.from_json(F.to_json(F.struct("v")), "v string")["v"]
    assert one(spark, back, v=text) == text


def test_row_checksum_tells_null_from_empty(spark):
    d = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "x", None)], "id int, a string, b string")
    got = [r[0] for r in d.orderBy("id").select(checksum.row_checksum(["a", "b"])).collect()]
    assert len(set(got)) == 3
    hashes = [r[0] for r in d.orderBy("id").select(checksum.row_hash(["a", "b"])).collect()]
    assert len(set(hashes)) == 3


@pytest.mark.parametrize("algorithm", checksum.ALGORITHMS)
def test_checksum_algorithms(spark, algorithm):
    a, b = (one(spark, checksum.row_checksum(["v"], algorithm), v=t) for t in ("one", "two"))
    assert a != b and int(a, 16) >= 0


def test_checksum_columns_exclude(spark):
    d = spark.createDataFrame([(1, 2, 3)], "b int, created_at int, a int")
    assert checksum.checksum_columns(d) == ["a", "b"]
    assert checksum.checksum_columns(d, exclude=[]) == ["a", "b", "created_at"]


def skewed(spark, n=6000):
    """A third of all rows belong to key 0; order numbers are unique, one value in five is null."""
    i = F.col("id")
    return spark.range(n).select(
        F.when(i % 3 == 0, 0).otherwise(F.xxhash64(i) % 40).alias("k"),
        F.pmod(i * 7919, F.lit(n)).alias("o"),
        F.when(i % 5 != 0, i).alias("v"),
    )


@pytest.mark.parametrize("width", [1, 50, 999, 10_000])
def test_bucketed_scan_equals_plain_window(spark, width):
    d = skewed(spark)
    steps = {
        "p": ordered.prior(F.col("v")),
        "t": ordered.total(F.coalesce("v", F.lit(0))),
        "n": ordered.position(),
        "l": ordered.known(F.col("v")),
    }
    plain = ordered.scan(d, ["k"], ["o"], steps)
    cut = ordered.scan(d, ["k"], ["o"], steps, ordered.range_bucket("o", width))
    assert cut.count() == 6000
    assert plain.exceptAll(cut).count() == 0 and cut.exceptAll(plain).count() == 0


@pytest.mark.parametrize("hot", [0, 300, 10**6])
def test_only_hot_keys_are_cut(spark, hot):
    d = skewed(spark)
    cut = ordered.split_hot(d, ["k"], ordered.range_bucket("o", 100), "b", hot)
    assert cut.count() == 6000 and {r.k for r in cut.filter("b is not null").select("k").distinct().collect()} == {
        r.k for r in ordered.hot_keys(d, ["k"], hot).collect()}
    steps = {"p": ordered.prior(F.col("v")), "n": ordered.position()}
    plain = ordered.scan(d, ["k"], ["o"], steps)
    got = ordered.scan(cut, ["k"], ["o"], steps, "b").drop("b")
    assert plain.exceptAll(got).isEmpty() and got.exceptAll(plain).isEmpty()


def test_scan_without_keys(spark):
    d = skewed(spark, 1000)
    with pytest.raises(ValueError):
        ordered.row_position(d, [], ["o"], "n")
    got = ordered.row_position(d, [], ["o"], "n", ordered.range_bucket("o", 37))
    assert got.filter(F.col("n") != F.col("o") + 1).count() == 0


import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import scalar
from tidemark.functions.base58 import base58, decode, encode, from_base58


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@given(st.binary(max_size=40))
def test_base58_round_trip(raw):
    assert decode(encode(raw)) == raw


def test_base58_known_values(spark):
    assert encode(bytes(32)) == "1" * 32 and encode(b"hello") == "Cn8eVZg"
    df = spark.createDataFrame([(b"hello",), (bytes(2),), (None,)], "k binary")
    assert [r[0] for r in df.select(base58("k")).collect()] == ["Cn8eVZg", "11", None]
    texts = spark.createDataFrame([("Cn8eVZg",), ("0OIl",), (None,)], "t string")
    assert [r[0] and bytes(r[0]) for r in texts.select(from_base58("t")).collect()] == [b"hello", None, None]


@pytest.mark.parametrize("n", [0, 1, 255, 258, 2**31, 2**63, 2**64 - 1, 0xA9C3, 0xBFEFBFEF])
def test_u64_round_trip(spark, n):
    value = F.lit(str(n)).cast("decimal(20,0)")
    assert int(one(spark, scalar.u_le(scalar.to_u64_le(value), 0, 8))) == n


def test_cut_off_integer_is_null(spark):
    assert one(spark, scalar.u_le(F.unhex(F.lit("0102")), 0, 4)) is None
    assert one(spark, scalar.key_or_null(F.unhex(F.lit("0000")))) is None
    assert one(spark, F.hex(scalar.key_or_null(F.unhex(F.lit("0010"))))) == "0010"


@pytest.mark.parametrize("seconds,text", [(0.0, "00:00:00"), (3661.1, "01:01:02"), (float("nan"), "unknown"), (-1.0, "unknown"), (float("inf"), "unknown")])
def test_duration(spark, seconds, text):
    assert scalar.duration(seconds) == text
    assert one(spark, scalar.duration_text(F.lit(seconds))) == text
    assert one(spark, scalar.duration_text(F.lit(None).cast("double"))) == "unknown"


def test_texts(spark):
    assert one(spark, scalar.readable_size(F.lit(1536))) == "1.50 KiB" and one(spark, scalar.readable_size(F.lit(7))) == "7.00 B" and one(spark, scalar.readable_size(F.lit(2**62))) == "4.00 EiB"
    assert one(spark, scalar.sorting_key(F.lit("(`owner`, \"pubkey\")"))) == "owner,pubkey"
    assert one(spark, scalar.align8(F.lit(9))) == 16 and one(spark, scalar.minus_saturating(F.lit(5), 9)) == 0
    assert one(spark, scalar.percent(F.lit(1), F.lit(0))) is None and one(spark, scalar.percent(F.lit(1), F.lit(4))) == 25.0
    assert [one(spark, scalar.state_label(F.lit(k))) for k in range(4)] == ["uninitialized", "initialized", "frozen", None]


@pytest.mark.parametrize("name,want", [("7.9", (7, 9)), ("007.9", (7, 9)), ("7.9.tmp", None), ("a.9", None), ("99999999999999999999.1", None), ("", None)])
def test_storage_names(spark, name, want):
    got = one(spark, scalar.storage_name(F.lit(name), 1)), one(spark, scalar.storage_name(F.lit(name), 2))
    assert got == want if want else None in got

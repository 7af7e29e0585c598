import json
import struct

import pytest
from pyspark.sql import functions as F

from tests import fixtures as fx
from tidemark.functions import decoders as D


def decoded(spark, data, how):
    row = spark.createDataFrame([(data,)], "data binary").select(how(F.col("data")).alias("x")).first()[0]
    return row and row.asDict()


def test_token_account(spark):
    got = decoded(spark, fx.account("m", "w", 2**64 - 1, "d", 2, 5, "c"), D.plain_account)
    assert (bytes(got["mint"]), bytes(got["owner"]), int(got["amount"])) == (fx.key("m"), fx.key("w"), 2**64 - 1)
    assert (bytes(got["delegate"]), got["state"], int(got["delegated_amount"]), bytes(got["close_authority"]), got["rent_reserve"]) == (fx.key("d"), 2, 5, fx.key("c"), None)
    assert decoded(spark, fx.account("m", "w", 1), D.plain_account)["delegate"] is None


@pytest.mark.parametrize("data", [bytes(165), fx.account("m", "w", 1, state=0), fx.account("m", "w", 1, state=3), fx.account("m", "w", 1)[:-1], fx.account("m", "w", 1) + b"\0", b"", fx.account("m", "w", 1)[:72] + b"\x02" + fx.account("m", "w", 1)[73:]])
def test_no_token_account(spark, data):
    assert decoded(spark, data, D.plain_account) is None


def test_mint(spark):
    got = decoded(spark, fx.mint(42000, 6, "a"), D.plain_mint)
    assert (int(got["supply"]), got["decimals"], got["is_initialized"], bytes(got["mint_authority"]), got["freeze_authority"]) == (42000, 6, True, fx.key("a"), None)
    assert decoded(spark, fx.mint(1, 1, ready=0), D.plain_mint) is None and decoded(spark, bytes(82), D.plain_mint) is None


def test_extended_layouts(spark):
    account = fx.account("m", "w", 987654)
    assert int(decoded(spark, account + b"\x02" + fx.tlv((0xFFFF, b"zz")), D.extended_account)["amount"]) == 987654
    assert decoded(spark, account + b"\x01", D.extended_account) is None
    assert decoded(spark, (account + b"\x02" + bytes(200))[:355], D.extended_account) is None
    minted = fx.extended_mint(fx.mint(42000, 6), (18, bytes(64)))
    assert int(decoded(spark, minted, D.extended_mint)["supply"]) == 42000 and decoded(spark, minted, D.extended_account) is None
    assert decoded(spark, minted[:100] + b"\x07" + minted[101:], D.extended_mint) is None


def fee() -> bytes:
    return fx.key("a") + bytes(32) + struct.pack("<QQQH", 0, 3, 2**64 - 1, 7) + struct.pack("<QQH", 9, 2**64 - 2, 8)


def test_eight_extensions_in_physical_order():
    entries = [(18, fx.key("p") + fx.key("q")), (20, b"abc"), (1, fee()), (6, b"\x02"), (9, b""), (14, bytes(32) + fx.key("h")), (12, bytes(32)), (3, fx.key("c")), (19, fx.metadata_value(None, "m", "Näme", "S", "u")), (1, bytes(108))]
    text, metadata, warnings = D.extensions(bytes(166) + fx.tlv(*entries) + bytes(4))
    got = json.loads(text)
    assert [x["extension"] for x in got] == ["metadataPointer", "transferFeeConfig", "defaultAccountState", "nonTransferable", "transferHook", "permanentDelegate", "mintCloseAuthority", "tokenMetadata"]
    assert got[0]["state"] == {"authority": fx.name("p")} and got[3]["state"] == {} and got[5]["state"] == {"delegate": None}
    assert got[1]["state"]["olderTransferFee"] == {"epoch": 3, "maximumFee": 2**64 - 1, "transferFeeBasisPoints": 7}
    assert got[1]["state"]["newerTransferFee"] == {"maximumFee": 2**64 - 2, "transferFeeBasisPoints": 8}
    assert got[4]["state"] == {"authority": None, "programId": fx.name("h")} and got[2]["state"] == {"accountState": "frozen"}
    assert metadata["name"] == "Näme" and metadata["update_authority"] is None and not warnings


def test_bad_value_is_a_warning_and_a_cut_off_list_an_error(spark):
    good = bytes(166) + fx.tlv((3, b"x"), (9, b""))
    text, _, warnings = D.extensions(good)
    assert [x["extension"] for x in json.loads(text)] == ["nonTransferable"] and len(warnings) == 1
    bad = bytes(166) + struct.pack("<HH", 14, 64) + bytes(8)
    with pytest.raises(D.Malformed):
        D.extensions(bad)
    df = spark.createDataFrame([(good,), (bad,), (bytes(10),)], "data binary").select(D.mint_extensions("data").alias("x")).select("x.failed", "x.extensions")
    assert [tuple(r) for r in df.collect()][1:] == [(True, None), (False, "[]")]


def test_metadata_values(spark):
    assert D.metadata_value(fx.metadata_value("a", "m", "N", "S", "u", [("k", "v")]))["update_authority"] == fx.name("a")
    with pytest.raises(D.Malformed):
        D.metadata_value(fx.metadata_value(None, "m", "N", "S", "u")[:-4] + struct.pack("<I", 1))
    with pytest.raises(D.Malformed):
        D.metadata_value(bytes(64) + struct.pack("<I", 2) + b"\xff\xfe" + bytes(20))
    df = spark.createDataFrame([(fx.metadata_value(None, "m", "N", "S", "u"),), (b"zz",), (None,)], "data binary")
    assert [r[0] for r in df.select(D.standalone_metadata("data")["mint"]).collect()] == [fx.name("m"), None, None]


def test_program_metadata(spark):
    tail = b"\1\xff" + b"\1\x04\0\0"
    got = D.program_metadata(fx.program_metadata("a", "m", "N", "S", "u", 250, ["c1", "c2"], False, tail))
    assert got["creators"] == [fx.name("c1"), fx.name("c2")] and got["seller_fee_basis_points"] == 250 and not got["is_mutable"] and got["token_standard"] == 4
    assert D.program_metadata(fx.program_metadata("a", "m", "N", "S", "u"))["token_standard"] is None
    assert D.program_metadata(b"") is None and D.program_metadata(b"\x06xx") is None
    rows = [(fx.program_metadata("a", "m", "N", "S", "u", 1, None, True, tail),), (b"\x04cut",)]
    out = spark.createDataFrame(rows, "data binary").select(D.metadata_account("data").alias("x")).select("x.*").collect()
    assert out[0]["mint"] == fx.name("m") and out[0]["token_standard"] == 4 and out[0]["creators"] == [] and out[1]["mint"] is None

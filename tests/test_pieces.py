from decimal import Decimal

import pytest

from tidemark.plans import catalogue
from tidemark.sources import records


@pytest.fixture(scope="module")
def accounts(spark):
    rows = [(k % 3, k % 2, 1000 - k, bytes([k % 251]) * 32, Decimal(k), Decimal(0), bytes(32), k % 5 == 0, bytes([7]) * 32, k % 40, bytes(k % 40)) for k in range(600)]
    return spark.createDataFrame(rows, records.RECORD_SCHEMA)


def test_pieces_of_a_file_are_the_file_in_bounded_parts(spark, accounts):
    whole = {(r.slot, r.file_id): bytes(r.content) for r in records.encode(accounts).collect()}
    pieces = records.encode_pieces(accounts, 1000).collect()
    assert len(pieces) > 5 * len(whole) and all(r.valid_len == len(r.content) < 1000 + 200 for r in pieces)
    made = {}
    for r in sorted(pieces, key=lambda r: r.start):
        assert r.start == len(made.get((r.slot, r.file_id), b""))
        made[r.slot, r.file_id] = made.get((r.slot, r.file_id), b"") + bytes(r.content)
    assert made == whole
    want = sorted(map(tuple, records.decode(records.encode(accounts)).collect()))
    assert sorted(map(tuple, records.decode(records.encode_pieces(accounts, 1000)).collect())) == want
    assert sorted(map(tuple, records.through_files(accounts, 1000).collect())) == want and len(want) == 600
    parted = sorted(map(tuple, records.through_files(accounts, 1000, 30).collect()))
    without = lambda rows: sorted((r[:2], *r[3:]) for r in rows)
    assert without(parted) == without(want) and sum(r[2] == 0 for r in parted) > 2 * len(whole)


def test_no_query_holds_a_storage_file_of_a_checkpoint_whole(spark, monkeypatch):
    monkeypatch.setattr(records, "encode", lambda rows: pytest.fail("a file of the whole delta is one value"))
    got = catalogue.QUERIES["checkpoint_incremental_balances"](spark, "/root/testdata/sf0.001")
    assert got.count() > 0

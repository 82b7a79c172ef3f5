"""Scratch folders go with their scope."""

import os

import pytest

from skuflow.config import scratch_path, scratch_scope
from skuflow.operators.changelog import item_changelog
from skuflow.sources.messages import events_messages
from skuflow.sources.codec import decode_transactions

SF = "/root/testdata/sf0.001"


def made(spark, name, keep=False):
    path = scratch_path(spark, name, keep)
    spark.range(3).write.parquet(path)
    return path


def test_scratch_goes_at_the_end_of_its_scope(spark):
    before = made(spark, "t-outside")
    with scratch_scope(spark):
        a = made(spark, "t-scope")
        with scratch_scope(spark):
            b, kept = made(spark, "t-inner"), made(spark, "t-kept", keep=True)
            scratch_path(spark, "t-never-written")
        assert not os.path.exists(b) and os.path.exists(kept) and os.path.exists(a)
        assert spark.read.parquet(kept).count() == 3
    assert not os.path.exists(a) and not os.path.exists(kept) and os.path.exists(before)
    assert os.path.exists(made(spark, "t-after"))


def test_scratch_goes_after_an_error_too(spark):
    with pytest.raises(RuntimeError), scratch_scope(spark):
        a = made(spark, "t-error")
        raise RuntimeError
    assert not os.path.exists(a)
    with scratch_scope(spark):
        kept = made(spark, "t-outermost", keep=True)   # no scope around: it stays
    assert os.path.exists(kept)


def test_a_changelog_collected_in_its_scope_leaves_nothing(spark):
    root = os.path.dirname(scratch_path(spark, "t"))
    os.makedirs(root, exist_ok=True)
    held = set(os.listdir(root))
    tx = decode_transactions(events_messages(spark, SF), "permissive", keep=("partition", "offset"))
    with scratch_scope(spark):
        rows = item_changelog(tx.where("sku is not null"), order=["offset", "partition"]).count()
        assert set(os.listdir(root)) - held
    assert rows > 0 and set(os.listdir(root)) == held

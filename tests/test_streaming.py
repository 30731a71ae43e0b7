import datetime as dt
import os

from hearth.plans import families as fam
from hearth.plans import specs as S
from hearth.sinks import read_table
from hearth.streaming import landed_csv_stream, incremental_load
from tests.test_families import _inventory_file


def test_incremental_inventory_stream(spark, tmpdir_path):
    landing, target, ckpt = f"{tmpdir_path}/landing", f"{tmpdir_path}/T", f"{tmpdir_path}/ckpt"
    _inventory_file(f"{landing}/a.csv", 202401)
    header = open(f"{landing}/a.csv", encoding="utf-8").readline().lstrip("﻿").strip().split(",")
    geo = S.INVENTORY_GEOGRAPHIES["zip"]
    run = dt.datetime(2025, 1, 15, 6, 30)

    def load():
        stream = landed_csv_stream(spark, landing, header)
        q = incremental_load(stream, lambda b: fam.inventory_transform(b, geo, run), target, "month_date_yyyymm", ckpt)
        q.awaitTermination(120)

    load()
    assert read_table(spark, target).count() == 2
    _inventory_file(f"{landing}/b.csv", 202402)
    load()                                   # only the new file is read
    assert sorted(r.month_date_yyyymm for r in read_table(spark, target).collect()) == [202401, 202401, 202402, 202402]
    load()                                   # nothing new: unchanged
    assert read_table(spark, target).count() == 4
    assert os.path.isdir(ckpt)

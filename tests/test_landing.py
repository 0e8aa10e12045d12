"""The landing zone as a data source: drops, skipped files, streams that go on."""

import json
import os
import zlib

from pyspark.sql import functions as F

from walletscope.sources import landing
from walletscope.streaming import runs


def pages(spark, wallets, lts, size=5):
    """A page per ``size`` lts of each wallet."""
    rows = [("ton", "tonapi", w, json.dumps({"transactions": [
        {"lt": lt, "hash": f"{w}-{lt}", "utime": lt} for lt in lts[i:i + size]]}))
        for w in wallets for i in range(0, len(lts), size)]
    return spark.createDataFrame(rows, landing.PAGE_FILE)


def found(df):
    return sorted((r.address, r.last_lt) for r in df.collect())


def opened(root, **filters):
    """The files that a read with these filters would open."""
    reader = landing.PageReader(root)
    list(reader.pushFilters([landing.EqualTo((k,), v) for k, v in filters.items() if k != "after"]
                            + [landing.GreaterThan(("last_lt",), v) for k, v in filters.items() if k == "after"]))
    return reader.partitions()


def test_a_wallet_opens_one_bucket_per_drop(spark, tmp_path):
    root, wallets = str(tmp_path), [f"0:{i:03}" for i in range(200)]
    for drop in range(3):
        landing.land(pages(spark, wallets, list(range(drop * 100, drop * 100 + 10))), root, drop, buckets=16)
    every, mine = opened(root), opened(root, chain="ton", address="0:007", provider="tonapi")
    bucket = f"bucket={zlib.crc32(b'ton:0:007:tonapi') % 16}/"
    assert mine and all(bucket in f.path for f in mine)
    assert {f.path for f in mine} == {f.path for f in every if bucket in f.path} and len(mine) * 8 < len(every)
    assert len(opened(root, address="0:007")) == len(every)  # a part of the key is no key
    got = landing.fetch_after(spark, root, "ton", "0:007", "tonapi", 103)
    assert [r.lt for r in got.collect()] == [*range(104, 110), *range(200, 210)]
    assert [r.lt for r in landing.fetch_after(spark, root, "ton", "0:007", "tonapi", None, limit=3).collect()] == [0, 1, 2]
    assert landing.fetch_after(spark, root, "ton", "0:007", "other", 0).count() == 0


def test_a_read_by_cursor_reads_later_pages_only(spark, tmp_path):
    root = str(tmp_path)
    landing.land(pages(spark, ["0:1"], list(range(100))), root, 0)
    read = [b for f in opened(root, after=89) for b in landing._pages(root, f)]
    assert sum(b.num_rows for b in read) == 2
    assert found(landing.read_landed(spark, root).where("last_lt >= 94")) == [("0:1", 94), ("0:1", 99)]


def test_a_hot_wallet_is_cut_into_several_files(spark, tmp_path):
    root = str(tmp_path)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as if the drop were large
    landing.land(pages(spark, ["0:hot"], list(range(4000)), size=1), root, 0)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(opened(root)) > 1
    assert landing.read_landed(spark, root).agg(F.countDistinct("last_lt")).first()[0] == 4000


def test_drops_count_when_whole_and_once(spark, tmp_path):
    root = str(tmp_path)
    assert landing.read_landed(spark, f"{root}/nothing").count() == 0
    landing.land(pages(spark, ["0:1"], [1]), root, 0)
    landing.land(pages(spark, ["0:2"], [2]), root, 1)
    os.remove(f"{root}/{landing._folder(1)}/_SUCCESS")  # as if the job had died
    assert found(landing.read_landed(spark, root)) == [("0:1", 1)]
    landing.land(pages(spark, ["0:2"], [3]), root, 1)
    landing.land(pages(spark, ["0:9"], [9]), root, 0)
    assert found(landing.read_landed(spark, root)) == [("0:1", 1), ("0:2", 3)]


def test_odd_pages_are_kept(spark, tmp_path):
    root = str(tmp_path)
    rows = [("ton", None, "0:1", "{broken"), (None, None, None, None), ("ton", "tonapi", "0:1", '{"transactions":[]}'),
            ("ton", "tonapi", "0:1", '{"transactions":[]}')]
    landing.land(spark.createDataFrame(rows, landing.PAGE_FILE).withColumn("bucket", F.lit("own")), root, 0)
    landing.land(spark.createDataFrame([], landing.PAGE_FILE), root, 1)
    back = landing.read_landed(spark, root)
    assert sorted(map(repr, back.drop("last_lt").collect())) == sorted(
        map(repr, spark.createDataFrame(rows, landing.PAGE_FILE).collect()))
    assert back.where("last_lt is not null").count() == 0


def test_stream_goes_on_and_waits_for_missing_drops(spark, tmp_path):
    root, out, log = (str(tmp_path / n) for n in ("zone", "out", "log"))

    def run():
        runs.append_available(landing.stream_landed(spark, root), out, log)
        return found(spark.read.schema(landing.PAGE).parquet(out))

    landing.land(pages(spark, ["0:1"], [1]), root, 0)
    landing.land(pages(spark, ["0:3"], [3]), root, 2)
    assert run() == [("0:1", 1)]
    assert run() == [("0:1", 1)]
    landing.land(pages(spark, ["0:2"], [2]), root, 1)
    assert run() == [("0:1", 1), ("0:2", 2), ("0:3", 3)]

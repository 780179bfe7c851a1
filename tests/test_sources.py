import hashlib
import io
import zipfile

import pandas as pd
import pytest
from series import collected, frame, walk
from pyspark.sql import functions as F

from seriesmill.sources import catalogue as cat, feeds, klines, storage
from seriesmill.streaming import ingest

ROW = "{t},1.5,2.5,0.5,2.0,10.0,{c},20.0,3,5.0,6.0,0"


def archive(path, text, members=("k.csv",)):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for m in members:
            z.writestr(zipfile.ZipInfo(m), text)
    path.write_bytes(out.getvalue())
    return out.getvalue()


def test_archive_variants(spark, tmp_path):
    ms, us = 1_704_067_200_000, 1_735_689_600_000_000
    archive(tmp_path / "plain.zip", "\n".join(ROW.format(t=ms + k, c=ms + k + 1) for k in range(3)))
    header = "Open Time,open,high,low,close,volume,close_time,quote_volume,count,taker_buy_volume,taker_buy_quote_volume,ignore\n"
    archive(tmp_path / "short.zip", header + ROW.format(t=us, c=us + 1000))
    got = klines.expand_archives(klines.read_archives(spark, str(tmp_path))).toPandas()
    assert sorted(got.open_time) == [ms, ms + 1, ms + 2, us // 1000]
    assert set(got.number_of_trades) == {3} and set(got.taker_buy_quote_asset_volume) == {6.0}


def test_bad_archives_fail(spark, tmp_path):
    archive(tmp_path / "two.zip", ROW.format(t=1, c=2), ("a.csv", "b.csv"))
    with pytest.raises(Exception, match="exactly one CSV"):
        klines.expand_archives(klines.read_archives(spark, str(tmp_path))).collect()


def test_bad_number_fails(spark, tmp_path):
    (tmp_path / "x.csv").write_text(ROW.format(t="oops", c=2))
    with pytest.raises(Exception, match="oops"):
        klines.read_klines(spark, [str(tmp_path / "x.csv")]).collect()


def test_header_must_be_complete(spark, tmp_path):
    (tmp_path / "x.csv").write_text("open_time,open\n1,2\n")
    with pytest.raises(Exception, match="header missing columns"):
        klines.read_klines(spark, [str(tmp_path / "x.csv")]).collect()


def test_each_file_has_its_own_header(spark, tmp_path):
    names = list(klines.KLINE_TYPES)
    values = dict(zip(names, ["1", "1", "4", "0.5", "2", "10", "2", "20", "3", "5", "6", "0"]))
    for k, order in enumerate([names, names[::-1], [names[0], *sorted(names[1:])]]):
        (tmp_path / f"{k}.csv").write_text(",".join(order) + "\n" + ",".join(values[c] for c in order) + "\n")
    (tmp_path / "3.csv").write_text(",".join(values.values()) + "\n")
    (tmp_path / "4.csv").write_text("\ufeff" + ",".join(names).replace("quote_asset_volume", "quote_volume", 1) + "\n")
    got = klines.read_klines(spark, [str(tmp_path)]).drop("file").distinct().collect()
    assert len(got) == 1 and (got[0].open, got[0].high, got[0].low, got[0].close) == (1.0, 4.0, 0.5, 2.0)


def test_an_increment_keeps_what_is_stored(spark, tmp_path):
    path, pdf = str(tmp_path / "bars"), walk(24 * 70, 3)
    assert storage.merge_bars(frame(spark, pdf.iloc[:24 * 40]), path) == 2
    assert storage.merge_bars(frame(spark, pdf.iloc[24 * 40:]), path) == 2  # the rest of February, and March
    changed = pdf.iloc[24 * 65:24 * 66].assign(close=1.0)
    assert storage.merge_bars(frame(spark, changed), path) == 1
    assert storage.merge_bars(frame(spark, changed).where("false"), path) == 0
    got = storage.read_bars(spark, path).toPandas().sort_values("ts")
    assert len(got) == len(pdf) and (got.close == 1.0).sum() == 24


def test_backfill_in_any_order_is_kept(spark, tmp_path):
    bars = frame(spark, walk(24 * 150, 4))
    path, table = str(tmp_path / "in"), str(tmp_path / "out")
    for month in (5, 4, 1, 3, 2, 1):
        bars.where(F.month("ts") == month).coalesce(1).write.mode("append").parquet(path)
    ingest.ingest_bars(ingest.bar_stream(spark, path, bars.schema, 1), table, str(tmp_path / "marks")).awaitTermination()
    assert storage.read_bars(spark, table).count() == 24 * 150


def test_rows_beyond_the_lateness_fail(spark, tmp_path):
    bars = frame(spark, walk(24 * 150, 4))
    path = str(tmp_path / "in")
    for month in (5, 4, 1):
        bars.where(F.month("ts") == month).coalesce(1).write.mode("append").parquet(path)
    with pytest.raises(RuntimeError, match="later than the watermark"):
        ingest.drain(ingest.distinct_bars(ingest.bar_stream(spark, path, bars.schema, 1)), spark)


@pytest.mark.parametrize("kind", ["bigint", "timestamp", "int"])
def test_order_key_of_signed_ids(spark, kind):
    from seriesmill.sources.ticks import order_key
    times = (-(10 ** 18) * 5, 0, 1, 2) if kind == "bigint" else (-7, 0, 1, 2)
    rows = [(t, i) for t in times for i in (-(2 ** 63), -81 * 10 ** 17, 0, 81 * 10 ** 17, 2 ** 63 - 1)]
    first = F.timestamp_micros("a") if kind == "timestamp" else F.col("a").cast(kind)
    df = spark.createDataFrame(rows, "a bigint, b bigint").withColumn("t", first)
    assert [(r.a, r.b) for r in df.orderBy(order_key(df, ("t", "b"))).collect()] == sorted(rows)


def test_two_writers_of_one_version(spark, tmp_path, monkeypatch):
    path, base = str(tmp_path / "t"), frame(spark, walk(5, 1))
    storage.upsert(spark, path, base, ["symbol", "ts"])
    monkeypatch.setattr(storage, "latest_version", lambda *_: None)  # the second writer has not seen the first
    with pytest.raises(RuntimeError, match="another writer"):
        storage.upsert(spark, path, base, ["symbol", "ts"])


def test_checksum_audit(spark, tmp_path):
    good = archive(tmp_path / "good.zip", "1")
    archive(tmp_path / "bad.zip", "2")
    archive(tmp_path / "none.zip", "3")
    files = klines.read_archives(spark, str(tmp_path)).withColumn("path", F.element_at(F.split("path", "/"), -1))
    manifest = spark.createDataFrame([("good.zip", f"{hashlib.sha256(good).hexdigest().upper()}  good.zip\n"), ("bad.zip", "00  bad.zip")], "path string, body string")
    got = {r.path: r.status for r in klines.audit_checksums(files, manifest).collect()}
    assert got == {"good.zip": "verified", "bad.zip": "mismatch", "none.zip": "absent"}


def test_upsert_is_idempotent(spark, tmp_path):
    base = frame(spark, walk(50, 1))
    keys, path = ["symbol", "ts"], str(tmp_path / "t")
    storage.upsert(spark, path, base, keys)
    newer = base.limit(50).withColumn("close", F.col("close") + 1).where("volume > 50")
    first = storage.upsert(spark, path, newer, keys)
    once = collected(spark.read.parquet(first))
    again = collected(spark.read.parquet(storage.upsert(spark, path, newer, keys)))
    pd.testing.assert_frame_equal(once[sorted(once)], again[sorted(again)])
    assert len(once) == 50


def test_half_written_version_is_ignored(spark, tmp_path):
    path = str(tmp_path / "t")
    done = storage.upsert(spark, path, frame(spark, walk(5, 1)), ["symbol", "ts"])
    (tmp_path / "t" / "v=00000009").mkdir()
    assert storage.latest_version(spark, path).endswith(done.rsplit("/", 1)[1])


def test_partition_pruning_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "bars")
    storage.write_bars(frame(spark, pd.concat([walk(30, 1, "A"), walk(30, 2, "B")])), path)
    df = storage.read_bars(spark, path, ["close"], symbol="A")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "symbol" in plan.split("PartitionFilters")[1].split("\n")[0]
    assert "volume" not in plan.split("ReadSchema")[1]
    assert df.count() == 30


def test_gaps_and_estimate_agree(spark):
    from seriesmill.plans.blocks import Layout
    pdf = walk(100, 1).drop(index=[10, 11, 50])
    df = frame(spark, pdf)
    w = cat.watermarks(df)
    assert w.select(cat.missing_estimate(F.col("first_ts"), F.col("last_ts"), F.col("rows"), F.col("timeframe"))).first()[0] == 3
    found = cat.gaps(df, Layout(step_ms=3_600_000, rows=20, bucket_steps=30)).toPandas()
    assert sorted(found.missing) == [1, 2]


def test_unknown_timeframe_fails(spark):
    from seriesmill.functions.scalar import timeframe_ms
    with pytest.raises(Exception, match="Unsupported timeframe"):
        spark.range(1).select(timeframe_ms(F.lit("7m"))).collect()


def test_feed_with_bad_values(spark):
    lines = spark.createDataFrame([('[{"fundingTime": 1000, "fundingRate": "x", "markPrice": "2"}, {"fundingTime": 2000, "fundingRate": "0.1"}]',)], "value string")
    got = feeds.funding_events(lines).toPandas().sort_values("ts")
    assert got.funding_rate.isna().tolist() == [True, False] and got.mark_price.isna().tolist() == [False, True]


def test_redelivered_stream_equals_batch(spark, tmp_path):
    bars = frame(spark, pd.concat([walk(80, 1, "A"), walk(40, 2, "B")]))
    path = str(tmp_path / "in")
    for part in (bars, bars.where("volume > 30"), bars.where("symbol = 'A'")):
        part.write.mode("append").parquet(path)
    stream = ingest.bar_stream(spark, path, bars.schema, 1)
    got = collected(ingest.drain(ingest.distinct_bars(stream), spark))
    want = collected(bars)
    pd.testing.assert_frame_equal(got[["symbol", "ts", "close"]], want[["symbol", "ts", "close"]])

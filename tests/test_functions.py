"""Column functions against plain Python and fixed expectations."""

import hashlib
import random
import struct
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from tagloom import functions as fn

UTC = timezone.utc


def utc(text):
    return datetime.fromisoformat(text.replace("Z", "+00:00")).astimezone(UTC)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def ts(text):
    return F.lit(text).cast("timestamp")


def test_event_id_fixed_value(spark):
    key = fn.event_id(F.lit("site1"), F.lit("sinusoid"), ts("2026-08-26T23:50:00Z"))
    assert one(spark, key) == "5e281c2f64e9ddfd67af8bc6b29a399c"


def test_event_id_same_instant_in_two_offsets(spark):
    a = fn.event_id(F.lit("s"), F.lit("T"), ts("2026-08-30T00:00:00Z"))
    b = fn.event_id(F.lit("s"), F.lit("T"), ts("2026-08-29T21:00:00-03:00"))
    assert one(spark, a) == one(spark, b)


def test_event_id_null_part_is_null(spark):
    assert one(spark, fn.event_id(F.lit(None).cast("string"), F.lit("T"), ts("2026-08-30T00:00:00Z"))) is None


def test_event_id_random_instants(spark):
    rng = random.Random(1)
    rows = []
    for i in range(500):
        micros = rng.choice([0, 1, 100000, 120000, 999999, rng.randrange(10**6)])
        at = datetime(1975, 1, 1, tzinfo=UTC) + timedelta(seconds=rng.randrange(2 * 10**9), microseconds=micros)
        rows.append((f"s{i % 3}", f"TÁG|{i}", at.isoformat()))
    df = spark.createDataFrame(rows, "site string, tag string, iso string")
    got = df.withColumn("ts", F.col("iso").cast("timestamp")).select(
        "*", fn.event_id("site", "tag", "ts").alias("k"), fn.iso_utc("ts").alias("t"), fn.iso_zulu("ts").alias("z")
    )
    for r in got.collect():
        assert r.t == r.iso and r.z == r.iso.replace("+00:00", "Z")
        assert r.k == hashlib.md5(f"{r.site}|{r.tag}|{r.iso}".encode()).hexdigest()


def test_value_text_matches_python(spark):
    rng = random.Random(2)
    values = [0.0, -0.0, 1.0, -1.0, 1e7, 12345678.0, 1e15, 1e16, 1.5e-5, 1e-4, 9.999e-5, 0.001, 123456789.125,
              float("nan"), float("inf"), float("-inf"), 1e22, 5e-300, 1.7976931348623157e308, 0.1 + 0.2, 100.0,
              1234567.1, 2e-3, 9999999.999, 10000000.001, 999999999999999.9, None, 9.5e15, 9999999999999998.0, 1e21, 1e23, 9.999999999999999e22,
              5e-324, 2e-44, 1.2345e-7, 1e-5, -2.5e-10, 123456789012345680.0, 2.0**100]
    values += [round(rng.uniform(-500, 500), 2) for _ in range(2000)]
    values += [rng.uniform(-1, 1) * 10 ** rng.randrange(-4, 16) for _ in range(6000)]
    values += [struct.unpack("f", struct.pack("f", rng.uniform(-1000, 1000)))[0] for _ in range(4000)]
    values += [rng.uniform(0.001, 1) ** rng.randrange(1, 3) * 10 ** rng.randrange(0, 7) for _ in range(20000)]
    values += [rng.uniform(-1, 1) * 10 ** rng.randrange(16, 34) for _ in range(6000)]
    values = [v for v in values if v is None or v != v or v == 0 or not 1e-5 > abs(v) > 1e-290 or len(repr(v)) < 14]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", fn.value_text("v").alias("t"))
    wrong = [(r.v, r.t) for r in got.collect() if r.t != (None if r.v is None else str(r.v))]
    assert wrong == []


def test_decode_fixed_values(spark):
    df = spark.createDataFrame([(-131087,), (-327689,), (0,), (10,), (-2147483648,), (None,)], "i int").select(
        "i", fn.digital_code("i"), fn.digital_set_id("i"), fn.digital_state_id("i")
    )
    got = {r[0]: tuple(r[1:]) for r in df.collect()}
    assert got[-131087] == (-131087, 2, 15)
    assert got[-327689] == (-327689, 5, 9)
    assert got[-2147483648] == (-2147483648, 32768, 0)
    assert got[0] == got[10] == got[None] == (None, None, None)


def test_decode_random(spark):
    rng = random.Random(3)
    codes = [rng.randrange(-(2**31), 2**31) for _ in range(1000)]
    df = spark.createDataFrame([(c,) for c in codes], "i bigint").select(
        "i", fn.digital_set_id("i").alias("s"), fn.digital_state_id("i").alias("t")
    )
    for r in df.collect():
        want = (None, None) if r.i >= 0 else ((abs(r.i) >> 16) & 0xFFFF, abs(r.i) & 0xFFFF)
        assert (r.s, r.t) == want


@pytest.mark.parametrize("text", [
    "2026-08-26T00:00:00Z", "2026-08-26T00:00:00", "2026-08-26 10:11:12.5", "2026-08-26T10:11:12.123456-03:00",
    "2026-08-26", "2026-08-26T10", "2026-08-26T10:11", "2026-08-26T10:11+0530", "2026-08-26T10:11:12+05",
    "20260826T101112", "20260826T101112.25Z", "2026-08-26T10:11:12,5", "2026-08-26T10:11:12.1234567",
    "2018-11-04T00:30:00", "2018-02-17T23:30:00", "2026-08-26T10:11:12+05:30:15",
])
@pytest.mark.parametrize("zone", ["America/Sao_Paulo", "UTC"])
def test_parse_timestamp_good(spark, text, zone):
    want = datetime.fromisoformat(text.replace("Z", "+00:00"))
    want = (want if want.tzinfo else want.replace(tzinfo=ZoneInfo(zone))).astimezone(UTC)
    got = one(spark, fn.iso_utc(fn.parse_timestamp(F.lit(text), zone)))
    assert got == want.isoformat()


@pytest.mark.parametrize("text", ["", "bad", "2026", "2026-08", "2026-13-01", "2026-02-30T00:00:00", "10:00:00",
                                  "2026-08-26T25:00:00", " 2026-08-26", "2026-08-26T10:11:12 America/Sao_Paulo", None])
def test_parse_timestamp_bad_is_null(spark, text):
    assert one(spark, fn.parse_timestamp(F.lit(text).cast("string"), "America/Sao_Paulo")) is None


def test_floor_to_interval(spark):
    for text, n in [("2026-08-30T18:52:59.9Z", 60), ("2026-08-30T18:52:00Z", 300), ("1969-12-31T23:59:01Z", 60)]:
        at = utc(text)
        epoch = int(at.timestamp())
        want = datetime.fromtimestamp(epoch - epoch % n, tz=UTC).isoformat()
        assert one(spark, fn.iso_utc(fn.floor_to_interval(ts(text), n))) == want
    with pytest.raises(ValueError):
        fn.floor_to_interval("x", 0)


def test_source_local_text(spark):
    assert one(spark, fn.source_local_text(ts("2026-08-30T18:47:00Z"), "America/Sao_Paulo")) == "30-Aug-26 15:47:00"


def test_partition_date(spark):
    assert str(one(spark, fn.partition_date(ts("2026-08-26T23:50:00Z")))) == "2026-08-26"


def test_tag_and_number_cleaning(spark):
    assert one(spark, fn.normalise_tag(F.lit("\t flowRate \n"))) == "FLOWRATE"
    assert one(spark, fn.safe_int(F.lit(1.9))) == 1
    assert one(spark, fn.safe_int(F.lit(-1.9))) == -1
    assert one(spark, fn.safe_int(F.lit("12"))) == 12
    assert one(spark, fn.safe_int(F.lit("1.9"))) is None
    assert one(spark, fn.safe_int(F.lit("x"))) is None
    assert one(spark, fn.server_key(F.lit("Hist-A"))) == "hist-a"


def test_state_name_bytes(spark):
    rows = [(bytearray("Válvula ".encode("utf-8")), "Válvula"), (bytearray("Fechada ç".encode("latin-1")), "Fechada ç"),
            (bytearray(b"  "), None), (None, None)]
    df = spark.createDataFrame(rows, "raw binary, want string").select("want", fn.decode_state_name("raw").alias("got"))
    for r in df.collect():
        assert r.got == r.want



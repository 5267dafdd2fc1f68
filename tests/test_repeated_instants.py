"""Registered queries where a tag has two readings at one instant, which share an event id."""

import pytest
from compare import difference, duck
from pyspark.sql import functions as F

from conftest import TESTDATA
from tagloom.plans.oracles import ORACLES
from tagloom.plans.queries import QUERIES

RAW = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
DIGITAL, FAILED, GOOD, BETTER = 20, 18, 21, 22  # numbers in props that make such a reading


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The smallest table; three of its instants with more readings of the same tag."""
    path = str(tmp_path_factory.mktemp("repeated"))
    raw = spark.read.schema(RAW).parquet(f"{TESTDATA}/sf0.001/events.parquet").where("event_id < 200")
    more = raw.where("event_id IN (10, 70, 130)").crossJoin(
        spark.createDataFrame([(1, DIGITAL, 1.0), (2, FAILED, 900.0), (3, GOOD, 7.5), (4, BETTER, 8.5)], "n long, k long, v double"))
    more = more.select((F.col("event_id") * 10 + 1000 + F.col("n")).alias("event_id"), "ts", "user_id", "event_type",
                       F.col("v").alias("value"), F.concat(F.lit('{"k": '), F.col("k").cast("string"), F.lit("}")).alias("props"))
    raw.where("event_id NOT IN (10, 70, 130)").unionByName(more).coalesce(1).write.parquet(f"{path}/events.parquet")
    return path


@pytest.fixture(scope="module")
def con(folder):
    made = duck(TESTDATA)
    made.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{folder}/events.parquet/*.parquet')")
    return made


def test_incomplete_events_equal_the_oracle(spark, folder, con):
    assert difference(QUERIES["q35_rejected_events"](spark, folder), con, ORACLES["q35_rejected_events"]) is None


@pytest.mark.parametrize("name", ["q17_merge", "q17_merge_all_columns"])
def test_merge_stages_one_reading_of_an_instant(spark, folder, name):
    rows = QUERIES[name](spark, folder).where("event_id IS NOT NULL").toPandas()
    assert rows.event_id.nunique() == 3 * 200  # stored, retired and forty days later
    per_id = rows.groupby("event_id").agg(n=("tag", "size"), values=("value", lambda v: v.nunique(dropna=False)), late=("timestamp", "max"))
    repeated = per_id[per_id.n > 1]
    # Stored plainly: all four, of a retired tag as they were, of a live one as the merge has them.
    assert sorted(repeated.n) == [4] * 6 and sorted(repeated["values"])[:3] == [1, 1, 1] and max(repeated.late) < "2024-02-01"


@pytest.mark.parametrize("name", ["q39_retention_after_merge", "q40_overwrite_after_merge"])
def test_tables_after_a_merge_hold_an_instant_once(spark, folder, name, monkeypatch):
    from tagloom.plans import queries

    monkeypatch.setattr(queries, "KEEP_DAYS", 60)
    rows = QUERIES[name](spark, folder).toPandas()
    if name.startswith("q39"):
        assert rows.n_events.sum() == 200 and (rows.n_folders == 1).all()
    else:
        assert rows.event_id.value_counts().max() == 1


def test_files_of_a_micro_batch_follow_the_rows(spark, monkeypatch):
    """A file of a stream is the work of one task, so a larger table is more files, not larger ones."""
    from tagloom.plans import queries
    from tagloom.session import scratch_path

    places, batches = [], []
    monkeypatch.setattr(queries, "scratch_path", lambda s, name: places.append(scratch_path(s, name)) or places[-1])
    monkeypatch.setattr(queries, "FILE_ROWS", 50)
    stream = queries._event_stream(spark, f"{TESTDATA}/sf0.001")
    queries._run(stream, lambda df, n: batches.append(df.count()), scratch_path(spark, "offsets"))
    assert len(spark.read.parquet(places[0]).inputFiles()) == 4 * 5 and batches == [250] * 4


#: The merge's pick among readings of one id: its order first, then the other columns, nulls last.
PICK = ", ".join(f"{c} DESC NULLS LAST" for c in (
    "quality", "value", "point_id", "value_type", "digital_code", "digital_set_id", "digital_state_id", "digital_state_name", "raw_istat"))


def once(rows, sql, before, after):
    """``sql`` with one row per id of ``rows``, where it reads them as ``before rows after``."""
    assert sql.count(f"{before}{rows}{after}") == 1
    picked = f"(SELECT * FROM {rows} QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY {PICK}) = 1)"
    return sql.replace(f"{before}{rows}{after}", f"{before}{picked}{after}")


@pytest.mark.parametrize("name", ["q17_merge", "q17_merge_all_columns"])
def test_merge_equals_its_sql_with_one_staged_reading_of_an_instant(spark, folder, con, name):
    sql = once("staging", ORACLES[name], "FULL OUTER JOIN ", " s ON")
    assert difference(QUERIES[name](spark, folder), con, sql) is None


def test_retention_equals_its_sql_with_one_reading_of_an_instant(spark, folder, con):
    name = "q39_retention_after_merge"
    sql = once("e", ORACLES[name], "AS event_date, * FROM ", ")")
    assert difference(QUERIES[name](spark, folder), con, sql) is None

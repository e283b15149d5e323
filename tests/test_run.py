from __future__ import annotations

import glob
import gzip
import json
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F
from shop import D1, D2, good_feeds, item, paid, tender, transaction

from retailgold.bind.queries import _landed, write_feed_files
from retailgold.plans import GateFailure, gold_run, run, run_paths, stage_feeds, stage_settlement
from retailgold.schemas import DIMENSIONS, GOLD_COLUMNS, GOLD_TABLES, POS_FEEDS
from retailgold.sinks import read_audit, read_manifest, read_rejects
from retailgold.sources import read_gold


def go(spark, raw, path, **more):
    options = dict(audit_path=f"{path}/audit", brand="brand_a", schedule="daily", as_of="20200110")
    return run(spark, raw, f"{path}/gold", **{**options, **more})


def gold_rows(spark, path):
    return {t: rows(read_gold(spark, f"{path}/gold", t)) for t in GOLD_TABLES}


def test_good_run(spark, feed, tmp_path):
    result = go(spark, good_feeds(feed), tmp_path)
    assert result.results == {t: "SUCCESS" for t in GOLD_TABLES}
    assert list(result.published) == list(GOLD_TABLES)
    got = gold_rows(spark, tmp_path)
    assert {t: len(r) for t, r in got.items()} == {
        "transactions": 3, "product_category": 1, "product": 1, "organization": 1, "tenders": 3, "transaction_item": 3,
        "discounts": 2,
    }
    named = read_gold(spark, f"{tmp_path}/gold", "tenders")
    assert rows(named, "check_id", "customer_name") == [("1~55~07", "Ann"), ("2~55~07", None), ("3~55~07", "Bob")]
    audit = read_audit(spark, f"{tmp_path}/audit").collect()
    assert [r.ENTITY_TYPE for r in audit] == list(GOLD_TABLES)
    assert all(r.SOURCE_COUNT == r.DESTINATION_COUNT and r.EVENT_START_TIME <= r.EVENT_END_TIME for r in audit)
    assert json.loads(audit[0].EVENT_NOTES)["SCHEDULE"] == "daily" and audit[0].INGESTION_DATE == "2020-01-10"


def test_staged_run_gives_the_same(spark, feed, tmp_path):
    raw = good_feeds(feed)
    go(spark, raw, tmp_path / "plain")
    raw["settlement"] = raw["settlement"].withColumn("file_dt", F.lit(D2))
    staged = stage_feeds(raw, f"{tmp_path}/archive")
    go(spark, staged, tmp_path / "staged", strict_contract=True)
    assert gold_rows(spark, tmp_path / "plain") == gold_rows(spark, tmp_path / "staged")
    # the weekly run takes no settlement: a start day that never comes
    none = stage_feeds(raw, f"{tmp_path}/archive2", settlement_after="99990101")
    assert none["settlement"].count() == 0


def broken(feed, how):
    raw = good_feeds(feed)
    if how == "lost item":
        raw["transaction_item"] = feed("transaction_item", [item("1"), item("2", "2-1", "11"), item(None, "3-1", dt=D2)])
    elif how == "no products":
        raw["product_category"] = raw["product_category"].withColumn("dt", F.lit(D2))
    elif how == "unknown code":
        raw["discounts"] = raw["discounts"].withColumn("discountcode", F.lit("?"))
    elif how == "no tenders":
        raw["tenders"] = raw["tenders"].filter("false")
    elif how == "crash":
        raw["organization"] = raw["organization"].withColumn("Name", F.raise_error(F.lit("boom")))
    return raw


@pytest.mark.parametrize("how, table, reason", [
    ("lost item", "transaction_item", "row count 2 differs from staging row count 3"),
    ("no products", "product", "zero rows; row count 0 differs from staging row count 1"),
    ("unknown code", "discounts", "zero rows; row count 0 differs from staging row count 2"),
    ("no tenders", "tenders", "zero rows"),
    ("crash", "organization", "boom"),
])
def test_a_failure_publishes_nothing(spark, feed, tmp_path, how, table, reason):
    with pytest.raises(GateFailure) as failure:
        go(spark, broken(feed, how), tmp_path)
    assert failure.value.table == table and reason in failure.value.reason
    assert not os.path.exists(tmp_path / "gold")
    audit = read_audit(spark, f"{tmp_path}/audit").collect()
    # later tables were not built, earlier ones passed
    assert [r.ENTITY_TYPE for r in audit] == list(GOLD_TABLES[:GOLD_TABLES.index(table) + 1])
    assert [r.EVENT_RESULT for r in audit] == ["SUCCESS"] * (len(audit) - 1) + ["FAILURE"]
    assert reason in json.loads(audit[-1].EVENT_NOTES)["FAILURE_REASON"]
    if how == "lost item":
        assert [tuple(r) for r in failure.value.by_date] == [(D2, 0, 1, -1)]


def test_a_warning_publishes(spark, feed, tmp_path):
    raw = good_feeds(feed)
    raw["settlement"] = feed("settlement", [paid(), paid(card="411111******1234", name="Twin")])
    result = go(spark, raw, tmp_path)
    assert result.results["tenders"] == "WARNING"
    assert read_gold(spark, f"{tmp_path}/gold", "tenders").count() == 4


def test_date_by_date_equals_one_backfill(spark, feed, tmp_path):
    raw = good_feeds(feed)
    go(spark, raw, tmp_path / "all", tables=("transactions", "tenders", "transaction_item", "discounts"))
    for dates in (str(D1), str(D2), str(D2)):
        go(spark, raw, tmp_path / "each", dates=dates, tables=("transactions", "tenders", "transaction_item", "discounts"))
    for table in ("transactions", "tenders", "transaction_item", "discounts"):
        one, other = (read_gold(spark, f"{tmp_path}/{p}/gold", table) for p in ("all", "each"))
        assert rows(one) == rows(other)
        assert len(glob.glob(f"{tmp_path}/each/gold/{table}/partition_col=*/*.gz")) == 2


def test_late_settlement_file_is_used(spark, feed, tmp_path):
    """A tender's settlement may lie in a file of another date than the run's."""
    raw = good_feeds(feed)
    raw["settlement"] = raw["settlement"].withColumn("file_dt", F.lit(20200131))
    go(spark, raw, tmp_path, dates=str(D1), tables=("tenders",))
    assert rows(read_gold(spark, f"{tmp_path}/gold", "tenders"), "customer_name") == [(None,), ("Ann",)]


def test_large_date_is_published_in_parts(spark, feed, tmp_path):
    raw = good_feeds(feed)
    raw["tenders"] = feed("tenders", [tender("1")] * 100)
    result = go(spark, raw, tmp_path, tables=("tenders",), rows_per_file=10)
    assert result.results == {"tenders": "WARNING"}
    assert len(glob.glob(f"{tmp_path}/gold/tenders/partition_col={D1}/*.gz")) == 10
    assert read_gold(spark, f"{tmp_path}/gold", "tenders").count() == 100


def test_scratch_folder_is_gone(spark, feed, tmp_path, monkeypatch):
    from retailgold.plans import gold_run

    made = []
    real = gold_run.scratch_dir
    monkeypatch.setattr(gold_run, "scratch_dir", lambda s, n, root: made.append(real(s, n, root)) or made[-1])
    go(spark, good_feeds(feed), tmp_path, scratch=f"{tmp_path}/mine")
    assert len(made) == 1 and made[0].startswith(f"{tmp_path}/mine/") and not os.path.exists(made[0])


def test_run_from_files(spark, feed, tmp_path):
    """Feed files with a column nobody knows, two dates one after the other, settlement from the second file only."""
    raw = good_feeds(feed)
    raw["transaction_item"] = raw["transaction_item"].select(
        "sourcetransactionitemnumber", F.lit("n").alias("brand_new"), *raw["transaction_item"].columns[1:]
    )
    for name in POS_FEEDS:
        write_feed_files(raw[name], f"{tmp_path}/landing", name)
    folder = tmp_path / "settlement"
    folder.mkdir()
    for name, row in (("SETTLE_1_20200102.csv", paid()), ("SETTLE_1_20200103.csv", paid(name="Abe"))):
        (folder / name).write_text(",".join(row) + "\n" + ",".join(row.values()) + "\n")

    def go_files(dates, schedule="daily"):
        return run_paths(
            spark, f"{tmp_path}/landing", f"{folder}/SETTLE_*", f"{tmp_path}/archive", f"{tmp_path}/gold", dates=dates,
            settlement_after="20200102", audit_path=f"{tmp_path}/audit", brand="brand_a", schedule=schedule,
            as_of="20200110", tables=("transactions", "tenders", "transaction_item", "discounts"),
        )

    for dates in (str(D1), str(D2)):
        go_files(dates)
    items = read_gold(spark, f"{tmp_path}/gold", "transaction_item")
    assert rows(items, "sourcetransactionitemnumber", "brand_new", "check_id", "dt") == [
        ("1-1", "n", "1~55~07", D1), ("2-1", "n", "2~55~07", D1), ("3-1", "n", "3~55~07", D2)
    ]
    named = read_gold(spark, f"{tmp_path}/gold", "tenders")
    assert rows(named, "sourcetransactionnumber", "customer_name") == [("1", "Abe"), ("2", None), ("3", None)]


def test_missing_contract_column_fails(spark, feed, tmp_path):
    raw = good_feeds(feed)
    raw["organization"] = raw["organization"].drop("City")
    with pytest.raises(GateFailure, match="City"):
        go(spark, raw, tmp_path)


def test_a_publishing_crash_leaves_all_tables_as_they_were(spark, feed, tmp_path, monkeypatch):
    from retailgold.plans import gold_run

    go(spark, good_feeds(feed), tmp_path, tables=("product_category", "product"))
    before = sorted(glob.glob(f"{tmp_path}/gold/**", recursive=True))
    real = gold_run.stage_gold

    def broken_disk(stored, path, table, *more):
        if table == "product":
            raise OSError("disk full")
        return real(stored, path, table, *more)

    monkeypatch.setattr(gold_run, "stage_gold", broken_disk)
    with pytest.raises(GateFailure, match="disk full"):
        go(spark, good_feeds(feed), tmp_path, tables=("product_category", "product"), audit_path=f"{tmp_path}/audit2")
    assert sorted(glob.glob(f"{tmp_path}/gold/**", recursive=True)) == before
    audit = rows(read_audit(spark, f"{tmp_path}/audit2"), "ENTITY_TYPE", "EVENT_RESULT", "DESTINATION_COUNT")
    assert audit == [("product", "FAILURE", 1), ("product_category", "FAILURE", 1)]


def test_stale_gold_goes(spark, feed, tmp_path):
    raw = good_feeds(feed)
    go(spark, raw, tmp_path)
    raw["trans_disc_xref"] = raw["trans_disc_xref"].filter(F.col("dt") == D1)
    go(spark, raw, tmp_path)
    assert [r[0] for r in rows(read_gold(spark, f"{tmp_path}/gold", "discounts"), "dt")] == [D1]
    assert len(rows(read_gold(spark, f"{tmp_path}/gold", "transactions"))) == 3


def test_lost_and_doubled_rows_do_not_cancel_out(spark, feed, tmp_path):
    raw = good_feeds(feed)
    raw["transactions"] = feed("transactions", [transaction("1"), transaction("1"), transaction("2", "11")])
    with pytest.raises(GateFailure, match="row counts of 2 dates differ") as failure:
        go(spark, raw, tmp_path, tables=("transaction_item",))
    assert [tuple(r) for r in failure.value.by_date] == [(D1, 3, 2, 1), (D2, 0, 1, -1)]


def test_contract_header(spark, feed, tmp_path):
    raw = good_feeds(feed)
    raw["transactions"] = raw["transactions"].withColumn("brand_new", F.lit("n"))
    go(spark, raw, tmp_path / "wide")
    go(spark, raw, tmp_path / "strict", strict_contract=True)

    def header(path, table):
        (file, *_) = sorted(glob.glob(f"{path}/gold/{table}/partition_col={D1}/*.gz"))
        with gzip.open(file, "rt") as f:
            return f.readline().strip().split("|")

    for table, names in GOLD_COLUMNS.items():
        assert header(tmp_path / "strict", table) == names.split()
    assert header(tmp_path / "wide", "transactions") == [*GOLD_COLUMNS["transactions"].split(), "brand_new"]


def test_own_sql_for_a_table(spark, feed, tmp_path):
    text = "select *, dt as partition_col from pos_organization where Name <> 'gone'"
    result = go(spark, good_feeds(feed), tmp_path, tables=("organization",), sql={"organization": text})
    assert result.results == {"organization": "SUCCESS"}
    with pytest.raises(GateFailure, match="zero rows"):
        go(spark, good_feeds(feed), tmp_path, tables=("organization",), sql={"organization": text.replace("<>", "=")})


def test_manifest(spark, feed, tmp_path):
    result = go(spark, good_feeds(feed), tmp_path, tables=("transactions", "organization"))
    assert result.manifest == f"{tmp_path}/gold/_manifest"
    listed = rows(read_manifest(spark, f"{tmp_path}/gold"), "entity_type", "dt", "part", "file_name")
    assert listed == [
        ("organization", D1, 1, "organization_20200101_20200102_daily_p0001.psv.gz"),
        ("transactions", D1, 1, "transactions_20200101_20200102_daily_p0001.psv.gz"),
        ("transactions", D2, 1, "transactions_20200102_20200103_daily_p0001.psv.gz"),
    ]


def test_weekly_run_takes_what_daily_runs_left(spark, feed, tmp_path):
    raw = good_feeds(feed)
    for name in POS_FEEDS:
        write_feed_files(raw[name], f"{tmp_path}/daily", name)
        if name not in DIMENSIONS:
            write_feed_files(raw[name], f"{tmp_path}/weekly", name)
    folder = tmp_path / "settlement"
    folder.mkdir()
    (folder / "SETTLE_1_20210102.csv").write_text(",".join(paid()) + "\n" + ",".join(paid().values()) + "\n")

    def go_files(schedule, dates):
        return run_paths(
            spark, f"{tmp_path}/{schedule}", f"{folder}/SETTLE_*", f"{tmp_path}/archive", f"{tmp_path}/{schedule}/gold", dates=dates,
            schedule=schedule, dimensions=f"{tmp_path}/carried", audit_path=f"{tmp_path}/audit", brand="brand_a", as_of="20200110",
        )

    go_files("daily", str(D1))
    os.remove(folder / "SETTLE_1_20210102.csv")
    result = go_files("weekly", str(D1))
    assert set(result.results) == set(GOLD_TABLES)
    for table in GOLD_TABLES:
        one, other = (read_gold(spark, f"{tmp_path}/{s}/gold", table) for s in ("daily", "weekly"))
        assert rows(one) == rows(other) != []
    with pytest.raises(ValueError, match="dimensions"):
        run_paths(spark, "x", "x", "x", "x", dates=str(D1), schedule="weekly", audit_path="x", brand="b", as_of="20200110")


def test_settlement_is_staged_once(spark, feed, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()

    def deliver(day, name):
        (folder / f"SETTLE_1_{day}.csv").write_text(",".join(paid()) + "\n" + ",".join(paid(name=name).values()) + "\n")

    deliver("20210102", "Ann")
    stage_settlement(spark, f"{folder}/SETTLE_*", f"{tmp_path}/archive", "20200910")
    first = {p: os.path.getmtime(p) for p in glob.glob(f"{tmp_path}/archive/settlement/*/*/*.parquet")}
    deliver("20210102", "Changed"), deliver("20210103", "Bob"), deliver("20200101", "Too early")
    out = stage_settlement(spark, f"{folder}/SETTLE_*", f"{tmp_path}/archive", "20200910")
    assert rows(out, "customer_name", "file_dt") == [("Ann", 20210102), ("Bob", 20210103)]
    assert {p: os.path.getmtime(p) for p in first} == first
    (folder / "SETTLE_1_nodate.csv").write_text("x\n")
    with pytest.raises(ValueError, match="nodate"):
        stage_settlement(spark, f"{folder}/SETTLE_*", f"{tmp_path}/archive", "20200910")


def test_lines_of_another_width_are_landed_apart(spark, feed, tmp_path):
    """One field too many, one too few: not in the gold, listed, and counted in the audit."""
    raw = good_feeds(feed)
    for name in POS_FEEDS:
        write_feed_files(raw[name], f"{tmp_path}/landing", name)
    folder = tmp_path / "landing" / "organization" / f"dt={D1}"
    head = "|".join(raw["organization"].drop("dt").columns)
    with gzip.open(folder / "more.psv.gz", "wt") as f:
        f.write(f"{head}\n" + "|".join(["20"] * 99) + "\n21|few\n" + "|".join(["22"] * (head.count("|") + 1)) + "\n")
    run_paths(
        spark, f"{tmp_path}/landing", f"{tmp_path}/none_*", f"{tmp_path}/archive", f"{tmp_path}/gold", dates=str(D1), schedule="daily",
        settlement_after="99990101", audit_path=f"{tmp_path}/audit", brand="brand_a", as_of="20200110", tables=("organization",), contents=True,
    )
    assert [r[0] for r in rows(read_gold(spark, f"{tmp_path}/gold", "organization"), "SourceOrganizationNumberkey")] == ["10", "22"]
    aside = read_rejects(spark, f"{tmp_path}/archive", POS_FEEDS)
    assert rows(aside) == [("organization", D1, "20" + "|20" * 98), ("organization", D1, "21|few")]
    assert json.loads(read_audit(spark, f"{tmp_path}/audit").first().EVENT_NOTES)["REJECTED_ROWS"] == "organization=2"


def test_contents_are_compared(spark, feed, tmp_path):
    raw = good_feeds(feed)
    tables = ("transactions", "organization")
    assert go(spark, raw, tmp_path, tables=tables, contents=True).results == {t: "SUCCESS" for t in tables}
    text = "select * except (Name), 'other' as Name, dt as partition_col from pos_organization"
    with pytest.raises(GateFailure, match="rows of 1 dates are not those of staging"):
        go(spark, raw, tmp_path, tables=tables, contents=True, sql={"organization": text})


def test_summaries_of_settlement_files_give_the_same_tenders(spark, feed, tmp_path):
    raw, folder = good_feeds(feed), tmp_path / "settlement"
    folder.mkdir()
    for name in POS_FEEDS:
        write_feed_files(raw[name], f"{tmp_path}/landing", name)

    def deliver(day, *people):
        lines = [",".join(paid(name=n, **more).values()) for n, more in people]
        (folder / f"SETTLE_1_{day}.csv").write_text("\n".join([",".join(paid()), *lines]) + "\n")

    def go_files(to, **more):
        run_paths(
            spark, f"{tmp_path}/landing", f"{folder}/SETTLE_*", f"{tmp_path}/archive{to}", f"{tmp_path}/{to}", dates=f"{D1}:{D2}", settlement_after="20200101",
            audit_path=f"{tmp_path}/audit", brand="brand_a", schedule="daily", as_of="20200110", tables=("tenders",), **more,
        )
        return rows(read_gold(spark, f"{tmp_path}/{to}", "tenders"), "check_id", "customer_name")

    deliver("20200102", ("Zoe", {}), ("Bob", {"when": "01/03/2020 11:00:00", "amount": "7"}))
    assert go_files("summed", summarise=True) == [("1~55~07", "Zoe"), ("2~55~07", None), ("3~55~07", "Bob")]
    deliver("20200103", ("Ann", {}))
    parts = {p: os.path.getmtime(p) for p in glob.glob(f"{tmp_path}/archivesummed/settlement_summary/*/*/*.parquet")}
    assert go_files("summed", summarise=True) == go_files("plain") == [("1~55~07", "Ann"), ("2~55~07", None), ("3~55~07", "Bob")]
    assert parts and {p: os.path.getmtime(p) for p in parts} == parts  # the first file was not summarised again


def test_a_table_goes_when_its_files_are_written(spark, feed, tmp_path, monkeypatch):
    """Tables' files are written one after the other, each from a table that goes before the next."""
    real, seen = gold_run.stage_gold, []

    def stage(built, out, table, *more):
        seen.append((table, sorted(os.path.basename(p) for p in glob.glob(f"{tmp_path}/scratch/*/*"))))
        return real(built, out, table, *more)

    monkeypatch.setattr(gold_run, "stage_gold", stage)
    go(spark, good_feeds(feed), tmp_path, scratch=f"{tmp_path}/scratch")
    assert seen == [(t, sorted(GOLD_TABLES[i:])) for i, t in enumerate(GOLD_TABLES)]
    assert read_gold(spark, f"{tmp_path}/gold", "discounts").count() == 2


def test_archive_and_stored_feeds_are_zstd(spark, feed, tmp_path):
    staged = stage_feeds({"transactions": good_feeds(feed)["transactions"]}, f"{tmp_path}/archive")
    for df in (staged["transactions"], _landed(spark, staged["transactions"])):
        assert df.count() == 3 and all(".zstd.parquet" in f for f in df.inputFiles())

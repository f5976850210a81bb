"""T5 with its stage, ledger and key index: failing runs change nothing, loads keep to themselves."""

import random

import pytest
from pyspark.sql import functions as F

from arrivals.operators.key_index import key_index, keys_across_months, keys_of, shared_key_count
from arrivals.plans import builds
from arrivals.plans.builds import (
    Lookups, build_arrivals, complete_releases, publish, published_keys_across_months, read_published)
from arrivals.plans.ledger import applied_loads, interrupted, read_loads, run_report
from arrivals.schemas import ARRIVALS
from arrivals.sources.sinks import partition_folder, read_rejects, refresh_months

FACT = "ID int, year int, month int, arrival_state string, residence_country string"


def fact_rows(spark, rows):
    return spark.createDataFrame(rows, FACT)


def month_of(first, n, month, lost=0):
    return [(first + i, 2016, None if i < lost else month, "NY", "MEXICO") for i in range(n)]


@pytest.fixture(scope="module")
def dimensions(spark):
    return {
        "demographics": spark.createDataFrame([("Oakton", "NY", "White")], "City string, State_code string, Race string"),
        "temperature": spark.createDataFrame([("MEXICO", 20.0)], "Country string, Temperature double"),
        "airports": spark.createDataFrame([("01A", "NY")], "ident string, state string"),
    }


def checks(report, table="immigration"):
    return {r.check_name: r.n_rows for r in report.collect() if r.table_name == table}


def snapshot(spark, root):
    return {n: sorted(map(str, read_published(spark, root, n).collect()))
            for n in ("immigration", "demographics", "temperature", "airports")}


def rejects(spark, root):
    rows = read_rejects(spark, f"{root}/immigration", ARRIVALS.schema).groupBy("load").count().collect()
    return {r.load: r["count"] for r in rows}


def test_every_run_reports_its_own_rejects_and_keeps_the_others(spark, dimensions, tmp_path):
    root = str(tmp_path / "out")
    runs = [("april", month_of(0, 60, 4, lost=24)), ("may", month_of(100, 50, 5)), ("june", month_of(200, 50, 6, lost=12))]
    got = [checks(publish(spark, dimensions | {"immigration": fact_rows(spark, r)}, root, load=name))["rejected"]
           for name, r in runs]
    assert got == [24, 0, 12]
    assert rejects(spark, root) == {"april": 24, "june": 12}
    # The April load again, now without such rows: its rejects go, June's stay.
    publish(spark, dimensions | {"immigration": fact_rows(spark, month_of(0, 60, 4))}, root, load="april")
    assert rejects(spark, root) == {"june": 12}
    ledger = {r.load: (r.n_rows, r.n_rejected, [tuple(m) for m in r.months]) for r in applied_loads(spark, root).collect()}
    assert ledger == {"april": (60, 0, [(2016, 4)]), "may": (50, 0, [(2016, 5)]), "june": (38, 12, [(2016, 6)])}


def test_loads_without_a_name_are_named_by_their_content(spark, dimensions, tmp_path):
    root = str(tmp_path / "out")
    april, may = month_of(0, 30, 4, lost=5), month_of(100, 30, 5, lost=7)
    for rows in (april, may, april[::-1]):
        publish(spark, dimensions | {"immigration": fact_rows(spark, rows).repartition(3)}, root)
    assert sorted(rejects(spark, root).values()) == [5, 7]
    assert applied_loads(spark, root).count() == 2
    # Swapped values beside nulls are another content.
    one, other = ([(1, 2016, 4, a, b)] for a, b in ((None, "x"), ("x", None)))
    prints = set()
    for rows in (one, other):
        publish(spark, {"immigration": fact_rows(spark, rows)}, root)
        prints |= {r.fingerprint for r in read_loads(spark, root).collect()}
    assert len(prints) == 4


@pytest.mark.parametrize("broken", ["immigration", "airports", "demographics"])
def test_a_failing_run_leaves_the_tables_as_they_were(spark, dimensions, tmp_path, broken):
    root = str(tmp_path / "out")
    good = dimensions | {"immigration": fact_rows(spark, month_of(0, 20, 4, lost=2))}
    publish(spark, good, root, load="good")
    before, kept = snapshot(spark, root), rejects(spark, root)
    bad = {n: df.where("false") if n == broken else df for n, df in good.items()}
    bad["temperature"] = spark.createDataFrame([("PERU", 1.0)], "Country string, Temperature double")
    with pytest.raises(ValueError, match=broken):
        publish(spark, bad, root, load="bad")
    assert snapshot(spark, root) == before and rejects(spark, root) == kept
    assert {r.load: r.event for r in read_loads(spark, root).where("event <> 'staged'").collect()} == {
        "good": "released", "bad": "failed"}
    assert interrupted(spark, root) == []


def test_a_table_that_cannot_be_computed_leaves_the_tables_as_they_were(spark, dimensions, tmp_path):
    root = str(tmp_path / "out")
    good = dimensions | {"immigration": fact_rows(spark, month_of(0, 20, 4))}
    publish(spark, good, root)
    before = snapshot(spark, root)
    broken = good["temperature"].withColumn("Temperature", F.raise_error(F.lit("broken input")).cast("double"))
    with pytest.raises(Exception, match="broken input"):
        publish(spark, good | {"temperature": broken, "immigration": fact_rows(spark, month_of(50, 20, 5))}, root)
    assert snapshot(spark, root) == before


def test_an_interrupted_release_is_completed(spark, dimensions, tmp_path, monkeypatch):
    root = str(tmp_path / "out")
    publish(spark, dimensions | {"immigration": fact_rows(spark, month_of(0, 20, 4))}, root, load="april")

    def lost(*args, **kwargs):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(builds, "refresh_months", lost)
        with pytest.raises(RuntimeError, match="driver lost"):
            publish(spark, dimensions | {"immigration": fact_rows(spark, month_of(100, 30, 5, lost=3))}, root, load="may")
    assert [run.load for run in interrupted(spark, root)] == ["may"]
    assert complete_releases(spark, root) == ["may"]
    assert {r.month for r in read_published(spark, root, "immigration").collect()} == {4, 5}
    assert rejects(spark, root) == {"may": 3}
    assert complete_releases(spark, root) == [] and read_published(spark, root, "immigration").count() == 47


def test_the_report_is_the_ledgers(spark, dimensions, tmp_path):
    root = str(tmp_path / "out")
    report = publish(spark, dimensions | {"immigration": fact_rows(spark, month_of(0, 20, 4))}, root)
    run = read_loads(spark, root).where("event = 'released'").first().run
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, run_report(spark, root, run).collect()))


def raw_row(**values):
    row = {"cicid": "1.0", "i94yr": "2016.0", "i94mon": "4.0", "i94cit": "582", "i94res": "582", "i94port": "NYC",
           "arrdate": "20545", "i94mode": "1", "i94addr": "NY", "depdate": None, "i94bir": "30", "i94visa": "2",
           "biryear": "1986", "gender": "F", "airline": "AA", "visatype": "B2"}
    return row | values


def test_flags_count_what_the_decode_report_counts(spark, tmp_path):
    rows = [raw_row(), raw_row(cicid="2", i94cit="999"), raw_row(cicid="3", i94cit=None, i94mode="7"),
            raw_row(cicid="4", i94res="700", i94addr="ZZ"), raw_row(cicid="5", i94port="XXX"), raw_row(cicid="6", i94addr=None)]
    raw = spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{c} string" for c in rows[0]))
    book = lambda *r: spark.createDataFrame(list(r), "code string, label string")
    lookups = Lookups(country=book(("582", "MEXICO"), ("700", "INVALID: STATELESS")), port=book(("NYC", "NEW YORK")),
                      state=book(("NY", "NEW YORK")))
    report = publish(spark, {"immigration": build_arrivals(raw, lookups, flags=True)}, str(tmp_path / "out"))
    got = {(r.check_name, r.column_name): r.n_rows for r in report.collect() if r.check_name in ("unmatched", "invalid")}
    want = {}
    for r in builds.arrivals_decode_report(raw, lookups).collect():
        want |= {("unmatched", r.column_name): r.n_unmatched, ("invalid", r.column_name): r.n_invalid}
    assert got == want and want["unmatched", "state"] == 1 and want["invalid", "residence_country"] == 1
    plain = build_arrivals(raw, lookups)
    assert plain.columns == ARRIVALS.columns
    assert read_published(spark, str(tmp_path / "out"), "immigration").columns == ARRIVALS.columns
    assert sorted(plain.select("ID", "Mode", "native_country").collect()) == sorted(
        read_published(spark, str(tmp_path / "out"), "immigration").select("ID", "Mode", "native_country").collect())


def test_the_raw_fact_is_read_once(spark, dimensions, tmp_path):
    """Rows computed in a whole publish, counted where they are computed: each raw row once."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    raw = fact_rows(spark, month_of(0, 500, 4, lost=20))
    publish(spark, dimensions | {"immigration": raw.mapInArrow(count, raw.schema)}, str(tmp_path / "out"))
    assert seen.value == 500


def test_keys_shared_with_stored_months_are_reported(spark, dimensions, tmp_path):
    root = str(tmp_path / "out")
    april, may = month_of(0, 40, 4), month_of(30, 40, 5)
    publish(spark, {"immigration": fact_rows(spark, april)}, root)
    assert checks(publish(spark, {"immigration": fact_rows(spark, may)}, root))["keys_in_other_months"] == 10
    # The same month again: it replaces itself and shares the same ten.
    assert checks(publish(spark, {"immigration": fact_rows(spark, may)}, root))["keys_in_other_months"] == 10
    held = {r.key: (r.n_months, r.first_month, r.last_month) for r in published_keys_across_months(spark, root).collect()}
    assert held == {k: (2, 201604, 201605) for k in range(30, 40)}
    publish(spark, {"immigration": fact_rows(spark, may)}, root, replace_fact=True)
    assert published_keys_across_months(spark, root).count() == 0


KEYS = [0, 1, -1, 32767, 32768, 32769, -32767, -32768, -32769, 2**31 - 1, -(2**31), 65536, 65537]


def test_the_index_holds_exactly_the_keys(spark):
    rng = random.Random(3)
    rows = [(k, 2016, m) for k in KEYS for m in (1, 2) if (k + m) % 3] + [
        (rng.randrange(-100_000, 100_000), 2016, rng.randrange(1, 5)) for _ in range(3000)]
    rows += [(7, 2016, 1)] * 1500 + [(None, 2016, 1)] * 10 + [(8, None, 1), (9, 2016, None)]
    df = spark.createDataFrame(rows, "ID int, year int, month int").repartition(7)
    index = key_index(df, "ID")
    kept = {(y, m, k) for k, y, m in rows if None not in (k, y, m)}
    assert {tuple(r) for r in keys_of(index).collect()} == kept
    months = {}
    for y, m, k in kept:
        months.setdefault(k, set()).add(100 * y + m)
    want = {k: (len(v), min(v), max(v)) for k, v in months.items() if len(v) > 1}
    assert {r.key: (r.n_months, r.first_month, r.last_month) for r in keys_across_months(index).collect()} == want
    new, old = index.where("month = 1"), index.where("month <> 1")
    held = lambda pick: {k for y, m, k in kept if pick(m)}
    assert shared_key_count(new, old).first().n_shared == len(held(lambda m: m == 1) & held(lambda m: m != 1))
    assert shared_key_count(new, old.where("false")).first().n_shared == 0


def test_rejects_of_a_load_with_an_odd_name(spark, tmp_path):
    path, name = str(tmp_path / "fact"), "s3://in/a=b 100%/x[1]?#"
    rows = fact_rows(spark, month_of(0, 9, 4, lost=4))
    refresh_months(rows, path, load=name)
    refresh_months(fact_rows(spark, month_of(0, 9, 4, lost=2)), path, load="other")
    got = {r.load: r["count"] for r in read_rejects(spark, path, rows.schema).groupBy("load").count().collect()}
    assert got == {name: 4, "other": 2}
    refresh_months(fact_rows(spark, month_of(0, 9, 4)), path, load=name)
    got = {r.load: r["count"] for r in read_rejects(spark, path, rows.schema).groupBy("load").count().collect()}
    assert got == {"other": 2}
    assert partition_folder("load", "a:b") == "load=a%3Ab"

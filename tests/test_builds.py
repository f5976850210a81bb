"""Build tests on tiny raw files shaped like the real inputs (invented rows)."""

import datetime as dt

from pyspark.sql import functions as F

import pytest

from arrivals.plans.builds import Lookups, RawInputs, build_all, build_temperature, publish
from arrivals.schemas import AIRPORTS, ARRIVALS, DEMOGRAPHICS, TEMPERATURE
from arrivals.sources import read_delimited
from tests.conftest import plan_text

ARRIVALS_CSV = """\
,cicid,i94yr,i94mon,i94cit,i94res,i94port,arrdate,i94mode,i94addr,depdate,i94bir,i94visa,count,dtadfile,visapost,occup,entdepa,entdepd,entdepu,matflag,biryear,dtaddto,gender,insnum,airline,admnum,fltno,visatype
0,1.0,2016.0,4.0,101.0,582.0,NYC,20545.0,1.0,NY,20550.0,40.0,2.0,1.0,20160401,,,G,O,,M,1976.0,10292016,M,,AA,10000000001.0,00123,B2
1,2.0,2016.0,4.0,999.0,101.0,LOS,20546.0,5.0,CA,,-4.7,1.0,1.0,20160401,,,G,,,,x,10292016,F,,UA,1.0,00456,WT
2,3.0,2016.0,4.0,101.0,101.0,MIA,20547.0,,,20560.0,30.0,3.0,1.0,20160401,,,G,O,,M,1986.0,10292016,M,,DL,2.0,00789,F1
3,4.0,2016.0,4.0,,582.0,SFR,20548.0,9.0,FL,20555.0,,2.0,1.0,20160401,,,G,O,,M,,10292016,F,,,3.0,,
"""

COUNTRY_CSV = 'Code,Country\n582,"MEXICO"\n101,ALBANIA\n700,"INVALID: STATELESS"\n'

DEMOGRAPHICS_CSV = """\
City;State;Median Age;Male Population;Female Population;Total Population;Number of Veterans;Foreign-born;Average Household Size;State Code;Race;Count
Alder Point;Maryland;33.8;41000.0;42100.0;83100;1500.0;30100.0;2.6;MD;Hispanic or Latino;25000
Alder Point;Maryland;33.8;41000.0;42100.0;83100;1500.0;30100.0;2.6;MD;White;38000.0
Birchton;Massachusetts;41.0;44000;49000;93000;4100;;2.39;MA;White;58000
Cedarville;Alabama;38.5;38100;46000;84100;4800;x;2.58;AL;Asian;4759
Dunmore;California;34.5;;61000;122000;5800;33000;3.18;CA;Black;3000
Elmford;New Jersey;34.6;138000;143000;281000;5900;86000;;NJ;White;76000
"""

TEMPERATURE_CSV = """\
dt,AverageTemperature,AverageTemperatureUncertainty,City,Country,Latitude,Longitude
1801-11-01,6.0,1.5,Nordby,Denmark,56.00N,11.00E
1801-12-01,,,Nordby,Denmark,56.00N,11.00E
1802-01-01,4.0,1.0,Vesterby,denmark,56.00N,9.0E
1802-01-01,10.0,1.0,Sudville,France,44.00N,3.00E
1802-01-01,7.0,1.0,X,,,
"""

AIRPORTS_CSV = """\
ident,type,name,elevation_ft,continent,iso_country,iso_region,municipality,gps_code,iata_code,local_code,coordinates
01A,heliport,Made Up Heliport,11,NA,US,US-PA,Fairplace,01A,,01A,"-70.10, 41.20"
01AK,small_airport,Invented Field,450,NA,US,US-AK,Coldham,01AK,,01AK,"-150.30, 60.40"
01CA,closed,X,,NA,CA,CA-ON,,,,,
02XX,small_airport,Y,,NA,,US-TX,,,,,
03US,small_airport,Z,,NA,US,US,,,,,
"""


def day(n):
    return dt.date(1960, 1, 1) + dt.timedelta(days=n)


@pytest.fixture
def built(spark, write_text):
    inputs = RawInputs(
        arrivals=write_text("arrivals.csv", ARRIVALS_CSV),
        demographics=write_text("demographics.csv", DEMOGRAPHICS_CSV),
        temperature=write_text("temperature.csv", TEMPERATURE_CSV),
        airports=write_text("airports.csv", AIRPORTS_CSV),
    )
    lookups = Lookups.from_files(spark, country=write_text("country.csv", COUNTRY_CSV))
    return build_all(spark, inputs, lookups)


def test_fact_rows_and_column_order(built):
    fact = built["immigration"]
    assert fact.columns == ARRIVALS.columns
    rows = sorted((tuple(r) for r in fact.collect()), key=lambda r: r[0])
    assert rows == [
        (1, 2016, 4, "ALBANIA", "MEXICO", "NYC", "NY", day(20545), day(20550), "Pleasure", 40, 1976, "M", "AA", "Air", "B2"),
        (2, 2016, 4, None, "ALBANIA", "LOS", "CA", day(20546), None, "Business", -4, None, "F", "UA", None, "WT"),
        (4, 2016, 4, None, "MEXICO", "SFR", "FL", day(20548), day(20555), "Pleasure", None, None, "F", None, "Not reported", None),
    ]
    assert day(20545) == dt.date(2016, 4, 1)


def test_fact_decodes_are_broadcast(built):
    plan = plan_text(built["immigration"])
    assert plan.count("BroadcastHashJoin") == 4
    assert "SortMergeJoin" not in plan


def test_demographics_rows(built):
    demo = built["demographics"]
    assert demo.columns == DEMOGRAPHICS.columns
    rows = sorted(tuple(r) for r in demo.collect())
    assert rows == [
        ("Alder Point", "Maryland", "33.8", 41000, 42100, 83100, 1500, 30100, "2.6", "MD", "Hispanic or Latino", 25000),
        ("Alder Point", "Maryland", "33.8", 41000, 42100, 83100, 1500, 30100, "2.6", "MD", "White", 38000),
    ]


def test_temperature_rows(built):
    temp = built["temperature"]
    assert temp.columns == TEMPERATURE.columns
    rows = {r.Country: (round(r.Temperature, 6) if r.Temperature is not None else None, r.Latitude, r.Longitude)
            for r in temp.collect()}
    assert rows == {
        "DENMARK": (5.0, "56.00N", "11.00E"),
        "FRANCE": (10.0, "44.00N", "3.00E"),
        None: (7.0, None, None),
    }


def test_temperature_rows_are_combined_before_any_shuffle(spark, write_text):
    raw = read_delimited(spark, write_text("t.csv", TEMPERATURE_CSV))
    plan = plan_text(build_temperature(raw))
    below = plan[plan.rindex("Exchange hashpartitioning"):]
    assert "partial_sum" in below and "SortAggregate" not in below


def test_airports_rows(built):
    air = built["airports"]
    assert air.columns == AIRPORTS.columns
    rows = sorted((r.ident, r.iso_country, r.state) for r in air.collect())
    assert rows == [("01A", "US", "PA"), ("01AK", "US", "AK"), ("03US", "US", "")]


def test_publish_writes_and_checks(spark, built, tmp_path):
    report = publish(spark, built, str(tmp_path / "out"))
    rows = {(r.table_name, r.check_name): (r.n_rows, r.passed) for r in report.collect()}
    assert {t: n for (t, c), (n, _) in rows.items() if c == "rows"} == {
        "immigration": 3, "demographics": 2, "temperature": 3, "airports": 3,
    }
    assert all(rows[t, "duplicate_keys"] == (0, True) for t in built)
    assert rows["immigration", "rejected"] == (0, True)
    fact = spark.read.parquet(str(tmp_path / "out" / "immigration"))
    assert sorted(fact.columns) == sorted(ARRIVALS.columns)
    from arrivals.plans.builds import read_published

    assert read_published(spark, str(tmp_path / "out"), "immigration").columns == ARRIVALS.columns
    # a re-run of the same month replaces it
    publish(spark, built, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "immigration")).count() == 3


def test_publish_fails_on_empty_table(spark, built, tmp_path):
    tables = dict(built)
    tables["airports"] = built["airports"].where("ident = 'none'")
    with pytest.raises(ValueError, match="airports"):
        publish(spark, tables, str(tmp_path / "out2"))


PORT_CSV = 'ID,Port\nNYC,"NEW YORK, NY"\nLOS,"LOS ANGELES, CA"\n'
STATE_CSV = "Code,State\nNY,NEW YORK\nCA,CALIFORNIA\n99,All Other Codes\n"


def test_run_etl_with_port_and_state_decodes(spark, write_text, tmp_path):
    from arrivals.plans.run import run_etl

    inputs = RawInputs(
        arrivals=write_text("arrivals.csv", ARRIVALS_CSV),
        demographics=write_text("demographics.csv", DEMOGRAPHICS_CSV),
        temperature=write_text("temperature.csv", TEMPERATURE_CSV),
        airports=write_text("airports.csv", AIRPORTS_CSV),
    )
    lookups = Lookups.from_files(
        spark,
        country=write_text("country.csv", COUNTRY_CSV),
        port=write_text("port.csv", PORT_CSV),
        state=write_text("state.csv", STATE_CSV),
    )
    report = run_etl(spark, inputs, lookups, str(tmp_path / "out"), decode_port=True, decode_state=True)
    rows = {(r.check_name, r.column_name): r.n_rows for r in report.collect() if r.table_name == "immigration"}
    assert rows["unmatched", "port"] == 1 and rows["unmatched", "state"] == 1 and rows["invalid", "native_country"] == 0
    from arrivals.plans.builds import read_published

    fact = read_published(spark, str(tmp_path / "out"), "immigration")
    got = sorted((r.ID, r.port_of_admission, r.arrival_state, r.arrival_state_name) for r in fact.collect())
    assert got == [(1, "NEW YORK, NY", "NY", "NEW YORK"), (2, "LOS ANGELES, CA", "CA", "CALIFORNIA"), (4, None, "FL", "other")]


def test_enriched_star_keeps_fact_rows(spark, built):
    from arrivals.plans.star_views import arrivals_by_state_month, enriched_arrivals

    demo = spark.createDataFrame(
        [("Oakton", "NY", 50, 40, 90, 1, 2, "White", 70), ("Oakton", "NY", 50, 40, 90, 1, 2, "Asian", 20),
         ("Pineburg", "NY", 100, 110, 210, 3, 4, "White", 210), ("LA", "CA", 5, 5, 10, 0, 1, "White", 10)],
        "City string, State_code string, Male_population int, Female_population int, Total_population int, "
        "Number_veterans int, Foreign_born int, Race string, Count int",
    )
    enriched = enriched_arrivals(built["immigration"], demo, built["airports"].union(
        built["airports"].where("ident = '01A'").withColumn("state", F.lit("NY"))),
        built["temperature"].union(spark.createDataFrame([("Mexico", 21.5, "19N", "99W")], built["temperature"].schema)))
    rows = sorted((r.ID, r.arrival_state, r.Total_population, r.n_cities, r.n_airports, r.residence_temperature)
                  for r in enriched.collect())
    assert rows == [(1, "NY", 300, 2, 1, 21.5), (2, "CA", 10, 1, None, None), (4, "FL", None, None, None, 21.5)]
    # Q4 on a star link: residence countries without a temperature row are reported, never dropped
    from arrivals.operators.quality import unmatched_codes

    q = unmatched_codes(enriched, {"residence_country": "residence_temperature"}).first()
    assert (q.n_rows, q.n_null_code, q.n_unmatched) == (3, 0, 1)
    by_month = {(r.arrival_state, r.month): (r.n_arrivals, r.state_population) for r in arrivals_by_state_month(enriched).collect()}
    assert by_month == {("NY", 4): (1, 300), ("CA", 4): (1, 10), ("FL", 4): (1, None)}


@pytest.mark.parametrize("fmt", ["parquet", "json", "orc"])
def test_builds_are_format_agnostic(spark, write_text, tmp_path, fmt, built):
    """S3: the same raw rows stored as parquet/json/orc build the same tables as from CSV."""
    csv_paths = {
        "arrivals": (write_text("a.csv", ARRIVALS_CSV), ","),
        "demographics": (write_text("d.csv", DEMOGRAPHICS_CSV), ";"),
        "temperature": (write_text("t.csv", TEMPERATURE_CSV), ","),
        "airports": (write_text("p.csv", AIRPORTS_CSV), ","),
    }
    paths = {}
    for name, (path, sep) in csv_paths.items():
        out = str(tmp_path / f"{name}_{fmt}")
        read_delimited(spark, path, sep=sep).write.format(fmt).save(out)
        paths[name] = out
    lookups = Lookups.from_files(spark, country=write_text("country.csv", COUNTRY_CSV))
    again = build_all(spark, RawInputs(fmt=fmt, **paths), lookups)
    for name, df in built.items():
        assert again[name].columns == df.columns
        key = lambda r: tuple((v is None, str(v)) for v in r)
        assert sorted(again[name].collect(), key=key) == sorted(df.collect(), key=key), name


def test_command_line_runner(write_text, tmp_path):
    import subprocess
    import sys

    root = __import__("os").path.dirname(__import__("os").path.dirname(__import__("os").path.abspath(__file__)))
    out = tmp_path / "cli_out"
    cmd = [
        sys.executable, "-m", "arrivals.plans.run",
        "--arrivals", write_text("a.csv", ARRIVALS_CSV),
        "--demographics", write_text("d.csv", DEMOGRAPHICS_CSV),
        "--temperature", write_text("t.csv", TEMPERATURE_CSV),
        "--airports", write_text("p.csv", AIRPORTS_CSV),
        "--country-lookup", write_text("c.csv", COUNTRY_CSV),
        "--output", str(out),
    ]
    res = subprocess.run(cmd, cwd=root, capture_output=True, text=True, timeout=600)
    assert res.returncode == 0, res.stderr[-2000:]
    assert "immigration" in res.stdout and "true" in res.stdout
    assert sorted(p.name for p in out.iterdir()) == [
        "airports", "demographics", "immigration", "immigration_rejects", "temperature"]


def test_per_dataset_calls(spark, write_text, tmp_path):
    from arrivals.plans.run import process_airports, process_demographics, process_immigration, process_temperature

    out = tmp_path / "per_dataset"
    process_immigration(spark, write_text("a.csv", ARRIVALS_CSV), str(out / "immigration"),
                        country_lookup=write_text("c.csv", COUNTRY_CSV))
    process_demographics(spark, write_text("d.csv", DEMOGRAPHICS_CSV), str(out / "demographics"))
    process_temperature(spark, write_text("t.csv", TEMPERATURE_CSV), str(out / "temperature"))
    process_airports(spark, write_text("p.csv", AIRPORTS_CSV), str(out / "airports"))
    counts = {n: spark.read.parquet(str(out / n)).count() for n in ("immigration", "demographics", "temperature", "airports")}
    assert counts == {"immigration": 3, "demographics": 2, "temperature": 3, "airports": 3}


def _inputs(write_text, **other):
    texts = {"arrivals": ARRIVALS_CSV, "demographics": DEMOGRAPHICS_CSV, "temperature": TEMPERATURE_CSV, "airports": AIRPORTS_CSV}
    return RawInputs(**{k: write_text(f"{k}.csv", t) for k, t in (texts | other).items()})


def test_a_file_with_the_wrong_header_is_an_error(spark, write_text):
    lookups = Lookups.from_files(spark, country=write_text("country.csv", COUNTRY_CSV))
    with pytest.raises(ValueError, match="AverageTemperature.*temperature.csv"):
        build_all(spark, _inputs(write_text, temperature="Country;T\nx;1\n".replace(";", ",")), lookups)


def test_header_case_does_not_matter(spark, write_text):
    lookups = Lookups.from_files(spark, country=write_text("country.csv", COUNTRY_CSV))
    upper = ARRIVALS_CSV.replace(ARRIVALS_CSV.split("\n")[0], ARRIVALS_CSV.split("\n")[0].upper())
    fact = build_all(spark, _inputs(write_text, arrivals=upper), lookups)["immigration"]
    assert sorted(r.arrival_state for r in fact.collect()) == ["CA", "FL", "NY"]


def test_an_empty_fact_fails_by_name_on_new_and_old_roots(spark, built, tmp_path):
    empty = dict(built, immigration=built["immigration"].where("ID < 0"))
    for root in (str(tmp_path / "new"), str(tmp_path / "old")):
        if root.endswith("old"):
            publish(spark, built, root)
        with pytest.raises(ValueError, match="immigration"):
            publish(spark, empty, root)


def test_replacing_the_fact_removes_vanished_months(spark, built, tmp_path):
    root = str(tmp_path / "out")
    may = built["immigration"].withColumn("month", F.lit(5))
    publish(spark, dict(built, immigration=built["immigration"].unionByName(may)), root)
    publish(spark, built, root)
    assert {r.month for r in spark.read.parquet(f"{root}/immigration").collect()} == {4, 5}
    publish(spark, built, root, replace_fact=True)
    assert {r.month for r in spark.read.parquet(f"{root}/immigration").collect()} == {4}


def test_rows_without_a_month_are_counted_and_kept(spark, built, tmp_path):
    root = str(tmp_path / "out")
    lost = built["immigration"].withColumn("month", F.when(F.col("ID") != 2, F.col("month")))
    rows = {(r.check_name): r.n_rows for r in publish(spark, dict(built, immigration=lost), root).collect()
            if r.table_name == "immigration"}
    assert rows["rows"] == 2 and rows["rejected"] == 1

import pytest

from arrivals.plans.builds import Lookups
from arrivals.schemas import ARRIVALS
from arrivals.sources.sinks import read_rejects
from arrivals.streaming import load_new_drops
from tests.test_builds import ARRIVALS_CSV, COUNTRY_CSV

MAY_CSV = """\
cicid,i94yr,i94mon,i94cit,i94res,i94port,arrdate,i94mode,i94addr,depdate,i94bir,i94visa,biryear,gender,airline,visatype
10.0,2016.0,5.0,101.0,582.0,NYC,20580.0,1.0,NY,,30.0,2.0,1986.0,F,AA,B2
11.0,2016.0,5.0,582.0,582.0,NYC,20581.0,2.0,NJ,,31.0,2.0,1985.0,M,AA,B2
"""

MAY_FIX_CSV = """\
i94addr,cicid,i94yr,i94mon,i94cit,i94res,i94port,arrdate,i94mode,depdate,i94bir,i94visa,biryear,gender,airline,visatype
NY,10.0,2016.0,5.0,101.0,582.0,NYC,20580.0,1.0,,30.0,2.0,1986.0,F,AA,B2
"""


def test_new_drops_load_incrementally(spark, tmp_path, write_text):
    drops = tmp_path / "drops"
    drops.mkdir()
    (drops / "2016_04.csv").write_text(ARRIVALS_CSV)
    lookups = Lookups.from_files(spark, country=write_text("country.csv", COUNTRY_CSV))
    target, ckpt = str(tmp_path / "fact"), str(tmp_path / "ckpt")

    load_new_drops(spark, str(drops), lookups, target, ckpt)
    assert sorted(r.ID for r in spark.read.parquet(target).collect()) == [1, 2, 4]

    (drops / "2016_05.csv").write_text(MAY_CSV)
    load_new_drops(spark, str(drops), lookups, target, ckpt)
    assert sorted(r.ID for r in spark.read.parquet(target).collect()) == [1, 2, 4, 10, 11]

    # nothing new: a re-run changes nothing
    load_new_drops(spark, str(drops), lookups, target, ckpt)
    assert spark.read.parquet(target).count() == 5

    # a corrected May drop (columns in another order) replaces May only
    (drops / "2016_05_fix.csv").write_text(MAY_FIX_CSV)
    load_new_drops(spark, str(drops), lookups, target, ckpt)
    rows = sorted((r.ID, r.month, r.arrival_state) for r in spark.read.parquet(target).collect())
    assert rows == [(1, 4, "NY"), (2, 4, "CA"), (4, 4, "FL"), (10, 5, "NY")]


def _drops(tmp_path, files):
    d = tmp_path / "drops"
    d.mkdir()
    for name, text in files.items():
        (d / name).write_text(text)
    return str(d)


def test_files_of_one_batch_keep_their_own_headers_and_names(spark, tmp_path, write_text):
    lookups = Lookups.from_files(spark, country=write_text("country.csv", COUNTRY_CSV))
    may = MAY_FIX_CSV.replace("10.0,2016", "12.0,2016")
    drops = _drops(tmp_path, {"2016_04.csv": ARRIVALS_CSV, "2016_05.CSV": MAY_CSV, "drop[1].txt": may})
    target = str(tmp_path / "fact")
    load_new_drops(spark, drops, lookups, target)
    rows = sorted((r.ID, r.month, r.arrival_state) for r in spark.read.parquet(target).collect())
    assert rows == [(1, 4, "NY"), (2, 4, "CA"), (4, 4, "FL"), (10, 5, "NY"), (11, 5, "NJ"), (12, 5, "NY")]


def test_a_stray_month_is_an_error(spark, tmp_path, write_text):
    lookups = Lookups.from_files(spark, country=write_text("country.csv", COUNTRY_CSV))
    drops = _drops(tmp_path, {"2016_04.csv": MAY_CSV})
    with pytest.raises(Exception, match="do not declare"):
        load_new_drops(spark, drops, lookups, str(tmp_path / "fact"))


def test_rows_without_a_month_survive_later_loads(spark, tmp_path, write_text):
    lookups = Lookups.from_files(spark, country=write_text("country.csv", COUNTRY_CSV))
    drops, target, ckpt = _drops(tmp_path, {"a.csv": MAY_CSV.replace("11.0,2016.0,5.0", "11.0,2016.0,x")}), str(tmp_path / "fact"), str(tmp_path / "c")
    load_new_drops(spark, drops, lookups, target, ckpt)
    (tmp_path / "drops" / "b.csv").write_text(MAY_CSV.replace("2016.0,5.0", "bad,6.0").replace("10.0,", "20.0,").replace("11.0,", "21.0,"))
    load_new_drops(spark, drops, lookups, target, ckpt)
    kept = {r.ID for r in spark.read.parquet(target).collect()}
    lost = {r.ID for r in read_rejects(spark, target, ARRIVALS.schema).collect()}
    assert (kept, lost) == ({10}, {11, 20, 21})

"""Several writers append to the fact at once."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from helpers import event, events, song, songs
from py4j.protocol import Py4JJavaError

from playmart import files
from playmart.plans.job import load_targets
from playmart.sinks import Warehouse, warehouse
from playmart.sinks.key_ranges import KeyRanges


@pytest.fixture
def mart(spark, tmp_path):
    mart = Warehouse(spark, str(tmp_path / "mart"), "key_ranges")
    mart.create()
    yield mart
    mart.drop()
    spark.sql("DROP DATABASE key_ranges CASCADE")


def ids(mart):
    return sorted(r.songplay_id for r in mart.table("songplays").select("songplay_id").collect())


def test_ranges_of_many_writers_touch_and_do_not_overlap(spark, tmp_path):
    ranges = KeyRanges(spark, str(tmp_path / "ids"), lambda: 5)
    counts = [3, 1, 7, 0, 2, 4, 1, 6] * 3
    with ThreadPoolExecutor(8) as pool:
        firsts = list(pool.map(ranges.reserve, counts))
    keys = [k for first, n in zip(firsts, counts) for k in range(first, first + n)]
    assert sorted(keys) == list(range(5, 5 + sum(counts)))
    assert ranges.next() == 5 + sum(counts)


def test_one_of_many_writers_gets_a_new_file(spark, tmp_path):
    def write(name, text):
        try:
            files.write_new(spark, f"{tmp_path}/new/{name}", text)
            return text
        except Py4JJavaError:
            return None

    with ThreadPoolExecutor(8) as pool:
        for name in "abcdefghijkl":
            written = [w for w in pool.map(write, [name] * 8, [f"{name}{i}" for i in range(8)]) if w]
            assert len(written) == 1 and files.read_text(spark, f"{tmp_path}/new/{name}") == written[0]
    # No checksum of another writer's text beside it, and no drafts.
    assert sorted(p.name for p in (tmp_path / "new").iterdir()) == list("abcdefghijkl")


def test_a_range_is_given_back_unless_another_follows(spark, tmp_path):
    ranges = KeyRanges(spark, str(tmp_path / "ids"), lambda: 0)
    first, second = ranges.reserve(10), ranges.reserve(5)
    ranges.give_back(first, 10)
    assert ranges.next() == 15
    ranges.give_back(second, 5)
    assert ranges.next() == 10 and ranges.reserve(1) == 10


def test_two_appends_at_once(spark, mart):
    load = events(spark, *[event(ts=1541990258796 + 1000 * i) for i in range(40)])
    one = songs(spark, song())
    load_targets(mart, load, one, tables=["songplays"])
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda _: load_targets(mart, load, one, "append", tables=["songplays"]), range(3)))
    spark.catalog.refreshTable(mart.name("songplays"))
    assert ids(mart) == list(range(160))
    assert mart.table("songplays").groupBy("start_time").count().filter("count <> 4").count() == 0
    assert spark.conf.get("spark.sql.files.openCostInBytes") == cost
    load_targets(mart, load, one, tables=["songplays"])  # a new generation starts over
    load_targets(mart, load, one, "append", tables=["songplays"])
    assert ids(mart) == list(range(80))


@pytest.mark.parametrize("at", ["write", "move"])
def test_a_failed_append_leaves_no_gap_and_no_rows(spark, mart, monkeypatch, at):
    load, one = events(spark, event(), event(ts=1541990259796)), songs(spark, song())
    load_targets(mart, load, one, "append", tables=["songplays"])

    def fail(*_):
        raise OSError("no")

    with monkeypatch.context() as broken:
        if at == "write":
            broken.setattr(Warehouse, "_write_generation", fail)
        else:
            broken.setattr(warehouse.files, "move_files", fail)
        with pytest.raises(OSError):
            load_targets(mart, load, one, "append", tables=["songplays"])
    assert ids(mart) == [0, 1]
    load_targets(mart, load, one, "append", tables=["songplays"])
    assert ids(mart) == [0, 1, 2, 3]

"""Boards that are pulled several times, with missing and repeated pages."""

import json

from pyspark.sql import functions as F

from flightlake.plans.board import arrivals_table
from flightlake.sources import fixtures as fx
from flightlake.sources.board import board_entries, board_rows, newest_board, read_board


def _page(folder, pull, code, page, ids):
    data = [{"flight": {"identification": {"id": i, "callsign": i}, "time": {"scheduled": {"departure": 1, "arrival": 2}}}} for i in ids]
    at = folder / f"pull={pull}"
    at.mkdir(parents=True, exist_ok=True)
    body = {"airport": {"code": code, "page": page, "pluginData": {"schedule": {"arrivals": {"data": data}}}}}
    (at / f"{code}-{page}-{len(list(at.iterdir()))}.json").write_text(json.dumps(body))


def _ids(spark, folder):
    got = arrivals_table(board_rows(newest_board(read_board(spark, str(folder))))).collect()
    return sorted((r.airport_code, r.flight_id) for r in got)


def test_newest_complete_pull(spark, tmp_path):
    for page, ids in ((1, ["a1", "a2"]), (2, ["a3"]), (3, ["a4"])):
        _page(tmp_path, "20240101", "AAA", page, ids)
    _page(tmp_path, "20240101", "BBB", 1, ["b1"])
    first = [("AAA", f"a{i}") for i in (1, 2, 3, 4)] + [("BBB", "b1")]
    assert _ids(spark, tmp_path) == first
    for page, ids in ((1, ["a1", "a2"]), (2, ["a3"]), (3, ["a4"]), (3, ["a4"])):  # landed twice: the table once
        _page(tmp_path, "20240102", "AAA", page, ids)
    assert _ids(spark, tmp_path) == first
    _page(tmp_path, "20240103", "AAA", 1, ["x1"])  # page 2 is missing
    _page(tmp_path, "20240103", "AAA", 3, ["x3"])
    _page(tmp_path, "20240103", "BBB", 1, [])      # empty
    _page(tmp_path, "20240103", "CCC", 2, ["c2"])
    assert _ids(spark, tmp_path) == first + [("CCC", "c2")]
    _page(tmp_path, "20240104", "AAA", 1, ["y1"])
    _page(tmp_path, "20240104", "AAA", 2, ["y2"])
    assert _ids(spark, tmp_path) == [("AAA", "y1"), ("AAA", "y2"), ("BBB", "b1"), ("CCC", "c2")]


def test_only_an_incomplete_pull(spark, tmp_path):
    _page(tmp_path, "1", "AAA", 1, ["a1"])
    _page(tmp_path, "1", "AAA", 4, ["a4"])
    assert _ids(spark, tmp_path) == [("AAA", "a1"), ("AAA", "a4")]


def _orders(spark, folder, rows):
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderpriority string").write.parquet(f"{folder}/orders.parquet")
    return str(folder)


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_pulls_make_each_page_once(spark, tmp_path):
    rows = [(k, c, "p") for k, c in ((1, 2), (2, 2), (150, 2), (3, 3), (104, 3), (5, 5), (None, 6), (6, 6), (6, 6), (7, None))]
    got = fx.board_pulls(spark, _orders(spark, tmp_path, rows))
    assert _plan(got).count("collect_list(") == 2  # the two lists of a page
    seen = got.select(F.get_json_object("payload", "$.airport.code").alias("code"),
                      F.get_json_object("payload", "$.airport.page").alias("page"), "pages", "pull").collect()
    want = []
    for code, pages in (("2", ["0", "1"]), ("3", ["0", "1"]), ("5", ["0"]), ("6", [None, "0"])):
        for page in pages:
            want += [(code, page, len(pages), "1")] * 2
            want += [(code, page, len(pages), "2")] * (code in "26")
            want += [(code, page, len(pages), "3")] * (code == "3" and page == "0")
        want.append((code, "0", len(pages), "4"))
    want.append((None, None, 1, "4"))  # entries without an airport: an empty text
    assert sorted(map(str, map(tuple, seen))) == sorted(map(str, want))


def test_newest_pull_reads_its_input_once(spark, tmp_path):
    """Pages are parsed once, the pull comes along with the entries: no join but the one with the newest pulls."""
    from flightlake.catalog import board_newest_pull
    df = board_newest_pull(spark, _orders(spark, tmp_path, [(k, k % 7, "p") for k in range(500)]))
    plan = _plan(df)
    assert "from_json(" not in plan and "collect_list(" not in plan
    assert plan.count("Join ") == 1 and "strategy=broadcast" in plan
    assert df.count() == 500 and df.where((F.col("airport_code") % 2 == 0) != (F.col("pull") == "2")).count() == 0


def test_entries_keep_columns(spark, tmp_path):
    _page(tmp_path, "1", "AAA", 1, ["a1", "a2"])
    got = board_entries(newest_board(read_board(spark, str(tmp_path))), keep=("pull",))
    assert got.columns == ["airport_code", "page", "pull", "idx", "Flight_type", "flight"]
    assert [r.pull for r in got.collect()] == ["pull=1", "pull=1"]

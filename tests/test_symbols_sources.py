"""Symbol predicate truth table, interval normalisation, HTML extraction, provider frames."""

import pytest
from pyspark.sql import functions as F

from barlake.functions.symbols import is_valid_symbol, normalize_interval
from barlake.sources.html import extract_symbols
from barlake.sources.landing import normalize_bars, session_hours

VALID = ["ZQ", "Q1W2E", "X.Y.Z", "\u00c9TA", "9Z", "W"]           # up to five, dots inside, any capital letter
INVALID = ["Q1W2EX", "X.Y.ZZ", "98765", "4.5", "zq", "Zq", "Z_Q", "Z\tQ", ".ZQ", "ZQ.", ".", " "]


def test_symbol_truth_table(spark):
    df = spark.createDataFrame([(s,) for s in VALID + INVALID] + [(None,)], "s string")
    got = {r.s: r.v for r in df.select("s", is_valid_symbol("s").alias("v")).collect()}
    for s in VALID:
        assert got[s] is True, s
    for s in INVALID:
        assert got[s] is False, s
    assert got[None] is False


@pytest.mark.parametrize("i,exp", [("5m", "5m"), ("1wk", "1wk"), ("3mo", "3mo"), ("7m", "1d"), ("", "1d")])
def test_normalize_interval(spark, i, exp):
    df = spark.createDataFrame([(i,)], "i string")
    assert df.select(normalize_interval("i").alias("o")).collect()[0].o == exp


def test_extract_symbols_links_dedup_sorted(spark):
    html = ("<ol><li><a href=\"/stocks/ZY/\">first</a><li><a href=\"/stocks/kq7/\">lower case</a>"
            "<li><a class=\"x\" href=\"/stocks/W.V//\">slashes</a><li><a href=\"/stocks/ZY/\">again</a>"
            "<li><a href=\"/stocks/SIXLET/\">too long</a></ol>")
    pages = spark.createDataFrame([(1, "u", html), (2, "v", "<p>no table</p>")], "page_id long, url string, html string")
    got = [r.symbol for r in extract_symbols(pages).collect()]
    assert got == ["KQ7", "W.V", "ZY"]


def test_table_symbols_first_table_second_cell(spark):
    from barlake.sources.html import table_symbols
    html = ("<div>no</div><Table id=a><thead><tr><th>#</th><th>Ticker name</th></tr></thead>"
            "<tr><td>1</td><td><a class='k' href='/stocks/qq/'>Q Corp</a></td></tr>"
            "<tr><td>2</td><td>\n <b>goog</b> </td></tr>"                      # text of a cell without a link
            "<tr><td>3</td><td><a href=\"/other/x\">zz.a</a></td></tr>"       # a link elsewhere: its text
            "<tr><td>4</td><td><a href=\"/stocks/MUCHTOOLONG/\">UV</a></td></tr>"
            "<tr><td>5</td><td>QQ</td><td>THIRD</td></tr><tr><td>ONE</td></tr></Table>"
            "<table><tr><td>1</td><td>NEXT</td></tr></table>")
    pages = spark.createDataFrame([(1, html), (2, "<p>AA</p>"), (3, None), (4, "<table></table>")], "page_id long, html string")
    assert [r.symbol for r in table_symbols(pages).collect()] == ["GOOG", "QQ", "UV", "ZZ.A"]


def test_blank_symbols_are_rejected():
    from datetime import datetime
    from barlake.sources.requests import bar_request
    with pytest.raises(ValueError):
        bar_request(["A", "  "], datetime(2024, 1, 1), datetime(2024, 1, 2))


def test_normalize_bars_missing_to_zero(spark):
    from datetime import datetime
    rows = [(datetime(2024, 1, 2), float("nan"), None, 1.0, 2.0, None)]
    f = spark.createDataFrame(rows, "Datetime timestamp_ntz, Open double, High double, Low double, Close double, "
                                    "Volume long")
    r = normalize_bars(f, "AAPL").collect()[0]
    assert (r.symbol, r.open, r.high, r.low, r.close, r.volume) == ("AAPL", 0.0, 0.0, 1.0, 2.0, 0)


def test_session_hours(spark):
    from datetime import datetime
    ts = [datetime(2024, 1, 2, h, m) for h, m in ((9, 0), (9, 30), (12, 0), (15, 55), (16, 0))]
    df = spark.createDataFrame([(t,) for t in ts], "timestamp timestamp_ntz")
    got = [r.timestamp for r in session_hours(df).orderBy("timestamp").collect()]
    assert got == ts[1:4]


def test_session_hours_with_zone(spark):
    from datetime import datetime
    # 14:30 UTC = 09:30 New York (EST, January); 21:00 UTC = 16:00 -> excluded
    ts = [datetime(2024, 1, 2, 14, 0), datetime(2024, 1, 2, 14, 30), datetime(2024, 1, 2, 21, 0)]
    df = spark.createDataFrame([(t,) for t in ts], "timestamp timestamp_ntz")
    got = [r.timestamp for r in session_hours(df, tz="America/New_York").collect()]
    assert got == [datetime(2024, 1, 2, 14, 30)]


def test_registered_table_symbols_read_the_pages_own_html(spark, monkeypatch):
    import __spark_entry__ as E
    from barlake.plans import extra
    sf = "/root/testdata/sf0.001"
    monkeypatch.setattr(extra.H, "table_symbols", lambda pages, prefix: pages)
    given = {r.page_id: r.html for r in E.queries()["extract_table_symbols"](spark, sf).collect()}
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    listed = lambda html: (html.replace("</td></tr>", "</li>").replace("<tr><td>*</td><td>", "<li>")
                           .replace("</table>", "</ul>").replace("<table>", "<ul>"))
    assert len(pages) == len(given) and all(listed(given[r.page_id]) == r.html for r in pages)

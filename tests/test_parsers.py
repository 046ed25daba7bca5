import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from ratewise.sources import text

ITEM_LINES = [
    "movieId,title,genres",
    '21,"Lantern, The (2003)",Mystery|Noir|Western',
    "4406,Dr. O'Neil: A Night in Oslo (2014),Noir",
    "movieId,title,genres",
    "7,  Spaced Title (2001)\t,Drama ",
]


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_item_parser_keeps_quotes_and_uses_last_comma(spark):
    rows = {r["mid"]: r for r in text.parse_item_lines(lines(spark, ITEM_LINES)).collect()}
    assert set(rows) == {21, 4406, 7}  # both header lines dropped
    assert rows[21]["title"] == '"Lantern, The (2003)"'
    assert rows[21]["genres"] == "Mystery|Noir|Western"
    assert rows[4406]["title"] == "Dr. O'Neil: A Night in Oslo (2014)"
    assert rows[4406]["genres"] == "Noir"
    assert rows[7]["title"] == "Spaced Title (2001)" and rows[7]["genres"] == "Drama"


def test_header_taken_from_first_line(spark):
    out = text.parse_item_lines(lines(spark, ITEM_LINES), header=None).collect()
    assert len(out) == 3


def test_bad_item_line_fails_the_job(spark):
    with pytest.raises((PySparkException, Py4JJavaError)):
        text.parse_item_lines(lines(spark, ["movieId,title,genres", "no commas here"])).collect()


def test_rating_parser_ignores_extra_fields_and_fails_on_bad_number(spark):
    out = text.parse_rating_lines(lines(spark, ["userId,movieId,rating,timestamp",
                                                "1,31,2.5,1300000000,extra"])).collect()
    assert [tuple(r) for r in out] == [(1, 31, 2.5, 1300000000)]
    with pytest.raises((PySparkException, Py4JJavaError)):
        text.parse_rating_lines(lines(spark, ["1,x,2.5,1"])).collect()


def test_event_parser(spark):
    out = text.parse_rating_events(lines(spark, ["17|203|4.5|1500000000"])).collect()
    assert [tuple(r) for r in out] == [(17, 203, 4.5, 1500000000)]


def test_recent_list_parser_trims_and_keeps_positions(spark):
    df = spark.createDataFrame([(17, ["31:4.0", " 88 : 5.0", "31:4.0"])], "uid int, items array<string>")
    out = [tuple(r) for r in text.parse_recent_lists(df).orderBy("pos").collect()]
    assert out == [(17, 0, 31, 4.0), (17, 1, 88, 5.0), (17, 2, 31, 4.0)]


def test_padded_numbers_are_accepted(spark):
    # documented leniency: Spark casts accept surrounding blanks
    out = text.parse_rating_lines(lines(spark, [" 1, 31,2.5 ,1300000000"])).collect()
    assert [tuple(r) for r in out] == [(1, 31, 2.5, 1300000000)]


def test_parsers_are_strict_even_without_ansi(spark):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        for bad in (["abc"], ["x,Title,Drama"]):
            with pytest.raises((PySparkException, Py4JJavaError)):
                text.parse_item_lines(lines(spark, bad), header="movieId,title,genres").collect()
        for bad in (["1,2,3.5"], ["1,x,3.5,7"]):
            with pytest.raises((PySparkException, Py4JJavaError)):
                text.parse_rating_lines(lines(spark, bad)).collect()
        with pytest.raises((PySparkException, Py4JJavaError)):
            text.parse_rating_events(lines(spark, ["1|2|x|4"])).collect()
        ok = text.parse_rating_events(lines(spark, ["1|2|3.5|4"])).collect()
        assert [tuple(r) for r in ok] == [(1, 2, 3.5, 4)]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)

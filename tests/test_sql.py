"""Parameters, typed reads, dates, LIKE, updates and SQL functions."""

import datetime
import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from courier.functions import sql as S


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(
        [("Text1", "Text2", 1, 2.0), ("x", None, None, -1.5)], "a string, b string, c bigint, d double"
    ).cache()


def test_named_parameters(spark, table):
    surplus = {"a": "Text1", "b": "Text2", "c": 1, "d": 2.0}
    assert S.run(spark, "SELECT * FROM {t} WHERE a = :a", surplus, t=table).count() == 1
    with pytest.raises(PySparkException):
        S.run(spark, "SELECT * FROM {t} WHERE a = :missing", surplus, t=table).count()


def test_positional_parameters(spark, table):
    assert S.run(spark, "SELECT * FROM {t} WHERE a = ? AND c = ?", ["Text1", True, 9], t=table).count() == 1
    with pytest.raises(PySparkException):
        S.run(spark, "SELECT * FROM {t} WHERE a = ? AND c = ?", ["Text1"], t=table).count()
    assert S.run(spark, "SELECT ? IS NULL AS n", [None]).first()["n"] is True


def test_binding():
    date = datetime.datetime(2024, 1, 2, 3, 4, 5, tzinfo=datetime.timezone.utc)
    assert S.bind_value(True) == 1 and S.bind_value(2**64 - 1) == -1 and S.bind_value(b"") == bytearray()
    assert S.bind_value(date) == date.timestamp()
    assert S.bind_value(date, "%Y-%m-%d") == "2024-01-02"
    assert S.bind_value(datetime.date(2024, 1, 2)) == "2024-01-02"


def test_typed_reads(spark):
    texts = ["12", " -7.9x", "1e3", "abc", "", None, "99999999999999999999", "-99999999999999999999", "4294967297"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    t = F.col("t")
    rows = df.select(S.read_long(t), S.read_int(t), S.read_double(t), S.read_bool(t), S.read_text(t)).collect()
    assert [r[0] for r in rows] == [12, -7, 1, 0, 0, 0, 2**63 - 1, -(2**63), 4294967297]
    assert [r[1] for r in rows] == [12, -7, 1, 0, 0, 0, -1, 0, 1]
    assert [r[2] for r in rows] == [12.0, -7.9, 1000.0, 0.0, 0.0, 0.0, 1e20, -1e20, 4294967297.0]
    assert [r[3] for r in rows] == [True, True, True, False, False, False, True, False, True]
    assert rows[5][4] is None
    reals = spark.createDataFrame([(2.9,), (-2.9,), (1e300,), (-1e300,), (math.nan,), (None,)], "d double")
    got = [r[0] for r in reals.select(S.read_long(F.col("d"), "double")).collect()]
    assert got == [2, -2, 2**63 - 1, -(2**63), 0, 0]
    empty = spark.range(1).select(S.read_bytes(F.lit("")).alias("b")).first()["b"]
    assert empty is not None and len(empty) == 0


def test_dates(spark):
    df = spark.sql("SELECT TIMESTAMP'2024-03-05 04:06:07.5' AS ts")
    row = df.select(
        S.store_date(F.col("ts")).alias("seconds"), S.store_date(F.col("ts"), "yyyy/MM/dd HH:mm:ss").alias("text")
    )
    kept = row.select(
        "seconds", "text", S.read_date(F.col("seconds")).alias("a"),
        S.read_date(F.col("text"), "yyyy/MM/dd HH:mm:ss").alias("b"),
        S.read_date(F.lit("nonsense"), "yyyy/MM/dd HH:mm:ss").alias("bad"),
    ).first()
    assert kept["seconds"] == 1709611567.5 and kept["text"] == "2024/03/05 04:06:07"
    assert kept["a"].microsecond == 500000 and kept["b"].second == 7 and kept["bad"] is None


def test_like(spark):
    df = spark.createDataFrame([("hi",), ("Hello",), ("not",), ("Éh",), ("h\\x",), ("h%",)], "foo string")

    def found(pattern):
        return [r[0] for r in df.where(S.like(F.col("foo"), pattern)).collect()]

    assert found("h%") == ["hi", "Hello", "h\\x", "h%"]
    assert found("H_") == ["hi", "h%"]
    assert found("é%") == []  # only ASCII letters fold
    assert found("h\\%") == ["h\\x"]


def test_update(table):
    changed = S.update(table, {"a": F.lit("New"), "c": F.col("c") + 1}, F.col("b") == "Text2")
    assert [(r["a"], r["c"]) for r in changed.collect()] == [("New", 2), ("x", None)]
    assert S.rows_changed(table, F.col("b") == "Text2").first()["changed"] == 1


def test_functions(spark):
    S.register_functions(spark)
    row = spark.sql(
        """SELECT remove_diacritics('Crème brûlée') AS t, remove_diacritics(NULL) AS n,
           hypotenuse(3, 4) AS h, hypotenuse(NULL, 4) AS one,
           set_alternating_bytes(X'AABBCCDDEE') AS odd, set_alternating_bytes(X'') AS none"""
    ).first()
    assert (row["t"], row["n"], row["h"], row["one"]) == ("Creme brulee", None, 5.0, 4.0)
    assert bytes(row["odd"]) == b"\x01\xbb\x01\xdd\x01" and bytes(row["none"]) == b""
    for call, message in (
        ("hypotenuse(NULL, NULL)", "hypotenuse needs a number"),
        ("set_alternating_bytes(NULL)", "set_alternating_bytes needs bytes"),
    ):
        with pytest.raises(PySparkException, match=message):
            spark.sql(f"SELECT {call} AS x FROM range(1)").collect()
    columns = spark.sql("SELECT 5.0D AS a, 12.0D AS b, X'0000' AS c")
    got = columns.select(S.hypotenuse(F.col("a"), F.col("b")), S.set_alternating_bytes(F.col("c"))).first()
    assert got[0] == 13.0 and bytes(got[1]) == b"\x01\x00"

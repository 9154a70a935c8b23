"""JDBC options, splits and runs, without a database."""

import datetime as dt
import random
from decimal import Decimal

import pytest

from vigil.sources import jdbc, sinks
from vigil.sources.sinks import JdbcSink


@pytest.mark.parametrize("key", ["url", "dbtable", "driver", "query", "user", "sessionInitStatement", "customSchema"])
def test_catalogs_cannot_redirect_a_read(key):
    for options in ({key: "x"}, {"read_conf": {"options": {key: "x"}}}):
        with pytest.raises(ValueError, match=key):
            jdbc.reader_options("jdbc:a", "t", {"user": "u", "password": "p"}, options)


def _shares(spark, view, predicates):
    total = spark.table(view).count()
    counts = [spark.table(view).where(p).count() for p in predicates]
    assert sum(counts) == total  # every row once
    return [c / total for c in counts]


def test_skewed_columns_are_cut_evenly(spark):
    rng = random.Random(5)
    values = [int(10 ** (6 * rng.random())) for _ in range(4000)] + [None] * 10  # most rows at small numbers
    spark.createDataFrame([(v,) for v in values], "id long").createOrReplaceTempView("skewed")
    cuts = [r[0] for r in spark.sql(jdbc.cuts_query("skewed", "id", 16)).collect()]
    shares = _shares(spark, "skewed", jdbc.equi_depth_predicates("id", cuts))
    assert len(shares) == 16 and max(shares) <= 2 / 16
    # equal strides would put nearly all rows into the first
    assert spark.table("skewed").where("id < 1000000 / 16").count() > 0.7 * len(values)


@pytest.mark.parametrize("kind", ["date", "timestamp", "decimal(10,2)", "string", "double"])
def test_every_kind_of_value_can_be_a_cut(spark, kind):
    text = {"date": "date_add(DATE'2024-01-01', CAST(id AS int))", "timestamp": "timestamp_micros(id * 86400000001)",
            "decimal(10,2)": "id / 3", "string": "concat('it''s ', id)", "double": "id * 1e-3"}[kind]
    spark.range(100).selectExpr(f"CAST({text} AS {kind}) AS c").createOrReplaceTempView("cut")
    cuts = [r[0] for r in spark.sql(jdbc.cuts_query("cut", "c", 4)).collect()]
    assert max(_shares(spark, "cut", jdbc.equi_depth_predicates("c", cuts))) <= 0.5


def test_cuts_of_little():
    assert jdbc.equi_depth_predicates("c", []) == []  # an empty table
    assert jdbc.equi_depth_predicates("c", [7, 7]) == []  # one value
    assert jdbc.equi_depth_predicates("c", [1, 5]) == ["c < 5 OR c IS NULL", "c >= 5"]
    assert [jdbc.literal(v) for v in (1, Decimal("1.50"), dt.date(2024, 1, 2), "it's")] == [
        "1", "1.50", "DATE '2024-01-02'", "'it''s'"]
    with pytest.raises(ValueError):
        jdbc.literal(None)


class Tables:
    """Stands in for ``spark.read`` of a database: answers from DataFrames and keeps the calls."""

    def __init__(self, spark, table):
        self.spark, self.table, self.calls = spark, table, []

    def load(self, spark, opts):
        self.calls.append(opts)
        return self.spark.sql(opts["query"]) if "query" in opts else self.spark.table(opts["dbtable"])

    @property
    def read(self):
        return self

    def jdbc(self, url, table, predicates, properties):
        self.calls.append({"url": url, "predicates": predicates, **properties})
        return predicates


def test_reads_are_split_by_default(spark, monkeypatch):
    spark.createDataFrame([("a", i) for i in range(100)], "name string, id long").createOrReplaceTempView("wide")
    fake = Tables(spark, "wide")
    monkeypatch.setattr(jdbc, "_load", fake.load)
    opts = jdbc.reader_options("jdbc:x", "wide", {"user": "u"}, num_partitions=4)
    assert len(jdbc.read(fake, {**opts, "split": "auto"})) == 4
    assert "id >= 25 AND id < 50" in fake.calls[-1]["predicates"] and fake.calls[-1]["user"] == "u"
    assert jdbc.read(fake, opts).count() == 100 and len(fake.calls) == 4  # no column named, none looked for
    spark.table("wide").where("false").createOrReplaceTempView("none")
    empty = jdbc.reader_options("jdbc:x", "none", partition_column="id")
    assert jdbc.read(fake, empty).count() == 0
    assert all("None" not in str(c) for c in fake.calls)
    bounded = jdbc.reader_options("jdbc:x", "wide", partition_column="id", lower_bound=0, upper_bound=9)
    jdbc.read(fake, bounded)
    assert fake.calls[-1]["numPartitions"] == str(jdbc.CONNECTIONS)


class Connection:
    """A connection that keeps what was committed; a statement with ``fails`` raises."""

    def __init__(self, fails="-"):
        self.fails, self.open, self.done, self.log = fails, [], [], []

    def setAutoCommit(self, on):
        assert on is False

    def createStatement(self):
        return self

    def executeUpdate(self, sql):
        if self.fails in sql:
            raise RuntimeError("connection lost")
        self.open.append(sql)

    def commit(self):
        self.done += self.open
        self.open = []

    def rollback(self):
        self.open = []
        self.log.append("rollback")

    def close(self):
        self.log.append("close")


def test_a_transaction_is_all_or_none():
    good, bad = Connection(), Connection("second")
    jdbc.all_or_none(good, ["first", "second"])
    assert good.done == ["first", "second"] and "rollback" not in good.log and "close" in good.log
    with pytest.raises(RuntimeError):
        jdbc.all_or_none(bad, ["first", "second"])
    assert bad.done == [] and bad.log.count("rollback") == 1 and bad.log[-1] == "close"


def test_a_jdbc_run_is_staged_and_inserted_once(spark, monkeypatch):
    sent, ran = [], []
    monkeypatch.setattr(sinks._jdbc, "append", lambda df, url, name, *a: sent.append((name, a[-1], df.columns, df.count())))
    monkeypatch.setattr(sinks._jdbc, "columns", lambda *a: ["k", "v", "vigil_row"])
    monkeypatch.setattr(sinks._jdbc, "transaction", lambda s, url, p, sql: ran.append(sql))
    sink = JdbcSink("jdbc:x", {"user": "u"})
    df = spark.createDataFrame([(1, 2), (1, 2)], "k int, v int")
    for _ in range(2):  # an attempt, and the attempt after it failed
        sink.append(df, "result", "day-1")
    assert sent[0] == sent[2] == ("result__day_1", "overwrite", ["k", "v", "vigil_row"], 2)
    assert sent[1][0] == "result" and sent[1][3] == 0 and not ran  # nothing reaches the table before it is published
    sink.publish(spark, "day-1", ["result"])
    inserts, drops = ran
    assert inserts == [
        "INSERT INTO result (k, v) SELECT k, v FROM (SELECT DISTINCT * FROM result__day_1) staged",
        "INSERT INTO vigil_runs (run_id) VALUES ('day-1')",
    ]
    assert drops == ["DROP TABLE result__day_1"]

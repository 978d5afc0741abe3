"""What keeps the guarded texts from growing faster than their input."""

from tallyforge.operators import guard
from tallyforge.plans.catalog import QUERIES, Tables
from tallyforge.sources import adapter


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_line_items_are_read_once(spark, data):
    facts, plain = Tables(spark, data, once=True).facts, adapter.facts(spark, data)
    assert facts.dtypes == plain.dtypes and facts.exceptAll(plain).count() == 0 and facts.count() == plain.count()
    for name in ("guarded_texts", "payloads", "refusal_gate"):
        assert "l_extendedprice" not in plan(QUERIES[name](spark, data))


def test_texts_of_one_ticker_are_no_single_task(spark):
    rows = [("T", "Some 12.50 of it")] * 50 + [("T", "no digit")] * 50 + [("T", None), (None, "a $5 x"), ("U", "at 5%")]
    own = spark.createDataFrame([("T", [5.0], [])], "ticker string, values array<double>, accessions array<string>")
    found = guard.guard(spark.createDataFrame(rows, "ticker string, text string"), own)
    assert "hashpartitioning(ticker" not in plan(found)
    expected = {"Some 12.50 of it": "bare number: 12.50", "a $5 x": "unknown amount: $5", "at 5%": "unknown per cent: 5%"}
    got = found.collect()
    assert sorted(map(str, got)) == sorted(map(str, [type(got[0])(ticker=t, text=x, violation=expected.get(x)) for t, x in rows]))

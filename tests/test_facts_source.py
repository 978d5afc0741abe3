import json

import pytest

from tallyforge.sources import companyfacts, facts_source


def document(cik, value):
    entry = {"end": "2024-03-31", "val": value, "accn": "0000000001-24-000001", "fy": 2024, "fp": "Q1", "form": "10-Q", "filed": "2024-05-01"}
    return json.dumps({"cik": cik, "facts": {"us-gaap": {"Revenues": {"label": "x", "units": {"USD": [entry]}}}}})


@pytest.fixture
def folder(tmp_path):
    for cik in (7, 8, 9):
        (tmp_path / f"CIK{cik:010d}.json").write_text(document(cik, cik * 1.5))
    return str(tmp_path)


def test_documents_come_one_partition_a_company(spark, folder):
    facts_source.register(spark, {" t ": 7, "U": 8, "V": 9}, facts_source.from_folder(folder))
    rows = spark.read.format("companyfacts").load()
    assert rows.rdd.getNumPartitions() == 3 and rows.columns == ["ticker", "cik", "json"]
    got = companyfacts.ingest(rows).collect()
    assert {(r.ticker, r.line_item, r.value) for r in got} == {("T", "Revenue", 10.5), ("U", "Revenue", 12.0), ("V", "Revenue", 13.5)}


def test_conditions_on_keys_choose_partitions(spark, folder):
    facts_source.register(spark, {"T": 7, "U": 8, "GONE": 10}, facts_source.from_folder(folder), name="some_facts")
    for condition, expected in (("ticker = 'T'", {"T"}), ("ticker IN ('T', 'U')", {"T", "U"}), ("cik = 8 AND json IS NOT NULL", {"U"}), ("ticker = 'T' AND cik = 8", set()), ("ticker IN ('T', 'U') AND length(ticker) = 2", set())):
        rows = spark.read.format("some_facts").option("pushdown", "true").load()
        assert {r.ticker for r in rows.where(condition).collect()} == expected  # GONE is never fetched
    rows = spark.read.format("some_facts").option("tickers", " u, t").load()
    assert [{r.ticker for r in rows.where(c).collect()} for c in ("ticker = 'T'", "true", "cik = 8", "true")] == [{"T"}, {"T", "U"}, {"U"}, {"T", "U"}]
    with pytest.raises(Exception, match="CIK0000000010"):
        spark.read.format("some_facts").load().collect()

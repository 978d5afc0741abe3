"""A Spark data source of company-facts documents: one partition a company, fetched where the task runs.

    register(spark, {"T": 7, "U": 8}, from_folder("/shared/companyfacts"))
    spark.read.format("companyfacts").option("tickers", "T,U").load()

Option tickers names the companies to fetch (all, without it). With option pushdown=true, conditions on ticker or cik (equal,
or in a list) choose the partitions instead. Spark 4.1 keeps what was pushed with the loaded relation, and a later query of
the same frame without conditions would miss the others, so a frame loaded with pushdown is for one query.

The fetcher is any function of a company's number that returns its JSON; it is sent to the tasks, and what it raises
fails the task, which Spark runs again. Tickers are compared in upper case without spaces.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

SCHEMA = "ticker string, cik long, json string"


class Company(InputPartition):
    def __init__(self, ticker: str, cik: int):
        super().__init__((ticker, cik))
        self.ticker, self.cik = ticker, cik


class FactsReader(DataSourceReader):
    def __init__(self, companies: dict[str, int], fetch: Callable[[int], str]):
        self.companies, self.fetch = companies, fetch

    def partitions(self) -> list[InputPartition]:
        return [Company(t, c) for t, c in sorted(self.companies.items())]

    def read(self, partition: Company) -> Iterator[tuple]:
        if isinstance(partition, Company):  # no company, no partition: Spark then asks for one that is None
            yield partition.ticker, partition.cik, self.fetch(partition.cik)


class PushingReader(FactsReader):
    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes conditions on the keys; all others are left to Spark."""
        for f in filters:
            values = f.value if isinstance(f, In) else (f.value,) if isinstance(f, EqualTo) else None
            if values is None or f.attribute not in (("ticker",), ("cik",)):
                yield f
                continue
            key = (lambda t, c: t) if f.attribute == ("ticker",) else (lambda t, c: c)
            self.companies = {t: c for t, c in self.companies.items() if key(t, c) in values}


def register(spark: SparkSession, companies: dict[str, int], fetch: Callable[[int], str], name: str = "companyfacts") -> None:
    """Makes format(name) read these companies through fetch."""
    known = {t.strip().upper(): int(c) for t, c in companies.items()}

    class CompanyFacts(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema) -> DataSourceReader:
            asked = {t.strip().upper() for t in self.options.get("tickers", "").split(",") if t.strip()}
            kind = PushingReader if self.options.get("pushdown", "").lower() == "true" else FactsReader
            return kind({t: c for t, c in known.items() if not asked or t in asked}, fetch)

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(CompanyFacts)


def from_folder(path: str) -> Callable[[int], str]:
    """Fetches CIK##########.json from a folder that all tasks see."""

    def fetch(cik: int) -> str:
        with open(f"{path}/CIK{cik:010d}.json", encoding="utf-8") as f:
            return f.read()

    return fetch

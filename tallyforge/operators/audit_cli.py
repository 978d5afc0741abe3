"""Offline check of a text against a payload file: exit 0 if it passes, 1 if not, 2 if unreadable."""

from __future__ import annotations

import sys

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..sources.readers import payload_json
from .guard import guard, payload_values


def check(spark: SparkSession, text_path: str, payload_path: str) -> str | None:
    """The first rule that the text breaks, or None. The payload is JSON itself or the first fenced JSON block of a text."""
    texts = spark.read.text(text_path, wholetext=True).select(F.lit("").alias("ticker"), F.col("value").alias("text"))
    payload = spark.read.text(payload_path, wholetext=True).select(F.lit("").alias("ticker"), payload_json("value").alias("payload"))
    if payload.where(F.try_parse_json("payload").isNotNull()).isEmpty():
        raise ValueError("no payload found")
    return guard(texts, payload_values(payload)).first().violation


def main(args: list[str]) -> int:
    try:
        text_path, payload_path = args
        found = check(SparkSession.builder.getOrCreate(), text_path, payload_path)
    except (PySparkException, ValueError) as e:
        print(f"cannot check: {str(e).splitlines()[0]}", file=sys.stderr)
        return 2
    print(found or "passes")
    return int(found is not None)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

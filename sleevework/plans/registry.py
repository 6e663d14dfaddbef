"""Registration of queries and composition of SQL texts out of named views."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    check_sql: str | None


QUERIES: dict[str, Query] = {}
VIEWS: dict[str, str] = {}  # the same text on Spark and on the checking engine
CHECK_VIEWS: dict[str, str] = {}  # only on the checking engine


def query(name: str, check_sql: str | None = None) -> Callable[[Run], Run]:
    """Register ``run(spark, sf_dir)`` under ``name``, with the SQL that must give the same rows."""

    def add(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(run, check_sql)
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_key(rows: DataFrame, key: str) -> DataFrame:
    """Narrow rows dealt by key ahead of work, such as parsing, that costs far more than moving them."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def _needed(text: str, views: dict[str, str]) -> list[str]:
    """The views a text refers to, dependencies first."""
    order: list[str] = []

    def visit(part: str) -> None:
        for name in re.findall(r"\b[vx]_\w+", part):
            if name in views and name not in order:
                visit(views[name])
                if name not in order:
                    order.append(name)

    visit(text)
    return order


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A shared view over the parquet tables, as one query without registering anything."""
    order = _needed(name, VIEWS)
    body = " ".join(VIEWS[n] for n in order)
    tables = [t for t in TABLES if re.search(rf"\b{t}\b", body)]
    ctes = [f"{t} as (select * from parquet.`{sf_dir}/{t}.parquet`)" for t in tables]
    ctes += [f"{n} as ({VIEWS[n]})" for n in order]
    return spark.sql(f"with {', '.join(ctes)} select * from {name}")


def notes_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The notes of every album, dealt by album for their parsing."""
    return by_key(view(spark, sf_dir, "v_notes"), "album_id")


def checking_sql(text: str) -> str:
    """A query text completed with the definitions of the views it refers to."""
    views = {**VIEWS, **CHECK_VIEWS}
    order = _needed(text, views)
    ctes = ",\n".join(f"{n} as ({views[n].strip()})" for n in order)
    return f"with {ctes}\n{text.strip()}" if ctes else text.strip()

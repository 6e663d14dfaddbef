"""The whole quality comparison as one set of result tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sleevework.operators import notes as N
from sleevework.operators import pages as P
from sleevework.operators import quality as Q


def matching_columns(credits: DataFrame, *labels: str) -> DataFrame:
    """What matching reads of mined credits: the key, the order in the notes, role and names."""
    return credits.select(*labels, "album_id", "track", F.array("pos", "grp").alias("ord"), "role", "names")


Keep = Callable[[str, DataFrame], DataFrame]


def written(path: str) -> Keep:
    """Each result is written below ``path`` by one action and read again by what follows, so none is worked out twice."""

    def keep(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{path}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{path}/{name}")

    return keep


def quality_run(
    sources: DataFrame,
    golden: DataFrame,
    notes: DataFrame,
    tracks: DataFrame,
    golden_credits: DataFrame,
    keep: Keep,
    backends: Mapping[str, N.Backend] | None = None,
) -> dict[str, DataFrame]:
    """Result tables by name: scores, their counts, the diff of all sources, mined credits, ranking and coverage.

    ``keep=written(path)`` stores every table as soon as it is built, the shared ones (scores, credits) ahead of those
    made of them, so matching joins stored tables and a lost executor costs no second mining.

    ``sources`` is long (source, album_id, field, value, ord): a source that could not be had is
    simply absent from it. Without backends only the structural tables have rows.
    """
    chosen = N.BACKENDS if backends is None else backends
    scores = keep("field_scores", Q.score(sources, golden))
    tables = {"field_scores": scores, "agreement": keep("agreement", Q.agreement(scores)), "scorecard": keep("scorecard", Q.scorecard(scores))}
    if chosen:
        albums = notes.select("album_id")
        produced = keep("credits", matching_columns(N.run_backends(notes, tracks, chosen), "backend"))
        backend_scores = keep("backend_scores", Q.score_backends(produced, golden_credits, list(chosen), albums))
        tables |= {"credits": produced, "backend_scores": backend_scores, "ranking": keep("ranking", Q.rank_backends(backend_scores))}
        for name in chosen:
            tables[f"coverage_{name}"] = keep(f"coverage_{name}", Q.coverage(albums, tracks, produced.where(F.col("backend") == name)))
    return tables


OURS = "ours"


def run_from_pages(
    pages: DataFrame,
    golden: DataFrame,
    golden_credits: DataFrame,
    keep: Keep,
    others: DataFrame | None = None,
    names: Sequence[str] = (OURS,),
    backends: Mapping[str, N.Backend] | None = None,
) -> dict[str, DataFrame]:
    """The whole comparison from album pages on: documents, canonical fields, scores, diff, mined credits, ranking.

    ``pages`` is (page_id, url, html), ``golden`` long (album_id, field, value, ord), ``golden_credits`` as matching reads
    them, ``others`` more sources in long form, ``names`` the sources in the order of the diff. The pages are read once: all
    that follows reads the album documents.
    """
    albums = keep("albums", P.album_records(pages).withColumn("album_id", F.col("id")))
    fields = keep("fields", Q.canonical(albums))
    ours = fields.select(F.lit(OURS).alias("source"), "album_id", "field", "value", "ord")
    sources = ours if others is None else ours.unionByName(others.select(*ours.columns))
    numbers = F.flatten(F.transform("discs", lambda d: F.transform(d["tracks"], lambda t: t["number"])))
    tracks = albums.select("album_id", F.explode(numbers).alias("number"))
    tables = quality_run(sources, golden, albums.select("album_id", "notes"), tracks, golden_credits, keep, backends)
    diff = keep("diff", Q.nway_diff(tables["field_scores"], list(names), golden))
    return {"albums": albums, "fields": fields, "diff": diff, **tables}


def summary(tables: Mapping[str, DataFrame], backend: str = "rules") -> DataFrame:
    """(section, name, matches, scored, precision, recall): the figures of a run on a few rows."""
    none = F.lit(None).cast("double")
    card = tables["scorecard"].select(
        F.lit("scorecard").alias("section"), F.col("source").alias("name"), "matches", "scored", none.alias("precision"), none.alias("recall")
    )
    if "ranking" not in tables:  # a run without backends
        return card
    ranks = tables["ranking"].where("over_all").select(
        F.lit("enrichment").alias("section"), F.col("backend").alias("name"), F.col("matched").alias("matches"), F.col("golden").alias("scored"), "precision", "recall"
    )
    covered = tables[f"coverage_{backend}"].agg(F.sum("tracks_with_credits").alias("matches"), F.sum("total_tracks").alias("scored")).select(
        F.lit("coverage").alias("section"), F.lit(backend).alias("name"), "matches", "scored", none.alias("precision"), none.alias("recall")
    )
    out = card.unionByName(ranks).unionByName(covered)
    if "diff" in tables:
        golden_fields = F.count_if(F.col("rank_place") == 0).alias("scored")
        counts = tables["diff"].agg(F.count(F.lit(1)).alias("matches"), golden_fields)
        out = out.unionByName(counts.select(F.lit("diff").alias("section"), F.lit("fields").alias("name"), "matches", "scored", none.alias("precision"), none.alias("recall")))
    return out


def write_tables(tables: Mapping[str, DataFrame], path: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def first_n(hits: DataFrame, key: str, order: str, n: int) -> DataFrame:
    """The first ``n`` rows of each key with their rank; tasks drop later rows before the shuffle."""
    ranked = hits.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(order)))
    return ranked.where(F.col("rank") <= n)

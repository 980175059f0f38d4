"""The catalogue's algebra: outcomes, index overlay, totals, incremental runs, shards.

Index rows: id, status, reason, name, version, nodecount, edgecount,
submission_id, source_bytes, http_status, download_url.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ontoloom.functions import text as X
from ontoloom.functions import vocab as V


def skiplisted(acronym: Column) -> Column:
    return X.acronym(acronym).isin(*V.GIANTS)


def drop_skiplisted(df: DataFrame, col: str = "id", enabled: bool = True) -> DataFrame:
    return df.where(~F.coalesce(skiplisted(F.col(col)), F.lit(False))) if enabled else df


def concrete(submission: Column) -> Column:
    """A submission id that names one: neither null, empty nor NA."""
    return F.coalesce((submission != "") & (submission != "NA"), F.lit(False))


def outcome(
    acronym: Column, metadata_code: Column, has_submission: Column, request_failed: Column, code: Column,
    has_filename: Column, content_length: Column, body_bytes: Column, limit: int,
) -> Column:
    """The reason of a download's outcome, empty for a success; the first test that holds decides.

    A limit of 0 switches the size gates off; a null length passes them.
    """
    gate = lambda n: F.lit(limit > 0) & F.coalesce(n > limit, F.lit(False))
    no = lambda c: ~F.coalesce(c, F.lit(False))
    return (
        F.when(skiplisted(acronym), "skiplist")
        .when(F.coalesce(metadata_code, F.lit(0)) != 200, "metadata_http_error")
        .when(no(has_submission), "no_submission")
        .when(F.coalesce(request_failed, F.lit(False)), "download_error")
        .when(code.isin(*V.LICENSE_CODES), V.LICENSED)
        .when(code == 404, "no_download_file")
        .when(no(code.between(200, 299)), "download_http_error")
        .when(no(has_filename), "not_downloadable")
        .when(gate(content_length) | gate(body_bytes), V.TOO_LARGE)
        .otherwise("")
    )


def download_status(reason: Column) -> Column:
    return F.when(reason == "", V.DOWNLOADED).when(reason.isin("skiplist", V.TOO_LARGE), V.SKIPPED).otherwise(V.ERROR)


def index_status(status: Column) -> Column:
    """Of a download's status; null for a download, whose transform decides."""
    return F.when(status == V.SKIPPED, V.SKIP).when(status == V.ERROR, V.FAILED)


def transform_status(reason: Column) -> Column:
    return F.when(F.coalesce(reason, F.lit("")) == "", V.OK).when(reason.isin(V.TOO_LARGE, V.TOO_SLOW), V.SKIP).otherwise(V.FAILED)


def too_large(unpacked: Column, limit: int) -> Column:
    """The gate behind decompression: strictly above the limit; 0 switches it off."""
    return F.lit(limit != 0) & F.coalesce(unpacked > limit, F.lit(False))


def last_of_each(df: DataFrame, key: str, pos: str) -> DataFrame:
    """The last row of each key by position, its values as they are there."""
    value = F.struct(*[c for c in df.columns if c != key])
    return df.groupBy(key).agg(F.max_by(value, pos).alias("v")).select(key, "v.*")


def submissions(catalogue: DataFrame) -> DataFrame:
    """(id, submission_id, pos): a repeated id keeps its first position and its last value."""
    return catalogue.groupBy("id").agg(F.max_by(F.coalesce("submission_id", F.lit("")), "pos").alias("submission_id"), F.min("pos").alias("pos"))


def with_report(files: DataFrame, report: DataFrame) -> DataFrame:
    """Files with what the download report knows; without a row there, the defaults."""
    r = report.select("id", "name", "version", "submission_id", "source_bytes")
    out = files.join(r, "id", "left")
    return out.withColumns({
        "name": F.coalesce("name", F.lit("")), "version": F.coalesce("version", F.lit("")),
        "submission_id": F.coalesce("submission_id", F.lit("NA")), "source_bytes": F.coalesce("source_bytes", F.lit(0)),
    })


def overlay(*layers: DataFrame) -> DataFrame:
    """One row per id, from the first layer that has it; whole rows, so no column of a lower layer shines through.

    One union and one aggregation, whatever the number of layers.
    """
    every = None
    for k, layer in enumerate(layers):
        ranked = layer.withColumn("_layer", F.lit(k))
        every = ranked if every is None else every.unionByName(ranked, allowMissingColumns=True)
    value = F.struct(*[c for c in every.columns if c not in ("id", "_layer")])
    return every.groupBy("id").agg(F.min_by(value, "_layer").alias("v")).select("id", "v.*")


def index_overlay(base: DataFrame, fragments: DataFrame, asset_prefix: str) -> DataFrame:
    """The next index: this run's rows over the last index.

    A row of this run that is OK gets this run's URL and any other none; rows
    that this run didn't touch keep theirs.
    """
    url = F.when(F.col("status") == V.OK, F.concat(F.lit(asset_prefix.rstrip("/") + "/"), "id", F.lit(".tar.gz")))
    return overlay(fragments.withColumn("download_url", url), base)


def add_giants(index: DataFrame, giants: DataFrame) -> DataFrame:
    """The index and, as skipped, the giants that it doesn't report."""
    new = giants.select("id").distinct().join(index, "id", "left_anti")
    rows = new.select("id", F.lit(V.SKIP).alias("status"), F.lit("skiplist").alias("reason"), F.col("id").alias("name"))
    return index.unionByName(rows, allowMissingColumns=True).fillna({"nodecount": 0, "edgecount": 0})


def url_manifest(index: DataFrame) -> DataFrame:
    return index.where((F.col("status") == V.OK) & F.col("download_url").isNotNull()).select("id", "download_url")


def totals(index: DataFrame) -> DataFrame:
    """One row: counts by status, licensed ones apart from the failed, sums over all rows. A single pass."""
    licensed = F.count_if(F.col("reason") == V.LICENSED)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return index.agg(
        F.count_if(F.col("status") == V.OK).alias("totalcount"), F.count_if(F.col("status") == V.SKIP).alias("skippedcount"),
        (F.count_if(F.col("status") == V.FAILED) - licensed).alias("failedcount"), licensed.alias("licensedcount"),
        total("nodecount").alias("totalnodecount"), total("edgecount").alias("totaledgecount"),
    )


def accounted(index: DataFrame) -> DataFrame:
    """One row (balanced): do the counts add up to the rows?"""
    t = totals(index)
    n = index.agg(F.count(F.lit(1)).alias("n"))
    return t.crossJoin(n).select((F.col("totalcount") + F.col("skippedcount") + F.col("failedcount") + F.col("licensedcount") == F.col("n")).alias("balanced"))  # one row each


def failure_log(report: DataFrame) -> DataFrame:
    """One row: how many were skipped, failed, of those licensed, and really in error."""
    err, lic = F.col("status") == V.ERROR, F.col("reason") == V.LICENSED
    return report.agg(
        F.count_if(F.col("status") == V.SKIPPED).alias("skipped"), F.count_if(err).alias("errored"),
        F.count_if(err & lic).alias("licensed"), F.count_if(err & ~F.coalesce(lic, F.lit(False))).alias("real_errors"),
    )


def changed(catalogue: DataFrame, index: DataFrame) -> DataFrame:
    """The catalogue's rows whose submission differs from the index's; an id without a concrete one there always does."""
    known = index.where(concrete(F.col("submission_id"))).select("id", F.col("submission_id").alias("_known"))
    return catalogue.join(known, "id", "left").where(~F.col("submission_id").eqNullSafe(F.col("_known"))).drop("_known")


def change_counts(catalogue: DataFrame, index: DataFrame) -> DataFrame:
    known = index.where(concrete(F.col("submission_id"))).select("id", F.col("submission_id").alias("_known"))
    same = F.col("submission_id").eqNullSafe(F.col("_known"))
    return catalogue.join(known, "id", "left").agg(F.count_if(same).alias("unchanged"), F.count_if(~same).alias("to_transform"))


def shard_plan(items: DataFrame, shards: int, id_col: str = "id", pos_col: str = "pos") -> DataFrame:
    """(shard, acronyms): items dealt round-robin by position, each shard's ids in order.

    Positions have to be unique. A shard's ids are one string, as a job's matrix
    takes them: this is for catalogues, not for tables of rows.
    """
    ranked = global_rank(items, pos_col)
    dealt = ranked.withColumn("shard", (F.col("rank") % F.lit(max(1, shards))).cast("long"))
    ids = F.transform(F.array_sort(F.collect_list(F.struct("rank", F.col(id_col).alias("id")))), lambda s: s["id"])
    return dealt.groupBy("shard").agg(F.array_join(ids, " ").alias("acronyms"))


def global_rank(df: DataFrame, pos: str, width: int = 1 << 16) -> DataFrame:
    """``df`` with ``rank`` (from 0) in the order of a long position column, without one task for all rows.

    Positions fall into ranges of ``width``; rows are ranked inside their range
    and shifted by the counts of the ranges before. Only the counts, one for
    each range, are put in one order.
    """
    ranged = df.withColumn("_p", F.floor(F.col(pos) / width))
    sizes = ranged.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_p").orderBy(pos)) - 1
    return ranged.withColumn("_r", inside).join(before, "_p").withColumn("rank", (F.col("_r") + F.col("_before")).cast("long")).drop("_p", "_r", "_before")

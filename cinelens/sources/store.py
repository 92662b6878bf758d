"""Model store S3/S4: a fitted model as a folder of Parquet parts.

Layout under ``path``: ``manifest.json`` (one-row JSON: version folder, parts,
parameters) and one folder for each save, ``v-<id>/``, with ``items/``,
``profiles/``, ``vocab/`` and, for SVD models, ``term_basis/``. A save writes
a new version folder first and the manifest last, and a load reads what the
manifest lists, so parts of an earlier model are never mixed in and a save
that fails half-way leaves the old model in place. The version before is
removed once the manifest is written. Writes are Spark jobs (no part passes
through the driver); ``path`` should be a shared folder on a cluster.

With ``user_buckets`` the profiles, and ``seen/`` (each user's rated ids), are
bucketed and sorted by userId: a lookup of one user reads one bucket of each
(``ContentModel.recommend_one``), and joins on userId with tables of the same
buckets need no shuffle. Bucketing is a property of tables, so a load declares
these folders as external tables of the session.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import asdict

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from cinelens.config import ModelParams, TfidfParams

MANIFEST = "manifest.json"
#: Parts that may be bucketed by userId.
BY_USER = ("profiles", "seen")


def _write_by_user(df: DataFrame, where: str, buckets: int) -> None:
    """``df`` as a folder of Parquet files bucketed by userId."""
    name = f"cinelens_{uuid.uuid4().hex}"
    df.repartition(buckets, "userId").write.bucketBy(buckets, "userId").sortBy("userId").option("path", where).saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")  # an external table: its files stay


def _by_user(spark: SparkSession, where: str, name: str, buckets: int) -> DataFrame:
    """A folder that :func:`_write_by_user` wrote, with its buckets."""
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(where).schema.fields)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (userId) SORTED BY (userId) INTO {int(buckets)} BUCKETS LOCATION '{where}'")
    return spark.table(name)


def buckets_read(df: DataFrame) -> list[tuple[int, int]]:
    """(buckets read, buckets) of each bucketed scan of ``df`` that is pruned.
    The planner drops the bucketing of a scan that nothing above uses, and its
    note with it, but reads the same files; so the plan is made without that."""
    conf, key = df.sparkSession.conf, "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    before = conf.get(key)
    conf.set(key, "false")
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        conf.set(key, before)
    return [(int(a), int(b)) for a, b in re.findall(r"SelectedBucketsCount: (\d+) out of (\d+)", plan)]


def save_model(model, path: str, user_buckets: int | None = None) -> None:
    """S3: write every part; raises ``RuntimeError`` for an unfitted model.
    ``user_buckets`` lays what belongs to users out for point lookups."""
    if model is None or getattr(model, "items", None) is None:
        raise RuntimeError("Cannot save an unfitted model.")
    spark = model.items.sparkSession
    path = path.rstrip("/")
    parts = {"items": model.items, "profiles": model.profiles, "vocab": model.vocab}
    if model.term_basis is not None:
        parts["term_basis"] = model.term_basis
    old = _manifest(spark, path)
    version = f"v-{uuid.uuid4().hex}"
    if user_buckets and model.ratings is not None:
        parts["seen"] = model.ratings.select("userId", "movieId").distinct()
    for name, df in parts.items():
        if user_buckets and name in BY_USER:
            _write_by_user(df, f"{path}/{version}/{name}", int(user_buckets))
        else:
            df.write.parquet(f"{path}/{version}/{name}")
    meta = {
        "version": version,
        "parts": list(parts),
        "user_buckets": int(user_buckets) if user_buckets else None,
        "params": asdict(model.params),
        "dims": int(model.dims),
        "singular_values": None if model.singular_values is None else [float(x) for x in model.singular_values],
    }
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").json(f"{path}/{MANIFEST}")
    if old:
        place, fs = _file_system(spark, f"{path}/{old['version']}")
        fs.delete(place, True)


def _file_system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _manifest(spark: SparkSession, path: str) -> dict | None:
    """The manifest under ``path``; None if there is none. Errors of reading
    one that is there are raised."""
    place, fs = _file_system(spark, f"{path}/{MANIFEST}")
    if not fs.exists(place):
        return None
    return json.loads(spark.read.json(f"{path}/{MANIFEST}").first()["meta"])


def _params(d: dict) -> ModelParams:
    tf = dict(d.pop("tfidf"))
    d.pop("max_exact_dims", None)  # of models saved when exact vectors were dense
    tf["ngram_range"] = tuple(tf["ngram_range"])
    return ModelParams(tfidf=TfidfParams(**tf), **d)


def load_model(spark: SparkSession, path: str, movies: DataFrame, ratings: DataFrame | None = None):
    """Read a saved model; ``movies`` gives metadata, ``ratings`` the
    seen sets (optional, as in the reference). A missing folder raises
    ``FileNotFoundError``."""
    from cinelens.plans.model import ContentModel

    path = path.rstrip("/")
    meta = _manifest(spark, path)
    if meta is None:
        raise FileNotFoundError(f"no model under {path}")
    buckets = meta.get("user_buckets")
    parts = {}
    for name in meta["parts"]:
        where = f"{path}/{meta['version']}/{name}"
        table = f"cinelens_{name}_{meta['version'].removeprefix('v-')}"
        parts[name] = _by_user(spark, where, table, buckets) if buckets and name in BY_USER else spark.read.parquet(where)
    values = meta.get("singular_values")
    return ContentModel(
        params=_params(meta["params"]),
        movies=movies,
        ratings=ratings,
        items=parts["items"],
        profiles=parts["profiles"],
        vocab=parts["vocab"],
        dims=int(meta["dims"]),
        term_basis=parts.get("term_basis"),
        seen=parts.get("seen"),
        singular_values=None if values is None else np.asarray(values),
    )

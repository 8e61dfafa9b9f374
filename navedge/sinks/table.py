"""A stored table with keyed replace: a batch rewrites only the buckets it touches.

Rows lie under ``bucket=<b>/version=<v>``, where ``bucket`` is a hash of the
key columns and ``version`` the batch that wrote the bucket last. A batch is
merged with the current rows of its buckets (pruned by folder) and written
with dynamic partition overwrite, which replaces just the folders it writes.
A manifest, published by a rename once the data are there, names the version
of every bucket: readers open those folders and fold nothing, and a failure
before that leaves the table as it was. A batch that is run again starts from
the manifest before it and writes the same rows into the same folders.

``vacuum`` removes folders that no kept manifest names.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navedge.operators.keyed import one_per_key
from navedge.sinks.versioned import _hadoop, _names

BUCKET, VERSION = "bucket", "version"
BUCKETS = 64


def _manifest_path(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/_manifests/{int(batch_id)}"


def manifests(spark: SparkSession, path: str) -> list[int]:
    """Published batch ids, ascending."""
    return sorted(int(n) for n in _names(spark, f"{path.rstrip('/')}/_manifests") if n.isdigit())


def read_manifest(spark: SparkSession, path: str, batch_id: int) -> dict:
    """``keys``, ``buckets``, ``schema`` and ``versions`` (bucket -> version) of one batch."""
    fs, location = _hadoop(spark, _manifest_path(path, batch_id))
    stream = fs.open(location)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    found = json.loads(text)
    return {**found, "versions": {int(b): int(v) for b, v in found["versions"].items()}}


def _publish(spark: SparkSession, path: str, batch_id: int, manifest: dict) -> None:
    """Written beside its place, then renamed: a manifest is there whole or not at all."""
    fs, place = _hadoop(spark, _manifest_path(path, batch_id))
    _, draft = _hadoop(spark, f"{path.rstrip('/')}/_manifests/.draft-{int(batch_id)}")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
    finally:
        out.close()
    if fs.exists(place):
        fs.delete(place, False)
    if not fs.rename(draft, place):
        raise OSError(f"manifest {batch_id} of {path} could not be published")


def bucket_of(keys: list[str], buckets: int):
    return F.pmod(F.xxhash64(*keys), F.lit(int(buckets))).cast("int")


def _rows(spark: SparkSession, path: str, manifest: dict, buckets: list[int] | None = None) -> DataFrame:
    """Current rows with their bucket, of all buckets or of some."""
    from pyspark.sql.types import IntegerType, LongType, StructField, StructType

    root = path.rstrip("/")
    schema = StructType.fromJson(manifest["schema"])
    folders = [f"{root}/{BUCKET}={b}/{VERSION}={v}" for b, v in sorted(manifest["versions"].items()) if buckets is None or b in buckets]
    if not folders:
        return spark.createDataFrame([], schema).withColumn(BUCKET, F.lit(0))
    whole = StructType([*schema.fields, StructField(BUCKET, IntegerType()), StructField(VERSION, LongType())])
    return spark.read.schema(whole).option("basePath", root).parquet(*folders).drop(VERSION)


def replace_batch(batch: DataFrame, path: str, batch_id: int, keys: list[str], buckets: int = BUCKETS, order: str | None = None) -> list[int]:
    """Replace the batch's rows into the table by key; returns the buckets that were rewritten.

    The batch's columns are the table's (``order`` apart, which only picks the
    row of a repeated key). Equal keys are those with equal values, null equal to null.
    """
    spark = batch.sparkSession
    before = [i for i in manifests(spark, path) if i < batch_id]
    manifest = read_manifest(spark, path, before[-1]) if before else {"keys": list(keys), "buckets": int(buckets), "versions": {}}
    if manifest["keys"] != list(keys):
        raise ValueError(f"the table's keys are {manifest['keys']}")
    columns = [c for c in batch.columns if c != order] if order and order not in keys else batch.columns
    fresh = one_per_key(batch, keys, order).select(*columns).withColumn(BUCKET, bucket_of(keys, manifest["buckets"])).persist()
    try:
        touched = sorted(r[0] for r in fresh.select(BUCKET).distinct().collect())  # at most ``buckets`` numbers
        if not touched:
            if before:
                _publish(spark, path, batch_id, manifest)
            return []
        schema = fresh.drop(BUCKET).schema
        if before and [f.name for f in schema] != [f["name"] for f in manifest["schema"]["fields"]]:
            raise ValueError("the batch's columns differ from the table's")
        both = fresh.withColumn("_nv_new", F.lit(1))
        if before:
            both = _rows(spark, path, manifest, touched).select(*fresh.columns).withColumn("_nv_new", F.lit(0)).unionByName(both)
        # One exchange by bucket serves the grouping by key and the write: a bucket is one task and one file.
        values = [c for c in schema.names if c not in keys]
        latest = F.max_by(F.struct(*values), "_nv_new").alias("_nv_v") if values else F.max("_nv_new").alias("_nv_v")
        merged = both.repartition(len(touched), BUCKET).groupBy(BUCKET, *keys).agg(latest).select(
            *[F.col(f"_nv_v.{c}").alias(c) if c in values else F.col(c) for c in schema.names], BUCKET, F.lit(int(batch_id)).cast("long").alias(VERSION))
        (merged.sortWithinPartitions(BUCKET, *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BUCKET, VERSION).parquet(path))
        versions = {**manifest["versions"], **{b: int(batch_id) for b in touched}}
        _publish(spark, path, batch_id, {**manifest, "schema": json.loads(schema.json()), "versions": versions})
        return touched
    finally:
        fresh.unpersist()


def read_table(spark: SparkSession, path: str, batch_id: int | None = None) -> DataFrame:
    """The table as of the last published batch, or of an earlier one that ``vacuum`` has kept."""
    ids = manifests(spark, path)
    if not ids:
        raise FileNotFoundError(f"no published batch under {path}")
    return _rows(spark, path, read_manifest(spark, path, ids[-1] if batch_id is None else batch_id)).drop(BUCKET)


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete folders that none of the last ``keep`` manifests names, and the manifests before; returns the folders deleted."""
    ids, root = manifests(spark, path), path.rstrip("/")
    kept = ids[-max(1, keep):]
    if not kept:
        return 0
    named = {(b, v) for i in kept for b, v in read_manifest(spark, path, i)["versions"].items()}
    gone = 0
    for folder in _names(spark, root):
        if not folder.startswith(f"{BUCKET}="):
            continue
        bucket = int(folder.partition("=")[2])
        for version in _names(spark, f"{root}/{folder}"):
            number = version.partition("=")[2]
            # A batch that is being written has no manifest yet.
            if number.isdigit() and int(number) <= kept[-1] and (bucket, int(number)) not in named:
                fs, place = _hadoop(spark, f"{root}/{folder}/{version}")
                fs.delete(place, True)
                gone += 1
    for i in ids[:-len(kept)]:
        fs, place = _hadoop(spark, _manifest_path(path, i))
        fs.delete(place, False)
    return gone


# Tables bucketed for joins ------------------------------------------------------
def save_bucketed(df: DataFrame, name: str, key: str, buckets: int = BUCKETS, path: str | None = None) -> str:
    """A catalog table bucketed and sorted by ``key``: joins and groupings on it need no exchange."""
    from navedge.session import scratch_path

    path = path or scratch_path(df.sparkSession, f"table-{name}")
    # One file a bucket: the rows are already dealt by the hash that Spark buckets with.
    dealt = df.repartition(int(buckets), key)
    dealt.write.mode("overwrite").bucketBy(int(buckets), key).sortBy(key).option("path", path).saveAsTable(name)
    return path


def bucketed_flow(spark: SparkSession, in_table: str, out_table: str) -> DataFrame:
    """Questions 5 and 6 from two bucketed tables of totals (``Article, in_count`` and ``link_clicked, out_count``)."""
    from navedge.operators.flow import flow_of_stored_totals

    return flow_of_stored_totals(spark.table(in_table), spark.table(out_table))

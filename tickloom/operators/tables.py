"""Writing, maintaining and publishing tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.session import publish
from tickloom.sources.ingest import TICKER_BUCKETS, find, stored_buckets, ticker_bucket


def save(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
         partition_by: Sequence[str] = ()) -> None:
    if partition_by:  # few files per folder, and large folders split over tasks
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.partitionBy(*partition_by).save(path)


def save_bars(df: DataFrame, path: str, mode: str = "overwrite", buckets: int = TICKER_BUCKETS) -> None:
    """Bars in a bounded number of ticker folders, so a ticker filter prunes to one of them.

    The number is stored with the ticker column; appending with another one is an error.
    """
    if mode == "append":
        try:
            stored = stored_buckets(df.sparkSession.read.parquet(path))
        except AnalysisException:  # nothing there yet
            stored = None
        if stored not in (None, buckets):
            raise ValueError(f"{path} has {stored} ticker folders, not {buckets}")
    noted = df.withMetadata("ticker", {**df.schema["ticker"].metadata, "buckets": buckets})
    save(noted.withColumn("bucket", ticker_bucket(F.col("ticker"), buckets)), path, "parquet", mode, ["bucket"])


def save_table(df: DataFrame, name: str, database: str, location: str, mode: str = "overwrite",
               partition_by: Sequence[str] = ()) -> DataFrame:
    """A catalog table in ``database``, stored under ``location``; few files per folder, and large folders split over tasks."""
    spark = df.sparkSession
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{location}'")
    (df.write.mode(mode).format("parquet").option("path", f"{location}/{name}").partitionBy(*partition_by)
     .saveAsTable(f"`{database}`.`{name}`"))
    return spark.table(f"`{database}`.`{name}`")


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    return [t.name for t in spark.catalog.listTables(database)]


def run_sql(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """SQL over frames named in braces, without registering global views."""
    return spark.sql(sql, **frames)


def append(current: DataFrame, incoming: DataFrame) -> DataFrame:
    return current.unionByName(incoming, allowMissingColumns=True)


def _versions(current: DataFrame, incoming: DataFrame, order: str | None) -> DataFrame:
    """Both sides with ``__side`` (0 current, 1 incoming) and ``__rank``, which grows with recency."""
    if order is None:
        ranks = F.lit(0), F.lit(1)
    else:
        later = F.struct(F.lit(1).alias("s"), F.col(order).alias("o"))
        kind = incoming.schema[order].dataType
        ranks = F.struct(F.lit(0).alias("s"), F.lit(None).cast(kind).alias("o")), later
    old = current.withColumns({"__side": F.lit(0), "__rank": ranks[0]})
    return old.unionByName(incoming.withColumns({"__side": F.lit(1), "__rank": ranks[1]}), allowMissingColumns=True)


def upsert(current: DataFrame, incoming: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """Set the incoming fields on matching keys, insert the rest.

    ``order`` tells which of several incoming rows of one key is the last; without it the
    incoming keys must be unique. One aggregate with map-side combining, no join.
    """
    keys = list(keys)
    rows = _versions(current, incoming, order)
    newest = F.col("__rank")
    from_current = F.when(F.col("__side") == 0, F.col("__rank"))
    columns = [c for c in rows.columns if c not in (*keys, "__rank", "__side")]
    shared = [c for c in columns if c in incoming.columns]
    kept = [c for c in columns if c not in shared]
    return rows.groupBy(*keys).agg(*[F.max_by(c, newest).alias(c) for c in shared],
                                   *[F.max_by(c, from_current).alias(c) for c in kept])


def upsert_report(current: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many keys an upsert inserts and updates."""
    sides = (current.select(*keys, F.lit(1).alias("o"), F.lit(0).alias("n"))
             .unionByName(incoming.select(*keys, F.lit(0).alias("o"), F.lit(1).alias("n"))))
    seen = sides.groupBy(*keys).agg(F.max("o").alias("o"), F.max("n").alias("n"))
    return seen.agg(F.count_if((F.col("n") == 1) & (F.col("o") == 0)).alias("inserted"),
                    F.count_if((F.col("n") == 1) & (F.col("o") == 1)).alias("updated"))


def replace_table(df: DataFrame, path: str) -> None:
    """Write beside ``path``, then swap by rename, so readers never see a half-written table."""
    jvm = df.sparkSession._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf())
    fresh = jvm.org.apache.hadoop.fs.Path(f"{path}.new-{uuid.uuid4().hex}")
    old = jvm.org.apache.hadoop.fs.Path(f"{path}.old-{uuid.uuid4().hex}")
    df.write.parquet(fresh.toString())
    if fs.exists(target):
        fs.rename(target, old)
    fs.rename(fresh, target)
    if fs.exists(old):
        fs.delete(old, True)


def upsert_stored(path: str, incoming: DataFrame, keys: Sequence[str], partition: str, order: str | None = None) -> None:
    """Upsert into a partitioned Parquet table, rewriting only the folders that ``incoming`` touches.

    ``partition`` must follow from the keys. The touched folders are merged into a new table
    in the shared folder first, because a table cannot be overwritten while it is read. Fields
    that the table lacks are added; read such a table with ``mergeSchema``.
    """
    spark = incoming.sparkSession
    touched = incoming.select(partition).distinct()
    current = spark.read.option("mergeSchema", "true").parquet(path)
    affected = current.join(touched, partition, "left_semi").select(*current.columns)
    merged = publish(upsert(affected, incoming, [*keys, partition], order), "upsert")
    columns = [*current.columns, *(c for c in merged.columns if c not in current.columns)]
    (merged.select(*columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition).parquet(path))


def _files_of(rows: DataFrame) -> list[str]:
    """The data files that rows of a stored table come from: names only, no more than the table has files."""
    return [r[0] for r in rows.select(F.col("_metadata.file_path")).distinct().collect()]


def _swap_files(spark: SparkSession, path: str, old: Sequence[str], fresh: DataFrame, partition_by: Sequence[str]) -> None:
    """Write ``fresh`` aside, move its files into the table, and delete the ``old`` ones.

    All else in the table keeps its name and time. A reader that lists the table between the moves and the deletions sees the
    rows of both, one that lists it before or after sees one version; a run that dies there is completed by running it again.
    """
    jvm = spark._jvm
    root, staged = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_staged-{uuid.uuid4().hex}")
    fs = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    fresh.write.partitionBy(*partition_by).parquet(staged.toString())
    base, found = fs.makeQualified(staged).toString(), fs.listFiles(staged, True)
    while found.hasNext():
        file = found.next().getPath()
        inside = file.toString()[len(base) + 1:]
        if file.getName().startswith("part-"):
            target = jvm.org.apache.hadoop.fs.Path(root, inside)
            fs.mkdirs(target.getParent())
            fs.rename(file, target)
    for file in old:
        fs.delete(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file)), False)
    fs.delete(staged, True)


def _stored(spark: SparkSession, path: str, files: Sequence[str] | None = None) -> DataFrame:
    reader = spark.read.option("mergeSchema", "true").option("basePath", path)
    return reader.parquet(*(files if files is not None else [path]))


def upsert_files(path: str, incoming: DataFrame, keys: Sequence[str], order: str | None = None, partition_by: Sequence[str] = ()) -> None:
    """Upsert into a stored table, rewriting only the files that hold a matching key; new keys go into new files.

    Incoming rows are the smaller side: the table is read once with its keys alone, to find the files. Fields that the table
    lacks are added in the files written; read such a table with ``mergeSchema``.
    """
    spark, keys = incoming.sparkSession, list(keys)
    table = _stored(spark, path)
    hits = table.select(*keys, "_metadata").join(incoming.select(*keys).distinct(), keys, "left_semi")
    files = _files_of(hits)
    current = _stored(spark, path, files) if files else table.limit(0)
    merged = upsert(current, incoming, keys, order)
    columns = [*current.columns, *(c for c in merged.columns if c not in current.columns)]
    _swap_files(spark, path, files, merged.select(*columns), partition_by)


def update_files(spark: SparkSession, path: str, predicate: Column, values: Mapping[str, Column | object], partition_by: Sequence[str] = ()) -> int:
    """Set ``values`` where the predicate holds, in the files that have such rows; their number."""
    files = _files_of(_stored(spark, path).where(predicate))
    if files:
        _swap_files(spark, path, files, update_where(_stored(spark, path, files), predicate, values), partition_by)
    return len(files)


def delete_files(spark: SparkSession, path: str, predicate: Column, partition_by: Sequence[str] = ()) -> int:
    """Delete the rows where the predicate holds, rewriting the files that have such rows; their number."""
    files = _files_of(_stored(spark, path).where(predicate))
    if files:
        _swap_files(spark, path, files, delete_where(_stored(spark, path, files), predicate), partition_by)
    return len(files)


def _only_first(df: DataFrame, predicate: Column, keys: Sequence[str]) -> Column:
    """True on the matching row with the smallest key; found by one aggregate, used as a scalar."""
    first = df.where(predicate).agg(F.min(F.struct(*keys)).alias("k"))
    return F.struct(*keys) == first.scalar()


def update_where(df: DataFrame, predicate: Column, values: Mapping[str, Column | object], many: bool = True,
                 keys: Sequence[str] = (), insert: Mapping[str, object] | None = None) -> DataFrame:
    """Set ``values`` where the predicate holds (only on the smallest key when not ``many``).

    ``insert`` is added as a new row when no row matches.
    """
    hit = F.coalesce(predicate, F.lit(False))
    if not many:
        hit = hit & _only_first(df, predicate, keys)
    new = {c: v if isinstance(v, Column) else F.lit(v) for c, v in values.items()}
    out = df.select(*[F.when(hit, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in df.columns])
    if insert is None:
        return out
    none_matched = df.agg(F.count_if(predicate).alias("n")).where("n = 0")
    row = none_matched.select(*[F.lit(insert.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields])
    return out.unionByName(row)


def delete_where(df: DataFrame, predicate: Column, many: bool = True, keys: Sequence[str] = ()) -> DataFrame:
    hit = F.coalesce(predicate, F.lit(False))
    if not many:
        hit = hit & F.coalesce(_only_first(df, predicate, keys), F.lit(False))
    return df.where(~hit)


def delete_keys(df: DataFrame, doomed: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(doomed.select(*keys), list(keys), "left_anti")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Violations of a uniqueness constraint."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def export(docs: DataFrame, path: str, predicate: Column | None = None, fmt: str = "parquet") -> None:
    save(find(docs, predicate), path, fmt)


def messages(df: DataFrame, key: str = "ticker") -> DataFrame:
    """Rows as JSON message values with their key, ready for a topic sink."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def publish_messages(df: DataFrame, topic: str, servers: str, key: str = "ticker") -> None:
    """Send to a Kafka topic; needs the connector on the classpath."""
    (messages(df, key).write.format("kafka").option("kafka.bootstrap.servers", servers)
     .option("topic", topic).save())


def prediction_documents(preds: DataFrame, issue: Sequence[str] = ("ticker", "issued"),
                         value_field: Mapping[str, str] | None = None) -> DataFrame:
    """One document per issue: ``{model: {date: {field: value}}}``.

    A document holds one issue's horizon, so the lists are bounded by models × horizon. The
    field name may differ per model.
    """
    issue = list(issue)
    field = F.lit("Predicted_Close")
    for model, name in (value_field or {}).items():
        field = F.when(F.col("model") == model, name).otherwise(field)
    point = F.struct(F.date_format("date", "yyyy-MM-dd").alias("day"), field.alias("field"), "predicted")
    by_model = preds.groupBy(*issue, "model").agg(F.array_sort(F.collect_list(point)).alias("points"))
    by_issue = by_model.groupBy(*issue).agg(F.array_sort(F.collect_list(F.struct("model", "points"))).alias("models"))

    def days(points: Column) -> Column:
        return F.map_from_entries(F.transform(
            points, lambda p: F.struct(p["day"].alias("k"), F.create_map(p["field"], p["predicted"]).alias("v"))))

    document = F.map_from_entries(F.transform(
        "models", lambda m: F.struct(m["model"].alias("k"), days(m["points"]).alias("v"))))
    return by_issue.select(*issue, document.alias("predictions"))


def latest_predictions(docs: DataFrame, issued: str = "issued") -> DataFrame:
    """The newest document per ticker, one row per model and date, close preferred over value."""
    newest = docs.groupBy("ticker").agg(F.max_by("predictions", issued).alias("p"), F.max(issued).alias(issued))
    models = newest.select("ticker", issued, F.explode("p").alias("model", "days"))
    rows = models.select("ticker", issued, "model", F.explode("days").alias("day", "fields"))
    value = F.coalesce(F.try_element_at("fields", F.lit("Predicted_Close")),
                       F.try_element_at("fields", F.lit("Predicted_Value")))
    return rows.select("ticker", issued, "model", F.to_date("day").alias("date"), value.alias("predicted"))

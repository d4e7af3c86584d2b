"""Hot table: append-only generations of Parquet, merged on read, compacted apart.

A batch is written once, as ``data/generation=<name>/tenant_id=/event_date=``, and becomes visible by
a new manifest: the list of live generations and of the batch ids they hold. Writing the same batch id
again changes nothing, so a retried batch gives equal rows, those without an id included; a generation
that was not committed is overwritten. Nothing that is live is ever rewritten by a batch.

A read takes the live generations and keeps, per document id within a tenant's day, the row of the latest
generation (then of the latest arrival). The keys of that merge are the partition columns and the id,
so filters on tenant and day prune partitions below it. ``compact`` merges days into one new generation and
hides them in the older ones; ``vacuum`` deletes what no manifest names any more. There is one writer.
``index_terms`` notes which files hold which term of the messages, so that a search for a rare term in a
compacted table opens few files.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftlog.functions.text import tokens
from driftlog.functions.timefmt import utc_day
from driftlog.schemas import ENTRY_COLUMNS, LOG_ENTRY
from driftlog.sources.files import Folder

PARTITION_COLUMNS = ["tenant_id", "event_date"]
GENERATION = "generation"
#: Rows that one array of a repeated row stands for, at most.
REPEAT = 4_096
#: Partitions of the index of terms.
TERM_BUCKETS = 64

# Read with an explicit schema: partition values are never type-inferred, so a tenant id
# such as "007" stays the string "007".
HOT_SCHEMA = T.StructType(
    [f for f in LOG_ENTRY.fields if f.name != "tenant_id"]
    + [T.StructField("message_terms", T.ArrayType(T.StringType())),
       T.StructField("tenant_id", T.StringType()), T.StructField("event_date", T.DateType())])
_STORED = T.StructType([T.StructField(GENERATION, T.StringType()), *HOT_SCHEMA.fields])


def last_write_wins(entries: DataFrame, arrival: str = "ingest_timestamp",
                    order: Sequence[str] = ("log_id",), generation: str | None = None) -> DataFrame:
    """One row per (tenant_id, event_date, log_id): the latest by (generation, arrival, order).

    A grouped max_by, so copies collapse in the map-side partial aggregate before
    any shuffle. Rows with an empty id are each kept (identical ones are
    counted and repeated again, never merged). The keys stay plain columns, so filters on them pass below.
    """
    x = entries if "event_date" in entries.columns else entries.withColumn("event_date", utc_day(F.col("event_timestamp")))
    cols, keys = x.columns, [*PARTITION_COLUMNS, "log_id"]
    rest = [c for c in cols if c not in keys]
    maps = {f.name for f in x.schema.fields if isinstance(f.dataType, T.MapType)}
    empty = F.coalesce(F.col("log_id"), F.lit("")) == ""
    dup_key = F.when(empty, F.struct(*[F.to_json(F.col(c)).alias(c) if c in maps else F.col(c) for c in rest]))
    rank_key = F.struct(*([F.col(generation)] if generation else []), F.col(arrival), *[F.col(o) for o in order])
    agg = x.groupBy(*keys, dup_key.alias("__dk")).agg(
        F.max_by(F.struct(*rest), rank_key).alias("__row"), F.count(F.lit(1)).alias("__n"))
    # two short arrays one after another: however often a row repeats, no array grows with it
    again = F.when(empty, F.col("__n")).otherwise(F.lit(1))
    out = agg.withColumn("__again", again).withColumn("__part", F.explode(F.sequence(F.lit(0), F.col("__again") - 1, F.lit(REPEAT))))
    out = out.withColumn("__one", F.explode(F.sequence(F.lit(1), F.least(F.col("__again") - F.col("__part"), F.lit(REPEAT)))))
    return out.select(*[F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in cols])


def to_hot_rows(entries: DataFrame) -> DataFrame:
    """Entry columns + event_date + message_terms (the analysed text, computed once at write)."""
    x = entries.select(*[c for c in ENTRY_COLUMNS if c in entries.columns])
    return x.withColumn("event_date", utc_day(F.col("event_timestamp"))).withColumn(
        "message_terms", tokens(F.col("message")))


class HotTable:
    """The hot table in the folder ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.folder = Folder(spark, self.path)

    # -- manifest: {"version", "next", "live": [generation], "hidden": {generation: [day]}, "batches": {writer: [[from, to]]}}

    def manifest(self) -> dict:
        names = self.folder.names("_manifest")
        if not names:
            return {"version": 0, "next": 0, "live": [], "hidden": {}, "batches": {}}
        return json.loads(self.folder.text(f"_manifest/{max(names)}"))

    def _commit(self, m: dict) -> None:
        m["version"] += 1
        # a file that appears whole or not at all, and never over another writer's
        self.folder.create(f"_manifest/{m['version']:020d}.json", json.dumps(m))

    def holds(self, batch_id: int, writer: str = "batch") -> bool:
        return any(a <= batch_id <= b for a, b in self.manifest()["batches"].get(writer, []))

    # -- writing

    def _write(self, rows: DataFrame, generation: str) -> None:
        # rebalance: AQE sizes the output per (tenant, day), splitting a hot day over several
        # tasks and merging small ones, instead of every task writing a file into every day
        (rows.hint("rebalance", *PARTITION_COLUMNS).sortWithinPartitions(*PARTITION_COLUMNS)
         .write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy(*PARTITION_COLUMNS).parquet(f"{self.path}/data/{GENERATION}={generation}"))

    def append(self, entries: DataFrame, batch_id: int | None = None, arrival: str = "ingest_timestamp",
               writer: str = "batch") -> bool:
        """Add a batch as a generation of its own; False if the table holds it already.

        Batch ids are a writer's own (a streaming query's id, say); a batch without one is always new.
        """
        if batch_id is not None and self.holds(batch_id, writer):
            return False
        m = self.manifest()
        name = f"{m['next']:020d}"  # a failed attempt left this name unused, and is overwritten
        self._write(last_write_wins(to_hot_rows(entries), arrival=arrival), name)
        m["live"], m["next"] = [*m["live"], name], m["next"] + 1
        if batch_id is not None:
            m["batches"][writer] = _joined([*m["batches"].get(writer, []), [batch_id, batch_id]])
        self._commit(m)
        return True

    def compact(self, days: Iterable[dt.date] | None = None) -> None:
        """Merge ``days`` (default: all) of all live generations into a new one."""
        m = self.manifest()
        if len(m["live"]) < 2:
            return
        # sorts after the generations it holds and before any later batch
        name = f"{m['live'][-1][:20]}-{m['version']:020d}"
        rows = self.read()
        if days is None:
            live, hidden = [name], {}
        else:
            days = sorted({d.isoformat() for d in days})
            rows = rows.where(F.col("event_date").isin([dt.date.fromisoformat(d) for d in days]))
            live = [*m["live"], name]
            hidden = {**m["hidden"], **{g: sorted({*m["hidden"].get(g, []), *days}) for g in m["live"]}}
        self._write(rows, name)
        m["live"], m["hidden"] = live, hidden
        self._commit(m)

    def vacuum(self, keep: int = 2) -> None:
        """Delete all but the last ``keep`` manifests, and the generations that none of those names."""
        names = sorted(self.folder.names("_manifest"))
        held = {g for n in names[-keep:] for g in json.loads(self.folder.text(f"_manifest/{n}"))["live"]}
        for n in names[:-keep]:
            self.folder.delete(f"_manifest/{n}")
        for top in ("data", "_terms"):
            for d in self.folder.names(top):
                if d.startswith(f"{GENERATION}=") and d.split("=", 1)[1] not in held:
                    self.folder.delete(f"{top}/{d}")

    # -- reading

    def index_terms(self) -> None:
        """Write which files hold which term, for the live generations that have no such index yet."""
        for g in self.manifest()["live"]:
            if self.folder.exists(f"_terms/{GENERATION}={g}/_SUCCESS"):
                continue
            rows = self.spark.read.schema(HOT_SCHEMA).parquet(f"{self.path}/data/{GENERATION}={g}")
            pairs = rows.select(F.explode("message_terms").alias("term"), F.col("_metadata.file_path").alias("file")).distinct()
            (pairs.withColumn("bucket", _bucket(F.col("term"))).repartition("bucket").sortWithinPartitions("bucket", "term")
             .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket")
             .parquet(f"{self.path}/_terms/{GENERATION}={g}"))

    def read_terms(self, terms: Sequence[str]) -> DataFrame:
        """The rows that can hold any of ``terms``: of a compacted and indexed table, those of the files that hold
        one. With several generations all rows: one without the term may have replaced one with it."""
        live = self.manifest()["live"]
        if len(live) != 1 or not self.folder.exists(f"_terms/{GENERATION}={live[0]}/_SUCCESS"):
            return self.read()
        index = self.spark.read.schema("term string, file string, bucket long").parquet(f"{self.path}/_terms/{GENERATION}={live[0]}")
        wanted = [F.lit(t) for t in sorted(set(terms))]
        hit = index.where(F.col("bucket").isin([_bucket(t) for t in wanted]) & F.col("term").isin(wanted)) if wanted else index.limit(0)
        return self.read([r["file"] for r in hit.select("file").distinct().collect()])  # a bounded list: files of one generation

    def read(self, files: Sequence[str] | None = None) -> DataFrame:
        """The rows of the table, merged over its live generations; with ``files``, those of these files."""
        m = self.manifest()
        if not m["live"] or files == []:
            return self.spark.createDataFrame([], HOT_SCHEMA)
        paths = files or [f"{self.path}/data/{GENERATION}={g}" for g in m["live"]]
        rows = self.spark.read.schema(_STORED).option("basePath", f"{self.path}/data").parquet(*paths)
        for days in {tuple(d) for d in m["hidden"].values()}:
            hiding = [g for g, d in m["hidden"].items() if tuple(d) == days and g in m["live"]]
            gone = F.col(GENERATION).isin(hiding) & F.col("event_date").isin([dt.date.fromisoformat(d) for d in days])
            rows = rows.where(~F.coalesce(gone, F.lit(False)))
        columns = HOT_SCHEMA.names
        if len(m["live"]) > 1:  # a generation by itself holds every id once
            rows = last_write_wins(rows, generation=GENERATION)
        return rows.select(*columns)


def _bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(TERM_BUCKETS))


def _joined(ranges: list[list[int]]) -> list[list[int]]:
    """Ranges of whole numbers, neighbours as one."""
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def upsert_hot(entries: DataFrame, path: str, arrival: str = "ingest_timestamp", batch_id: int | None = None,
               writer: str = "batch") -> bool:
    """Add entries to the hot table at ``path`` (see ``HotTable.append``)."""
    return HotTable(entries.sparkSession, path).append(entries, batch_id, arrival, writer)


def read_hot(spark: SparkSession, path: str) -> DataFrame:
    return HotTable(spark, path).read()

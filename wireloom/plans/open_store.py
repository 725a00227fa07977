"""Open exchanges between batches, as a log of changes with snapshots, and how far the log has been read.

A batch writes the exchanges that it opened or continued, the texts that came for them, and the
keys that are no longer open: ``batch_id=.../exchanges, texts, gone``. What stays open and was not touched is not written again. Once
as many changes have gathered as exchanges were open, or MOST_CHANGES batches, they are folded into a snapshot,
``snapshot=.../exchanges, texts``, dealt by key into buckets; so a change is written again about once, and a lookup of
some keys reads their buckets only. A *commit*, one small file written last, names the snapshot and the changes that make up
the state after a batch, and the offsets read so far. Whatever a batch wrote before it failed is in no commit.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wireloom.operators.assemble import Summed
from wireloom.plans.staging import at_once, file_names, load_text, remove_folder, save_text
from wireloom.schema import EXCHANGE, TEXTS

#: Rows of a snapshot for each bucket that keys are dealt into, most buckets, and batches after which changes are folded
#: in any case.
BUCKET_ROWS, MOST_BUCKETS, MOST_CHANGES = 1 << 17, 1024, 64

CHANGED = T.StructType([*EXCHANGE.fields, T.StructField("write", T.LongType())])
GONE = T.StructType([EXCHANGE["request_key"], T.StructField("write", T.LongType())])


@dataclass(frozen=True)
class Commit:
    """The state after a write: snapshot, its buckets, changes since; its exchanges, rows changed since; offsets read."""

    write: int
    run: str
    snapshot: int | None = None
    buckets: int = 1
    changes: tuple[int, ...] = ()
    held: int = 0
    changed: int = 0
    offsets: tuple[tuple[str, int, int, int], ...] = ()
    #: What a run that took over an older one skips.
    taken_over: tuple[tuple[str, int, int, int], ...] = ()


def _of_text(text: str) -> Commit:
    fields = json.loads(text)
    for name in ("offsets", "taken_over"):
        fields[name] = tuple(tuple(part) for part in fields[name])
    return Commit(**{**fields, "changes": tuple(fields["changes"])})


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64("request_key"), F.lit(buckets)).cast("int")


class OpenStore:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def commits(self) -> list[Commit]:
        """The last commits in their order; runs no Spark job."""
        folder = f"{self.folder}/commits"
        names = [name for name in file_names(self.spark, folder) if name.startswith("batch_id=")]
        found = (_of_text(load_text(self.spark, f"{folder}/{name}")) for name in names)
        return sorted(found, key=lambda commit: commit.write)

    def before(self, write: int) -> Commit | None:
        """The last commit below a write number."""
        return max((c for c in self.commits() if c.write < write), key=lambda c: c.write, default=None)

    def _changes(self, commit: Commit, part: str, schema: T.StructType) -> DataFrame:
        folders = [f"{self.folder}/batch_id={write}/{part}" for write in commit.changes]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def _rows(self, commit: Commit, part: str, schema: T.StructType, buckets: list[int] | None = None) -> DataFrame:
        """Rows of the snapshot, or of some of its buckets, and of the changes since."""
        rows = self._changes(commit, part, schema)
        if commit.snapshot is None:
            return rows
        dealt = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
        folded = self.spark.read.schema(dealt).parquet(f"{self.folder}/snapshot={commit.snapshot}/{part}")
        if buckets is not None:
            folded = folded.filter(F.col("bucket").isin(buckets))
        return folded.drop("bucket").unionByName(rows)

    def heads(self, commit: Commit) -> DataFrame:
        """request_key, start_ts and born of all open exchanges; ``born`` is the write after which a key was opened anew.

        A narrow read: of the exchanges no more than key, write and start.
        """
        known, gone = self._rows(commit, "exchanges", CHANGED), self._changes(commit, "gone", GONE)
        rows = known.select("request_key", "write", F.col("start.ts").alias("start_ts"), F.lit(False).alias("gone"))
        rows = rows.unionByName(gone.select("request_key", "write", F.lit(None).cast("timestamp").alias("start_ts"), F.lit(True).alias("gone")))
        last = F.max_by(F.struct("gone", "start_ts"), "write").alias("last")
        born = F.coalesce(F.max(F.when(F.col("gone"), F.col("write"))), F.lit(-1)).alias("born")
        latest = rows.groupBy("request_key").agg(last, born).filter(~F.col("last.gone"))
        return latest.select("request_key", F.col("last.start_ts").alias("start_ts"), "born")

    def lookup(self, commit: Commit, keys: DataFrame, few: bool = True) -> Summed:
        """The exchanges of open keys (request_key, born), and their texts.

        With ``few`` the buckets of the keys are found first, and no others are read.
        """
        buckets = None
        if few and commit.buckets > 1:
            buckets = [row[0] for row in keys.select(bucket_of(commit.buckets)).distinct().collect()]
        rows = self._rows(commit, "exchanges", CHANGED, buckets).join(keys.select("request_key"), "request_key", "left_semi")
        names = EXCHANGE.fieldNames()
        latest = rows.groupBy("request_key").agg(F.max_by(F.struct(*names), "write").alias("row")).select("row.*")
        texts = self._rows(commit, "texts", TEXTS, buckets)
        texts = texts.join(keys.select("request_key", "born"), "request_key").filter(F.col("batch") > F.col("born"))
        return Summed(latest.select(*names), texts.select(*TEXTS.fieldNames()))

    def write(self, write: int, open_now: DataFrame, texts: DataFrame, gone: DataFrame) -> None:
        """The changes of a batch; a second call for the write replaces the first."""
        number = F.lit(write).cast("long").alias("write")
        parts = {"exchanges": open_now.select("*", number), "texts": texts, "gone": gone.select("request_key", number)}

        def put(name: str) -> None:
            parts[name].write.mode("overwrite").parquet(f"{self.folder}/batch_id={write}/{name}")

        at_once(self.spark, *[lambda name=name: put(name) for name in parts])

    def commit(self, before: Commit | None, write: int, run: str, changed: int, offsets: Iterable[Row], taken_over: tuple) -> Commit:
        """Records the state after a write, folded if that is due, and removes what no later batch can ask for."""
        last = before or Commit(write - 1, run)
        done = replace(
            last, write=write, run=run, changes=(*last.changes, write), changed=last.changed + changed,
            offsets=_reached(last.offsets, offsets), taken_over=taken_over,
        )
        if (done.changed and done.changed >= done.held) or len(done.changes) >= MOST_CHANGES:
            done = self._folded(done)
        save_text(self.spark, f"{self.folder}/commits/batch_id={write}", json.dumps(asdict(done)))
        self._clear(last, done)
        return done

    def _folded(self, commit: Commit) -> Commit:
        state = self._state(commit)
        folder = f"{self.folder}/snapshot={commit.write}"
        buckets = min(MOST_BUCKETS, 1 + (commit.held + commit.changed) // BUCKET_ROWS)
        number = F.lit(commit.write).cast("long")

        def fold(part: str, rows: DataFrame) -> None:
            rows = rows.withColumn("bucket", bucket_of(buckets)).repartition("bucket")
            rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/{part}")

        exchanges = state.exchanges.withColumn("write", number)
        at_once(self.spark, lambda: fold("exchanges", exchanges), lambda: fold("texts", state.texts))
        held = self.spark.read.schema(CHANGED).parquet(f"{folder}/exchanges").count()
        return replace(commit, snapshot=commit.write, buckets=buckets, changes=(), held=held, changed=0)

    def _state(self, commit: Commit) -> Summed:
        """All open exchanges after a commit, and their texts."""
        if commit.snapshot is None and len(commit.changes) == 1:
            # The first write has a row for each key that it left open, and no key was open before to be gone.
            exchanges = self._changes(commit, "exchanges", CHANGED).select(*EXCHANGE.fieldNames())
            return Summed(exchanges, self._changes(commit, "texts", TEXTS))
        return self.lookup(commit, self.heads(commit), few=False)

    def _clear(self, *needed: Commit) -> None:
        """Removes the folders below the last write that neither of the last two commits needs."""
        last = max(commit.write for commit in needed)
        kept = {f"batch_id={write}" for commit in needed for write in (commit.write, *commit.changes)}
        kept |= {f"snapshot={commit.snapshot}" for commit in needed}
        for folder, names in ((self.folder, kept), (f"{self.folder}/commits", {f"batch_id={c.write}" for c in needed})):
            for name in file_names(self.spark, folder):
                kind, _, number = name.partition("=")
                if kind in ("batch_id", "snapshot") and int(number) < last and name not in names:
                    remove_folder(self.spark, f"{folder}/{name}")


def _reached(before: Iterable[tuple], batch: Iterable[Row]) -> tuple[tuple[str, int, int, int], ...]:
    """The offsets read after a batch: one range for each topic and partition."""
    ranges = {(topic, part): (first, until) for topic, part, first, until in before}
    for row in batch:
        first, until = ranges.get((row["topic"], row["partition"]), (row["first"], row["last"] + 1))
        ranges[row["topic"], row["partition"]] = min(first, row["first"]), max(until, row["last"] + 1)
    order = lambda item: (item[0][0] or "", item[0][1] or 0)
    return tuple((*place, *span) for place, span in sorted(ranges.items(), key=order))


def unread(records: DataFrame, offsets: Iterable[tuple]) -> DataFrame:
    """Records at or above the offsets read so far; those of other partitions, or without a place, all."""
    offsets = [(topic, part, until) for topic, part, _, until in offsets]
    if not offsets:
        return records
    read = records.sparkSession.createDataFrame(offsets, "t string, p int, until bigint")
    place = F.col("topic").eqNullSafe(F.col("t")) & F.col("partition").eqNullSafe(F.col("p"))
    joined = records.join(F.broadcast(read), place, "left")
    return joined.filter(F.col("until").isNull() | F.coalesce(F.col("offset") >= F.col("until"), F.lit(True))).select(*records.columns)

"""A stream of lifecycle rows kept as the latest version of each record."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quillon.operators.rows import last_by

#: Runs of one width that are merged into one of so many times the width.
FANOUT = 8
KEY, ORDER = ["employee_id"], ["record_updated_at", "source_row"]


def merged(rows: DataFrame) -> DataFrame:
    """Last versions by date (none is earliest), then by source_row, whatever order rows came in."""
    return last_by(rows, KEY, ORDER)


def runs(n: int, fanout: int = FANOUT) -> list[tuple[int, int]]:
    """The runs (first batch, last batch) that hold all batches up to n: those of n + 1 written to the base of the fan-out."""
    out, width = [], 1
    while width * fanout <= n + 1:
        width *= fanout
    at = 0
    while width:
        while at + width <= n + 1:
            out.append((at, at + width - 1))
            at += width
        width //= fanout
    return out


class State:
    """Runs of batches under root/run=FIRST-LAST, each with the last versions of its records among them.

    A batch writes one run and touches no other: mostly its own rows alone; every FANOUT batches also those of the runs
    that it completes a wider one with, so that a row is written again once for each width. Which runs count follows
    from the number of the last finished batch alone, so a reader never sees half a batch, and a batch that is repeated
    after a failure writes the same run. Batches are numbered by the stream's checkpoint: a root belongs to one checkpoint."""

    def __init__(self, spark: SparkSession, root: str, fanout: int = FANOUT):
        self.spark, self.root, self.fanout = spark, root, fanout

    def _path(self, name: str = ""):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def stored(self) -> set[tuple[int, int]]:
        """Runs that were written to the end."""
        p, store = self._path()
        names = [x.getPath().getName() for x in store.listStatus(p)] if store.exists(p) else []
        done = [n for n in names if n.startswith("run=") and store.exists(self._path(f"{n}/_SUCCESS")[0])]
        return {(int(a), int(b)) for a, b in (n[4:].split("-") for n in done)}

    def last(self) -> int:
        """The last batch that was finished, -1 if none was."""
        return max((b for _, b in self.stored()), default=-1)

    def read(self, of: list[tuple[int, int]], schema) -> DataFrame | None:
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/run={a}-{b}" for a, b in of]) if of else None

    def write(self, n: int, rows: DataFrame) -> None:
        """Put a batch into a run of its own, or into the wider one that it completes."""
        have = self.stored()
        if any(b == n for _, b in have):
            return  # was finished before
        if have and max(b for _, b in have) > n:
            raise ValueError(f"{self.root} has later batches than {n}: it belongs to another checkpoint")
        new = runs(n, self.fanout)[-1]
        inside = [r for r in runs(n - 1, self.fanout) if r[0] >= new[0]]
        if missing := [r for r in runs(n - 1, self.fanout) if r not in have]:
            raise ValueError(f"{self.root} lacks the runs {missing}")
        before = self.read(inside, rows.schema)
        out = merged(rows if before is None else before.unionByName(rows))
        out.sortWithinPartitions(*KEY).write.mode("overwrite").parquet(f"{self.root}/run={new[0]}-{new[1]}")  # sorted: a look for some ids skips most row groups
        for old in have - {*runs(n, self.fanout), *runs(n - 1, self.fanout)}:  # what readers may still be at stays for one more batch
            p, store = self._path(f"run={old[0]}-{old[1]}")
            store.delete(p, True)


def current(spark: SparkSession, root: str, schema, fanout: int = FANOUT) -> DataFrame:
    """The state after the last finished batch."""
    state = State(spark, root, fanout)
    found = state.read(runs(state.last(), fanout), schema)
    return spark.createDataFrame([], schema) if found is None else merged(found)


def upsert(stream: DataFrame, root: str, checkpoint: str, fanout: int = FANOUT) -> StreamingQuery:
    """Keep the last version of each record under root; read it with current()."""
    return stream.writeStream.foreachBatch(lambda df, n: State(df.sparkSession, root, fanout).write(n, df)).option("checkpointLocation", checkpoint).start()

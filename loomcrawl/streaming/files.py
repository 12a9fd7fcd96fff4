"""A folder of files worked off once each: new files are picked up, results appended, files that keep failing set aside."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcrawl.operators.scratch import saved

ATTEMPTS = "path string, attempt int"
FILE = "path string, modificationTime timestamp, length long, content binary"
DEAD_LETTERS = "path string, attempts int, error string"


def _folder(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


class _Batch:
    """One batch of files. Its folders are named after its number, so that a batch done again replaces what it has written."""

    def __init__(self, spark: SparkSession, work: Callable[[DataFrame], DataFrame], number: int, out: str, failures: str | None, tried: str):
        self.spark, self.work, self.number, self.out, self.failures = spark, work, number, out, failures
        self.tried = f"{tried}/batch={number}"

    def attempts(self, paths: list[str]) -> dict[str, int]:
        """How often each file was tried in this batch, by runs that ended early too."""
        system, where = _folder(self.spark, self.tried)
        rows = self.spark.read.schema(ATTEMPTS).option("recursiveFileLookup", True).parquet(self.tried) if system.exists(where) else self.spark.createDataFrame([], ATTEMPTS)
        found = {r["path"]: r["n"] for r in rows.groupBy("path").agg(F.max("attempt").alias("n")).collect()}
        return {p: found.get(p, 0) for p in paths}

    def begin(self, attempts: dict[str, int]) -> None:
        """Told before files are tried: a file that takes the driver with it was tried as well."""
        rows = self.spark.createDataFrame(list(attempts.items()), ATTEMPTS).coalesce(1)
        rows.write.mode("append").parquet(self.tried)

    def run(self, paths: list[str], part: str) -> dict[str, str]:
        """The errors of the files among `paths` that fail; the results of the others are written. Halves of what fails are tried on their own."""
        try:
            result = self.work(self.spark.read.text(paths))
            if "error" in result.columns:
                result = saved(result, "file-results")
                bad, result = result.where("error is not null"), result.where("error is null").drop("error")
                if self.failures:
                    bad.write.mode("overwrite").parquet(f"{self.failures}/batch={self.number}/part={part}")
            result.write.mode("overwrite").parquet(f"{self.out}/batch={self.number}/part={part}")
            return {}
        except Exception as e:
            if len(paths) == 1:
                return {paths[0]: f"{type(e).__name__}: {e}"[:1000]}
            half = len(paths) // 2
            return self.run(paths[:half], part + "0") | self.run(paths[half:], part + "1")

    def clear(self) -> None:
        for path in (self.out, self.failures):
            if path:
                system, where = _folder(self.spark, f"{path}/batch={self.number}")
                system.delete(where, True)


def process_new_files(
    spark: SparkSession, folder: str, work: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, failures: str | None = None, pattern: str = "*", dead_letters: str | None = None, attempts: int = 3, files_per_batch: int = 1000
) -> None:
    """Runs `work` over the text lines of all files not seen before, and stops when none is left.

    The stream is one of paths, at most files_per_batch a batch; its checkpoint remembers which were taken. A batch runs
    as one job. If that fails, halves of it run, until files that fail are alone; these are tried again after all
    others, and after `attempts` tries in all they are rows of dead_letters (path, attempts, error), while the results of
    the others are written. Attempts are written below the checkpoint before each try, so that they count
    across restarts; an interrupted batch is done again under its number, and replaces its output. Spark retries tasks
    first, as spark.task.maxFailures says. Rows of a result with a non-null column `error` go to `failures`.
    """
    paths = spark.readStream.format("binaryFile").schema(FILE).option("pathGlobFilter", pattern).option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_per_batch).load(folder).select("path")

    def batch(df: DataFrame, number: int) -> None:
        files = [r["path"] for r in df.collect()]  # at most files_per_batch
        one = _Batch(spark, work, number, out, failures, f"{checkpoint}/attempts")
        one.clear()
        tried = one.attempts(files)
        dead = {p: "ended the run" for p in files if tried[p] >= attempts}
        left, errors, turn = [p for p in files if p not in dead], {}, 0
        while left:
            for p in left:
                tried[p] += 1
            one.begin({p: tried[p] for p in left})
            # the first time all together, then each that failed on its own
            errors = one.run(left, f"{turn}-") if not turn else {k: v for i, p in enumerate(left) for k, v in one.run([p], f"{turn}-{i}-").items()}
            dead |= {p: e for p, e in errors.items() if tried[p] >= attempts}
            left, turn = [p for p in errors if p not in dead], turn + 1
        if dead and dead_letters:
            rows = [(p, tried[p], e) for p, e in dead.items()]
            spark.createDataFrame(rows, DEAD_LETTERS).coalesce(1).write.mode("overwrite").parquet(f"{dead_letters}/batch={number}")

    paths.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()

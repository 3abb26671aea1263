"""Token counts kept by signed changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kerbside.sources.tables import ConcurrentUpdateError, Versions

KEY = ["source", "lang", "tokenizer_version"]
LEDGER = "source string, lang string, tokenizer_version string, docs long, tokens long, batch string, version string"


def signed(changes: DataFrame) -> DataFrame:
    """Changes as signed sums by source, language and tokenizer version.

    ``changes`` has kind, source, lang, tokenizer_version, tokens and
    old_tokens: an ``insert`` adds a document and its tokens, a ``delete`` takes
    both away, a ``revise`` replaces the count ``old_tokens`` by ``tokens``.
    Another kind is an error. Null keys are keys, null counts are 0. Rows are
    summed before the shuffle, so a hot source sends one row a task.
    """
    kind = F.col("kind")
    tokens, old = F.coalesce("tokens", F.lit(0)), F.coalesce("old_tokens", F.lit(0))
    docs = F.when(kind == "insert", 1).when(kind == "delete", -1).when(kind == "revise", 0)
    delta = F.when(kind == "insert", tokens).when(kind == "delete", -tokens).when(kind == "revise", tokens - old)
    unknown = F.raise_error(F.concat(F.lit("unknown kind of change: "), F.coalesce(kind, F.lit("null"))))
    return changes.groupBy(*KEY).agg(
        F.sum(F.coalesce(docs, unknown.cast("int"))).cast("long").alias("docs"), F.sum(delta).cast("long").alias("tokens")
    )


class TokenRollup(Versions):
    """Totals as the sum of committed batches, below one shared folder.

    A batch is a part of the table, under its id: its sums are written aside and count from the
    commit that names them, all at once. One that is delivered again replaces itself, also by
    nothing, so the same batch changes nothing; one that dies leaves no trace. Sums don't
    depend on the order of batches. Before the first commit totals are empty.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        super().__init__(spark, path, StructType.fromDDL(LEDGER))

    def commit(self, batch: str, changes: DataFrame) -> None:
        """Make ``changes`` the whole content of a batch; other writers' commits only let this one take its turn later."""
        self._write(signed(changes).withColumn("batch", F.lit(batch)), [batch])

    def _write(self, rows: DataFrame, batches: list[str], turns: int = 100) -> None:
        version, base = self._new_version()
        rows = rows.withColumn("version", F.lit(version)).select(self.schema.names)
        rows.coalesce(1).write.parquet(f"{self.root}/data/{version}")  # a row for each source, language and version
        for _ in range(turns):
            try:
                return self._commit(base, version, batches)
            except ConcurrentUpdateError:  # batches don't depend on each other
                base = self.snapshot().seq
        raise ConcurrentUpdateError(f"{self.root} was changed {turns} times meanwhile")

    def ledger(self) -> DataFrame:
        """The sums of all batches: source, lang, tokenizer_version, docs, tokens, batch, version."""
        parts = self.snapshot().parts
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.root}/data/{version}" for version in sorted(set(parts.values()))]
        told = self.spark.createDataFrame(list(parts.items()), "batch string, version string")
        return self.spark.read.schema(self.schema).parquet(*paths).join(told, ["batch", "version"], "left_semi")

    def totals(self) -> DataFrame:
        """source, lang, tokenizer_version, docs, tokens; groups that are empty again stay out."""
        return (
            self.ledger()
            .groupBy(*KEY)
            .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
            .where((F.col("docs") != 0) | (F.col("tokens") != 0))
        )

    def fold(self, path: str) -> TokenRollup:
        """The same batches in one version in a new folder, where the ledger has grown long.

        Each keeps its id and sums, empty ones too, so one that is delivered again still replaces itself.
        """
        folded = TokenRollup(self.spark, path)
        batches = sorted(self.snapshot().parts)
        if batches:
            folded._write(self.ledger(), batches)
        return folded

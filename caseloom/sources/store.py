"""The stored star schema: eight Parquet tables that always change together.

Every load writes its new rows below ``<table>/version=<its own name>`` and becomes visible through one
numbered commit file that lists the folder.  Loads only ever insert, so a table is the union of its committed versions: nothing that
is being read is overwritten, a load that dies half-way leaves no visible row, and a load costs what
its new rows cost, not what the table weighs.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.schemas import TABLES
from caseloom.sources import files

FACT_PARTITION = "occ_year"


@dataclass(frozen=True)
class Commit:
    number: int
    load: str
    batch: str | None
    rows: dict[str, int]
    rejects: dict[str, int] = field(default_factory=dict)  # staging values that could not be read, by column


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._read_commits: dict[str, Commit] = {}

    # ------------------------------------------------------------ commits
    def commits(self) -> list[Commit]:
        """All commits in order.  Commit files never change, so each one is read once."""
        folder = f"{self.root}/commits"
        for name in files.children(self.spark, folder):
            if name not in self._read_commits:
                text = files.read_small_text(self.spark, f"{folder}/{name}")
                self._read_commits[name] = Commit(**json.loads(text))
        return sorted(self._read_commits.values(), key=lambda c: c.number)

    def new_load(self) -> tuple[int, str]:
        """Number the next commit must have, and a folder name no other load uses."""
        number = max((c.number for c in self.commits()), default=0) + 1
        return number, f"{number}-{uuid.uuid4().hex[:12]}"

    def commit(
        self, number: int, load: str, rows: dict[str, int], batch: str | None = None, rejects: dict[str, int] | None = None
    ) -> Commit:
        """Make a load visible.  Fails if another load took the number since this one looked at the
        tables; it must then be repeated, as its rows were chosen without those of the other."""
        done = Commit(number, load, batch, {t: n for t, n in rows.items() if n}, rejects or {})
        files.publish_text(self.spark, f"{self.root}/commits/{number:08d}.json", json.dumps(asdict(done)))
        return done

    # ------------------------------------------------------------ tables
    def write(self, table: str, load: str, rows: DataFrame) -> int:
        """Write the new rows of one table and return how many there are (from the file footers)."""
        path = self._path(table, load)
        if table == "fact_crime":
            # Rebalancing brings each year together and lets AQE split large years and pack small ones
            # into even files, whatever share of the rows one year holds.  Sorted by day inside, so a
            # date filter skips years by folder and pages by their statistics.
            rows = (
                rows.withColumn(FACT_PARTITION, F.year("date_occ"))
                .hint("rebalance", FACT_PARTITION)
                .sortWithinPartitions(FACT_PARTITION, "date_occ")
            )
            rows.write.mode("overwrite").partitionBy(FACT_PARTITION).parquet(path)
        else:
            rows.write.mode("overwrite").parquet(path)
        return self.loaded(table, [load]).count()

    def _path(self, table: str, load: str) -> str:
        return f"{self.root}/{table}/version={load}"

    def loaded(self, table: str, loads: list[str]) -> DataFrame:
        """Rows the given loads wrote to a table, committed or not."""
        schema = TABLES[table]
        if table == "fact_crime":
            schema = T.StructType([*schema.fields, T.StructField(FACT_PARTITION, T.IntegerType())])
        # The version folders are partitions of the table folder; their number itself is not needed.
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}")
        return reader.parquet(*[self._path(table, load) for load in loads]).select(*schema.names)

    def holds(self, name: str) -> bool:
        """Whether any commit brought rows of a table."""
        return any(name in c.rows for c in self.commits())

    def table(self, name: str, until: int | None = None) -> DataFrame:
        """Committed rows of a table, by default of all commits.

        The fact carries its storage partition ``occ_year`` as an extra last column.
        """
        loads = [
            c.load for c in self.commits() if name in c.rows and (until is None or c.number <= until)
        ]
        if loads:
            return self.loaded(name, loads)
        empty = self.spark.createDataFrame([], TABLES[name])
        return empty.withColumn(FACT_PARTITION, F.year("date_occ")) if name == "fact_crime" else empty

    def sql(self, statement: str, **parameters: object) -> DataFrame:
        """A SELECT over the store's tables by name, values bound as ``:name`` parameters."""
        for name in TABLES:
            self.table(name).createOrReplaceTempView(name)
        return self.spark.sql(statement, args=parameters)

"""Session-scoped lakehouse: silver and gold written once, queried many times.

The reference rebuilds its gold table once a day and points every report at
it.  Here the same happens per Spark application: the first query on a
source folder writes

* ``silver/{territory,dp03,dp05}``    small dimension tables
* ``silver/premiums``                 the premiums join, partitioned by batch

and the first query on either of

* ``gold/fact_current``, ``gold/fact_legacy``  full rebuilds, clustered by time

under the session's shared checkpoint folder, and every later query reads the
written parquet (column pruning and pushed filters apply, and a lost executor
only re-reads files instead of re-running the joins).
"""

from __future__ import annotations

import hashlib
import threading
import uuid
from collections import Counter
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from actuaria.constants import AS_OF
from actuaria.plans import gold
from actuaria.session import shared_dir
from actuaria.sources import binding, files

_LOCK = threading.RLock()
DIMENSIONS = ("territory", "dp03", "dp05")
EVOLVE_AT = "1998-01"  # first batch carrying the added columns (schema v2)
_LAKES: dict[tuple[str, str], "Lake"] = {}


@dataclass
class Lake:
    spark: SparkSession
    sf_dir: str
    root: str
    as_of: object = AS_OF
    state: str = ""
    built: bool = field(default=False)
    rows: dict = field(default_factory=dict)
    _frames: dict = field(default_factory=dict, repr=False)

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    # -- build ---------------------------------------------------------------
    def _write(self, df: DataFrame, *parts: str) -> int:
        """Write ``df`` as parquet and return its row count, observed in the
        same job (no second pass over the data)."""
        obs = Observation("rows_" + "_".join(parts))
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(self.path(*parts))
        return int(obs.get["rows"])

    def _write_premiums(self) -> int:
        # Silver is partitioned by batch (the newest batch is one folder) and
        # clustered by load time inside, so a big batch still spreads over tasks.
        spark, src = self.spark, self.sf_dir
        obs = Observation("rows_premiums")
        times = binding.table(spark, src, "lineitem").select(F.col("l_shipdate").alias("ingested_at"))
        (
            binding.shaped(gold.by_time(binding.joined(spark, src), times)).observe(obs, F.count(F.lit(1)).alias("rows"))
            .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("batch_id").parquet(self.path("silver", "premiums"))
        )
        return int(obs.get["rows"])

    def _together(self, **jobs: Callable[[], int]) -> None:
        """Run independent writes at the same time; their row counts go to ``rows``."""
        with ThreadPoolExecutor(len(jobs)) as pool:
            found = {name: pool.submit(job) for name, job in jobs.items()}
            self.rows.update({name: f.result() for name, f in found.items()})

    def build(self) -> "Lake":
        spark, src = self.spark, self.sf_dir
        small = {"territory": binding.territory, "dp03": binding.census_dp03, "dp05": binding.census_dp05}
        writes = {name: partial(self._write, read(spark, src).coalesce(1), "silver", name) for name, read in small.items()}
        self._together(premiums=self._write_premiums, **writes)
        self.built = True
        return self

    def _batch_bytes(self) -> dict[str, int]:
        """The bytes of every batch of the written premiums."""
        found = Counter()
        for path, length, _ in files.tree(self.spark, self.path("silver", "premiums")):
            folder = path.rsplit("/", 2)[1]
            if folder.startswith("batch_id=") and not folder.endswith("=__HIVE_DEFAULT_PARTITION__"):
                found[unquote(folder.removeprefix("batch_id="))] += length
        return dict(found)

    def _write_fact(self, name: str) -> int:
        # Gold is a full rebuild that never reads what it replaces.  Silver is clustered by
        # time; beside broadcast dimensions its rows stay where they are.
        shape = {"fact_current": gold.fact_current, "fact_legacy": gold.fact_legacy}[name]
        silver, dims = self.silver(), [self.dim(d) for d in DIMENSIONS]
        if sum(self.rows[d] for d in DIMENSIONS) > gold.DIMENSION_ROWS:
            return gold.write_fact(shape(silver, *dims), self.path("gold", name), silver)
        return self._write(shape(gold.in_slices(silver, self._batch_bytes()), *dims), "gold", name)

    # -- read ----------------------------------------------------------------
    def dim(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path("silver", name))

    def _table(self, layer: str, name: str, kind: str) -> DataFrame:
        # One DataFrame per written table and session: the file listing and
        # footer read happen once, every query plans on the same relation.
        key = (layer, name)
        if key not in self._frames:
            self._frames[key] = self._ordered(self.spark.read.parquet(self.path(layer, name)), kind)
        return self._frames[key]

    def silver(self) -> DataFrame:
        return self._table("silver", "premiums", "premiums")

    def _fact(self, name: str, kind: str) -> DataFrame:
        with _LOCK:
            if name not in self.rows:
                self.rows[name] = self._write_fact(name)
            return self._table("gold", name, kind)

    def fact_current(self) -> DataFrame:
        return self._fact("fact_current", "current")

    def fact_legacy(self) -> DataFrame:
        return self._fact("fact_legacy", "legacy")

    def evolving_premiums(self) -> DataFrame:
        """Silver premiums as two schema generations.

        Batches before ``EVOLVE_AT`` come without the ``cgr``/``cgr_factor`` columns,
        later batches with them; the union by name reads them as NULL in the old ones.
        """
        src = self.silver()
        old = src.where(F.col("batch_id") < EVOLVE_AT).drop("cgr", "cgr_factor")
        return old.unionByName(src.where(F.col("batch_id") >= EVOLVE_AT), allowMissingColumns=True)

    @staticmethod
    def _ordered(df: DataFrame, kind: str) -> DataFrame:
        # Partition discovery moves batch_id last and infers its type; restore
        # the declared column order and keep batch_id as text.
        cols = {
            "current": gold.CURRENT_COLUMNS,
            "legacy": gold.LEGACY_COLUMNS,
            "premiums": None,
        }[kind]
        df = df.withColumn("batch_id", df["batch_id"].cast("string"))
        return df.select(*cols) if cols else df


_SOURCES = ("region", "nation", "customer", "supplier", "orders", "lineitem")


def fingerprint(spark: SparkSession, src: str) -> str:
    """The state of the source files: path, length and time of every file of every table."""
    h = hashlib.sha1()
    for name in _SOURCES:
        h.update(repr(files.tree(spark, f"{src.rstrip('/')}/{name}.parquet")).encode())
    return h.hexdigest()


def kept(spark: SparkSession, sf_dir: str) -> Lake | None:
    """The lake of ``sf_dir`` if this application has one and no source file changed since."""
    src = files.qualified(spark, sf_dir)
    with _LOCK:
        found = _LAKES.get((spark.sparkContext.applicationId, src))
        return found if found and found.state == fingerprint(spark, src) else None


def lake(spark: SparkSession, sf_dir: str, root: str | None = None) -> Lake:
    """The built lake for ``sf_dir``: built on first use and again when a source file changes.

    A lake belongs to its application; nothing is taken over from another one.
    ``root`` names where to build, by default a fresh folder in the shared folder.
    """
    src = files.qualified(spark, sf_dir)
    key = (spark.sparkContext.applicationId, src)
    with _LOCK:
        state = fingerprint(spark, src)
        found = _LAKES.get(key)
        if found is None or found.state != state or root not in (None, found.root):
            where = root or f"{shared_dir(spark).rstrip('/')}/actuaria-lake/{uuid.uuid4().hex}"
            found = Lake(spark, src, where, state=state).build()
            _LAKES[key] = found
        return found

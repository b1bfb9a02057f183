"""Seasons and maxima that are kept from year to year: new looks change the years that they are in, and older years are not made again."""

from __future__ import annotations

import hashlib
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.grid import tile
from ..functions.scenes import season, season_year
from ..operators.features import features, previous_year
from ..operators.screening import stack_years, within_years
from ..operators.temporal import seasonal_wide, with_indices
from ..settings import FILL, INDICES, MEASURES, PIXEL, TILE
from ..storage import exists, materialize, remove
from .pipeline import kept_in_place

_KEYS = (*PIXEL, *TILE)
_BUCKETED = ("path", "row", *TILE)
_SUMS = ("good", *(f"{m}_{part}" for m in MEASURES for part in ("sum", "n")))
_COMMITS = "batch string, place int, kind string, year int, scene_id string, path int, row int"


class YearlyState:
    """Looks, sums of their seasons and maxima of their years in one folder, each a table in buckets of stack and tile.

    Groupings by pixel, and joins of the three under kept_in_place(), need no shuffle: looks are shuffled once, when they are added.
    Rows that a batch changes are written for the whole season-years (years) that it has looks in, beside the older version; one small
    file then names the versions that count. So a batch that broke off leaves nothing that is read, and is simply added again. One
    writer at a time. Stacks whose looks come at different times are best kept in folders of their own.

    buckets and side (of a tile, in pixels) are those that the folder was begun with, whatever is given later.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int | None = None, side: int = 256):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions")) if buckets is None else buckets
        self.side = side
        self._name = "yearly_" + hashlib.md5(self.folder.encode()).hexdigest()
        self._ready = exists(spark, f"{self.folder}/settings/_SUCCESS")
        if self._ready:
            self._attach()

    # ---- what is asked of it

    def add(self, batch: str, looks: DataFrame) -> bool:
        """Adds looks (obs columns and qa) as a batch of that name. False if it is there already; nothing is done then.

        A scene that another batch has brought is an error.
        """
        if not re.fullmatch(r"[A-Za-z0-9_-]+", batch):
            raise ValueError(f"no name for a batch: {batch}")
        before = self.commits()
        if before.where(F.col("batch") == batch).limit(1).count():
            return False
        rows = with_indices(looks.drop(*TILE)).withColumns({c: F.col(c).cast("int") for c in (*PIXEL, "year")})
        rows = rows.select("*", *tile(self.side))
        self._begin(rows)
        with kept_in_place(self.spark):
            self._put("looks", batch, rows.repartition(self.buckets, *_BUCKETED))
            own = self._table("looks").where(F.col("_version") == batch)
            scenes = own.select("scene_id", "path", "row", "year").distinct()
            twice = scenes.join(before.where("kind = 'scene'").select("scene_id", "path", "row"), ["scene_id", "path", "row"], "left_semi").first()
            if twice is not None:
                raise ValueError(f"scene {twice.scene_id} is there already")
            good = F.col("qa") >= 0
            sums = [F.count_if(good).alias("good")]
            for m in MEASURES:
                clear = F.when(good, F.col(m).cast("long"))
                sums += [F.sum(clear).alias(f"{m}_sum"), F.count(clear).alias(f"{m}_n")]
            by_season = own.groupBy(*_KEYS, season().alias("season"), season_year().alias("season_year")).agg(*sums)
            add = {c: F.coalesce(F.col(f"a.{c}"), F.lit(0)) + F.coalesce(F.col(f"b.{c}"), F.lit(0)) for c in _SUMS}
            self._merge("seasonal", batch, by_season, "season_year", add, own.select(season_year().alias("year")))
            by_year = own.groupBy(*_KEYS, "year").agg(*(F.max(i).alias(i) for i in INDICES))
            self._merge("maxima", batch, by_year, "year", {i: F.greatest(f"a.{i}", f"b.{i}") for i in INDICES}, own.select("year"))
        self._commit(batch, before, scenes, own)
        return True

    def commits(self) -> DataFrame:
        """What each batch has brought: its scenes, and the years of which it wrote looks, seasons and maxima. place: its number."""
        path = f"{self.folder}/commits"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], _COMMITS)
        return self.spark.read.schema(_COMMITS).option("recursiveFileLookup", True).parquet(path)

    def scenes(self) -> DataFrame:
        return self.commits().where("kind = 'scene'").select("scene_id", "path", "row", "year")

    def seasonal(self) -> DataFrame:
        """As temporal.seasonal_means() makes them from all looks with the years of their stacks, with tiles."""
        return within_years(self._means(None), self._years(), "season_year", 1)

    def annual_max(self) -> DataFrame:
        """As temporal.annual_max() makes them from all looks, with tiles."""
        return self._current("maxima", None).select(*_KEYS, "year", *INDICES)

    def featured(self, years: list[int] | None = None) -> DataFrame:
        """All looks of these years (None: all) after the first one of their stack, with their 50 features. Only the years before are read.

        Plan what is made of it under kept_in_place(); nothing is shuffled then. A year whose year before has no looks is an error.
        """
        scenes, spans = self.scenes(), self._years()
        own = within_years(scenes if years is None else scenes.where(F.col("year").isin(*years)), spans).select("path", "row", "year").distinct()
        have = scenes.select("path", "row", (F.col("year") + 1).alias("year")).distinct()
        if own.join(have, ["path", "row", "year"], "left_anti").limit(1).count():
            raise ValueError("scenes of a year without annual maxima in the year before")
        wanted = sorted(r.year for r in own.select("year").distinct().collect())  # a row for each year
        past = [y - 1 for y in wanted]
        looks = within_years(self._current("looks", wanted).drop("_version", *INDICES), spans)
        return features(previous_year(looks, seasonal_wide(self._means(past)), self._current("maxima", past), check_years=False))

    def vacuum(self) -> None:
        """Deletes versions that newer ones have replaced, once nothing reads them any more."""
        done = self.commits().select("kind", "year", "batch").where("kind in ('seasonal', 'maxima')")
        current = {(kind, year): v for kind in ("seasonal", "maxima") for year, v in self._versions(kind)}
        for kind, year, batch in done.distinct().collect():  # a row for each batch and year it touched
            if current[kind, year] != batch:
                column = "season_year" if kind == "seasonal" else "year"
                self.spark.sql(f"ALTER TABLE {self._name}_{kind} DROP IF EXISTS PARTITION (_version = '{batch}', {column} = {year})")
                remove(self.spark, f"{self.folder}/{kind}/_version={batch}/{column}={year}")

    # ---- tables

    def _table(self, kind: str) -> DataFrame:
        return self.spark.table(f"{self._name}_{kind}")

    def _begin(self, rows: DataFrame) -> None:
        """Begins the folder with the first batch, whose columns are those of all."""
        if self._ready:
            return
        columns = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "year")
        said = self.spark.createDataFrame([(self.buckets, self.side, columns)], "buckets int, side int, looks string")
        said.coalesce(1).write.mode("overwrite").json(f"{self.folder}/settings")
        self._attach()

    def _attach(self) -> None:
        """Tells the session's catalogue of the tables and of what is in their folders."""
        said = self.spark.read.schema("buckets int, side int, looks string").json(f"{self.folder}/settings").first()
        self.buckets, self.side, self._ready = said.buckets, said.side, True
        keys = ", ".join(f"{c} int" for c in _KEYS)
        columns = {
            "looks": (said.looks, "year"),
            "seasonal": (f"{keys}, season string, " + ", ".join(f"{c} bigint" for c in _SUMS), "season_year"),
            "maxima": (f"{keys}, " + ", ".join(f"{i} smallint" for i in INDICES), "year"),
        }
        for kind, (listed, year) in columns.items():
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self._name}_{kind} ({listed}, _version string, {year} int) USING parquet PARTITIONED BY (_version, {year}) "
                f"CLUSTERED BY ({', '.join(_BUCKETED)}) INTO {self.buckets} BUCKETS LOCATION '{self.folder}/{kind}'"
            )
            if exists(self.spark, f"{self.folder}/{kind}"):
                self.spark.sql(f"MSCK REPAIR TABLE {self._name}_{kind}")

    def _put(self, kind: str, batch: str, rows: DataFrame) -> None:
        """Writes a batch's version of a table; what an attempt before has left of it goes."""
        year = "season_year" if kind == "seasonal" else "year"
        view = f"rows_{uuid.uuid4().hex}"
        columns = [c for c in self._table(kind).columns if c not in ("_version", year)]
        quoted = ", ".join(f"`{c.replace('`', '``')}`" for c in columns)
        remove(self.spark, f"{self.folder}/{kind}/_version={batch}")  # Spark overwrites no table that it reads, but adds to it
        rows.createOrReplaceTempView(view)
        try:
            self.spark.sql(f"INSERT INTO {self._name}_{kind} PARTITION (_version = '{batch}', {year}) SELECT {quoted}, {year} FROM {view}")
        finally:
            self.spark.catalog.dropTempView(view)

    def _merge(self, kind: str, batch: str, new: DataFrame, year: str, values: dict[str, Column], touched: DataFrame) -> None:
        """Writes the touched years with the rows that they had and the new ones."""
        years = sorted(r.year for r in touched.distinct().collect())  # a row for each year
        keys = [*_KEYS, *(["season"] if kind == "seasonal" else []), year]
        if any(y in years for y, _ in self._versions(kind)):
            old = self._current(kind, years).select(*keys, *values)
            new = old.alias("a").join(new.alias("b"), keys, "full").select(*keys, *(v.alias(c) for c, v in values.items()))
        self._put(kind, batch, new)

    def _commit(self, batch: str, before: DataFrame, scenes: DataFrame, own: DataFrame) -> None:
        place = before.agg(F.coalesce(F.max("place"), F.lit(0)) + 1).first()[0]
        nothing = F.lit(None)
        parts = [scenes.select(F.lit("scene").alias("kind"), "year", "scene_id", "path", "row")]
        for kind, year in (("looks", F.col("year")), ("seasonal", season_year()), ("maxima", F.col("year"))):
            parts.append(own.select(F.lit(kind).alias("kind"), year.cast("int").alias("year")).distinct().select("kind", "year", nothing.cast("string").alias("scene_id"), nothing.cast("int").alias("path"), nothing.cast("int").alias("row")))
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p)
        # one file, so that all of it is there or nothing
        rows.select(F.lit(batch).alias("batch"), F.lit(place).cast("int").alias("place"), "*").coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/commits/{batch}")

    def _versions(self, kind: str) -> list[tuple[int, str]]:
        """Years and the batches whose rows count: of looks all, of the others the last one. A row for each year and batch at most."""
        done = self.commits().where(F.col("kind") == kind)
        if kind != "looks":
            done = done.groupBy("year").agg(F.max_by("batch", "place").alias("batch"))
        return [(r.year, r.batch) for r in done.select("year", "batch").collect()]

    def _current(self, kind: str, years: list[int] | None) -> DataFrame:
        """Rows that count, of these years (None: all); other partitions are not read."""
        year = "season_year" if kind == "seasonal" else "year"
        of: dict[str, list[int]] = {}
        for y, batch in self._versions(kind):
            if years is None or y in years:
                of.setdefault(batch, []).append(y)
        wanted = F.lit(False)
        for batch, own in sorted(of.items()):
            wanted = wanted | ((F.col("_version") == batch) & F.col(year).isin(*sorted(own)))
        return self._table(kind).where(wanted)

    def _means(self, years: list[int] | None) -> DataFrame:
        means = [F.coalesce(F.round(F.col(f"{m}_sum").cast("double") / F.when(F.col(f"{m}_n") > 0, F.col(f"{m}_n"))), F.lit(float(FILL))).cast("short").alias(m) for m in MEASURES]
        return self._current("seasonal", years).select(*_KEYS, "season_year", "season", F.least("good", F.lit(255)).cast("int").alias("good_looks"), *means)

    def _years(self) -> DataFrame:
        return materialize(stack_years(self.scenes()), "years")

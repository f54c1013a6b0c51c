"""The layered data set of one run, and when its layers are published.

``Lake(spark, sf_dir)`` exposes every dataset (Bronze, Silver, Gold). Layers
are published through the commit log of a store (:mod:`tripmart.sources.commits`)
in the shared folder, so a later session over the same inputs reads what an
earlier one wrote. Reading a layer that is not published yet writes it;
``refresh()`` brings all of them up to date and switches them in one commit.

A layer by source partition (year and month) is rewritten only where the parts
it was derived from changed: each part records where it came from. Rules that
must fail the run are observed while a layer is written, and nothing that
broke one is committed.
"""

from __future__ import annotations

import hashlib
import pathlib
import uuid
from collections.abc import Callable
from functools import cache, cached_property

import tripmart
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripmart.config import FIXTURE_CONFIG, RunConfig
from tripmart.operators.checks import ExpectationError, enforce
from tripmart.operators.dedup import duplicate_groups_by
from tripmart.operators.lookup import discard
from tripmart.plans import gold, silver, states
from tripmart.session import fixed_zone, shared_folder
from tripmart.sources import fixtures
from tripmart.sources.commits import CommitConflict, Store, bytes_of, rows_of
from tripmart.sources.sinks import CLUSTER_KEYS, clustered
from tripmart.sources.trips import bronze_trips
from tripmart.sources.zones import read_zones, stamp_zone_lookup_lineage, write_zones

_RUNS: dict[tuple, "Lake"] = {}

RAW_BY = ("year", "month")
SOURCE_BY = ("source_year", "source_month")
#: Columns whose bounds the commit log keeps for every part.
BOUNDS = {"fact_trips": CLUSTER_KEYS}
#: The layer by trips that each layer by trips reads: its size tells how many tasks make the layer.
MADE_FROM = {
    "bronze_trips": "raw_trips", "duplicate_groups": "bronze_trips", "trips_classified": "bronze_trips",
    "silver_baseline": "trips_classified", "fact_trips": "trips_classified", "fact_states": "fact_trips",
    "fact_members": "fact_trips", "fact_sketches": "fact_trips",
}
#: A source partition: year and month.
Month = tuple[int, int]


def _digest(*parts: object) -> str:
    return hashlib.sha256("\0".join(map(str, parts)).encode()).hexdigest()


@cache
def _engine() -> str:
    """Digest of this library's text: layers written by other code are never taken for current."""
    root = pathlib.Path(tripmart.__file__).parent
    files = sorted(p for p in root.rglob("*.py") if "llm" not in p.parts and "oracle" not in p.parts)
    return _digest(*[p.read_text() for p in files])


class Lake:
    def __init__(self, spark: SparkSession, sf_dir: str, cfg: RunConfig = FIXTURE_CONFIG):
        self.spark = spark
        self.sf_dir = sf_dir
        self.cfg = cfg
        self.inputs = fixtures.input_state(spark, sf_dir)
        self.zone = fixed_zone(spark)
        folder = cfg.shared_folder or shared_folder(spark)
        self.store = Store(spark, f"{folder.rstrip('/')}/lake-{_digest(sf_dir, cfg, self.zone)[:16]}")
        self._adopt(self.store.head())
        self._written: list[dict] = []
        self._in_refresh = False

    def _adopt(self, head: dict) -> None:
        """Take over a published version.

        Layers made from other inputs only serve to be reused in part, and layers made by other code not at all.
        """
        self._version = head["version"]
        if head.get("engine") != _engine():
            head = head | {"inputs": None, "layers": {}, "stale": {}}
        same = head["inputs"] == self.inputs
        self._layers: dict[str, dict] = dict(head["layers"]) if same else {}
        self._stale: dict[str, dict] = dict(head["stale"]) if same else head["stale"] | head["layers"]

    @classmethod
    def of_run(cls, spark: SparkSession, sf_dir: str, cfg: RunConfig = FIXTURE_CONFIG) -> "Lake":
        """The layers over the inputs as they are now, shared by every query of the application.

        A refresh publishes each layer once; the queries registered on top of
        them read those written copies, as reports run after a pipeline
        refresh read the published tables. When an input file was rewritten,
        added or removed, the next query starts from the new inputs.
        """
        key = (spark.sparkContext.applicationId, sf_dir, cfg)
        held = _RUNS.get(key)
        if held is None or held.spark is not spark or held.inputs != fixtures.input_state(spark, sf_dir):
            _RUNS[key] = held = cls(spark, sf_dir, cfg)
        return held

    #: Published layers in the order a refresh writes them.
    PUBLISHED = (
        "raw_trips", "bronze_trips", "silver_zones", "quarantine_zones", "duplicate_groups", "trips_classified",
        "silver_baseline", "dim_date", "dim_pickup_zone", "dim_dropoff_zone", "fact_trips", "fact_states", "fact_members",
        "fact_sketches",
    )

    def refresh(self, whole: bool = False) -> "Lake":
        """Bring every layer up to date with the inputs and switch them in one commit.

        Parts whose sources did not change stay (``whole`` rewrites all). If a
        check fails or another writer commits first, what was written is
        deleted and the published version stays.
        """
        fresh = Lake(self.spark, self.sf_dir, self.cfg)
        fresh._in_refresh = True
        fresh._stale = {} if whole else fresh._stale | fresh._layers
        fresh._layers = {}
        try:
            for name in self.PUBLISHED:
                getattr(fresh, name)
            fresh._commit()
        except Exception:
            for layer in fresh._written:
                self.store.drop(layer)
            raise
        fresh._in_refresh = False
        self.store.vacuum()
        self.discard()
        self.__dict__.clear()
        self.__dict__.update(fresh.__dict__)
        return self

    def _commit(self) -> None:
        content = {"inputs": self.inputs, "engine": _engine(), "layers": self._layers, "stale": {}}
        content["stale"] = {} if self._in_refresh else {k: v for k, v in self._stale.items() if k not in self._layers}
        self._version = self.store.commit(content, self._version)["version"]
        self._written = []

    def _publish(self, name: str, layer: dict) -> None:
        """Add a layer to the published version; during a refresh, to the version being made."""
        self._layers[name] = layer
        while not self._in_refresh:
            try:
                return self._commit()
            except CommitConflict:
                head = self.store.head()
                if head["inputs"] != self.inputs or head.get("engine") != _engine():
                    raise
                mine = self._layers
                self._adopt(head)
                # Layers are functions of the inputs: what another session published serves as well.
                self._layers = mine | self._layers

    # -- writing -------------------------------------------------------------------
    def publish(self, name: str, df: DataFrame, by: tuple[str, ...] = (), inside: list | None = None) -> dict:
        """Write a layer and check the rules observed on the way; raises, and keeps nothing, if one is broken."""
        rules = self._rules(name)
        observed = {k: m for k, (_, m) in rules.items()}
        layer, seen = self.store.write(name, df, by, observed, BOUNDS.get(name, ()), *self._read_for(name))
        self._written.append(layer)
        try:
            self._check({k: n for k, (n, _) in rules.items()}, seen)
            for names, observation in inside or ():
                self._check(names, observation.get)
        except ExpectationError:
            self._written.remove(layer)
            self.store.drop(layer)
            raise
        return layer

    def _read_for(self, name: str) -> tuple[int, int]:
        """Rows, and bytes of files, that a layer is made from (the bytes only of layers; raw inputs are shuffled)."""
        if name == "raw_trips":
            return fixtures.raw_lines(self.spark, self.sf_dir), 0
        made_from = self._layers.get(MADE_FROM.get(name))
        return (rows_of(made_from), bytes_of(made_from)) if made_from else (0, 0)

    def _rules(self, name: str) -> dict[str, tuple[str, Column]]:
        """Broken-rule counters of a layer: ``counter -> (expectation, count of rows that break it)``."""
        from tripmart.plans.expectations import enforced

        found = [(part, rule, text) for part, rules in enforced(name, self.cfg) for rule, text in rules.items()]
        return {
            f"broken{i}": (rule, F.count_if(F.expr(f"({part}) AND NOT coalesce({text}, false)")))
            for i, (part, rule, text) in enumerate(found)
        }

    @staticmethod
    def _check(names: dict[str, str], seen: dict) -> None:
        broken = {rule: seen[k] for k, rule in names.items() if seen.get(k)}
        if broken:
            raise ExpectationError(f"expectations failed: {broken}")

    def _layer(self, name: str, build: Callable[[], DataFrame], stamp: str) -> DataFrame:
        """An unpartitioned layer, written unless it was derived from the same ``stamp``."""
        if name not in self._layers:
            held = self._stale.get(name)
            if held and held.get("from") == stamp:
                layer = held
            else:
                layer = self.publish(name, build()) | {"from": stamp}
            self._publish(name, layer)
        return self.store.read(self._layers[name], name)

    def _monthly(
        self, name: str, by: tuple[str, ...], sources: dict[Month, str], build: Callable[[list[Month]], DataFrame | tuple]
    ) -> DataFrame:
        """A layer by source partition: parts whose month has the same source as before stay, the others are written."""
        if name not in self._layers:
            held = self._stale.get(name, {"parts": []})
            kept = [p for p in held["parts"] if sources.get(_month(p)) == p["from"]]
            changed = sorted(set(sources) - {_month(p) for p in kept})
            # A month without rows has no part; the layer tells which months it covers.
            covered = held.get("empty", {})
            changed = [m for m in changed if covered.get(_text(m)) != sources[m]]
            if changed or not held["parts"]:
                built = build(changed)
                layer = self.publish(name, built[0], by, built[1]) if isinstance(built, tuple) else self.publish(name, built, by)
            else:
                layer = held | {"parts": []}
            for part in layer["parts"]:
                part["from"] = sources[_month(part)]
            layer = layer | {"parts": kept + layer["parts"]}
            present = {_month(p) for p in layer["parts"]}
            layer["empty"] = {_text(m): s for m, s in sources.items() if m not in present}
            self._publish(name, layer)
        return self.store.read(self._layers[name], name)

    def sources_of(self, name: str, *more: str) -> dict[Month, str]:
        """Months of a layer with a digest of the parts they consist of (and of whatever else matters)."""
        found: dict[Month, list[str]] = {}
        for part in self._layers[name]["parts"]:
            found.setdefault(_month(part), []).append(part["folder"])
        return {month: _digest(*sorted(folders), *more) for month, folders in found.items()}

    def discard(self) -> None:
        """Delete what this run wrote beside the published layers."""
        if (zones := self.__dict__.pop("raw_zones", None)) is not None:
            discard(zones)

    # -- Bronze ---------------------------------------------------------------
    @cached_property
    def raw_trips(self) -> DataFrame:
        """The bound raw trips by source partition; months whose rows did not change keep their parts."""
        name = "raw_trips"
        if name not in self._layers:
            held = self._stale.get(name)
            if held and held["from"] == _digest(self.inputs):
                layer = held
            else:
                layer = self.publish(name, fixtures.raw_trips(self.spark, self.sf_dir), RAW_BY)
                layer = self._unchanged_kept(name, held, layer) if held else layer
            self._publish(name, layer | {"from": _digest(self.inputs)})
        return self.store.read(self._layers[name], name)

    def _unchanged_kept(self, name: str, held: dict, layer: dict) -> dict:
        """Of new parts, those whose rows equal the held part's are dropped again: nothing downstream is rewritten."""
        old, new = (self._month_digests(name, x) for x in (held, layer))
        same = {m for m, d in new.items() if old.get(m) == d}
        kept = [p for p in held["parts"] if _month(p) in same]
        self.store.drop({"parts": [p for p in layer["parts"] if _month(p) in same]})
        return layer | {"parts": kept + [p for p in layer["parts"] if _month(p) not in same]}

    def _month_digests(self, name: str, layer: dict) -> dict[Month, tuple]:
        """Order-free digest of the rows of every month: count, sum and exclusive or of their hashes."""
        rows = self.store.read(layer, name)
        h = F.xxhash64(*rows.columns)
        sums = rows.groupBy(*RAW_BY).agg(F.count(F.lit(1)), F.sum(h.cast("decimal(20,0)")), F.bit_xor(h)).collect()
        return {(int(r[0]), int(r[1])): tuple(r[2:]) for r in sums}

    @cached_property
    def bronze_trips(self) -> DataFrame:
        """The Bronze copy of one source year, by month."""
        self.raw_trips
        year = self.cfg.expected_pickup_year
        sources = {m: s for m, s in self.sources_of("raw_trips").items() if m[0] == year}
        return self._monthly(
            "bronze_trips", RAW_BY, sources,
            lambda months: bronze_trips(_in_months(self.raw_trips, RAW_BY, months), year, self.cfg.trip_source_table),
        )

    @cached_property
    def raw_zones(self) -> DataFrame:
        """The bound zone lookup, written as CSV and scanned as the feed is: fixed schema, header check."""
        path = f"{self.store.path}/feeds/{uuid.uuid4().hex}"
        write_zones(fixtures.raw_zones(self.spark, self.sf_dir), path)
        zones = read_zones(self.spark, path)
        zones._written_to = path
        return zones

    @cached_property
    def bronze_zones(self) -> DataFrame:
        return stamp_zone_lookup_lineage(self.raw_zones, self.cfg.zone_source_path)

    # -- Silver ---------------------------------------------------------------
    @cached_property
    def zones_classified(self) -> DataFrame:
        return silver.classified_zones(self.bronze_zones)

    def _zones(self, name: str, condition: Column) -> DataFrame:
        return self._layer(name, lambda: self.zones_classified.where(condition), self.inputs)

    @cached_property
    def silver_zones(self) -> DataFrame:
        return self._zones("silver_zones", ~F.col("_is_quarantined"))

    @cached_property
    def quarantine_zones(self) -> DataFrame:
        return self._zones("quarantine_zones", F.col("_is_quarantined"))

    @property
    def zone_rows(self) -> int:
        """Counted size of the valid zone lookup (bound for broadcasts)."""
        self.silver_zones
        return rows_of(self._layers["silver_zones"])

    @cached_property
    def _zone_digest(self) -> str:
        """Digest of what trips take from the zone lookup, whatever its refresh time."""
        h = F.xxhash64("location_id", "borough", "zone", "service_zone")
        found = self.silver_zones.agg(F.count(F.lit(1)), F.sum(h.cast("decimal(20,0)")), F.bit_xor(h)).first()
        return _digest(*found)

    @cached_property
    def hashed_trips(self) -> DataFrame:
        return silver.hashed_trips(self.bronze_trips)

    def _hashed(self, months: list[Month]) -> DataFrame:
        return silver.hashed_trips(_in_months(self.bronze_trips, RAW_BY, months))

    @cached_property
    def duplicate_groups(self) -> DataFrame:
        """Record hashes that occur more than once, with their count and first row, by source partition.

        The hash covers the source year and month, so a group never spans two
        partitions: a late part of a month regroups that month alone.
        """
        self.bronze_trips
        return self._monthly(
            "duplicate_groups", SOURCE_BY, self.sources_of("bronze_trips"),
            lambda months: duplicate_groups_by(self._hashed(months), SOURCE_BY),
        )

    @cached_property
    def trips_classified(self) -> DataFrame:
        """Every Bronze trip classified, published once by source partition and quarantine flag.

        Silver, quarantine, Gold and every report read this written copy: the
        classification runs once per refresh, and downstream plans start
        from a scan instead of re-planning the whole pipeline.
        """
        self.bronze_trips

        def build(months: list[Month]) -> DataFrame:
            groups = _in_months(self.duplicate_groups, SOURCE_BY, months).drop(*SOURCE_BY)
            return silver.classify_trips(self._hashed(months), groups, self.silver_zones, self.cfg, self.zone_rows)

        sources = self.sources_of("bronze_trips", self._zone_digest)
        return self._monthly("trips_classified", (*SOURCE_BY, "_is_quarantined"), sources, build)

    @cached_property
    def silver_trips(self) -> DataFrame:
        return silver.split(self.trips_classified)[0]

    @cached_property
    def quarantine_trips(self) -> DataFrame:
        return silver.split(self.trips_classified)[1]

    def _stamp(self, name: str) -> str:
        return _digest(*sorted(self.sources_of(name).values()))

    @cached_property
    def silver_baseline(self) -> DataFrame:
        """One row of Silver aggregates that Gold must reproduce."""
        from tripmart.plans.gold_validation import silver_baseline

        self.trips_classified
        return self._layer("silver_baseline", lambda: silver_baseline(self.silver_trips), self._stamp("trips_classified"))

    # -- Gold -----------------------------------------------------------------
    @cached_property
    def gold_trip_source(self) -> DataFrame:
        """Canonical Silver trips; their rules are observed when the fact is written, or checked here before that."""
        source = gold.gold_trip_source(self.silver_trips)
        if "fact_trips" not in self._layers:
            self.enforce_on("gold_trip_source", source)
        return source

    def enforce_on(self, name: str, df: DataFrame) -> None:
        """Raise if rows break a rule that must fail the run (EX3-EX8), by a pass over them."""
        from tripmart.plans.expectations import enforced

        for part, rules in enforced(name, self.cfg):
            enforce(df.where(F.expr(part)), rules)

    @cached_property
    def gold_zone_source(self) -> DataFrame:
        return gold.gold_zone_source(self.silver_zones)

    @cached_property
    def _calendar(self) -> str:
        """First and last calendar day: all that the calendar is made from."""
        return _digest(*gold.calendar_bounds(self.silver_baseline).first())

    @cached_property
    def dim_date(self) -> DataFrame:
        return self._layer("dim_date", lambda: gold.dim_date(self.silver_baseline), self._calendar)

    @cached_property
    def dim_time(self) -> DataFrame:
        return gold.dim_time(self.spark)

    @cached_property
    def dim_pickup_zone(self) -> DataFrame:
        return self._layer("dim_pickup_zone", lambda: gold.zone_dimension(self.gold_zone_source, "pickup"), self._zone_digest)

    @cached_property
    def dim_dropoff_zone(self) -> DataFrame:
        return self._layer("dim_dropoff_zone", lambda: gold.zone_dimension(self.gold_zone_source, "dropoff"), self._zone_digest)

    @cached_property
    def dim_payment_type(self) -> DataFrame:
        return gold.dim_payment_type(self.spark)

    @cached_property
    def dim_rate_code(self) -> DataFrame:
        return gold.dim_rate_code(self.spark)

    @cached_property
    def dim_vendor(self) -> DataFrame:
        return gold.dim_vendor(self.spark)

    def dimension(self, name: str) -> DataFrame:
        return getattr(self, name)

    def dimension_rows(self, name: str) -> int:
        """Counted rows of a dimension (bound for broadcasts): of a published one, as its commit says."""
        rows = self.dimension(name)
        return rows_of(self._layers[name]) if name in self._layers else rows.count()

    @cached_property
    def fact_trips(self) -> DataFrame:
        """The Gold fact, published once by source partition and clustered; KPIs and Gold reports scan the written copy."""
        self.trips_classified

        def build(months: list[Month]) -> tuple[DataFrame, list]:
            source = gold.gold_trip_source(_in_months(self.silver_trips, SOURCE_BY, months))
            rules = self._rules("gold_trip_source")
            seen = Observation()
            if rules:
                source = source.observe(seen, *[m.alias(k) for k, (_, m) in rules.items()])
            inside = [({k: n for k, (n, _) in rules.items()}, seen)] if rules else []
            return clustered(gold.fact_trips(self, source), days, zones), inside

        days = self._known_keys("dim_date", "date_key")
        zones = self._known_keys("dim_pickup_zone", "pickup_zone_key")
        sources = self.sources_of("trips_classified", self._zone_digest, self._calendar)
        return self._monthly("fact_trips", SOURCE_BY, sources, build)

    def _known_keys(self, dimension: str, key: str) -> tuple[int, int]:
        """Least and largest key of a dimension beside its unknown member (0)."""
        known = self.dimension(dimension).where(F.col(key) > 0)
        return tuple(known.agg(F.coalesce(F.min(key), F.lit(0)), F.coalesce(F.max(key), F.lit(0))).first())

    def _of_fact(self, name: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """State of the fact by source partition, renewed where the fact was."""
        self.fact_trips
        months = lambda found: build(_in_months(self.fact_trips, SOURCE_BY, found))
        return self._monthly(name, SOURCE_BY, self.sources_of("fact_trips"), months)

    @cached_property
    def fact_states(self) -> DataFrame:
        """Additive sums of the fact; KPIs fold them."""
        return self._of_fact("fact_states", states.fact_states)

    @cached_property
    def fact_members(self) -> DataFrame:
        """Members that the fact's foreign keys use, with their rows."""
        from tripmart.plans.gold_validation import FOREIGN_KEYS

        keys = [k.fact for k in FOREIGN_KEYS]
        return self._of_fact("fact_members", lambda fact: states.fact_members(fact, keys))

    @cached_property
    def fact_sketches(self) -> DataFrame:
        """Sketches of the fact's routes."""
        return self._of_fact("fact_sketches", states.fact_sketches)

    def counts(self, name: str, year: int) -> DataFrame:
        """Rows per partition value of one year of a published layer, from the footers of its files."""
        getattr(self, name)
        layer = self._layers[name]
        parts = [p for p in layer["parts"] if _month(p)[0] == year]
        # Only the reader that `counts` asks for heeds this.
        self.spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        return self.store.counts(layer | {"parts": parts}, name)


def _month(part: dict) -> Month:
    year, month, *_ = part["values"].values()
    return int(year), int(month)


def _text(month: Month) -> str:
    return f"{month[0]}-{month[1]}"


def _in_months(df: DataFrame, by: tuple[str, ...], months: list[Month]) -> DataFrame:
    """Rows of the given source partitions, selected by partition pruning."""
    year, month = by
    wanted = F.lit(False)
    for y, m in months:
        wanted = wanted | ((F.col(year).cast("int") == y) & (F.col(month).cast("int") == m))
    return df.where(wanted)

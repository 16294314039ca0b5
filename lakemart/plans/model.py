"""Models: functions from upstream tables to a table.

A model is registered with ``@model``; its parameters name the tables it
reads.  The parameter ``now`` is the run time, and ``target`` the stored table
(None before the first load).
"""

from __future__ import annotations

import inspect
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions.keys import surrogate_key
from lakemart.operators import merge
from lakemart.operators.quality import assert_contract
from lakemart.plans import contracts
from lakemart.plans.derivations import DERIVATIONS
from lakemart.plans.propagation import VALUE, Derivation, difference, fingerprint, holding, same_keys
from lakemart.session import stored
from lakemart.sinks.versions import ProtectedHistory, Tables, clustered, month_of

SPECIAL = ("now", "target")
BEGINNING = datetime(1899, 12, 31)


@dataclass(frozen=True)
class Since:
    """Incremental filter on the first input: rows past the newest time that
    the stored table holds."""

    source: str = "dw_metadata_dbt_copied_at"
    stored: str | None = None
    inclusive: bool = False
    or_null: bool = False
    overlap: str | None = None

    def apply(self, df: DataFrame, newest: Callable[[str], object]) -> DataFrame:
        mark = newest(self.stored or self.source) or BEGINNING
        margin = F.expr(f"INTERVAL {self.overlap}") if self.overlap else None
        return merge.above(df, self.source, mark, self.inclusive, self.or_null, margin)


@dataclass(frozen=True)
class Model:
    name: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    load: str = "table"
    keys: tuple[str, ...] = ()
    keep: tuple[str, ...] = ()
    since: Since | None = None
    parent: tuple[str, ...] = ()
    newer: str | None = None
    after: Callable[..., DataFrame] | None = None
    history: bool = False
    by_month: str | None = None
    order: tuple[str, ...] = ()
    digests: tuple[tuple[str, tuple[str, ...]], ...] = ()

    @property
    def derivation(self) -> Derivation | None:
        return DERIVATIONS.get(self.name) if self.load == "table" else None

    @property
    def dealt_by(self) -> tuple[str, ...]:
        """Columns whose hash says in which bucket a row is stored; none for
        tables that are written whole."""
        if self.derivation:
            return (self.derivation.unit,)
        if self.by_month or self.load not in ("merge", "replace", "replace_changed"):
            return ()
        return self.parent or self.keys

    def made(self, columns: list[str]) -> dict[str, Column]:
        """Digests among the columns that other columns of a row say."""
        return {name: surrogate_key(*parts) for name, parts in self.digests if {name, *parts} <= {*columns}}

    def bare(self, df: DataFrame, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """A step over rows without their digests, which are made again after it: they do
        not compress, and a step that shuffles or writes carries what they are made of."""
        made = self.made(df.columns)
        return step(df.drop(*made)).withColumns(made).select(*df.columns) if made else step(df)

    @property
    def late(self) -> tuple[str, ...]:
        """Tables that the clean-up step reads."""
        return tuple(inspect.signature(self.after).parameters)[1:] if self.after else ()

    @property
    def tables(self) -> tuple[str, ...]:
        """Upstream tables, those of the clean-up step included."""
        return tuple(dict.fromkeys(n for n in self.inputs + self.late if n not in SPECIAL))


MODELS: dict[str, Model] = {}
#: Writes of a table that stay readable.
KEPT_WRITES = 3


def add(name: str, build: Callable[..., DataFrame], inputs: tuple[str, ...] | None = None, **options) -> Model:
    inputs = inputs if inputs is not None else tuple(inspect.signature(build).parameters)
    MODELS[name] = Model(name, inputs, build, **options)
    return MODELS[name]


def model(**options):
    """Register a function under its own name."""

    def register(fn: Callable[..., DataFrame]):
        add(fn.__name__, fn, **options)
        return fn

    return register


def in_order(models: dict[str, Model] = MODELS, wanted: list[str] | None = None) -> list[str]:
    """Models so that each comes after its inputs; only those that the wanted
    ones need."""
    needed, queue = set(), list(wanted if wanted is not None else models)
    while queue:
        name = queue.pop()
        if name in models and name not in needed:
            needed.add(name)
            queue += models[name].tables
    graph = {n: [t for t in models[n].tables if t in needed] for n in needed}
    return list(TopologicalSorter(graph).static_order())


def _call(m: Model, read: Callable[[str], DataFrame], now: Column, target: DataFrame | None, first: DataFrame | None = None):
    special = {"now": now, "target": target}
    args = [special[n] if n in SPECIAL else read(n) for n in m.inputs]
    if first is not None:
        args[0] = first
    return m.build(*args)


def evaluate(
    sources: Callable[[str], DataFrame],
    wanted: list[str],
    now: Column,
    models: dict[str, Model] = MODELS,
    store: Callable[[str, DataFrame], DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Full refresh of the wanted models as frames.  ``store`` may write a
    model that several others read and return the stored frame."""
    built: dict[str, DataFrame] = {}

    def read(name: str) -> DataFrame:
        return built[name] if name in models else sources(name)

    for name in in_order(models, wanted):
        m = models[name]
        df = _call(m, read, now, None)
        if m.after:
            df = m.after(df, *[read(t) for t in m.late])
        built[name] = store(name, df) if store else df
    return built


def _news(m: Model, tables: Tables, read: Callable[[str], DataFrame], now: Column, target: DataFrame):
    """Source rows since the last load, and the batch made of them."""
    source = read(m.inputs[0])
    if m.since:
        source = m.since.apply(source, lambda column: tables.newest(m.name, column))
    return source, _call(m, read, now, target, source)


def _merged(m: Model, target: DataFrame, source: DataFrame, batch: DataFrame) -> DataFrame:
    """Stored rows after a batch, by the load of the model."""
    keys = list(m.keys)
    if m.load == "merge" and m.parent:
        return merge.mark_deleted(target, batch, list(m.parent), keys, changed=source)
    if m.load == "merge":
        return merge.upsert(target, batch, keys, list(m.keep))
    if m.load == "replace":
        return merge.replace_keys(target, batch, keys)
    if m.load == "replace_changed":
        return merge.replace_changed(target, source, batch, keys)
    raise ValueError(f"{m.name}: no incremental form of load {m.load!r}")


def _published(m: Model, tables: Tables, df: DataFrame) -> DataFrame:
    """Published tables have the declared types, and keep the columns they were published with."""
    df = contracts.keep(m.name, df)
    if m.name.startswith("pub_") and tables.exists(m.name):
        return assert_contract(df, tables.live(m.name).schema)
    return df


def _buckets_of(tables: Tables, m: Model, keys: DataFrame) -> list[str]:
    """Names of the buckets that hold the keys."""
    return [r[0] for r in keys.select(tables.bucket_of(m.name, m.dealt_by)).distinct().collect()]


def _replace(m: Model, tables: Tables, keys: DataFrame, new: DataFrame, target: DataFrame, notes: dict) -> bool:
    """Store the rows of some keys of a bucketed table; `new` are all their rows.

    Only buckets with a row that differs are written, and the differing rows are kept
    as changes.  Says whether there are any.
    """
    new = m.bare(_published(m, tables, new), lambda rows: stored(rows, f"new-{m.name}"))
    old = same_keys(target, keys, "left_semi")
    if set(old.columns) != set(new.columns):
        changes = None
        differing = keys
    else:
        changes, rows = tables.keep_changes(m.name, m.bare(new, lambda rows: difference(old, rows)))
        differing = stored(rows.select(*m.dealt_by).distinct(), f"differing-{m.name}")
    touched = _buckets_of(tables, m, differing)
    if not touched:
        if changes:
            tables.drop_changes(m.name, changes)
        tables.note(m.name, notes)
        return False
    kept = same_keys(tables.read(m.name, touched), differing, "left_anti")
    merged = kept.unionByName(same_keys(new, differing, "left_semi"), allowMissingColumns=True)
    made = m.made(merged.columns)
    tables.replace_buckets(m.name, merged, m.dealt_by, touched, notes=notes, changes=changes, order=m.order, made=made)
    return True


def merge_buckets(m: Model, tables: Tables, read: Callable[[str], DataFrame], now: Column) -> bool | None:
    """Merge into the buckets that the batch or its source has keys of.

    All rows that a key can change are in its bucket; other buckets are neither
    read nor written, and a load without news writes nothing.  A clean-up step is
    done again for the keys of its tables' changed rows; None if these are unknown.
    """
    since = tables.notes(m.name).get("from", {})
    late = {t: tables.changes_since(t, since.get(t, -1)) for t in m.late}
    if any(paths is None for paths in late.values()):
        return None
    notes = {"from": {t: tables.version(t) for t in m.late}}
    source, batch = _news(m, tables, read, now, tables.read(m.name))
    batch = m.bare(batch, lambda rows: stored(rows, f"batch-{m.name}"))
    changed = batch.select(*m.dealt_by)
    if m.parent or m.load == "replace_changed":
        source = stored(source.select(*m.dealt_by).distinct(), f"changed-{m.name}")
        changed = changed.union(source)
    for t, paths in late.items():
        if paths:
            changed = changed.union(tables.changed_rows(t, paths).select(*m.dealt_by))
    changed = stored(changed.distinct(), f"keys-{m.name}")
    touched = _buckets_of(tables, m, changed)
    if not touched:
        return False
    target = tables.read(m.name, touched)
    if m.newer:
        batch = stored(merge.only_newer(batch, target, list(m.keys), m.newer), f"batch-{m.name}")
        if batch.isEmpty():
            return False
    new = same_keys(_merged(m, target, source, batch), changed, "left_semi")
    if m.after:
        new = m.after(new, *[read(t) for t in m.late])
    return _replace(m, tables, changed, new, target, notes)


def merge_months(m: Model, tables: Tables, read: Callable[[str], DataFrame], now: Column) -> bool:
    """Merge into the months that the batch has rows of.

    The change time is part of the key, so a stored row that matches is in the
    same month; all other months are neither read nor written.
    """
    batch = m.bare(_news(m, tables, read, now, tables.read(m.name))[1], lambda rows: stored(rows, f"batch-{m.name}"))
    months = [r[0] for r in batch.select(month_of(m.by_month)).distinct().collect()]
    if not months:
        return False
    target = tables.read(m.name, months)
    keys = batch.select(*m.keys).distinct()
    merged = merge.upsert(target, batch, list(m.keys), list(m.keep))
    changes = None
    if set(merged.columns) == set(target.columns):
        old, new = same_keys(target, keys, "left_semi"), same_keys(merged, keys, "left_semi")
        # where no stored row has a key of the batch there is nothing to compare
        changes = new if old.isEmpty() else m.bare(new, lambda rows: difference(old, rows))
    tables.replace_parts(m.name, merged, month_of(m.by_month), changes=changes, made=m.made(merged.columns))
    return True


def _whole(m: Model, tables: Tables, read: Callable[[str], DataFrame], df: DataFrame, notes: dict, history: bool) -> bool:
    """Store a table that was built whole; what is as it was is not written again."""
    if m.after:
        df = m.after(df, *[read(t) for t in m.late])
    df = _published(m, tables, df)
    if not tables.exists(m.name):
        if m.dealt_by:
            tables.replace_buckets(m.name, df, m.dealt_by, fresh=True, notes=notes, order=m.order, made=m.made(df.columns))
        else:
            tables.write(m.name, clustered(df, *m.order) if m.order else df, notes=notes)
        return True
    if not m.dealt_by:
        before = tables.version(m.name)
        tables.rebuild(m.name, clustered(df, *m.order) if m.order else df, history=history, notes=notes, compare=difference)
        return tables.version(m.name) != before
    if history:
        raise ProtectedHistory(f"{m.name} holds history and is not rebuilt")
    target = tables.read(m.name)
    if set(target.columns) != set(df.columns) or any(h.part is None for h in tables.live(m.name).held):
        tables.replace_buckets(m.name, df, m.dealt_by, fresh=True, notes=notes, order=m.order, made=m.made(df.columns))
        return True
    df = stored(df, f"whole-{m.name}")
    keys = stored(target.select(*m.dealt_by).union(df.select(*m.dealt_by)).distinct(), f"keys-{m.name}")
    return _replace(m, tables, keys, df, target, notes)


def _versions(m: Model, tables: Tables, read: Callable[[str], DataFrame]) -> dict:
    """What a model reads now: versions of tables, and fingerprints of lookups that have none."""
    found = {t: tables.version(t) for t in m.tables}
    return {t: fingerprint(read(t)) if version is None else version for t, version in found.items()}


def derive(m: Model, tables: Tables, read: Callable[[str], DataFrame], now: Column) -> bool | None:
    """Derive again what the changed rows of a model's inputs lead to.  Nothing is
    read if no input has changed.  None if the whole model has to be derived."""
    known = tables.notes(m.name).get("from")
    if known is None or "now" in m.inputs:
        return None
    current = _versions(m, tables, read)
    changed = [t for t in m.tables if known.get(t) != current[t]]
    if not changed:
        return False
    if not m.derivation or not m.derivation.covers(changed):
        return None
    paths = {t: tables.changes_since(t, known[t]) if isinstance(known.get(t), int) else None for t in changed}
    if any(found is None for found in paths.values()):
        return None
    changes = {t: tables.changed_rows(t, found) for t, found in paths.items() if found}
    notes = {"from": current}
    if not changes:
        tables.note(m.name, notes)
        return False
    unit = m.derivation.unit
    units = m.derivation.units(changes, read)
    if units.filter(F.col(VALUE).isNull()).count():
        return None
    keys = units.withColumnRenamed(VALUE, unit)
    target = tables.read(m.name, _buckets_of(tables, m, keys))
    new = holding(_call(m, m.derivation.reader(units, read), now, None), units, unit)
    return _replace(m, tables, keys, new, target, notes)


def refresh(m: Model, tables: Tables, read: Callable[[str], DataFrame], now: Column, full: bool = False) -> bool:
    """Build or update one stored table; says whether its rows have changed."""
    first = full or not tables.exists(m.name)
    if m.by_month:
        if not first:
            return merge_months(m, tables, read, now)
        df = _call(m, read, now, None)
        tables.replace_parts(m.name, df, month_of(m.by_month), fresh=True, made=m.made(df.columns))
        return True
    if m.load == "append" and not first:
        return tables.add_any(m.name, _news(m, tables, read, now, tables.read(m.name))[1])
    if m.load == "table":
        done = None if first else derive(m, tables, read, now)
        if done is not None:
            return done
        notes = {} if "now" in m.inputs else {"from": _versions(m, tables, read)}
    else:
        done = None if first else merge_buckets(m, tables, read, now)
        if done is not None:
            return done
        # the clean-up step's tables are read whole, and from here on by their changes
        notes = {"from": {t: tables.version(t) for t in m.late}}
        if not first:
            target = tables.read(m.name)
            source, batch = _news(m, tables, read, now, target)
            if m.newer:
                batch = merge.only_newer(batch, target, list(m.keys), m.newer)
            return _whole(m, tables, read, _merged(m, target, source, stored(batch, f"batch-{m.name}")), notes, False)
    return _whole(m, tables, read, _call(m, read, now, None), notes, m.history and full)


def run(
    tables: Tables,
    sources: Callable[[str], DataFrame],
    at: datetime,
    wanted: list[str] | None = None,
    full: bool = False,
    models: dict[str, Model] = MODELS,
    check: Callable[[str, DataFrame, Callable[[str], DataFrame]], None] | None = None,
) -> list[str]:
    """Refresh the models in order, each from stored tables.  A ``check`` that
    raises ends the run before anything is built on the failed table; tables whose
    rows have not changed are not checked again."""
    now = F.lit(at).cast("timestamp")

    def read(name: str) -> DataFrame:
        return tables.read(name) if name in models else sources(name)

    done = in_order(models, wanted)
    for name in done:
        changed = refresh(models[name], tables, read, now, full and not models[name].history)
        tables.prune(name, KEPT_WRITES)
        if check and changed:
            check(name, tables.read(name), read)
    return done


def sources_from(spark: SparkSession, given: dict[str, DataFrame], defaults: Callable[[SparkSession, str], DataFrame]):
    """Reader of source tables; a table without data is empty, not missing."""
    return lambda name: given[name] if name in given else defaults(spark, name)

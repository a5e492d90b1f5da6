"""What becomes of each source row: insert, update, skip, error or silent drop.

A plan hands over its rows with the row rules already judged (``before`` the
check against stored keys, and ``after`` it) and names the conflict key. From
that one description come four lazy frames: the rows to insert, the rows to
update, the rejects with a reason, and the counters.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leaseload.operators.keys import attach, attach_code, first_rows, hot_hashes, known_flag, last_wins, without_known
from leaseload.operators.sieve import Sieve, sieve
from leaseload.sources.exports import ROW_ORDER, stage

REPEAT_REASON = "repeat_in_file"


@dataclass(frozen=True)
class Rule:
    """A row rule: the row stops here where ``bad`` holds (null does not count)."""

    reason: str
    bad: Column
    column: str = ""
    value: Column | None = None
    outcome: str = "skip"

    @property
    def code(self) -> str:
        """Outcome, reason and field as one constant. Rows carry only this, and whether
        it is null is a plain condition that Spark can split and push down."""
        return f"{self.outcome}|{self.reason}|{self.column}"

    @property
    def told(self) -> Column:
        return F.lit(self.code)


@dataclass(frozen=True)
class Judged(Rule):
    """Neighbouring rules that were judged before a lookup: the column ``reason`` holds the
    code of the first broken one."""

    @property
    def told(self) -> Column:
        return F.col(self.reason)


def judged(rows: DataFrame, rules: list[Rule], late: tuple[str, ...], name: str) -> tuple[DataFrame, list[Rule]]:
    """Rows with their rules judged, all but those whose reasons are ``late``, which need a lookup.

    What a lookup shuffles is then the codes, null in most rows, in place of the cells they
    were read from. The rules come back in their order, each run without a late one as one.
    """
    told, run, columns = [], [], {}

    def close() -> None:
        if run:
            code = f"_{name}_{len(columns) // 2}"
            columns.update({code: first_reason(run), f"{code}_value": first_value(run)})
            told.append(Judged(code, F.col(code).isNotNull(), value=F.col(f"{code}_value")))
            run.clear()

    for rule in rules:
        if rule.reason in late:
            close()
            told.append(rule)
        else:
            run.append(rule)
    close()
    return rows.withColumns(columns) if columns else rows, told


def first_reason(rules: list[Rule]) -> Column:
    """Code of the first rule that a row breaks, null for a sound row."""
    return _first(rules, [r.told for r in rules])


def first_value(rules: list[Rule]) -> Column:
    """The cell that broke the first broken rule."""
    return _first(rules, [F.lit(None).cast("string") if r.value is None else r.value.cast("string") for r in rules])


def _first(rules: list[Rule], results: list[Column]) -> Column:
    if not rules:
        return F.lit(None).cast("string")
    chain = F.when(rules[0].bad, results[0])
    for rule, result in zip(rules[1:], results[1:], strict=True):
        chain = chain.when(rule.bad, result)
    return chain


def is_sound(rules: list[Rule]) -> Column:
    """True where no rule is broken. One condition per rule, joined by AND, so that Spark
    can push each one to where its column comes from and turn a lookup whose miss is a
    reject into an inner join."""
    kept = [F.coalesce(~r.bad, F.lit(True)) for r in rules]
    return reduce(lambda a, b: a & b, kept, F.lit(True))


def _known_code(check: Known) -> str:
    return Rule(check.reason, F.lit(True), check.on[-1][0]).code


def field_errors(named: dict[str, tuple[Column, Column, Column]]) -> Column:
    """Array of (field, reason, value) for cells that failed while the row is kept."""
    entries = [
        F.when(
            error.isNotNull(),
            F.struct(F.lit(name).alias("field"), error.alias("reason"), raw.cast("string").alias("value")),
        )
        for name, (_, error, raw) in named.items()
    ]
    return F.array_compact(F.array(*entries))


@dataclass(frozen=True)
class Known:
    """Keys that exist already. ``on`` pairs a row column with a table column."""

    table: DataFrame
    on: tuple[tuple[str, str], ...]
    reason: str = "duplicate"
    null_safe: bool = False


@dataclass(frozen=True)
class Outcome:
    """Classified rows of one plan.

    ``rows`` carries the target columns, ``_before`` and ``_after`` reason codes, the
    flag ``_sound``, ``_row_ord`` and ``_row_id``, and may carry ``_early``: the code of the
    rules that come first and need no lookup. The last entry of ``known`` is the table itself:
    a match there is a skip or, with ``on_match='update'``, an update. ``lean`` makes the same
    rows for the rejects alone, stored: reason codes and values, key, order and id.
    """

    rows: DataFrame
    columns: tuple[str, ...]
    key: tuple[str, ...] = ()
    known: tuple[Known, ...] = ()
    on_match: str = "skip"
    update_columns: tuple[str, ...] = ()
    order: str = ROW_ORDER
    stored: bool = False
    extra: dict[str, DataFrame] = field(default_factory=dict)
    lean: Callable[[], DataFrame] | None = None

    def settled(self, folder: str | None = None) -> Outcome:
        """Same outcome over rows written once to the shared folder.

        Use it when more than one of the four frames is wanted: the lookups then
        run once, and a lost executor costs a re-read, not a recompute.
        """
        return replace(self, rows=stage(self.rows, folder), stored=True)

    # -- the rows of interest ------------------------------------------------

    def _sound(self) -> DataFrame:
        return self.rows.filter("_sound")

    def _new_only(self, rows: DataFrame) -> DataFrame:
        for check in self.known:
            rows = without_known(rows, check.table, list(check.on), check.null_safe)
        return rows

    def _matched(self, rows: DataFrame) -> DataFrame:
        own = self.known[-1]
        for check in self.known[:-1]:
            rows = without_known(rows, check.table, list(check.on), check.null_safe)
        return _flag(rows, own, "_own").filter("_own").drop("_own")

    @property
    def accepted(self) -> DataFrame:
        """Rows to insert. Winners are picked first, so each key meets the stored
        keys once no matter how often the file repeats it."""
        if not self.key:
            return self._sound().select(*self.columns)
        key = list(self.key)
        if self.on_match == "skip" or not self.update_columns:
            return self._new_only(first_rows(self._sound(), key, [self.order])).select(*self.columns)
        return self._new_only(self._first_with_last()).select(*self.columns)

    def _first_with_last(self) -> DataFrame:
        """Per key the first row, its updatable columns taken from the last row: what
        an insert followed by updates leaves behind."""
        key = list(self.key)
        kept = [c for c in self.columns if c not in key and c not in self.update_columns]
        order = F.col(self.order)
        sound = self._sound()
        merged = sound.groupBy(*key).agg(
            F.min_by(F.struct(*kept), order).alias("_first"),
            F.max_by(F.struct(*self.update_columns), order).alias("_last"),
        )
        return merged.select(
            *key,
            *[F.col(f"_first.{c}").alias(c) for c in kept],
            *[F.col(f"_last.{c}").alias(c) for c in self.update_columns],
        )

    @property
    def updates(self) -> DataFrame:
        """Key and updatable columns of stored rows to change, last row wins."""
        key, values = list(self.key), list(self.update_columns)
        changed = [c for c in values if c not in key]
        sound = self._sound().filter(F.lit(self.on_match == "update"))
        return self._matched(last_wins(sound, key, changed, F.col(self.order))).select(*key, *changed)

    # -- the audit -----------------------------------------------------------

    @property
    def rejects(self) -> DataFrame:
        """One row per source row that is not loaded: id, outcome, reason, field, value."""
        if self._told_by_key():
            return self._rejects_by_key()
        return self._rejects_by_lookups()

    def _told_by_key(self) -> bool:
        """Whether the key alone tells if a row is known already or a repeat."""
        kinds = {f.name: f.dataType for f in self.rows.schema}
        return bool(self.key) and self.on_match != "update" and all(
            not check.null_safe
            and {a for a, _ in check.on} == set(self.key)
            and all(kinds[a] == check.table.schema[b].dataType for a, b in check.on)
            for check in self.known
        )

    def _rejects_by_key(self) -> DataFrame:
        """The rows are judged once and what is told of them is stored, as long as they are not.
        Rows that stop before the stored keys, or have no key, go straight to the result. The
        others are shuffled once, next to the known keys: a key's rows tell which of them is the
        first, and its known keys who has it. Rows whose key occurs nowhere else are left out
        of that; which keys do is told by counts of their hashes. A key with a large share of all
        rows would be one task's, so the rows of such keys take a lookup of one row per key."""
        key = list(self.key)
        rows = self._told_rows()
        keyed = rows.filter(F.col(key[0]).isNotNull())
        tables = [self._known_keys(c) for c in self.known]
        hot = hot_hashes(keyed, key)
        shared = self._shared_keys(keyed, tables)
        if shared is None:
            direct = rows.filter(F.col(key[0]).isNull())
        else:
            sifted = shared.may_hold(_hashed(rows, key), ["_hash"], "_maybe")
            direct, keyed = sifted.filter("NOT _maybe"), sifted.filter("_maybe").drop("_hash", "_maybe")
            tables = [shared.may_hold(_hashed(t, key), ["_hash"], "_maybe").filter("_maybe").select(*key) for t in tables]
        if hot:
            is_hot = F.xxhash64(*key).isin(hot)
            met = self._met_together(keyed.filter(~is_hot), [t.filter(~is_hot) for t in tables])
            met = met.unionByName(self._met_by_lookup(keyed.filter(is_hot), [t.filter(is_hot) for t in tables]))
        else:
            met = self._met_together(keyed, tables)
        known = F.coalesce(*[F.when(F.col("_known") == n, F.lit(_known_code(c))) for n, c in enumerate(self.known)], F.lit(None).cast("string"))
        again = F.when(F.col(self.order) != F.col("_first"), F.lit(Rule(REPEAT_REASON, F.lit(True), key[-1]).code))
        met = met.select("_row_id", F.coalesce(known, "_code", again).alias("_code"), F.when(known.isNull(), F.col("_value")).alias("_value"))
        direct = direct.select("_row_id", "_code", "_value")
        return direct.unionByName(met).filter("_code IS NOT NULL").select(*_shown())

    def _shared_keys(self, rows: DataFrame, tables: list[DataFrame]) -> Sieve | None:
        """The keys that more than one of the rows and known keys have, by their hashes."""
        key = list(self.key)
        hashes = reduce(DataFrame.unionByName, [_hashed(f, key).select("_hash") for f in (rows, *tables)])
        return sieve(stage(hashes.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_hash")), ["_hash"])

    def _told_rows(self) -> DataFrame:
        """Row id, code and value of every row; key and order only of those that get as far as the
        stored keys and have a key. Rows told by their own cells alone skip the lookups."""
        rows = self.rows if self.stored or self.lean is None else self.lean()
        key = list(self.key)
        before = F.col("_before").isNotNull()
        is_open = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key], ~before)

        def told(rows: DataFrame, is_open: Column, code: Column, value: Column) -> DataFrame:
            kept = [F.when(is_open, F.col(c)).alias(c) for c in (*key, self.order)]
            return rows.select("_row_id", code.alias("_code"), value.alias("_value"), *kept)

        code = F.coalesce("_before", "_after")
        value = F.when(before, F.col("_before_value")).otherwise(F.col("_after_value"))
        if self.stored or self.lean is not None:
            return told(rows, is_open, code, value)
        if "_early" not in rows.columns:
            return stage(told(rows, is_open, code, value), compression="zstd")
        stopped = told(rows.filter("_early IS NOT NULL"), F.lit(False), F.col("_early"), F.col("_early_value"))
        return stage(stopped.unionByName(told(rows.filter("_early IS NULL"), is_open, code, value)), compression="zstd")

    def _known_keys(self, check: Known) -> DataFrame:
        """The keys of a table under the names they have in the rows."""
        named = dict(check.on)
        return check.table.select(*[F.col(named[k]).alias(k) for k in self.key]).dropna()

    def _met_together(self, rows: DataFrame, tables: list[DataFrame]) -> DataFrame:
        """Rows with ``_first``, their key's first sound row, and ``_known``, the number of the first
        table that has the key. One shuffle of the rows and the tables."""
        key, kind = list(self.key), rows.schema[self.order].dataType
        marked = rows.withColumn("_hit", F.lit(None).cast("int"))
        for n, table in enumerate(tables):
            marked = marked.unionByName(table.withColumn("_hit", F.lit(n)), allowMissingColumns=True)
        of_key = W.partitionBy(*key)
        first = F.when(F.col("_code").isNull(), F.col(self.order)).cast(kind)
        return marked.withColumns({"_known": F.min("_hit").over(of_key), "_first": F.min(first).over(of_key)}).filter("_hit IS NULL").drop("_hit")

    def _met_by_lookup(self, rows: DataFrame, tables: list[DataFrame]) -> DataFrame:
        """The same for few keys of many rows, which are not shuffled."""
        key, kind = list(self.key), rows.schema[self.order].dataType
        lookup = rows.filter("_code IS NULL").select(*key, F.col(self.order).alias("_first"), F.lit(None).cast("int").alias("_known"))
        for n, table in enumerate(tables):
            lookup = lookup.unionByName(table.withColumns({"_first": F.lit(None).cast(kind), "_known": F.lit(n)}))
        lookup = lookup.groupBy(*key).agg(F.min("_first").alias("_first"), F.min("_known").alias("_known"))
        return attach_code(rows, lookup, [(k, k) for k in key])

    def _rejects_by_lookups(self) -> DataFrame:
        """One lookup per table of known keys, over rows that are read twice: their order
        must be stored, see ``settled``."""
        rows, hits = self.rows, []
        for n, check in enumerate(self.known):
            if check is self.known[-1] and self.on_match == "update":
                continue
            rows = _flag(rows, check, f"_hit{n}")
            hits.append(F.when(F.col(f"_hit{n}"), F.lit(_known_code(check))))
        value = F.when(F.col("_before").isNotNull(), F.col("_before_value"))
        for n in range(len(hits)):
            value = value.when(F.col(f"_hit{n}"), F.lit(None).cast("string"))
        judged = rows.withColumns(
            {"_code": F.coalesce("_before", *hits, "_after"), "_value": value.otherwise(F.col("_after_value"))}
        )
        shown = _shown()
        if not self.key or self.on_match == "update":
            return judged.filter("_code IS NOT NULL").select(*shown)
        # Two reads in all: one for the first row of each key, one for everything else.
        key = list(self.key)
        firsts = judged.filter("_code IS NULL").dropna(subset=key).groupBy(*key).agg(F.min(self.order).alias("_first"))
        told = attach(judged, firsts, [(k, k) for k in key])
        again = F.when(F.col(self.order) != F.col("_first"), F.lit(Rule(REPEAT_REASON, F.lit(True), key[-1]).code))
        return told.withColumn("_code", F.coalesce("_code", again)).filter("_code IS NOT NULL").select(*shown)

    @property
    def field_errors(self) -> DataFrame:
        """One row per cell that failed in a row that is kept."""
        return self.rows.select(F.col("_row_id").alias("row_id"), F.inline("_errors"))

    @property
    def counters(self) -> DataFrame:
        """Rows per outcome and reason, from one pass over the rows.

        Rows are counted per key first, so the check against stored keys joins one
        row per key. ``insert`` counts rows really added.
        """
        key = list(self.key)
        open_key = [F.when(F.col("_before").isNull(), F.col(k)).alias(k) for k in key]
        grouped = self.rows.select("_before", "_after", *open_key).groupBy("_before", "_after", *key).count()
        codes = [F.col("_before")]
        for n, check in enumerate(self.known):
            grouped = _flag(grouped, check, f"_hit{n}")
            hit, code = F.col(f"_hit{n}"), _known_code(check)
            if check is self.known[-1] and self.on_match == "update":
                hit, code = hit & F.col("_after").isNull(), "update|matched|"
            codes.append(F.when(hit, F.lit(code)))
        code = F.coalesce(*codes, "_after", F.lit("insert|new|"))
        judged = grouped.select(
            F.split_part(code, F.lit("|"), F.lit(1)).alias("outcome"),
            F.split_part(code, F.lit("|"), F.lit(2)).alias("reason"),
            F.col("count").alias("n"),
            (reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key]) if key else F.lit(False)).alias("keyed"),
        )
        is_new = F.col("outcome") == "insert"
        added = F.when(is_new & F.col("keyed"), F.lit(1).cast("bigint")).otherwise(F.col("n"))
        again = ("update", "matched") if self.on_match == "update" else ("skip", REPEAT_REASON)
        lines = F.array(
            F.struct(F.col("outcome"), F.col("reason"), added.alias("n_rows")),
            F.struct(
                F.lit(again[0]).alias("outcome"), F.lit(again[1]).alias("reason"), (F.col("n") - added).alias("n_rows")
            ),
        )
        return (
            judged.select(F.inline(lines))
            .filter("n_rows > 0")
            .groupBy("outcome", "reason")
            .agg(F.sum("n_rows").alias("n_rows"))
        )


def _flag(rows: DataFrame, check: Known, name: str) -> DataFrame:
    return known_flag(rows, check.table, list(check.on), name, check.null_safe)


def _hashed(rows: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` with a hash of their key, null where a part of the key is."""
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    return rows.withColumn("_hash", F.when(complete, F.xxhash64(*key)))


def _shown() -> list[Column]:
    """The columns of a reject from its row id, code and value."""
    parts = [F.split_part("_code", F.lit("|"), F.lit(n)).alias(c) for n, c in enumerate(("outcome", "reason", "field"), 1)]
    return [F.col("_row_id").alias("row_id"), *parts, F.col("_value").alias("value")]

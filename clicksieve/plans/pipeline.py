"""Groups of features and rules over a log, judged and joined back.

A pipeline is a list of groups. Each group aggregates the log once, computes
features and rules on the group frame, and joins chosen columns back to the
log. A group reads the raw rows and only those columns of earlier groups that
it names; all judgements are attached once, at the end. Everything is a lazy
plan; the caller writes the frames it wants.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicksieve.operators.aggregate import Keyed, Scalar, group_features, same_keys
from clicksieve.plans import reports
from clicksieve.session import cut_lineage
from clicksieve.status import valid_rows


@dataclass(frozen=True)
class Model:
    """A model fitted in one group and applied where ``target`` says.

    ``fit`` maps the group frame ("local") or the log ("global") to a table;
    ``apply`` adds columns to the target frame: "local" (the group's own
    frame), "global" (the log) or the name of a later group.
    """

    name: str
    fit: Callable[[DataFrame], DataFrame]
    apply: Callable[[DataFrame, DataFrame], DataFrame]
    target: Sequence[str] = ("local",)
    source: str = "local"


@dataclass(frozen=True)
class Group:
    """One grouping of the log. Without ``dims`` its rules work on log rows.

    ``uses`` names the columns of earlier groups that this group's own columns,
    statistics or global models read. ``export`` gets the finished group frame.
    """

    name: str
    dims: Sequence[str] = ()
    row_columns: dict[str, Column] = field(default_factory=dict)
    scalars: Sequence[Scalar] = ()
    keyed: Sequence[Keyed] = ()
    features: dict[str, Column] = field(default_factory=dict)
    rules: dict[str, Column] = field(default_factory=dict)
    models: Sequence[Model] = ()
    join_back: Sequence[str] = ()
    uses: Sequence[str] = ()
    export: Callable[[DataFrame], None] | None = None


@dataclass
class Result:
    log: DataFrame
    frames: dict[str, DataFrame]
    rules: list[str]


def join_judgements(log: DataFrame, group: DataFrame, dims: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Attach group columns to every log row, rows with null keys included.

    The group frame holds one row per key, so a frequent key makes one side of
    the join large, never both; AQE splits that side.
    """
    return same_keys(log, group.select(*dims, *cols), dims)


@dataclass
class _Rows:
    """The raw rows, and what earlier groups can add to them when it is asked for."""

    base: DataFrame
    joins: list[tuple[DataFrame, Sequence[str], list[str]]] = field(default_factory=list)
    later: list[tuple[str, Column, Sequence[str]]] = field(default_factory=list)

    def having(self, names: Sequence[str]) -> DataFrame:
        """The rows with the named columns of earlier groups; no other join is made."""
        wanted = set(names)
        for name, _, uses in reversed(self.later):
            if name in wanted:
                wanted |= set(uses)
        return self._with(wanted)

    def complete(self) -> DataFrame:
        return self._with({c for _, _, cols in self.joins for c in cols} | {n for n, _, _ in self.later})

    def _with(self, wanted: set[str]) -> DataFrame:
        out = self.base
        # joins that start with one key stand side by side
        for frame, dims, cols in sorted(self.joins, key=lambda j: list(j[1])):
            chosen = [c for c in cols if c in wanted]
            if chosen:
                out = join_judgements(out, frame, dims, chosen)
        for name, col, _ in self.later:
            if name in wanted:
                out = out.withColumn(name, col)
        return out


def run(log: DataFrame, groups: Sequence[Group], materialize: bool = True) -> Result:
    """Run the groups in order over a log.

    A finished group frame is checkpointed, so that later groups and the rows
    read it instead of aggregating the log for it again; the log stays a plan.
    """
    frames: dict[str, DataFrame] = {}
    pending: dict[str, list[tuple[Model, DataFrame]]] = {}
    rules: list[str] = []
    rows = _Rows(log)
    for group in groups:
        if group.uses:  # columns that may read joined ones are made where they are wanted
            rows.later += [(n, c, group.uses) for n, c in group.row_columns.items()]
        else:
            rows.base = rows.base.withColumns(group.row_columns)
        frame = None
        if group.dims:
            own = rows.having([*group.uses, *group.row_columns])
            frame = group_features(own, group.dims, group.scalars, group.keyed)
        for model, table in pending.pop(group.name, []):
            frame = model.apply(frame, table)
        if frame is not None:
            for name, col in group.features.items():
                frame = frame.withColumn(name, col)
        for model in group.models:
            table = model.fit(rows.having([*group.uses, *group.row_columns]) if model.source == "global" else frame)
            if materialize:
                table = cut_lineage(table)
            for target in model.target:
                if target == "local":
                    frame = model.apply(frame, table)
                elif target == "global":
                    rows.base = model.apply(rows.base, table)
                else:
                    pending.setdefault(target, []).append((model, table))
        if frame is None:
            rows.later += [(n, c, group.uses) for n, c in group.rules.items()]
        else:
            for name, col in group.rules.items():
                frame = frame.withColumn(name, col)
            if materialize:
                frame = cut_lineage(frame)
            frames[group.name] = frame
            cols = [*group.join_back, *group.rules]
            if cols:
                rows.joins.append((frame, group.dims, cols))
            if group.export is not None:
                group.export(frame)
        rules += list(group.rules)
    if pending:
        raise ValueError(f"models wait for groups that did not follow: {sorted(pending)}")
    return Result(rows.complete(), frames, rules)


def export_frame(
    frame: DataFrame, day: str, *, where: Column | None = None, actions: str | None = None,
    must_hold: str = "adclick", drop: Sequence[str] = (), min_volume: tuple[str, int] | None = None,
    sep: str = "->",
) -> DataFrame:
    """Group frame as exported: filtered, arrays joined to text, the day added."""
    if actions is not None:
        frame = frame.filter(F.array_contains(actions, must_hold))
    if where is not None:
        frame = frame.filter(where)
    if min_volume is not None:
        frame = frame.filter(F.col(min_volume[0]) >= min_volume[1])
    from clicksieve.functions.detail import arrays_to_text

    return arrays_to_text(frame.drop(*drop), sep).withColumn("day", F.lit(day))


def filter_types(log: DataFrame, most: str = "1", type_col: str = "tp") -> DataFrame:
    """Rows whose type is at most ``most`` as text; the filter reaches the scan."""
    return log.filter(F.col(type_col) <= most)


def daily_reports(
    log: DataFrame, groups: Sequence[Group], judged_path: str, keep: Sequence[str] = ()
) -> dict[str, DataFrame]:
    """All reports of a day: sheets, rule statistics, correlations, valid rows.

    The judged rows, cut to the columns of the reports and those in ``keep``,
    are written once; every report reads that narrow table.
    """
    result = run(filter_types(log), groups)
    rules = result.rules
    wanted = ["site", "srcg", "ctype", "sadspace", *keep, *rules]
    result.log.select(*dict.fromkeys(wanted)).write.mode("overwrite").parquet(judged_path)
    judged = log.sparkSession.read.parquet(judged_path)
    return {
        "judged": judged,
        "valid": valid_rows(judged, rules),
        "sheet": reports.settlement_sheet(judged, rules),
        "sheet_pc": reports.settlement_sheet_pc(judged, rules),
        "rules_by_channel": reports.rule_status_by_channel(judged, rules),
        "rules_total": reports.rule_status_total(judged, rules),
        "correlation_by_channel": reports.rule_cooccurrence(judged, rules, ["srcg"]),
        "correlation": reports.rule_cooccurrence(judged, rules),
        **{f"group:{name}": frame for name, frame in result.frames.items()},
    }

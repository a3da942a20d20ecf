"""Quality checks. Every check yields result rows; only those few rows reach the driver.

Result columns: test_name, dataset, dimension, severity, status, failed_rows, total_rows,
message. A check passes when no row fails, else its status is its severity.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions import is_blank, literal, parsed_number, unaccepted
from lakemart.operators.lookups import key_counts, missing_parents
from lakemart.sources.contract import Contract, DatasetSpec, ForeignKey

RESULT_COLUMNS = (
    "test_name",
    "dataset",
    "dimension",
    "severity",
    "status",
    "failed_rows",
    "total_rows",
    "message",
)


class QualityGateError(RuntimeError):
    """Raised by a gate when an ERROR-level check failed."""


def result_row(
    test_name: str,
    dataset: str,
    dimension: str,
    failed: str,
    total: str,
    message: str,
    severity: str = "ERROR",
) -> list[str]:
    """Columns of one result; ``failed``, ``total`` and ``message`` are SQL expressions."""
    level = literal(severity)
    return [
        f"{literal(test_name)} as test_name",
        f"{literal(dataset)} as dataset",
        f"{literal(dimension)} as dimension",
        f"{level} as severity",
        f"if({failed} = 0, 'PASS', {level}) as status",
        f"cast({failed} as bigint) as failed_rows",
        f"cast({total} as bigint) as total_rows",
        f"{message} as message",
    ]


def _counted(number: str, words: str) -> str:
    return f"concat(cast({number} as string), {literal(' ' + words)})"


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union in pairs of pairs, so that each frame is analysed a few times only."""
    frames = list(frames)
    while len(frames) > 1:
        pairs = [frames[i : i + 2] for i in range(0, len(frames), 2)]
        frames = [p[0].unionByName(p[1]) if len(p) == 2 else p[0] for p in pairs]
    return frames[0]


def _fixed_result(
    spark: SparkSession,
    name: str,
    dataset: str,
    dimension: str,
    failed: int,
    total: int,
    message: str,
) -> DataFrame:
    row = result_row(name, dataset, dimension, str(failed), str(total), literal(message))
    return spark.range(1).selectExpr(*row)


def missing_file(spark: SparkSession, dataset: str, file: str) -> DataFrame:
    message = f"missing file {file}"
    return _fixed_result(spark, "file_exists", dataset, "availability", 1, 1, message)


def check_columns(df: DataFrame, dataset: str, spec: DatasetSpec) -> tuple[DataFrame, list[str]]:
    """The schema check and the missing columns; reads no data."""
    missing = sorted(set(spec.required_columns) - set(df.columns))
    message = f"missing columns: {missing}" if missing else "all required columns present"
    wanted = len(set(spec.required_columns))
    spark = df.sparkSession
    result = _fixed_result(
        spark, "required_columns", dataset, "schema", len(missing), wanted, message
    )
    return result, missing


def _row_rules(spec: DatasetSpec) -> list[tuple[str, str, str, str]]:
    """(test name, dimension, failed-row condition, message) of every row-level rule."""
    rules = []
    for c in spec.not_null:
        bad = is_blank.sql(f"`{c}`")
        rules.append((f"{c}_not_null", "completeness", bad, "null or blank values"))
    for c, values in spec.accepted_values.items():
        bad = unaccepted.sql(f"`{c}`", values)
        rules.append((f"{c}_accepted_values", "validity", bad, "values outside the list"))
    for c in spec.non_negative:
        bad = _unless(c, "{n} >= 0")
        rules.append((f"{c}_non_negative", "validity", bad, "negative or non-numeric values"))
    for c, (low, high) in spec.ranges.items():
        bad = _unless(c, f"{{n}} between {low} and {high}")
        rules.append((f"{c}_range", "validity", bad, f"values outside [{low}, {high}]"))
    return rules


def _unless(column: str, good: str) -> str:
    """True for a non-null text that is no number or whose number ``n`` is not ``good``."""
    test = good.format(n=parsed_number.sql(f"`{column}`"))
    return f"`{column}` is not null and not coalesce({test}, false)"


def check_rows(df: DataFrame, dataset: str, spec: DatasetSpec) -> DataFrame:
    """Emptiness and all row-level rules in one pass: one conditional count per rule."""
    rules = _row_rules(spec)
    counts = df.selectExpr(
        "count(1) as n", *[f"count_if({bad}) as c{i}" for i, (_, _, bad, _) in enumerate(rules)]
    )
    empty = "cast(n = 0 as int)"
    rows = [
        result_row("file_not_empty", dataset, "availability", empty, "n", _counted("n", "rows"))
    ]
    for i, (name, dimension, _, message) in enumerate(rules):
        rows.append(result_row(name, dataset, dimension, f"c{i}", "n", _counted(f"c{i}", message)))
    structs = ", ".join(f"struct({', '.join(row)})" for row in rows)
    return counts.selectExpr(f"inline(array({structs}))")


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows in groups that share a key (nulls equal), and all rows."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return groups.selectExpr(
        "coalesce(sum(n) filter (where n > 1), 0) as failed", "coalesce(sum(n), 0) as total"
    )


def check_unique(df: DataFrame, dataset: str, keys: Sequence[str]) -> DataFrame:
    message = _counted("failed", "rows share a key")
    name = f"{'_'.join(keys)}_unique"
    row = result_row(name, dataset, "uniqueness", "failed", "total", message)
    return duplicate_rows(df, keys).selectExpr(*row)


def check_foreign_key(child: DataFrame, parent: DataFrame, rule: ForeignKey) -> DataFrame:
    """Child rows whose non-null key the parent lacks, out of all non-null child rows."""
    keys = key_counts(child, rule.child_column)
    known = key_counts(parent, rule.parent_column).selectExpr("key", "true as known")
    counts = keys.join(known, "key", "left").selectExpr(
        "coalesce(sum(n) filter (where known is null), 0) as failed", "coalesce(sum(n), 0) as total"
    )
    message = _counted("failed", f"keys without a row in {rule.parent_dataset}")
    row = result_row(
        rule.name, rule.child_dataset, "integrity", "failed", "total", message, rule.severity
    )
    return counts.selectExpr(*row)


def unusable_foreign_key(spark: SparkSession, rule: ForeignKey, column: str) -> DataFrame:
    """A rule whose own column is missing cannot be evaluated: one failure."""
    return _fixed_result(
        spark, rule.name, rule.child_dataset, "integrity", 1, 1, f"missing column: {column}"
    )


def check_dataset(df: DataFrame, dataset: str, spec: DatasetSpec) -> DataFrame:
    """All contract checks of one data set; a schema failure stops after emptiness."""
    schema_result, missing = check_columns(df, dataset, spec)
    if missing:
        only_count = DatasetSpec(spec.file, spec.required_columns)
        return check_rows(df, dataset, only_count).unionByName(schema_result)
    unique = [check_unique(df, dataset, keys) for keys in spec.unique]
    return union_all([check_rows(df, dataset, spec), schema_result, *unique])


def run_contract(
    spark: SparkSession, frames: dict[str, DataFrame], contract: Contract
) -> DataFrame:
    """Result rows of the whole contract; a data set without a frame has no file.

    Each data set is read twice whatever the number of rules: once for the row-level rules
    and once for all its key columns (see ``check_keys``).
    """
    results, complete = [], {}
    for name, spec in contract.datasets.items():
        if name not in frames:
            results.append(missing_file(spark, name, spec.file))
            continue
        schema_result, missing = check_columns(frames[name], name, spec)
        results.append(schema_result)
        if missing:
            spec = DatasetSpec(spec.file, spec.required_columns)
        results.append(check_rows(frames[name], name, spec))
        complete[name] = spec
    rules = []
    for rule in contract.foreign_keys:
        child, parent = frames.get(rule.child_dataset), frames.get(rule.parent_dataset)
        if child is None or parent is None:
            continue
        if rule.child_column not in child.columns:
            results.append(unusable_foreign_key(spark, rule, rule.child_column))
        elif rule.parent_column not in parent.columns:
            results.append(unusable_foreign_key(spark, rule, rule.parent_column))
        else:
            rules.append(rule)
    unique = [(name, keys) for name, spec in complete.items() for keys in spec.unique]
    if unique or rules:
        results.append(check_keys(spark, frames, unique, rules))
    return union_all(results)


def check_keys(
    spark: SparkSession,
    frames: dict[str, DataFrame],
    unique: Sequence[tuple[str, Sequence[str]]],
    rules: Sequence[ForeignKey],
) -> DataFrame:
    """All uniqueness and foreign-key rules with one aggregation and no join.

    A key space is a data set's key (a unique key, or the parent side of foreign keys). Slot 0
    counts its own rows per key value, each further slot the rows of one child. Every data set
    is scanned once and emits its key values, which are counted per task before the exchange,
    so a hot key travels as a few rows. A key is duplicated if slot 0 counts more than one row
    and orphaned if a child slot counts rows and slot 0 none.
    """
    spaces: dict[tuple, int] = {}
    entries: dict[str, list[str]] = {}
    found: list[tuple[int, int, list[str]]] = []
    children: dict[int, int] = {}

    def emit(dataset: str, space: int, slot: int, columns: Sequence[str]) -> None:
        values = ", ".join(f"cast(`{c}` as string)" for c in columns)
        entry = f"struct({space} as space, {slot} as slot, array({values}) as key)"
        entries.setdefault(dataset, []).append(entry)

    def space_of(dataset: str, columns: Sequence[str]) -> int:
        name = (dataset, tuple(columns))
        if name not in spaces:
            spaces[name] = len(spaces)
            emit(dataset, spaces[name], 0, columns)
        return spaces[name]

    counted = ("failed", "total")
    for dataset, keys in unique:
        message = _counted("failed", "rows share a key")
        name = f"{'_'.join(keys)}_unique"
        row = result_row(name, dataset, "uniqueness", *counted, message)
        found.append((space_of(dataset, keys), 0, row))
    for rule in rules:
        space = space_of(rule.parent_dataset, [rule.parent_column])
        slot = children[space] = children.get(space, 0) + 1
        emit(rule.child_dataset, space, slot, [rule.child_column])
        message = _counted("failed", f"keys without a row in {rule.parent_dataset}")
        row = result_row(
            rule.name, rule.child_dataset, "integrity", *counted, message, rule.severity
        )
        found.append((space, slot, row))

    keys = union_all(
        [frames[d].selectExpr(f"inline(array({', '.join(e)}))") for d, e in entries.items()]
    ).filter("slot = 0 or key[0] is not null")
    slots = range(1 + max(children.values(), default=0))
    per_key = keys.groupBy("space", "key").agg(
        *[F.expr(f"count_if(slot = {i}) as s{i}") for i in slots]
    )
    bad = {i: "s0 = 0" if i else "s0 > 1" for i in slots}
    sums = [
        f"struct({i} as slot, sum(if({bad[i]}, s{i}, 0)) as failed, sum(s{i}) as total)"
        for i in slots
    ]
    per_slot = per_key.groupBy("space").agg(F.expr(f"array({', '.join(sums)}) as slots"))
    counts = per_slot.selectExpr("space", "inline(slots)")
    wanted = ", ".join(f"struct({space} as space, {slot} as slot)" for space, slot, _ in found)
    listed = spark.range(1).selectExpr(f"inline(array({wanted}))")
    # One row per rule on the left, at most one per space and slot on the right.
    matched = listed.join(F.broadcast(counts), ["space", "slot"], "left").selectExpr(
        "space",
        "slot",
        "coalesce(failed, 0) as failed",
        "coalesce(total, 0) as total",
    )
    cases = " ".join(
        f"when space = {space} and slot = {slot} then struct({', '.join(row)})"
        for space, slot, row in found
    )
    return matched.selectExpr(f"case {cases} end as result").selectExpr("result.*")


def summary(results: DataFrame) -> DataFrame:
    """One row: number of checks, passed, warnings, errors."""
    return results.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(F.col("status") == "PASS").alias("passed"),
        F.count_if(F.col("status") == "WARN").alias("warnings"),
        F.count_if(F.col("status") == "ERROR").alias("errors"),
    )


def report_document(results: DataFrame, generated_at: dt.datetime) -> DataFrame:
    """One row: the whole report as a nested document of ``generated_at_utc``, ``summary`` and ``results``.

    ``results`` are one row for each declared check, so they fit one row.
    """
    tallies = [
        F.count(F.lit(1)).alias("total_checks"),
        *[F.count_if(F.col("status") == s).alias(name) for s, name in (("PASS", "passed"), ("WARN", "warnings"), ("ERROR", "errors"))],
    ]
    listed = F.sort_array(F.collect_list(F.struct(*RESULT_COLUMNS)))
    whole = results.agg(*tallies, listed.alias("results"))
    at = generated_at.astimezone(dt.timezone.utc).isoformat()
    return whole.select(
        F.lit(at).alias("generated_at_utc"), F.struct("total_checks", "passed", "warnings", "errors").alias("summary"), "results"
    )


def gate(results: DataFrame) -> dict[str, int]:
    """Raise if a check ended in ERROR, else return the tallies."""
    row = summary(results).first().asDict()
    if row["errors"]:
        raise QualityGateError(f"quality gate failed: {row}")
    return row


# ---- model tests: each returns the failing rows, so no rows means the test passes ----------


def failing_not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows with a null; a blank text passes."""
    return df.filter(F.col(column).isNull())


def failing_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Non-null keys that occur more than once, with their number of rows."""
    rows = df.select(*keys).dropna()
    return (
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("duplicate_count"))
        .filter("duplicate_count > 1")
    )


def failing_relationships(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Child keys without a parent and how many rows hold them."""
    return missing_parents(child, column, parent, parent_column).select(
        F.col("key").alias(column), F.col("n").alias("row_count")
    )


def failing_accepted_values(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Values outside the list and how many rows hold them."""
    bad = df.filter(unaccepted.sql(column, accepted))
    return bad.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))


def reconcile_counts(left: dict[str, DataFrame], right: dict[str, DataFrame]) -> DataFrame:
    """Row counts of the data sets on both sides; all counts run side by side."""
    nothing = "cast(null as bigint)"
    counted = [
        frames[name].selectExpr(f"{literal(name)} as dataset", f"{ln} as l", f"{rn} as r")
        for name in left
        for frames, ln, rn in ((left, "count(1)", nothing), (right, nothing, "count(1)"))
    ]
    paired = union_all(counted).groupBy("dataset").agg(
        F.max("l").alias("source_count"), F.max("r").alias("target_count")
    )
    status = "if(source_count = target_count, 'PASS', 'ERROR') as status"
    return paired.selectExpr("*", status)

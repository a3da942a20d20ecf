"""Declared tests of built models, run as a suite whose failing rows are stored.

A test is declared by kind, model and column. The suite is compiled into few passes:

* tests that look at single rows (no nulls, a condition) become one pass of each model, which
  routes every row to all tests it fails. Their counts can also be observed while a model is
  written; models without an observed failure are then not read again.
* tests that look at keys (unique, accepted values, relationships) share one aggregation over the
  key columns of all models, without a join: see ``key_failures``.
* other tests state the frame of their failing rows.

All failing rows have one form, (test_name, failed_rows, failure), where ``failure`` is a JSON
document and ``failed_rows`` says for how many rows of the test's result it stands. The outcome of
the suite is a count over them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions import literal, unaccepted
from lakemart.operators.checks import union_all

FAILURE_COLUMNS = "test_name string, failed_rows bigint, failure string"
Frames = dict[str, DataFrame]


@dataclass(frozen=True)
class ModelTest:
    """One declared test. ``kind`` decides which of the fields after ``columns`` are used."""

    kind: str
    model: str
    columns: tuple[str, ...] = ()
    severity: str = "ERROR"
    parent: tuple[str, str] | None = None
    accepted: tuple[str, ...] = ()
    condition: str | None = None
    failing: Callable[[Frames], DataFrame] | None = None
    title: str | None = None

    @property
    def name(self) -> str:
        if self.title:
            return self.title
        target = [self.parent[0]] if self.parent else []
        return "_".join([self.kind, self.model, *self.columns, *target])

    def row_condition(self) -> str | None:
        """SQL that is true for a failing row, where single rows decide."""
        if self.kind == "not_null":
            return f"`{self.columns[0]}` is null"
        return self.condition


def not_null(model: str, column: str) -> ModelTest:
    """No null in the column; a blank text passes."""
    return ModelTest("not_null", model, (column,))


def unique(model: str, *columns: str, title: str | None = None) -> ModelTest:
    """No key twice. A single column's nulls are no keys; in a grain of several, nulls are equal."""
    return ModelTest("unique", model, columns, title=title)


def relationships(model: str, column: str, parent: str, parent_column: str) -> ModelTest:
    """Every value of the column, but null, is in the parent."""
    return ModelTest("relationships", model, (column,), parent=(parent, parent_column))


def accepted_values(model: str, column: str, accepted: Sequence[str]) -> ModelTest:
    """Every value of the column, but null, is in the list."""
    return ModelTest("accepted_values", model, (column,), accepted=tuple(accepted))


def condition(title: str, model: str, bad: str, severity: str = "ERROR") -> ModelTest:
    """No row for which the SQL condition ``bad`` is true."""
    return ModelTest("condition", model, severity=severity, condition=bad, title=title)


def query(title: str, model: str, failing: Callable[[Frames], DataFrame], severity: str = "ERROR") -> ModelTest:
    """No row in the frame that ``failing`` makes of the models."""
    return ModelTest("query", model, severity=severity, failing=failing, title=title)


# ---- tests of rows ------------------------------------------------------------------------


def as_json(columns: Iterable[str]) -> str:
    fields = ", ".join(f"'{c}', `{c}`" for c in columns)
    return f"to_json(named_struct({fields}), map('ignoreNullFields', 'false'))"


def failing_rows(df: DataFrame, tests: Sequence[ModelTest], shown: Sequence[str] | None = None) -> DataFrame:
    """Each row of one model once for every test it fails, from one scan; ``shown`` limits the stored columns."""
    document = as_json(shown or df.columns)
    routes = ", ".join(
        f"if({t.row_condition()}, struct({literal(t.name)} as test_name, 1L as failed_rows, {document} as failure), null)" for t in tests
    )
    return df.selectExpr(f"inline(filter(array({routes}), x -> x is not null))")


def observed(df: DataFrame, model: str, tests: Sequence[ModelTest]) -> tuple[DataFrame, Observation | None]:
    """``df`` that counts, while it is written, the failures of the row tests of ``model``."""
    counts = [
        F.expr(f"count_if({t.row_condition()})").alias(t.name) for t in tests if t.model == model and t.row_condition()
    ]
    if not counts:
        return df, None
    seen = Observation(f"tests of {model}")
    return df.observe(seen, *counts), seen


# ---- tests of keys ------------------------------------------------------------------------


def key_failures(frames: Frames, tests: Sequence[ModelTest]) -> DataFrame | None:
    """Failing keys of all key tests, from one aggregation over the key columns of all models.

    A key space is a set of columns whose values are counted; slot 0 counts the model's own rows,
    each further slot the rows of one child that refers to it. Every model is scanned once and
    emits its key values, which are counted in the task before the exchange, so that a hot key
    travels as one row a task. A key is duplicated if slot 0 counts more than one row, and orphaned
    if a child's slot counts rows and slot 0 none. An accepted-values test is a space of its own
    that only receives values outside its list.

    Whole numbers travel as the up to eight bytes they are, not as their digits: most keys are surrogate
    keys, which do not compress.
    """
    whole = lambda model, column: isinstance(frames[model].schema[column].dataType, T.IntegralType)
    # Keys that a child refers to by a column of another kind are compared as text.
    as_text = {t.parent for t in tests if t.kind == "relationships" and not whole(t.model, t.columns[0])}
    spaces: dict[tuple, int] = {}
    entries: dict[str, list[str]] = {}
    children: dict[int, int] = {}
    found: dict[int, list[str]] = {}

    def packed(model: str, column: str) -> bool:
        return whole(model, column) and (model, column) not in as_text

    def key_text(model: str, columns: Sequence[str], i: int) -> str:
        return f"cast(conv(hex(key[{i}]), 16, -10) as string)" if packed(model, columns[i]) else f"cast(key[{i}] as string)"

    def emit(model: str, space: int, slot: int, columns: Sequence[str], only: str | None = None, of: tuple[str, str] | None = None) -> None:
        """``of``: the parent's model and column, where the key is one of a child."""
        as_bytes = ["unhex(hex(cast({} as bigint)))" if packed(*(of or (model, c))) else "cast(cast({} as string) as binary)" for c in columns]
        values = ", ".join(form.format(f"`{c}`") for form, c in zip(as_bytes, columns, strict=True))
        # Nulls are no keys, but for grains of several columns.
        only = only or (f"`{columns[0]}` is not null" if len(columns) == 1 else "true")
        entry = f"if({only}, struct({space} as space, {slot} as slot, array({values}) as key), null)"
        entries.setdefault(model, []).append(entry)

    def space_of(model: str, columns: tuple[str, ...]) -> int:
        if (model, columns) not in spaces:
            spaces[model, columns] = len(spaces)
            emit(model, spaces[model, columns], 0, columns)
        return spaces[model, columns]

    def failure(test: ModelTest, bad: str, failed: str, fields: dict[str, str]) -> str:
        document = ", ".join(f"'{name}', {value}" for name, value in fields.items())
        shown = f"to_json(named_struct({document}), map('ignoreNullFields', 'false'))"
        return f"if({bad}, struct({literal(test.name)} as test_name, cast({failed} as bigint) as failed_rows, {shown} as failure), null)"

    for test in tests:
        column = test.columns[0] if test.columns else ""
        if test.kind == "unique":
            space = space_of(test.model, test.columns)
            shown = {c: key_text(test.model, test.columns, i) for i, c in enumerate(test.columns)}
            keys = {"unique_field": shown[column]} if len(test.columns) == 1 else shown
            route = failure(test, "s0 > 1", "1", keys | {"n_records": "s0"})
        elif test.kind == "relationships":
            space = space_of(test.parent[0], (test.parent[1],))
            slot = children[space] = children.get(space, 0) + 1
            emit(test.model, space, slot, (column,), of=test.parent)
            orphan = {"from_field": key_text(test.parent[0], test.parent[1:], 0), "n_records": f"s{slot}"}
            route = failure(test, f"s0 = 0 and s{slot} > 0", f"s{slot}", orphan)
        elif test.kind == "accepted_values":
            space = spaces[test.name,] = len(spaces)
            emit(test.model, space, 0, (column,), unaccepted.sql(f"`{column}`", test.accepted))
            route = failure(test, "s0 > 0", "1", {"value_field": key_text(test.model, test.columns, 0), "n_records": "s0"})
        else:
            continue
        found.setdefault(space, []).append(route)
    if not found:
        return None
    emitted = [frames[m].selectExpr(f"inline(filter(array({', '.join(e)}), x -> x is not null))") for m, e in entries.items()]
    slots = range(1 + max(children.values(), default=0))
    per_key = union_all(emitted).groupBy("space", "key").agg(*[F.expr(f"count_if(slot = {i})").alias(f"s{i}") for i in slots])
    routes = " ".join(f"when {space} then array({', '.join(r)})" for space, r in found.items())
    return per_key.selectExpr(f"inline(filter(case space {routes} end, x -> x is not null))")


# ---- the suite ----------------------------------------------------------------------------


def failures(
    frames: Frames, tests: Sequence[ModelTest], counted: dict[str, int] | None = None, shown: dict[str, Sequence[str]] | None = None,
) -> DataFrame:
    """(test_name, failed_rows, failure) of all tests over the models ``frames``.

    ``counted`` holds the failures of row tests that were observed while models were written;
    tests known to have none are left out, and a model with no others is not read for them.
    ``shown`` names the columns of a model's failing rows that are stored, else all.
    """
    counted, shown = counted or {}, shown or {}
    parts = []
    by_model: dict[str, list[ModelTest]] = {}
    for test in tests:
        if test.row_condition() and counted.get(test.name) != 0:
            by_model.setdefault(test.model, []).append(test)
        if test.failing:
            rows = test.failing(frames)
            parts.append(rows.selectExpr(f"{literal(test.name)} as test_name", "1L as failed_rows", f"{as_json(rows.columns)} as failure"))
    parts += [failing_rows(frames[model], of, shown.get(model)) for model, of in by_model.items()]
    keys = key_failures(frames, tests)
    if keys is not None:
        parts.append(keys)
    if not parts:
        return next(iter(frames.values())).sparkSession.createDataFrame([], FAILURE_COLUMNS)
    return union_all(parts)


def outcome(spark: SparkSession, failed: DataFrame, tests: Sequence[ModelTest]) -> DataFrame:
    """(test_name, model, kind, severity, status, failed_rows): one row for each declared test."""
    declared = ", ".join(
        "struct(" + ", ".join(
            f"{literal(value)} as {name}"
            for name, value in (("test_name", t.name), ("model", t.model), ("kind", t.kind), ("severity", t.severity))
        ) + ")"
        for t in tests
    )
    listed = spark.range(1).selectExpr(f"inline(array({declared}))")
    # At most one row for each declared test on the right.
    counts = F.broadcast(failed.groupBy("test_name").agg(F.sum("failed_rows").alias("failed_rows")))
    return listed.join(counts, "test_name", "left").selectExpr(
        "test_name", "model", "kind", "severity", "if(failed_rows > 0, severity, 'PASS') as status", "coalesce(failed_rows, 0L) as failed_rows"
    )


def check_names(tests: Sequence[ModelTest]) -> None:
    """Raise if two tests share a name: their failures could not be told apart."""
    names = [t.name for t in tests]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"tests declared twice: {twice}")

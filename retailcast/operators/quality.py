"""Data-quality analyzers and constraint checks (Q-series).

All analyzers of a run compile to aggregate expressions evaluated in ONE
``agg`` over the input (single scan, map-side partial aggregation); the
one-row result is unpivoted to the long ``(entity, instance, name, value)``
metric table. Uniqueness needs a per-key count, i.e. one extra grouped pass.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailcast.contract import FLAG_COLUMNS, WEEKDAY_NAMES


@dataclass(frozen=True)
class Analyzer:
    entity: str
    instance: str
    name: str
    expr: Column


def size() -> Analyzer:
    return Analyzer("Dataset", "*", "Size", F.count(F.lit(1)).cast("double"))


def completeness(c: str) -> Analyzer:
    return Analyzer("Column", c, "Completeness", F.avg(F.col(c).isNotNull().cast("double")))


#: log2 of the registers of a distinct sketch: a relative error of about 0.8 %.
LG_REGISTERS = 14


def distinct_sketch(c: str) -> Column:
    """A mergeable sketch of a column's distinct values (HLL); values of any type by their hash."""
    return F.hll_sketch_agg(F.when(F.col(c).isNotNull(), F.xxhash64(c)), LG_REGISTERS)


def approx_distinct(c: str) -> Analyzer:
    return Analyzer("Column", c, "ApproxCountDistinct", F.hll_sketch_estimate(distinct_sketch(c)).cast("double"))


def mean(c: str) -> Analyzer:
    return Analyzer("Column", c, "Mean", F.avg(F.col(c).cast("double")))


def minimum(c: str) -> Analyzer:
    return Analyzer("Column", c, "Minimum", F.min(F.col(c).cast("double")))


def maximum(c: str) -> Analyzer:
    return Analyzer("Column", c, "Maximum", F.max(F.col(c).cast("double")))


def compliance(name: str, predicate: str) -> Analyzer:
    """Share of rows for which the SQL predicate is true (NULL counts as false)."""
    return Analyzer("Column", name, "Compliance",
                    F.avg(F.coalesce(F.expr(predicate), F.lit(False)).cast("double")))


def correlation(a: str, b: str) -> Analyzer:
    return Analyzer("Mutlicolumn", f"{a},{b}", "Correlation",
                    F.corr(F.col(a).cast("double"), F.col(b).cast("double")))


def contained_in(c: str, values: list) -> Analyzer:
    """Share of rows whose value is in the list; NULL passes."""
    ok = F.col(c).isNull() | F.col(c).isin(*values)
    return Analyzer("Column", c, "Compliance", F.avg(ok.cast("double")))


# ---- fixed values: the analyzer set of the quality job ----
def default_analyzers() -> list[Analyzer]:
    return [
        size(),
        completeness("record_id"), completeness("date"), completeness("store_id"),
        completeness("units_sold"), completeness("base_price"),
        approx_distinct("store_id"), approx_distinct("day_of_week"),
        mean("units_sold"), mean("base_price"), mean("discount_pct"),
        mean("max_temp_c"), mean("rainfall_mm"),
        compliance("non_negative_units_sold", "units_sold >= 0"),
        compliance("valid_discount_range", "discount_pct >= 0 AND discount_pct <= 1"),
        compliance("positive_base_price", "base_price > 0"),
        correlation("units_sold", "base_price"),
        correlation("units_sold", "max_temp_c"),
    ]


def run_analyzers(df: DataFrame, analyzers: list[Analyzer]) -> DataFrame:
    """Q7: evaluate all analyzers in one aggregation, return the long metric table."""
    wide = df.agg(*[a.expr.alias(f"m{i}") for i, a in enumerate(analyzers)])
    stack = ", ".join(f"'{a.entity}', '{a.instance}', '{a.name}', m{i}" for i, a in enumerate(analyzers))
    return wide.selectExpr(f"stack({len(analyzers)}, {stack}) as (entity, instance, name, value)")


def uniqueness(df: DataFrame, *cols: str) -> DataFrame:
    """Q12/Q17: share of rows whose key occurs exactly once (NULL keys ignored).

    One grouped pass over the key; partial aggregation bounds the shuffle to
    one row per key per task even when a key is hot."""
    keyed = df.filter(F.greatest(*[F.col(c).isNull() for c in cols]) == False) \
        if len(cols) > 1 else df.filter(F.col(cols[0]).isNotNull())  # noqa: E712
    per = keyed.groupBy(*cols).agg(F.count(F.lit(1)).alias("cnt"))
    return per.agg(F.try_divide(F.sum(F.when(F.col("cnt") == 1, 1).otherwise(0)).cast("double"),
                                F.sum("cnt").cast("double")).alias("value"))


@dataclass(frozen=True)
class Constraint:
    """A named assertion over one metric value."""
    description: str
    analyzer: Analyzer | None
    assertion: str              # "value <op> number", e.g. "value >= 500"
    unique_cols: tuple = ()     # uniqueness constraints use the grouped pass


# ---- fixed values: the constraint set of the quality check ----
def default_constraints() -> list[Constraint]:
    cs = [
        Constraint("SizeConstraint(Size(None))", size(), "value >= 500"),
        Constraint("MinimumConstraint(Minimum(units_sold,None))", minimum("units_sold"), "value >= 0"),
        Constraint("MaximumConstraint(Maximum(discount_pct,None))", maximum("discount_pct"), "value <= 1.0"),
    ]
    for c in ("record_id", "date", "store_id", "units_sold"):
        cs.append(Constraint(f"CompletenessConstraint(Completeness({c},None))", completeness(c), "value = 1.0"))
    cs.append(Constraint("UniquenessConstraint(Uniqueness(List(record_id),None))", None, "value = 1.0",
                         ("record_id",)))
    cs.append(Constraint("ComplianceConstraint(Compliance(day_of_week contained in "
                         + ",".join(WEEKDAY_NAMES) + ",None))",
                         contained_in("day_of_week", WEEKDAY_NAMES), "value = 1.0"))
    for c in FLAG_COLUMNS:
        cs.append(Constraint(f"ComplianceConstraint(Compliance({c} contained in 0,1,None))",
                             contained_in(c, [0, 1]), "value = 1.0"))
    return cs


def _constraint_array(df: DataFrame, constraints: list[Constraint]) -> DataFrame:
    """One row holding an array with one struct per constraint: metadata,
    metric value and verdict. Column metrics come from one aggregation,
    uniqueness from one grouped pass (a scalar subquery); the array length
    is the (code-sized) constraint list, never data-sized."""
    plain = [(i, c) for i, c in enumerate(constraints) if c.analyzer is not None]
    base = df.agg(*[c.analyzer.expr.alias(f"m{i}") for i, c in plain]) if plain \
        else df.sparkSession.range(1).select(F.lit(1).alias("_one"))
    structs = []
    for i, c in enumerate(constraints):
        value = F.col(f"m{i}") if c.analyzer is not None else \
            uniqueness(df, *c.unique_cols).select("value").scalar()
        entity = c.analyzer.entity if c.analyzer else "Column"
        instance = c.analyzer.instance if c.analyzer else ",".join(c.unique_cols)
        name = c.analyzer.name if c.analyzer else "Uniqueness"
        structs.append(F.struct(F.lit(i).alias("idx"), F.lit(c.description).alias("constraint"),
                                F.lit(entity).alias("entity"), F.lit(instance).alias("instance"),
                                F.lit(name).alias("name"), value.cast("double").alias("value")))
    arr = base.select(F.array(*structs).alias("cs"))
    # verdict: each assertion applied to its own element's value
    verdict = F.transform("cs", lambda x: x.withField("ok", F.coalesce(_assert_expr(constraints, x),
                                                                       F.lit(False))))
    return arr.select(verdict.alias("cs"))


def _assert_expr(constraints: list[Constraint], x):
    """Per-element assertion, dispatched on the element index."""
    e = None
    for i, c in enumerate(constraints):
        a = _compare(x["value"], c.assertion)
        e = F.when(x["idx"] == i, a) if e is None else e.when(x["idx"] == i, a)
    return e


def _compare(v, assertion: str):
    """`value <op> number` assertions as column comparisons."""
    _, op, num = assertion.split()
    n = float(num)
    return {">=": v >= n, "<=": v <= n, ">": v > n, "<": v < n, "=": v == n, "==": v == n}[op]


def _constraint_values(df: DataFrame, constraints: list[Constraint]) -> DataFrame:
    """One row per constraint: (idx, constraint, entity, instance, name, value, ok)."""
    return _constraint_array(df, constraints).select(F.inline("cs"))


def check_results(df: DataFrame, constraints: list[Constraint] | None = None,
                  check: str = "daily sales quality", level: str = "Error") -> DataFrame:
    """Q14: per-constraint status rows; `check_status` is the overall verdict."""
    cs = constraints or default_constraints()
    arr = _constraint_array(df, cs)
    overall = F.when(F.forall("cs", lambda x: x["ok"]), "Success").otherwise(level)
    res = arr.select(overall.alias("check_status"), F.inline("cs"))
    status = F.when(F.col("ok"), "Success").otherwise("Failure")
    return res.select(
        F.lit(check).alias("check"), F.lit(level).alias("check_level"),
        "check_status", "constraint", status.alias("constraint_status"),
        F.when(~F.col("ok"), F.concat(F.lit("Value: "), F.col("value").cast("string"),
                                      F.lit(" does not meet the constraint requirement!")))
        .otherwise(F.lit("")).alias("constraint_message"))


def success_metrics(df: DataFrame, constraints: list[Constraint] | None = None) -> DataFrame:
    """Q15: the metrics behind the checks, long form."""
    cs = constraints or default_constraints()
    return _constraint_values(df, cs).select("entity", "instance", "name", "value")


# ---------------------------------------------------------------- metrics that add up

def metric_state(df: DataFrame, by: list[str], numeric: list[str], distinct: list[str], pairs: list[tuple[str, str]] = ()) -> DataFrame:
    """Q3/Q7 by period: one row per ``by`` with counts, moments and distinct sketches, in one pass.

    Rows of further periods are appended; ``merged_metrics`` adds the rows up, so that a day's
    metrics are never computed again."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for c in dict.fromkeys([*numeric, *distinct]):
        aggs.append(F.count(c).alias(f"{c}__n"))
    for c in numeric:
        v = F.col(c).cast("double")
        aggs += [F.sum(v).alias(f"{c}__s"), F.sum(v * v).alias(f"{c}__s2"), F.min(v).alias(f"{c}__lo"), F.max(v).alias(f"{c}__hi")]
    aggs += [distinct_sketch(c).alias(f"{c}__hll") for c in distinct]
    for a, b in pairs:
        x, y = (F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), F.col(c).cast("double")) for c in (a, b))
        aggs += [F.count(x).alias(f"{a}__{b}__n"), *[F.sum(e).alias(f"{a}__{b}__{k}") for k, e in (("x", x), ("y", y), ("xx", x * x), ("yy", y * y), ("xy", x * y))]]
    return df.groupBy(*by).agg(*aggs)


def merged_metrics(state: DataFrame, numeric: list[str], distinct: list[str], pairs: list[tuple[str, str]] = ()) -> DataFrame:
    """(entity, instance, name, value) of all periods of ``metric_state`` rows together."""
    t = state.agg(*[(F.hll_union_agg if c.endswith("__hll") else F.min if c.endswith("__lo") else F.max if c.endswith("__hi") else F.sum)(c).alias(c)
                    for c, kind in state.dtypes if c == "rows" or "__" in c])
    out = [("Dataset", "*", "Size", F.col("rows").cast("double"))]
    for c in dict.fromkeys([*numeric, *distinct]):
        out.append(("Column", c, "Completeness", F.try_divide(F.col(f"{c}__n").cast("double"), F.col("rows"))))
    for c in numeric:
        n, s1, s2 = (F.col(f"{c}__{k}").cast("double") for k in ("n", "s", "s2"))
        out += [("Column", c, "Mean", F.try_divide(s1, n)), ("Column", c, "Minimum", F.col(f"{c}__lo")), ("Column", c, "Maximum", F.col(f"{c}__hi")),
                ("Column", c, "StandardDeviation", F.sqrt(F.greatest(F.try_divide(s2, n) - F.pow(F.try_divide(s1, n), 2), F.lit(0.0))))]
    out += [("Column", c, "ApproxCountDistinct", F.hll_sketch_estimate(f"{c}__hll").cast("double")) for c in distinct]
    for a, b in pairs:
        n, x, y, xx, yy, xy = (F.col(f"{a}__{b}__{k}").cast("double") for k in ("n", "x", "y", "xx", "yy", "xy"))
        out.append(("Mutlicolumn", f"{a},{b}", "Correlation", F.try_divide(n * xy - x * y, F.sqrt(n * xx - x * x) * F.sqrt(n * yy - y * y))))
    wide = t.select(*[e.alias(f"m{i}") for i, (*_, e) in enumerate(out)])
    stack = ", ".join(f"'{e}', '{i}', '{n}', m{k}" for k, (e, i, n, _) in enumerate(out))
    return wide.selectExpr(f"stack({len(out)}, {stack}) as (entity, instance, name, value)")


# ---------------------------------------------------------------- suggestions

def _few_values(columns: list[str], most: int):
    """Distinct values of each column of a task, given up beyond ``most``."""
    def run(batches):
        held: dict[str, set | None] = {c: set() for c in columns}
        for batch in batches:
            for i, c in enumerate(columns):
                if held[c] is not None:
                    held[c].update(x for x in pc.unique(batch.column(i)).to_pylist() if x is not None)
                    if len(held[c]) > most:
                        held[c] = None
        rows = [(c, v, False) for c, some in held.items() for v in some or ()] + [(c, None, True) for c, some in held.items() if some is None]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.string(), pa.bool_()))], ["column", "value", "over"])
    return run


#: Rows looked at first, for columns that certainly have too many values.
PROOF_ROWS = 2_000


def few_values(df: DataFrame, columns: list[str], most: int) -> dict[str, list[str]]:
    """The distinct non-NULL values, as text in order (numbers by value), of the columns that have at most
    ``most``: exact, and bounded by columns x ``most`` rows a task and on the driver."""
    # some rows prove that a column has more values than that; only the others are searched
    some = df.select(*[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(columns)]).limit(PROOF_ROWS).toArrow()
    columns = [c for i, c in enumerate(columns) if pc.count_distinct(some.column(i), mode="only_valid").as_py() <= most]
    if not columns:
        return {}
    texts = df.select(*[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(columns)])
    per = texts.mapInArrow(_few_values(columns, most), "column string, value string, over boolean").groupBy("column", "value").agg(F.bool_or("over").alias("over"))
    fits = per.groupBy("column").agg(F.count("value").alias("n"), F.bool_or("over").alias("over")).filter(~F.col("over") & (F.col("n") <= most))
    rows = per.join(fits.select("column"), "column").filter("value IS NOT NULL").select("column", "value", F.col("value").try_cast("double").alias("number")).collect()
    out: dict[str, list] = {}
    for r in rows:
        out.setdefault(r["column"], []).append((r["number"] is None, r["number"] or 0.0, r["value"]))
    return {c: [v for _, _, v in sorted(x)] for c, x in out.items()}


def completeness_bound(share: Column, n: Column) -> Column:
    """The lower end of the 95 % interval of a share of ``n`` rows, cut to two decimals."""
    return F.floor(F.greatest(share - F.lit(1.96) * F.sqrt(share * (F.lit(1.0) - share) / n), F.lit(0.0)) * 100) / 100


def suggest_constraints(df: DataFrame, columns: list[str] | None = None,
                        max_categories: int = 10) -> DataFrame:
    """Q16: propose constraints from a column profile (our rule set):
    complete -> isComplete; partly complete -> hasCompleteness at the lower confidence bound;
    string parsable as number -> hasDataType; at most ``max_categories`` distinct values, counted
    exactly -> isContainedIn with the observed values; numeric min >= 0 -> isNonNegative."""
    cols = columns or df.columns
    types = dict(df.dtypes)
    aggs = [F.count(F.lit(1)).cast("double").alias("__rows")]
    for c in cols:
        aggs.append(F.avg(F.col(c).isNotNull().cast("double")).alias(f"{c}__compl"))
        if types[c] == "string":
            aggs.append(F.avg(F.when(F.col(c).isNotNull(),
                                     F.col(c).try_cast("double").isNotNull().cast("double"))).alias(f"{c}__num"))
        else:
            aggs.append(F.min(F.col(c).cast("double")).alias(f"{c}__min"))
    prof = df.agg(*aggs)
    known = few_values(df, cols, max_categories)
    structs = []
    for c in cols:
        compl = F.col(f"{c}__compl")
        values = ", ".join('"' + v.replace("\\", "\\\\").replace('"', '\\"') + '"' for v in known.get(c, []))
        rules = [
            (compl == 1.0, "CompleteIfCompleteRule", F.lit(f".isComplete(\"{c}\")"),
             f"'{c}' is not null"),
            ((compl < 1.0) & (compl > 0), "RetainCompletenessRule",
             F.format_string(f".hasCompleteness(\"{c}\", _ >= %.2f)", completeness_bound(compl, F.col("__rows"))),
             f"'{c}' has less than full completeness"),
            (F.lit(c in known), "CategoricalRangeRule",
             F.lit(f".isContainedIn(\"{c}\", Array({values}))"),
             f"'{c}' has value range of at most {max_categories} values"),
        ]
        if types[c] == "string":
            rules.append((F.col(f"{c}__num") == 1.0, "RetainTypeRule",
                          F.lit(f".hasDataType(\"{c}\", ConstrainableDataTypes.Numeric)"),
                          f"'{c}' has numeric type"))
        else:
            rules.append((F.col(f"{c}__min") >= 0, "NonNegativeNumbersRule",
                          F.lit(f".isNonNegative(\"{c}\")"), f"'{c}' has no negative values"))
        for cond, rule, code, desc in rules:
            structs.append(F.when(F.coalesce(cond, F.lit(False)), F.struct(
                F.lit(c).alias("column_name"), F.lit(rule).alias("rule"),
                F.lit(desc).alias("description"), code.alias("code_for_constraint"))))
    # One profile row -> inline its (bounded, per-column) suggestion array.
    return (prof.select(F.inline(F.filter(F.array(*structs), lambda x: x.isNotNull()))))

"""Cell-by-cell comparison of two tables within a numeric tolerance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def compare_tables(actual: DataFrame, golden: DataFrame, keys: list[str], tol: float = 1e-3) -> DataFrame:
    """Differences as rows ``keys, issue, column_name, actual, golden``.

    Issues: ``value`` (a cell differs), ``missing`` (row only in golden), ``extra`` (row
    only in actual), ``duplicate`` (a key occurs a different number of times, more than
    once on a side), ``rows`` (of a repeated key: how many different rows only one side
    has), ``column`` (a column of one side only, keys NULL). Numbers match within ``tol``,
    also where both sides hold them as text, everything else exactly; NULL matches NULL.
    The rows of a repeated key match exactly or not at all. Equal rows are counted before
    they meet by key, so repeats neither multiply nor pile up in a task.
    """
    shared = [c for c in golden.columns if c in actual.columns and c not in keys]
    types = dict(zip(golden.columns, [f.dataType for f in golden.schema.fields]))
    sides = _side(actual, keys, shared, "a").unionByName(_side(golden, keys, shared, "g"))
    counts = [F.count(F.when(F.col("__side") == side, 1)).alias(f"__{side}") for side in "ag"]
    contents = sides.groupBy(*keys, *[F.col(f"`{c}`") for c in shared]).agg(*counts)

    def one(side: str, name: str) -> Column:
        return F.max(F.when(F.col(f"__{side}") > 0, F.col(f"`{name}`")))

    totals = [F.sum(f"__{side}").alias(f"__n_{side}") for side in "ag"]
    only = [F.count(F.when(F.col(f"__{b}") == 0, 1)).alias(f"__only_{a}") for a, b in ("ag", "ga")]
    cells = [one(side, name).alias(f"__{side}_{name}") for name in shared for side in "ag"]
    merged = contents.groupBy(*keys).agg(*totals, *only, *cells)

    n_actual, n_golden = F.col("__n_a"), F.col("__n_g")
    repeated = (n_actual > 1) | (n_golden > 1)
    row_issue = (
        F.when(n_actual == 0, "missing")
        .when(n_golden == 0, "extra")
        .when(repeated & (n_actual != n_golden), "duplicate")
    )
    row_entry = F.when(row_issue.isNotNull(), _entry(row_issue, None, n_actual, n_golden))
    both = (n_actual > 0) & (n_golden > 0)
    unlike = both & repeated & ((F.col("__only_a") > 0) | (F.col("__only_g") > 0))
    rows_entry = F.when(unlike, _entry(F.lit("rows"), None, F.col("__only_a"), F.col("__only_g")))
    differing = [F.when(both & ~repeated, _cell(name, types[name], tol)) for name in shared]
    found = F.array_compact(F.array(row_entry, rows_entry, *differing))
    out = merged.select(*keys, F.explode(found).alias("d")).select(*keys, "d.*")
    lone = [(c, "present", None) for c in actual.columns if c not in golden.columns]
    lone += [(c, None, "present") for c in golden.columns if c not in actual.columns]
    if not lone:
        return out
    fields = "column_name string, actual string, golden string"
    columns = golden.sparkSession.createDataFrame(lone, fields)
    nulls = [F.lit(None).cast(types[k]).alias(k) for k in keys]
    return out.unionByName(columns.select(*nulls, F.lit("column").alias("issue"), "column_name", "actual", "golden"))


def _entry(issue: Column, name: str | None, actual: Column, golden: Column) -> Column:
    return F.struct(
        issue.alias("issue"),
        F.lit(name).cast("string").alias("column_name"),
        actual.cast("string").alias("actual"),
        golden.cast("string").alias("golden"),
    )


def _side(df: DataFrame, keys: list[str], values: list[str], side: str) -> DataFrame:
    return df.select(*keys, *[F.col(f"`{v}`") for v in values], F.lit(side).alias("__side"))


def _cell(name: str, dtype: T.DataType, tol: float) -> Column:
    a, g = F.col(f"`__a_{name}`"), F.col(f"`__g_{name}`")
    same = a.eqNullSafe(g)
    if isinstance(dtype, (T.NumericType, T.StringType)):
        # Text that is no number on both sides gives NULL here and stays exact.
        close = F.abs(a.try_cast("double") - g.try_cast("double")) <= tol
        same = same | F.coalesce(close, F.lit(False))
    return F.when(~same, _entry(F.lit("value"), name, a, g))


def comparison_summary(differences: DataFrame) -> DataFrame:
    """Number of differences per issue and column."""
    return differences.groupBy("issue", "column_name").agg(F.count(F.lit(1)).alias("n"))

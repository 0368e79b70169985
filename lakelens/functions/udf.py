"""§2.16 extension points: named column functions, row/batch maps, the reply
hook and a metric registry.  Column functions stay inside Catalyst; only
``map_batches`` and a user reply hook run Python, in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ColumnRegistry(dict):
    """name -> Callable[[Column], Column]; ``register`` works as a decorator."""

    def register(self, name: str):
        def deco(fn: Callable[[Column], Column]):
            self[name] = fn
            return fn
        return deco

    def apply_all(self, df: DataFrame, col: str, name_col: str = "strategy", out: str = "out") -> DataFrame:
        """Every registered function on every row: rows x names (names are literals)."""
        names = F.array(*[F.lit(n) for n in self])
        d = df.select("*", F.explode(names).alias(name_col))
        expr = None
        for n, fn in self.items():
            e = fn(F.col(col))
            expr = F.when(F.col(name_col) == n, e) if expr is None else expr.when(F.col(name_col) == n, e)
        return d.withColumn(out, expr)


def map_rows(df: DataFrame, exprs: dict[str, Column], drop: list[str] | tuple = ()) -> DataFrame:
    """Row map as column expressions (the fast path)."""
    return df.withColumns(exprs).drop(*drop)


def map_batches(df: DataFrame, fn: Callable, schema: str, keep: list[str] | None = None) -> DataFrame:
    """Batched map in pandas (Arrow); ``keep`` selects the input columns given to
    ``fn`` (the others are removed, like a batched map that drops columns)."""
    src = df.select(*keep) if keep else df

    def run(it: Iterator):
        for pdf in it:
            yield fn(pdf)
    return src.mapInPandas(run, schema)


def provide_replies(prompts: DataFrame, key_cols: list[str], replies: DataFrame | None = None,
                    fn: Callable | None = None, reply_col: str = "reply") -> DataFrame:
    """prompt -> reply.  Default: equi-join to a landed replies table (no
    network from executors).  Or a user hook ``fn(pandas.DataFrame) ->
    pandas.Series`` run with mapInPandas; a failed call should give None,
    which the parser treats as a parse failure."""
    if replies is not None:
        return prompts.join(replies.select(*key_cols, reply_col), key_cols, "left")
    if fn is None:
        raise ValueError("give a replies table or a hook")
    schema = prompts.schema.add(reply_col, "string")

    def run(it):
        for pdf in it:
            pdf = pdf.copy()
            pdf[reply_col] = fn(pdf)
            yield pdf
    return prompts.mapInPandas(run, schema)


def metric_registry() -> dict[str, Callable]:
    """Scorer by name (as accepted by model selection helpers)."""
    from ..operators import metrics
    return {"accuracy": metrics.accuracy, "roc_auc": metrics.roc_auc, "f1": metrics.f1_binary,
            "f1_weighted": metrics.f1_weighted, "regression": metrics.regression_metrics}


def score_by_name(df: DataFrame, name: str, **cols) -> DataFrame:
    """Run the registered scorer ``name`` and return one ``(metric, value)`` row
    (the scorer is a plain aggregate, so this is one pass over ``df``)."""
    out = metric_registry()[name](df, **cols)
    first = out.columns[0]
    return out.select(F.lit(name).alias("metric"), F.col(first).cast("double").alias("value"))
